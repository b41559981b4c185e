"""Token ids as files of directly addressable codes.

A segment holds a run of ids. Each id is split into chunks, lowest first; a
level holds the chunks of those ids that reach it, packed at the level's width,
and a bitmap that says which of them continue in the next level. A directory
of ranks (ones before every 256th bit) and a count of bits inside that stretch
give an id's place in the next level. So any id is read by one chunk and one
rank per level; nothing before it is decoded. The widths of the levels are
those that take the fewest bits for the segment's own ids, a visit to a further
level counted as a bit.

Segment (little-endian, sections padded to 8 bytes)::

    b"DACTOK01" | u32 partition, u32 number in it | u64 ids, u64 documents, u32 levels, u32 0
    documents: i64 doc ids | u8 flags (1: id is null, 2: goes on in the next segment,
               4: comes from the one before) | u64 first place of each document
    level: u32 width, u32 0, u64 entries | chunks, and but for the last | continuation bits | u32 ranks

Writing: documents are dealt by ranges of (doc_id, text hash) and sorted, so
partitions follow each other in the order of the ids; a task encodes its texts
and cuts the ids into segments of ``segment_ids``; each becomes one file (the
text writer with one row per file; ``END`` is its separator), so the archive is
committed like any Spark output. A segment's size is bounded whatever the
length of a document; long documents go over several segments.

Reading: the binary file source; a segment's header has its partition, its
number and its ids, from which sums per partition (one row per partition of
the writer) give the place of its first id in the whole archive.

Texts are encoded in pieces cut before a blank or line feed that follows some
other character. A pre-tokenizer that never lets a token begin before and end
behind such a place (byte-level with its own pattern) gives the same ids as
for the whole text; other tokenizers get whole texts. Ids of pieces are kept
in a bounded cache, since words come again.

Defined results: a null text is an empty one and holds the end id only; null
doc ids come first; rows that share a doc id come in the order of their text
hashes, each as a document of its own; an empty table gives an archive without
segments and no rows; extra columns play no part.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import col, materialize, scratch_path, table

MAGIC, END = b"DACTOK01", "DACTOKEND\n"
HEAD, LEVEL = "<8sIIQQII", "<IIQ"
HEAD_BYTES, LEVEL_BYTES = struct.calcsize(HEAD), struct.calcsize(LEVEL)
#: Bits between two entries of a rank directory.
STRETCH = 256
SEGMENT_IDS = 1 << 21
#: What it costs to visit a further level for an id, in bits of space.
VISIT_BITS = 1.0
#: Pieces whose ids a task keeps.
CACHE = 600_000
#: Characters that are cut up at once.
BATCH_CHARS = 8 << 20
#: New pieces that are encoded as one text.
TOGETHER = 64
NULL_ID, GOES_ON, CAME_IN = 1, 2, 4


# --- codes ------------------------------------------------------------------

def widths_for(ids: np.ndarray) -> list[int]:
    """Chunk widths of least cost: chunks, continuation bits, ranks, and visits
    to further levels."""
    need = np.maximum(np.frexp(ids.astype(np.float64))[1], 1) if len(ids) else np.ones(1, np.int64)
    top = int(need.max())
    count = np.bincount(need, minlength=top + 1)
    reach = np.cumsum(count[::-1])[::-1]                       # ids of at least so many bits
    per_bit = 1 + 32 / STRETCH
    best: list[tuple[float, list[int]]] = [(0.0, [])] * (top + 1)
    for done in range(top - 1, -1, -1):                         # bits below ``done`` are placed already
        here = int(reach[done + 1])
        visit = VISIT_BITS if done else 0.0
        best[done] = min((here * (w + visit + (per_bit if done + w < top else 0)) + best[done + w][0], [w, *best[done + w][1]])
                         for w in range(1, top - done + 1))
    return best[0][1]


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def _pack(values: np.ndarray, width: int) -> bytes:
    out = []
    for at in range(0, len(values), 1 << 16):                   # whole bytes: a multiple of 8 values
        part = values[at:at + (1 << 16)].astype("<u2" if width <= 16 else "<u4")
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), -1), axis=1, bitorder="little", count=width)
        out.append(np.packbits(bits.ravel(), bitorder="little").tobytes())
    return _padded(b"".join(out)) + bytes(8)                    # a word is read behind the last one


def encode(ids: np.ndarray) -> bytes:
    """The levels of a segment."""
    widths = widths_for(ids)
    out, rest = [], ids.astype(np.uint32)
    for k, width in enumerate(widths):
        chunk = rest & np.uint32((1 << width) - 1)
        out += [struct.pack(LEVEL, width, 0, len(rest)), _pack(chunk, width)]
        if k + 1 == len(widths):                                # nothing goes on behind the last level
            break
        rest = rest >> np.uint32(width)
        goes = rest > 0
        bits = np.packbits(goes, bitorder="little").tobytes()
        words = np.frombuffer(bits + bytes(-len(bits) % (STRETCH // 8)) + bytes(STRETCH // 8), np.uint64)
        ones = np.bitwise_count(words).reshape(-1, STRETCH // 64).sum(axis=1)
        ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.uint32)
        out += [words.tobytes(), _padded(ranks.tobytes())]
        rest = rest[goes]
    return struct.pack("<I", len(widths)) + b"".join(out)


class Codes:
    """Random access to the ids of one segment's levels."""

    def __init__(self, data, at: int, levels: int):
        self.levels = []
        for k in range(levels):
            width, _, n = struct.unpack_from(LEVEL, data, at)
            at += LEVEL_BYTES
            size = -(-(n * width) // 8)
            size += -size % 8 + 8
            chunks = np.frombuffer(data, np.uint64, size // 8, at)
            at += size
            if k + 1 == levels:
                self.levels.append((width, n, chunks, None, None))
                break
            size = -(-n // 8)
            size += -size % (STRETCH // 8) + STRETCH // 8
            words = np.frombuffer(data, np.uint64, size // 8, at)
            at += size
            ranks = np.frombuffer(data, np.uint32, size // (STRETCH // 8), at)
            at += 4 * len(ranks) + -4 * len(ranks) % 8
            self.levels.append((width, n, chunks, words, ranks))
        self.end = at

    def __len__(self) -> int:
        return self.levels[0][1] if self.levels else 0

    def __getitem__(self, place: int) -> int:
        return int(self.at(np.array([place], np.int64))[0])

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at these places (uint32)."""
        out = np.zeros(len(places), np.uint32)
        who, place, shift = np.arange(len(places)), places.astype(np.int64), 0
        for k, (width, _, chunks, words, ranks) in enumerate(self.levels):
            bit = place * width
            word, off = bit >> 6, (bit & 63).astype(np.uint64)
            got = chunks[word] >> off
            far = off + np.uint64(width) > 64
            if far.any():
                got[far] |= chunks[word[far] + 1] << (np.uint64(64) - off[far])
            out[who] |= ((got & np.uint64((1 << width) - 1)) << np.uint64(shift)).astype(np.uint32)
            if k + 1 == len(self.levels):
                break
            word, off = place >> 6, (place & 63).astype(np.uint64)
            goes = (words[word] >> off) & np.uint64(1) == 1
            who, place, word, off = who[goes], place[goes], word[goes], off[goes]
            if not len(who):
                break
            stretch = place // STRETCH
            rank = ranks[stretch].astype(np.int64)
            for back in range(STRETCH // 64 - 1):                # the whole words before it in its stretch
                w = stretch * (STRETCH // 64) + back
                rank += np.where(w < word, np.bitwise_count(words[np.minimum(w, word)]), 0)
            rank += np.bitwise_count(words[word] & ((np.uint64(1) << off) - np.uint64(1)))
            place, shift = rank, shift + width
        return out

    def _rank(self, level: int, place: int) -> int:
        """How many of the level's first ``place`` entries go on."""
        _, _, _, words, ranks = self.levels[level]
        stretch, word = place // STRETCH, place >> 6
        inside = words[stretch * (STRETCH // 64):word]
        part = int(words[word]) & ((1 << (place & 63)) - 1)
        return int(ranks[stretch]) + int(np.bitwise_count(inside).sum()) + part.bit_count()

    def slice(self, start: int, end: int) -> np.ndarray:
        """The ids at the places start .. end - 1: their chunks stand side by
        side on every level, between the ranks of the two ends."""
        start, end = int(start), int(end)
        out = np.zeros(max(end - start, 0), np.uint32)
        if not len(out):
            return out
        who, shift = None, 0
        for k, (width, _, chunks, words, _) in enumerate(self.levels):
            bit = np.arange(start * width, end * width, width, dtype=np.int64)
            word, off = bit >> 6, (bit & 63).astype(np.uint64)
            got = chunks[word] >> off | (chunks[word + 1] << np.uint64(1)) << (np.uint64(63) - off)
            got = ((got & np.uint64((1 << width) - 1)) << np.uint64(shift)).astype(np.uint32)
            if who is None:
                out |= got
            else:
                out[who] |= got
            if k + 1 == len(self.levels):
                break
            first = start >> 6
            bits = np.unpackbits(words[first:(end - 1 >> 6) + 1].view(np.uint8), bitorder="little")
            goes = np.flatnonzero(bits[start - 64 * first:end - 64 * first])
            if not len(goes):
                break
            who, shift = goes if who is None else who[goes], shift + width
            start = self._rank(k, start)
            end = start + len(goes)
        return out


class Segment:
    """A segment's documents and ids."""

    def __init__(self, data):
        magic, self.part, self.number, self.n, docs, levels, _ = struct.unpack_from(HEAD, data, 0)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEAD_BYTES
        self.doc_ids = np.frombuffer(data, np.int64, docs, at)
        at += 8 * docs
        self.flags = np.frombuffer(data, np.uint8, docs, at)
        at += docs + -docs % 8
        self.starts = np.frombuffer(data, np.uint64, docs, at).astype(np.int64)
        at += 8 * docs
        self.codes = Codes(data, at, levels)


def segment(part: int, number: int, doc_ids, flags, starts, ids: np.ndarray) -> bytes:
    body = encode(ids)
    levels, = struct.unpack_from("<I", body)
    return b"".join([
        struct.pack(HEAD, MAGIC, part, number, len(ids), len(doc_ids), levels, 0), np.asarray(doc_ids, np.int64).tobytes(),
        _padded(np.asarray(flags, np.uint8).tobytes()), np.asarray(starts, np.uint64).tobytes(), body[4:]])


# --- tokenizing -------------------------------------------------------------

#: A place before a blank or line feed and behind a character that is no white space.
CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: White space side by side: only ``CUT`` tells where such a text can be cut.
CROWDED = r"[\s\v\p{Z}\x{85}\x1c-\x1f][\s\v\p{Z}\x{85}\x1c-\x1f]"


class Encoder:
    """Texts to ids for a tokenizer's JSON."""

    def __init__(self, config: str):
        import json
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, made = Tokenizer.from_str(config), json.loads(config)
        pre = made.get("pre_tokenizer") or {}
        self.in_pieces = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                          and not made.get("normalizer") and not made.get("truncation")
                          and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] for t in made.get("added_tokens") or []))
        self.kept: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """The ids of different pieces (as bytes), from the cache where they
        are known."""
        out = list(map(self.kept.get, pieces))
        places = [i for i, b in enumerate(out) if b is None]
        new = [pieces[i] for i in places]
        made = self._new(new)
        for i, b in zip(places, made, strict=True):
            out[i] = b
        if len(self.kept) + len(new) > CACHE:
            self.kept.clear()
        if len(new) <= CACHE:
            self.kept.update(zip(new, made, strict=True))
        return out

    def _new(self, pieces: list[str]) -> list[bytes]:
        """Pieces that begin with a blank or line feed and end with neither are
        encoded some at a time, as one text cut by the ids' places in it."""
        plain = [i for i, p in enumerate(pieces) if p and p[0] in " \n" and not p[-1].isspace()]
        runs = [plain[k:k + TOGETHER] for k in range(0, len(plain), TOGETHER)]
        out: list = [None] * len(pieces)
        texts = ["".join([pieces[i] for i in run]) for run in runs]
        for run, got in zip(runs, self.tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
            ids, at = np.array(got.ids, np.uint32).tobytes(), [o[0] for o in got.offsets]
            begin = place = 0
            for i in run:
                place += len(pieces[i])
                end = bisect_left(at, place, begin)
                out[i] = ids[4 * begin:4 * end]
                begin = end
        rest = [i for i, b in enumerate(out) if b is None]
        for i, b in zip(rest, self._whole([pieces[i] for i in rest]), strict=True):
            out[i] = b
        return out

    def text(self, text: str) -> np.ndarray:
        """The ids of one text, cut wherever white space follows anything else."""
        if not self.in_pieces:
            return np.frombuffer(self._whole([text])[0], np.uint32)
        parts = CUT.split(text)
        different = list(set(parts))
        ids = dict(zip(different, self.pieces(different), strict=True))
        return np.frombuffer(b"".join(map(ids.__getitem__, parts)), np.uint32)

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text. Texts without white space side by side are
        cut at every blank and line feed, all at once, and their pieces are
        looked up by number."""
        if not self.in_pieces:
            return [np.frombuffer(b, np.uint32) for b in self._whole(texts.to_pylist())]
        crowded = pc.match_substring_regex(texts, CROWDED)
        out: list = [None] * len(texts)
        for i in np.flatnonzero(crowded.to_numpy(zero_copy_only=False)):
            out[i] = self.text(texts[int(i)].as_py())
        even = np.flatnonzero(~crowded.to_numpy(zero_copy_only=False))
        if not len(even):
            return out
        # a blank ahead of each line feed: the split leaves the line feed with its piece, and takes the blanks
        parts = pc.split_pattern(pc.replace_substring(texts.take(pa.array(even)), "\n", " \n"), " ")
        numbered = parts.flatten().dictionary_encode()
        number, words = numbered.indices.to_numpy().astype(np.int64), numbered.dictionary
        offsets = parts.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        # a text's first piece has no blank before it
        plain, own = np.unique(number[offsets[:-1]], return_inverse=True)
        number[offsets[:-1]] = len(words) + own
        spaced = pc.if_else(pc.starts_with(words, "\n"), words, pc.binary_join_element_wise(pa.scalar(" ", words.type), words, pa.scalar("", words.type)))
        table = self.pieces(spaced.to_numpy(zero_copy_only=False).tolist()) + self.pieces(words.take(pa.array(plain)).to_pylist())
        flat = np.frombuffer(b"".join(table), np.uint32)
        size = np.fromiter(map(len, table), np.int64, len(table)) // 4
        begin = np.cumsum(size) - size
        n = size[number]
        ends = np.cumsum(n)
        stream = flat[np.repeat(begin[number] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[offsets]
        for k, i in enumerate(even):
            out[i] = stream[bounds[k]:bounds[k + 1]]
        return out


# --- files ------------------------------------------------------------------

def _encoded(encoder: Encoder, batch: pa.RecordBatch):
    """(doc id, ids) of a batch, in runs of about BATCH_CHARS bytes."""
    texts = batch.column("text").cast(pa.large_string())
    sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
    run = np.cumsum(sizes) // BATCH_CHARS
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), len(batch)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield from zip(batch.column("doc_id").slice(a, b - a).to_pylist(), encoder.batch(texts.slice(a, b - a)), strict=True)


def _writing(config, end_id: int, segment_ids: int):
    def run(batches):
        from pyspark import TaskContext
        part, number = TaskContext.get().partitionId(), 0
        encoder = config.value.get("encoder") or config.value.setdefault("encoder", Encoder(config.value["config"]))
        ids, doc_ids, flags, starts, held = [], [], [], [], 0

        def close(goes_on: bool):
            nonlocal ids, doc_ids, flags, starts, held, number
            if goes_on:
                flags[-1] |= GOES_ON
            made = segment(part, number, doc_ids, flags, starts, np.concatenate(ids))
            ids, doc_ids, flags, starts, held, number = [], [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], names=["segment"])

        for doc, ids_of_doc in ((d, x) for batch in batches for d, x in _encoded(encoder, batch)):
            own = np.append(ids_of_doc, np.uint32(end_id))
            at = 0
            while at < len(own):
                take = own[at:at + segment_ids - held]
                doc_ids.append(doc or 0)
                flags.append((NULL_ID if doc is None else 0) | (CAME_IN if at else 0))
                starts.append(held)
                ids.append(take)
                held, at = held + len(take), at + len(take)
                if held >= segment_ids:
                    yield close(at < len(own))
        if held:
            yield close(False)
    return run


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> str:
    """Encodes every text, appends ``end_id`` to each document and writes the
    ids in ascending order of the ids of the documents below ``path``."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        # a vocabulary of a few MB; a worker keeps its encoder in the dictionary, for all its tasks
        config = spark.sparkContext.broadcast({"config": f.read()})
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    # the running id only deals equal rows over several partitions
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("tie", F.monotonically_increasing_id())
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    by = [F.asc_nulls_first(c) for c in ("doc_id", "h", "tie")]
    dealt = rows.repartitionByRange(n, *by).sortWithinPartitions(*by).select("doc_id", "text")
    made = dealt.mapInArrow(_writing(config, end_id, segment_ids), "segment binary")
    # one row per file; the writer puts END behind it
    made.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path, lineSep=END)
    return path


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)


def _heads(batches):
    for batch in batches:
        got = [struct.unpack_from(HEAD, x.as_buffer(), 0) for x in batch.column("content") if x.as_buffer().size >= HEAD_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in got], pa.int64()) for i in (1, 2, 3)], names=["part", "number", "n"])


def _documents(with_ids: bool):
    names = ["part", "number", "at", "doc_id", "flags", "start", "n", "crc", *(["ids"] if with_ids else [])]

    def run(batches):
        for batch in batches:
            for x in batch.column("content"):
                data = x.as_buffer()
                if data.size < HEAD_BYTES:                       # an empty partition's file
                    continue
                s = Segment(data)
                ends = np.append(s.starts[1:], s.n)
                crc, ids = [], []
                for a, b in zip(s.starts, ends, strict=True):
                    own = s.codes.slice(a, b)
                    crc.append(zlib.crc32(own.astype("<u4").tobytes()))
                    if with_ids:
                        ids.append(own)
                docs = len(s.starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(docs, s.part, np.int64)), pa.array(np.full(docs, s.number, np.int64)),
                    pa.array(np.arange(docs)), pa.array(s.doc_ids, mask=s.flags & NULL_ID > 0),
                    pa.array(s.flags.astype(np.int32)), pa.array(s.starts), pa.array(ends - s.starts), pa.array(crc, pa.int64()),
                    *([pa.array(ids, pa.list_(pa.int64()))] if with_ids else [])], names=names)
    return run, "part long, number long, at long, doc_id long, flags int, start long, n long, crc long" + (", ids array<long>" if with_ids else "")


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32 (bits reversed)."""
    out = 0
    for i in range(31, -1, -1):
        if a >> i & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """CRC-32 of byte strings put together, from (crc, bytes) of each."""
    out = 0
    for crc, length in parts:
        power, square, n = 1 << 31, 1 << 30, 8 * length           # x**0, x**1
        while n:
            if n & 1:
                power = _times(power, square)
            square, n = _times(square, square), n >> 1
        out = _times(out, power) ^ crc
    return out


def bases(spark: SparkSession, path: str) -> DataFrame:
    """(part, number, n, base): the place of every segment's first id."""
    from pyspark.sql import Window
    heads = materialize(_files(spark, path).select("content").mapInArrow(_heads, "part long, number long, n long"), "token-heads")
    before, rows = 0, []
    for part, n in sorted(heads.groupBy("part").agg(F.sum("n")).collect()):     # one row per partition of the writer
        rows.append((part, before))
        before += n
    offsets = spark.createDataFrame(rows, "part long, _before long")
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    return (heads.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
            .join(F.broadcast(offsets), "part").select("part", "number", "n", (F.col("_before") + F.col("_inside")).alias("base")))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, and with
    ``with_ids`` the ids (a long document's in one array)."""
    run, schema = _documents(with_ids)
    found = materialize(_files(spark, path).select("content").mapInArrow(run, schema), "token-documents")
    placed = found.join(materialize(bases(spark, path).drop("n"), "token-bases"), ["part", "number"]).withColumn(
        "start", F.col("base") + F.col("start"))
    out = ["doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"), *(["ids"] if with_ids else [])]
    alone = placed.where(F.col("flags").bitwiseAND(GOES_ON | CAME_IN) == 0).select(*out)
    # documents over several segments: a document's parts follow each other in one partition
    from pyspark.sql import Window
    cut = placed.where(F.col("flags").bitwiseAND(GOES_ON | CAME_IN) != 0)
    begins = F.sum(F.when(F.col("flags").bitwiseAND(CAME_IN) == 0, 1).otherwise(0)).over(
        Window.partitionBy("part").orderBy("number", "at"))
    fields = ["start", "n", "crc", *(["ids"] if with_ids else [])]
    parts = (cut.withColumn("_doc", begins).groupBy("part", "_doc")
             .agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct(*fields))).alias("p")))
    joined = F.udf(lambda p: joined_crc([(x["crc"], 4 * x["n"]) for x in p]), "long")     # long documents only
    whole = parts.select("doc_id", F.element_at("p", 1)["start"].alias("start"),
                         F.aggregate("p", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_tokens"),
                         joined("p").alias("ids_crc32"),
                         *([F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids")] if with_ids else []))
    return alone.unionByName(whole)


def tokens_at(spark: SparkSession, path: str, positions: DataFrame, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """(position, token) for each row of ``positions`` (position) that lies in
    the archive: random access, one chunk and rank per level and id."""
    where = materialize(bases(spark, path), "token-bases")
    # a segment meets at most two cells of ``segment_ids`` places
    cells = where.withColumn("_cell", F.explode(F.sequence(
        F.floor(F.col("base") / F.lit(segment_ids)), F.floor((F.col("base") + F.col("n") - 1) / F.lit(segment_ids)))))
    asked = positions.select(F.col("position").cast("long").alias("position")).withColumn(
        "_cell", F.floor(F.col("position") / F.lit(segment_ids)))
    found = asked.join(cells, "_cell").where("position >= base AND position < base + n").select(
        "part", "number", "position", (F.col("position") - F.col("base")).alias("place"))
    run_files = _files(spark, path).select("content").mapInArrow(_named, "part long, number long, content binary")
    return found.groupBy("part", "number").cogroup(run_files.groupBy("part", "number")).applyInPandas(_looked, "position long, token long")


def _named(batches):
    for batch in batches:
        keep = [x for x in batch.column("content") if x.as_buffer().size >= HEAD_BYTES]
        heads = [struct.unpack_from(HEAD, x.as_buffer(), 0) for x in keep]
        yield pa.RecordBatch.from_arrays([pa.array([h[1] for h in heads], pa.int64()), pa.array([h[2] for h in heads], pa.int64()),
                                          pa.array([x.as_py() for x in keep], pa.binary())], names=["part", "number", "content"])


def _looked(asked, files):
    import pandas as pd
    if not len(asked) or not len(files):
        return pd.DataFrame({"position": pd.Series(dtype="int64"), "token": pd.Series(dtype="int64")})
    codes = Segment(files["content"].iloc[0]).codes
    return pd.DataFrame({"position": asked["position"].to_numpy(), "token": codes.at(asked["place"].to_numpy(np.int64)).astype(np.int64)})


def op11_token_file(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = write_tokens(table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"),
                        public_tokenizers.path("byte_bpe_50k.json"))
    return read_tokens(spark, path)
