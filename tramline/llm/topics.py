"""Topics learned from the corpus: clusters of hashed TF-IDF vectors.

A text's words (lower case) are counted in ``FEATURES`` hashed buckets, weighted
by inverse document frequency and scaled to length 1; k-means over these vectors
gives ``k`` topics, named t0, t1, ... . Every text takes part, whole and once
however many copies it has: in the document frequencies, in the choice of the
first centres (as in k-means||: rows drawn by their squared distance to the rows
drawn so far; the means of the texts nearest to each are then reduced to ``k``,
weighted by their numbers of texts) and in every round.
Every document is assigned, by its whole text.

Words are counted once per row (``count_words``); a round is one pass over the
different texts' counts, which are written with many texts a row and read as Arrow
buffers, and the driver sees a sum per centre and bucket. Vectors
and centres are rounded to whole numbers (1 is ``UNIT``), so sums do not depend on
the order in which tasks are added: the same corpus has the same topics in every
run.

Defined results: a text without words has the topic ``NO_TOPIC``; with fewer
different vectors than ``k``, there are as many topics as vectors; fewer than two
put all texts in one topic.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import col, materialize

K, FEATURES = 8, 1 << 12
SEED, ROUNDS, TOLERANCE = 7, 15, 1e-4
SEED_ROUNDS, OVERSAMPLED = 2, 2
UNIT = 1 << 20
CHUNK, SLAB = 1 << 14, 1 << 19
LONG = 32
CRC = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))   # as bytes.split
NO_TOPIC = "none"


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values' bytes end to end, and how many each has; nothing is copied."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, ends, data = values.buffers()
    ends = np.frombuffer(ends, np.int64 if pa.types.is_large_binary(values.type) else np.int32)[values.offset:values.offset + len(values) + 1]
    return np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]], np.diff(ends).astype(np.int64)


def _binary(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    ends = np.r_[0, np.cumsum(lengths)].astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())


def _slices(sizes: np.ndarray, about: int) -> list[slice]:
    """Runs of rows whose sizes add up to about as much."""
    edges = np.flatnonzero(np.diff(np.cumsum(sizes) // about)) + 1
    return [slice(a, b) for a, b in zip(np.r_[0, edges], np.r_[edges, len(sizes)], strict=True) if a < b]


def _crcs(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``zlib.crc32`` of the words that begin at ``first``: a byte of each at a
    time, shorter words in front; the long ones one by one."""
    order = np.argsort(np.minimum(size, LONG + 1).astype(np.uint8), kind="stable")
    first, size = first[order], size[order]
    crc = np.full(len(first), 0xFFFFFFFF, np.uint32)
    more = np.searchsorted(size, np.arange(LONG + 1), side="right")
    for j in range(LONG):
        if more[j] == len(first):
            break
        now = crc[more[j]:]
        crc[more[j]:] = CRC[(now ^ data[first[more[j]:] + j]) & 255] ^ (now >> np.uint32(8))
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(more[LONG], len(first)):
        crc[i] = zlib.crc32(data[first[i]:first[i] + size[i]])
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _words(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the texts' words begin, how long they are and whose they are."""
    ends = np.cumsum(lengths)
    edge = np.zeros(len(data) + 1, bool)
    edge[np.r_[0, ends]] = True                      # no word goes on in the next text
    word = ~SPACE[data]
    edge[1:-1] |= word[1:] != word[:-1]
    at = np.flatnonzero(edge)
    on = np.flatnonzero(word[at[:-1]])
    return at[on], at[on + 1] - at[on], np.searchsorted(ends, at[on], side="right")


def _counted(texts: pa.Array) -> pa.Array:
    """Per text: its number of words, the buckets and their counts (in as few
    bytes each as all of the text's fit in)."""
    data, lengths = _bytes(texts)
    begin, out = np.r_[0, np.cumsum(lengths)], []
    for rows in _slices(lengths + FEATURES, SLAB):
        own, number = data[begin[rows.start]:begin[rows.stop]], rows.stop - rows.start
        first, size, text = _words(own, lengths[rows])
        met = np.bincount(text * FEATURES + _crcs(own, first, size) % FEATURES, minlength=number * FEATURES)
        on = np.flatnonzero(met)
        sizes, top = np.bincount(on // FEATURES, minlength=number), met.reshape(number, FEATURES).max(1)
        widths = np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4))
        times = np.empty((sizes * widths).sum(), np.uint8)
        for width in np.unique(widths):
            times[np.repeat(widths == width, sizes * widths)] = met[on][np.repeat(widths == width, sizes)].astype(f"<u{width}").view(np.uint8)
        out.append((np.bincount(text, minlength=number), sizes, widths, (on % FEATURES).astype("<u2").view(np.uint8), times))
    n, sizes, widths, at, times = map(np.concatenate, zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 5
    return pa.StructArray.from_arrays([pa.array(n, pa.int64()), _binary(at, 2 * sizes), _binary(times, sizes * widths)], ["n", "at", "times"])


def count_words(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """``rows`` with ``_hash`` of the text and ``_words``: the number of words
    (``n``), the buckets they fall in (``at``) and their counts (``times``)."""
    @F.arrow_udf("struct<n: long, at: binary, times: binary>")
    def counts(texts: pa.Array) -> pa.Array:
        return _counted(texts)

    text = col(text_col)
    return rows.withColumn("_hash", F.xxhash64(text)).withColumn("_words", counts(F.lower(F.coalesce(text, F.lit(""))).cast("binary")))


def _runs(at: pa.Array, times: pa.Array):
    """Runs of rows of about ``CHUNK`` buckets as (the run, its rows' numbers of
    buckets, the buckets, their counts). No row may be empty."""
    (at, sizes), (times, lengths) = _bytes(at), _bytes(times)
    sizes //= 2
    widths = lengths // sizes
    met, begin = np.r_[0, np.cumsum(sizes)], np.r_[0, np.cumsum(lengths)]
    for rows in _slices(sizes, CHUNK):
        counts, own = np.zeros(met[rows.stop] - met[rows.start], "<u4"), times[begin[rows.start]:begin[rows.stop]]
        for width in np.unique(widths[rows]):
            on = widths[rows] == width
            counts[np.repeat(on, sizes[rows])] = own[np.repeat(on, lengths[rows])].view(f"<u{width}")
        yield rows, sizes[rows], at[2 * met[rows.start]:2 * met[rows.stop]].view("<u2"), counts


def _narrow(counts: np.ndarray) -> np.ndarray:
    top = counts.max(initial=0)
    return counts.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4")


def _packed(texts: DataFrame) -> DataFrame:
    """Rows of many texts each: their hashes, their numbers of buckets, the
    buckets and their counts, end to end."""
    def run(batches):
        for batch in batches:
            hashes = batch["hash"].to_numpy()
            rows = [(hashes[rows], sizes.astype("<u4").tobytes(), at.tobytes(), _narrow(counts).tobytes())
                    for rows, sizes, at, counts in _runs(batch["at"], batch["times"])]
            if rows:
                kinds = (pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "sizes", "at", "times"])

    return texts.select("hash", "at", "times").mapInArrow(run, "hash array<long>, sizes binary, at binary, times binary")


def _unpacked(batch: pa.RecordBatch):
    """Per row of many texts: their numbers of buckets, the buckets and counts."""
    for sizes, at, times in zip(batch["sizes"], batch["at"], batch["times"], strict=True):
        sizes, at = np.frombuffer(sizes.as_buffer(), "<u4").astype(np.int64), np.frombuffer(at.as_buffer(), "<u2")
        yield sizes, at, np.frombuffer(times.as_buffer(), f"<u{times.as_buffer().size // len(at)}")


def _vectors(sizes: np.ndarray, at: np.ndarray, times: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the rows begin, buckets and components."""
    begin, buckets = np.cumsum(sizes) - sizes, at.astype(np.int64)
    w = times * idf[buckets]
    length = np.sqrt(np.add.reduceat(w * w, begin))
    w *= np.repeat(UNIT / np.where(length > 0, length, 1.0), sizes)
    return begin, buckets, np.rint(w)


def _distances(begin: np.ndarray, buckets: np.ndarray, w: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, row by centre; exact, as all are whole numbers."""
    return np.add.reduceat(w * w, begin)[:, None] + _beyond(begin, buckets, w, centres)


def _beyond(begin: np.ndarray, buckets: np.ndarray, w: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances less the row's own square, which has no part in which
    centre is nearest."""
    inner = np.stack([np.add.reduceat(np.take(c, buckets) * w, begin) for c in centres], axis=1)
    return (centres * centres).sum(1)[None, :] - 2 * inner


def _added(parts: DataFrame, size: int) -> np.ndarray:
    """The tasks' sums ``s`` by number ``i``; whole numbers."""
    sums = parts.groupBy("i").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros(size)
    out[sums["i"].to_numpy()] = sums["s"].to_numpy()
    return out


def _part(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at].astype(np.int64))], ["i", "s"])


def _idf(texts: DataFrame) -> np.ndarray:
    def run(batches):
        total = np.zeros(FEATURES + 1)
        for batch in batches:
            for sizes, at, _ in _unpacked(batch):
                total[:-1] += np.bincount(at, minlength=FEATURES)
                total[-1] += len(sizes)
        yield _part(total)

    total = _added(texts.select("sizes", "at", "times").mapInArrow(run, "i long, s long"), FEATURES + 1)
    return np.log((total[-1] + 1) / (total[:-1] + 1))


def _sums(texts: DataFrame, idf: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum of the vectors nearest to each centre, and their number."""
    shape = (len(centres), FEATURES + 1)

    def run(batches):
        total = np.zeros(shape[0] * shape[1])
        for batch in batches:
            for sizes, at, times in _unpacked(batch):
                begin, buckets, w = _vectors(sizes, at, times, idf)
                nearest = _beyond(begin, buckets, w, centres).argmin(1) * shape[1]
                total += np.bincount(np.repeat(nearest, sizes) + buckets, w, len(total))
                total += np.bincount(nearest + FEATURES, minlength=len(total))
        yield _part(total)

    total = _added(texts.select("sizes", "at", "times").mapInArrow(run, "i long, s long"), shape[0] * shape[1]).reshape(shape)
    return total[:, :-1], total[:, -1]


def _drawn(texts: DataFrame, idf: np.ndarray, centres: np.ndarray, number: int, turn: int) -> np.ndarray:
    """``number`` rows at most, drawn without replacement by their squared
    distance to ``centres`` (any row, if there are none); never one of them."""
    def run(batches):
        best = []
        for batch in batches:
            for hashes, u, (sizes, at, times) in zip(batch["hash"], batch["u"], _unpacked(batch), strict=True):
                hashes, u, far = hashes.values.to_numpy(), u.values.to_numpy(), np.ones(len(sizes))
                begin = np.cumsum(sizes) - sizes
                if len(centres):
                    far = _distances(*_vectors(sizes, at, times, idf), centres).min(1)
                with np.errstate(divide="ignore"):
                    key = np.where(far > 0, -np.log(u) / np.where(far > 0, far, 1), np.inf)
                first = [r for r in np.lexsort((hashes, key))[:number] if key[r] < np.inf]
                own = [slice(begin[r], begin[r] + sizes[r]) for r in first]
                best += [(key[r], hashes[r], at[o].tobytes(), times[o].astype("<u4").tobytes()) for r, o in zip(first, own, strict=True)]
                best = sorted(best)[:number]
        if best:
            kinds = (pa.float64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*best, strict=True), kinds, strict=True)], ["key", "hash", "at", "times"])

    u = F.transform("hash", lambda h: (F.pmod(F.xxhash64(F.lit(SEED), F.lit(turn), h), F.lit(1 << 40)) + 1) / float((1 << 40) + 1))
    keyed = texts.select("hash", "sizes", "at", "times", u.alias("u")).mapInArrow(run, "key double, hash long, at binary, times binary")
    found = keyed.orderBy("key", "hash", "at", "times").limit(number).collect()
    out = np.zeros((len(found), FEATURES))
    for row, r in zip(out, found, strict=True):
        at, times = np.frombuffer(r["at"], "<u2"), np.frombuffer(r["times"], "<u4")
        _, buckets, w = _vectors(np.array([len(at)]), at, times, idf)
        row[buckets] = w
    return out


def _reduced(rows: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """``k`` centres of a few weighted means: k-means++ and its rounds."""
    rng = np.random.default_rng(SEED)
    apart = lambda a, b: ((a[:, None, :] - b[None, :, :]) ** 2).sum(2)
    chosen = [int(rng.choice(len(rows), p=weights / weights.sum()))]
    while len(chosen) < k:
        near = apart(rows, rows[chosen]).min(1)
        odds = weights * near if (weights * near).any() else near
        tried = rng.choice(len(rows), size=4, p=odds / odds.sum())
        left = [(weights * np.minimum(near, apart(rows, rows[[t]])[:, 0])).sum() for t in tried]
        chosen.append(int(tried[int(np.argmin(left))]))
    centres = rows[chosen]
    for _ in range(30):
        member = (apart(rows, centres).argmin(1)[:, None] == np.arange(k)) * weights[:, None]
        mass = member.sum(0)
        centres = np.where(mass[:, None] > 0, member.T @ rows / np.where(mass > 0, mass, 1)[:, None], centres)
    return np.rint(centres)


class Topics:
    """Centres by number; none put all texts in one topic."""

    def __init__(self, idf: np.ndarray | None = None, centres: np.ndarray | None = None):
        self.idf, self.centres = idf, centres

    def assign(self, rows: DataFrame, text_col: str = "text", name: str = "topic") -> DataFrame:
        """``rows`` with their topic; their words are counted unless they are
        already (``count_words``), so no other column may be called ``_words``."""
        counted = rows if "_words" in rows.columns else count_words(rows, text_col)
        topic = F.lit("t0")
        if self.centres is not None:
            idf, centres = self.idf, self.centres

            @F.arrow_udf("long")
            def nearest(at: pa.Array, times: pa.Array) -> pa.Array:
                out = np.zeros(len(at), np.int64)
                full = np.flatnonzero(_bytes(at)[1])
                for rows, *counted in _runs(at.take(pa.array(full)), times.take(pa.array(full))):
                    out[full[rows]] = _beyond(*_vectors(*counted, idf), centres).argmin(1)
                return pa.array(out)

            topic = F.concat(F.lit("t"), nearest("_words.at", "_words.times").cast("string"))
        return counted.withColumn(name, F.when(F.col("_words.n") > 0, topic).otherwise(NO_TOPIC)).select(*rows.columns, name)


def learn_topics(rows: DataFrame, text_col: str = "text", k: int = K) -> Topics:
    """Topics of the texts of ``rows``, whose words may be counted already."""
    counted = rows if "_words" in rows.columns else count_words(rows, text_col)
    texts = counted.where("_words.n > 0").select(F.col("_hash").alias("hash"), "_words.at", "_words.times").distinct()
    texts = materialize(_packed(texts), "topics-texts")
    idf = _idf(texts)
    seeds = _drawn(texts, idf, np.zeros((0, FEATURES)), 1, 0)
    turn, more = 0, len(seeds) > 0
    while more and (turn < SEED_ROUNDS or len(seeds) < k):
        turn += 1
        drawn = _drawn(texts, idf, seeds, OVERSAMPLED * k, turn)
        more = len(drawn) > 0
        seeds = np.concatenate([seeds, np.unique(drawn, axis=0)]) if more else seeds
    if len(seeds) < 2:
        return Topics()
    sums, number = _sums(texts, idf, seeds)
    centres = _reduced(sums / number[:, None], number, min(k, len(seeds)))     # a seed is nearest to itself
    for _ in range(ROUNDS):
        sums, number = _sums(texts, idf, centres)
        new = np.where(number[:, None] > 0, np.rint(sums / np.where(number > 0, number, 1)[:, None]), centres)
        moved = np.sqrt(((new - centres) ** 2).sum(1)).max()
        centres = new
        if moved <= TOLERANCE * UNIT:
            break
    return Topics(idf, centres)
