"""Benchmark decontamination by the q-gram lemma.

Texts are normalised (lower case, every run of characters that are neither
letters nor digits one space). The q-grams of an item at the places 0, q, 2q,
... do not overlap, so an edit changes at most one of them. If an item of m
characters occurs in a document with at most k edits, at least m // q - k of
these occur there, on diagonals (document position minus item position) that
differ by at most k. So the shared q-grams, each once, are counted in diagonal
bands of width 2 (k + 1) that overlap by half; a band that reaches the bound
is a candidate region, which a banded alignment of the item verifies. (With all
q-grams the bound is m + 1 - q - k q: it separates no better here, for q times
the postings.) Places of the document where a q-gram stands close together
(within a half band, as in a run of one letter) are one run; it meets every
half band between its ends, so self-similar texts give postings per band, not
per character. Neighbouring candidate bands are one region. The budget k is ``MAX_ERROR`` of the item's length, lowered for
short items until the bound is at least one; items shorter than q must occur
as they are.

The benchmark is the query set: it is taken in blocks of at most
``BLOCK_CHARS`` characters (so the index of a block has a known size and is
broadcast), each block against all documents in one pass without a shuffle.
Work in a task is per document: rolling q-gram codes and one table look-up per
character, then postings only of characters that hit.

Defined results: null, empty and blank texts or items match nothing; equal
documents or items each get their own row; null ids are kept as such; an empty
table on either side gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import packed, table, unpacked

Q = 6
MAX_ERROR = 0.12
BLOCK_CHARS = 2_000_000
TABLE_BITS = 22
#: Characters searched at once, to share the cost of a call among short texts.
RUN_CHARS = 30_000
MATCHES = "item_no int, start int, end int, edits int"



def _word_characters() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def normalised(text: str | None, letters: np.ndarray) -> np.ndarray:
    """Code points of the normalised text; ``letters`` marks the code points
    that are letters or digits."""
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    solid = letters[chars]
    keep = solid.copy()
    keep[1:] |= solid[:-1]                       # the first character of a gap becomes its space
    out = np.where(solid, chars, np.uint32(32))[keep]
    return out[:-1] if len(out) and out[-1] == 32 else out


def _qgrams(chars: np.ndarray) -> np.ndarray:
    """A code for each run of six characters."""
    n = len(chars) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    p = 0x100000001B3
    two = chars[:-1].astype(np.uint64) * np.uint64(p) + chars[1:]
    code = (two[:n] * np.uint64(p ** 4 % 2 ** 64) + two[2:n + 2] * np.uint64(p * p % 2 ** 64) + two[4:n + 4])
    code ^= code >> np.uint64(29)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    return code ^ (code >> np.uint64(32))


class ItemIndex:
    """The q-grams of a block of items: a bit table to skip what no item has,
    and for each q-gram the places where it occurs."""

    def __init__(self, items: list[str]):
        self.letters = _word_characters()
        self.chars = [normalised(t, self.letters) for t in items]
        self.length = np.array([len(c) for c in self.chars], np.int64)
        self.budget = np.minimum((self.length * MAX_ERROR).astype(np.int64), np.maximum(self.length // Q - 1, 0))
        self.bound = np.where(self.length >= Q, self.length // Q - self.budget, 0)
        grams = [_qgrams(c)[::Q] for c in self.chars]
        code = np.concatenate([*grams, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([*[np.arange(len(g)) * Q for g in grams], np.empty(0, np.int64)])
        order = np.argsort(code, kind="stable")
        self.item, self.place = item[order], place[order].astype(np.int64)
        self.code, self.first, self.count = np.unique(code[order], return_index=True, return_counts=True)
        # a q-gram's places in a text this close to each other leave out no half band of any of its items
        self.near = np.minimum.reduceat(self.budget[self.item] + 1, self.first) if len(self.code) else np.empty(0, np.int64)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.code & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)] = True
        self.short = [(i, "".join(map(chr, c))) for i, c in enumerate(self.chars) if 0 < len(c) < Q]

    def matches(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """Per text, (item, start, end, edits) of the best region per item;
        start and end count characters of the normalised text. Short texts are
        searched together, kept apart by more blanks than any budget covers."""
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        gap = np.zeros(int(self.budget.max(initial=0)) + Q, np.uint32)
        run, starts, size = [], [], 0
        for no, text in enumerate(texts):
            chars = normalised(text, self.letters)
            for i, short in self.short:
                if (at := "".join(map(chr, chars)).find(short)) >= 0:
                    out[no].append((i, at, at + len(short), 0))
            run += [chars, gap]
            starts.append((no, size))
            size += len(chars) + len(gap)
            if size >= RUN_CHARS or no == len(texts) - 1:
                self._search(np.concatenate(run), starts, out)
                run, starts, size = [], [], 0
        return out

    def _search(self, chars: np.ndarray, starts: list[tuple[int, int]], out: list[list]) -> None:
        if len(chars) < Q or not len(self.code):
            return
        code = _qgrams(chars)
        at = np.flatnonzero(self.table[(code & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)])
        row = np.searchsorted(self.code, code[at])
        row[row == len(self.code)] = 0
        same = self.code[row] == code[at]
        at, row = at[same], row[same]
        if not len(at):
            return
        # runs: places of one q-gram that leave out no half band between them
        order = np.argsort(row, kind="stable")
        at, row = at[order], row[order]
        begins = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (np.diff(at) > self.near[row[1:]])]))
        low, high, row = at[begins], at[np.append(begins[1:], len(at)) - 1], row[begins]
        n = self.count[row]
        where = np.repeat(self.first[row] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        # diagonals start at -length: shifted to be non-negative; a region is two neighbouring half bands
        item, place = self.item[where], self.place[where]
        many = (len(chars) + int(self.length.max())) // int(self.budget.min() + 1) + 2
        shift, wide = self.length[item] - place, self.budget[item] + 1
        half = (np.repeat(low, n) + shift) // wide
        spans = (np.repeat(high, n) + shift) // wide - half + 1
        half = (item * many + half)
        if int(spans.max()) > 1:                     # a run over several half bands is in each of them
            inside = np.arange(int(spans.sum())) - np.repeat(np.cumsum(spans) - spans, spans)
            half, place = np.repeat(half, spans) + inside, np.repeat(place, spans)
        ordered = np.sort(half)
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        halves, hits = ordered[first], np.diff(np.append(first, len(ordered)))
        hits[:-1] += np.where(np.diff(halves) == 1, hits[1:], 0)
        dense = halves[hits >= self.bound[halves // many]]
        if not len(dense):
            return
        # in those, each q-gram of the item counts once
        pairs = [np.stack([half[on] - side, place[on]]) for side in (0, 1) for on in [np.flatnonzero(np.isin(half - side, dense))]]
        found, hits = np.unique(np.unique(np.concatenate(pairs, axis=1), axis=1)[0], return_counts=True)
        found = found[hits >= self.bound[found // many]]
        if not len(found):
            return
        # neighbouring bands of an item are one region
        edges = np.flatnonzero(np.concatenate([[True], (np.diff(found) > 1) | (found[1:] // many != found[:-1] // many)]))
        regions = list(zip(found[edges].tolist(), found[np.append(edges[1:], len(found)) - 1].tolist(), strict=True))
        offsets = np.array([at for _, at in starts])
        ends = np.append(offsets[1:], len(chars)) - (int(self.budget.max()) + Q)
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        for r, last in regions:
            i = r // many
            k, m = int(self.budget[i]), int(self.length[i])
            left, right = (r % many) * (k + 1) - m - k, (last % many + 2) * (k + 1) + k
            for t in range(max(0, int(np.searchsorted(offsets, left, side="right")) - 1), int(np.searchsorted(offsets, right))):
                low, high = max(left, int(offsets[t])), min(right, int(ends[t]))
                if high - low < m - k:
                    continue
                edits, end = banded_edits(self.chars[i], chars[low:high], k)
                no, offset = starts[t]
                if edits <= k and ((no, i) not in best or edits < best[no, i][3]):
                    best[no, i] = (i, max(0, low + end - m - offset), low + end - offset, edits)
        for (no, _), match in best.items():
            out[no].append(match)


def banded_edits(item: np.ndarray, region: np.ndarray, budget: int) -> tuple[int, int]:
    """Fewest edits that turn a part of ``region`` into ``item``, and where
    that part ends; the region is as wide as the band, so all its diagonals
    are in it. More than ``budget`` edits are reported as budget + 1."""
    n = len(region)
    if not n:
        return budget + 1, 0
    j = np.arange(n + 1)
    row = np.zeros(n + 1, np.int64)                 # the part may begin anywhere
    for i, c in enumerate(item, 1):
        best = np.empty(n + 1, np.int64)
        best[0] = i
        best[1:] = np.minimum(row[1:] + 1, row[:-1] + (region != c))
        row = np.minimum.accumulate(best - j) + j   # skipped characters of the region
        if row.min() > budget:
            return budget + 1, 0
    end = int(row.argmin())
    return int(row[end]), end


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, most: int):
    """The items in blocks of at most ``most`` characters (or one item)."""
    ids, texts, size = [], [], 0
    for r in benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).toLocalIterator():
        if size + len(r["text"] or "") > most and ids:
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r["id"])
        texts.append(r["text"])
        size += len(r["text"] or "")
    if ids:
        yield ids, texts


def _matcher(spark, texts: list[str], text: Column) -> Column:
    index = spark.sparkContext.broadcast(ItemIndex(texts))

    @F.pandas_udf(f"array<struct<{MATCHES.replace(' int', ': int')}>>")
    def matches(column: pd.Series) -> pd.Series:
        own = index.value
        names = ("item_no", "start", "end", "edits")
        found = own.matches(column.tolist())
        return pd.Series([[dict(zip(names, map(int, m), strict=True)) for m in ms] for ms in found], dtype=object)

    return matches(text)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item, start, end, edits, similarity): each document with each item it holds."""
    spark = docs.sparkSession
    rows = packed(docs, id_col, text_col).select("id", "text")
    item_type = benchmark.schema[item_col].dataType.simpleString()
    out = None
    for ids, texts in _blocks(benchmark, item_col, item_text, block_chars):
        found = (rows.select("id", F.explode(_matcher(spark, texts, F.coalesce("text", F.lit("")))).alias("m"))
                 .select("id", F.lit(ids).cast(f"array<{item_type}>")[F.col("m.item_no")].alias("item"),
                         "m.start", "m.end", "m.edits"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return rows.select("id", F.lit(None).cast(item_type).alias("item"), *[
            F.lit(0).alias(c) for c in ("start", "end", "edits")]).where("false")
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no item; no join, each row judged where it is."""
    kept = packed(docs, id_col, text_col)
    for _, texts in _blocks(benchmark, item_col, item_text, block_chars):
        kept = kept.where(F.size(_matcher(docs.sparkSession, texts, F.coalesce("text", F.lit("")))) == 0)
    return unpacked(kept, docs.columns)


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    leaks = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), F.col("start").alias("match_start"),
                        F.col("end").alias("match_end"), "edits")
