"""Quality rules on repetition, by suffix arrays over the words of each text.

The suffix array of a text's words is built by prefix doubling; the longest
common prefix (LCP) of neighbouring suffixes follows from the ranks of the
doublings, or, where those are many (long texts that repeat themselves), from
one pass in text order that never goes back more than a word (Kasai).
An LCP interval of at least ``MIN_REPEAT`` words that cannot be extended to
the left is a maximal repeat; the union of the spans of all its occurrences is
what is repeated. A text fails if more than ``MAX_COVERED`` of its word
characters are, or if its longest repeat exceeds ``MAX_LONGEST`` words.

Each text is one row and judged where it is; no shuffle. Memory grows with the
number of a text's words, time with n log n of it.

Defined results: a null, empty or blank text has no words, all counts are 0
and the base rule fails; a text of fewer words than the window has no repeat.
"""

from __future__ import annotations

import re
from array import array
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import packed, table

MIN_REPEAT = 5
MAX_COVERED = 0.2
MAX_LONGEST = 100
MIN_WORDS = 10
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOLS = "#*$%&|<>"


class Repeats(NamedTuple):
    covered: np.ndarray      # of each word, whether it lies in a repeat
    longest: int             # words of the longest repeat
    n_maximal: int           # number of different maximal repeats


#: Ranks kept for the LCP; more than that, and it is computed in text order.
KEPT_RANKS = 1 << 22


def suffix_array(words: np.ndarray, kept: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array of integers and the LCP of each suffix with the one before."""
    n, kept = len(words), KEPT_RANKS if kept is None else kept
    first = np.unique(words, return_inverse=True)[1].astype(np.int64)
    rank, step = first, 1
    ranks: list[np.ndarray] | None = [rank]
    order = np.argsort(rank, kind="stable")
    while step < n and rank.max() < n - 1:
        key = rank * (n + 1)
        key[:n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
        if ranks is not None:
            ranks = [*ranks, rank] if (len(ranks) + 1) * n <= kept else None
        step *= 2
    if ranks is None:
        return order, _lcp_in_text_order(first, order)
    i, j, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        width, rank = 1 << level, ranks[level]
        inside = np.flatnonzero((i + width <= n) & (j + width <= n))
        same = inside[rank[i[inside]] == rank[j[inside]]]
        lcp[same] += width
        i[same] += width
        j[same] += width
    return order, np.concatenate([[0], lcp])


def _lcp_in_text_order(words: np.ndarray, order: np.ndarray) -> np.ndarray:
    """LCP by Kasai's rule: the suffix after one that shares h words with its
    predecessor shares at least h - 1 with its own."""
    n = len(words)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(place > 0, order[place - 1], -1)
    text, prior, out = array("q", words.tobytes()), array("q", before.tobytes()), array("q", bytes(8 * n))
    h = 0
    for i in range(n):
        j = prior[i]
        if j < 0:
            h = 0
            continue
        top = n - max(i, j)
        while h < top and text[i + h] == text[j + h]:
            h += 1
        out[i] = h
        h = max(h - 1, 0)
    return np.frombuffer(out, np.int64)[order]


def maximal_repeats(words: np.ndarray, least: int = MIN_REPEAT) -> Repeats:
    n = len(words)
    covered = np.zeros(n, bool)
    if n <= least:
        return Repeats(covered, 0, 0)
    order, lcp = suffix_array(words)
    reach = np.maximum(lcp, np.append(lcp[1:], 0))          # longest repeat that begins at each suffix
    hit = np.flatnonzero(reach >= least)
    if not len(hit):
        return Repeats(covered, 0, 0)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, order[hit], 1)
    np.add.at(edge, order[hit] + reach[hit], -1)
    covered = np.cumsum(edge[:-1]) > 0
    # intervals: runs of suffixes whose neighbours share at least a length; left-maximal if what precedes differs
    before = np.where(order > 0, words[order - 1], -1 - np.arange(n))
    change = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
    count = 0
    stack: list[tuple[int, int]] = []                        # (length, first suffix)
    for i in np.append(np.unique(np.concatenate([hit, hit + 1])), n + 1):
        value = int(lcp[i]) if i < n else 0
        value = value if value >= least else 0
        low = int(i) - 1
        while stack and stack[-1][0] > value:
            _, low = stack.pop()
            last = min(int(i) - 1, n - 1)
            count += change[last] > change[low]
        if value and (not stack or stack[-1][0] < value):
            stack.append((value, low))
    return Repeats(covered, int(reach.max()), int(count))


def word_ids(tokens: list[str]) -> np.ndarray:
    seen: dict[str, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in tokens), np.int64, len(tokens))


def judged(text: str | None) -> tuple:
    """The fields of ``VERDICT`` for one text."""
    text = text or ""
    tokens = _WORD.findall(text)
    n = len(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, n)
    chars = int(lengths.sum())
    found = maximal_repeats(word_ids(tokens))
    repeated = int(found.covered.sum())
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif _WORD.search(line):
            seen.add(line)
    covered = float(lengths[found.covered].sum()) / chars if chars else 0.0
    base_failed = n < MIN_WORDS or 100 * repeated > 20 * n
    kept = not base_failed and covered <= MAX_COVERED and found.longest <= MAX_LONGEST
    return (n, chars, sum(map(text.count, _SYMBOLS)), again, repeated, base_failed, kept, covered, found.longest,
            found.n_maximal)


VERDICT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
           "kept boolean, covered_share double, longest_repeat long, n_maximal_repeats long")


def repetition_verdict(text: Column) -> Column:
    names = [c.split()[0] for c in VERDICT.split(", ")]

    @F.pandas_udf(f"struct<{VERDICT.replace(' ', ':').replace(',:', ',')}>")
    def verdict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([judged(t) for t in texts], columns=names)

    return verdict(text)


def judge_repetition(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, verdict fields) of every row."""
    rows = packed(docs, id_col, text_col)
    return rows.select("row", "id", repetition_verdict(F.col("text")).alias("v")).select("row", "id", "v.*")


def drop_repetitive(docs: DataFrame, **options) -> DataFrame:
    return judge_repetition(docs, **options).where("kept").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op7_repetition(spark, sf_dir: str) -> DataFrame:
    return judge_repetition(table(spark, sf_dir, "documents")).drop("row").withColumnRenamed("id", "doc_id")
