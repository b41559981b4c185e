"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted per (source, language, topic) cell. Raking gives every cell
a weight f(source) g(language) h(topic) such that the weighted tokens meet the
target share of each source, each language and each topic. Documents are then
drawn with a probability of at most 1, so that ``keep_share`` of the tokens is
expected, by a hash of id, text and seed: a rerun draws the same rows.

The probabilities are raked under that bound: min(1, F(source) G(language)
H(topic)), starting from the scaled weights. Cells at 1 are held, the others
are raked against what is left of each margin, and the cells at 1 are found
anew, until the expected draw meets the margins. A group with fewer tokens
than its target is drawn whole; what it lacks goes to the others of its axis
in proportion to their targets. ``draw_error`` is the largest share of the
draw by which a language or topic still differs (targets that no draw meets
together).

Targets may be given per axis; an axis without targets gets its own token
shares to the power ``flatten``, normalised, which lifts small groups.

Topics are learned from the corpus (``topics``: hashed TF-IDF, k-means over all
different texts, all texts assigned); ``topic`` takes any expression instead.
Words are counted once, written beside the rows and read by every later pass.

Sources may be many, so they stay distributed: one row per source with its own
cells (language and topic number, tokens). A round is one pass over these rows:
each source's factor follows from the other two, and the tasks' sums per
(language, topic) give the next two; these sums are all the driver sees. No
plan grows with the number of languages or topics.

Defined results: null or empty texts hold no tokens and are kept with the
probability of their cell; a null axis value is a group of its own; targets
of groups without tokens are dropped and the others normalised; groups without
a target get none; if no token is left or there are no documents, the result
is empty; rows equal in id and text share their fate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, packed, table, unpacked
from .topics import count_words, learn_topics

KEEP_SHARE = 0.5
FLATTEN = 0.5
ROUNDS, TOLERANCE = 60, 1e-7
DRAW_ROUNDS, DRAW_TOLERANCE = 60, 1e-4
NONE = "\u0000none"


def n_tokens(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")).cast("double")


def _targets(shares: dict[str, float], given: dict[str, float] | None, flatten: float) -> dict[str, float]:
    raw = given if given is not None else {k: v ** flatten for k, v in shares.items() if v > 0}
    raw = {k: float(v) for k, v in raw.items() if v > 0 and shares.get(k, 0) > 0}
    total = sum(raw.values())
    return {k: v / total for k, v in raw.items()}


def _named(given):
    return None if given is None else {NONE if k is None else str(k): v for k, v in given.items()}


class Rake:
    """Factors per source (a table), language and topic (two dictionaries)."""

    def __init__(self, sources: DataFrame, langs: dict[str, float], topics: dict[str, float], scale: float,
                 error: float, rounds: int, draw_langs: dict[str, float], draw_topics: dict[str, float], draw_error: float):
        self.sources, self.langs, self.topics = sources, langs, topics
        self.scale, self.error, self.rounds = scale, error, rounds
        self.draw_langs, self.draw_topics, self.draw_error = draw_langs, draw_topics, draw_error

    def weight(self) -> Column:
        """Of a row with the columns f, lang and topic."""
        return self._product("f", self.langs, self.topics)

    def probability(self) -> Column:
        """Of a row with the columns draw_f, lang and topic."""
        return F.least(F.lit(1.0), self._product("draw_f", self.draw_langs, self.draw_topics))

    @staticmethod
    def _product(f: str, langs: dict[str, float], topics: dict[str, float]) -> Column:
        g = F.create_map(*[x for k, v in langs.items() for x in (F.lit(k), F.lit(v))])
        h = F.create_map(*[x for k, v in topics.items() for x in (F.lit(k), F.lit(v))])
        return F.coalesce(F.col(f) * F.try_element_at(g, "lang") * F.try_element_at(h, "topic"), F.lit(0.0))


def _summed(rows: DataFrame, value, size: int, second: int | None = None) -> np.ndarray:
    """The sum of ``value(i, t, row)`` over all sources' cells, per number:
    every task adds up its own, one row per number and task is combined. With
    ``second``, a value is two in a row, the second ones numbered from there."""
    def run(batches):
        total = np.zeros(size)
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                i = np.asarray(r.i, np.int64)
                at = i if second is None else np.concatenate([i, i + second])
                total[at] += value(i, np.asarray(r.t, float), r)     # a source has each number once
        at = np.flatnonzero(total)
        yield pd.DataFrame({"i": at, "s": total[at]})

    out = np.zeros(size)
    for r in rows.mapInPandas(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        out[r["i"]] = r["s"]
    return out


def rake(cells: DataFrame, source_targets=None, lang_targets=None, topic_targets=None,
         flatten: float = FLATTEN, keep_share: float = KEEP_SHARE) -> Rake | None:
    """``cells``: source, lang, topic (no nulls), tokens; one row per cell."""
    sums = {a: {r[a]: r["tokens"] for r in cells.groupBy(a).agg(F.sum("tokens").alias("tokens")).collect()} for a in ("lang", "topic")}
    total = sum(sums["lang"].values())
    if not total:
        return None
    langs, topics = sorted(sums["lang"]), sorted(sums["topic"])
    gt, ht = (_targets(sums[a], _named(t), flatten) for a, t in (("lang", lang_targets), ("topic", topic_targets)))
    shape = (len(langs), len(topics))
    spark = cells.sparkSession
    numbered = lambda names, a: spark.createDataFrame(list(enumerate(names)), f"{a}_no long, {a} string")
    at = F.col("lang_no") * len(topics) + F.col("topic_no")
    rows = (cells.join(numbered(langs, "lang"), "lang").join(numbered(topics, "topic"), "topic")
            .groupBy("source").agg(F.sum("tokens").alias("tokens"), F.array_sort(F.collect_list(F.struct(at.alias("i"), "tokens"))).alias("c"))
            .select("source", "tokens", F.col("c.i").alias("i"), F.col("c.tokens").alias("t")))
    raw = (F.when(F.col("tokens") > 0, F.pow("tokens", F.lit(flatten))) if source_targets is None else
           F.try_element_at(F.create_map(*[x for k, v in _named(source_targets).items() for x in (F.lit(k), F.lit(float(v)))]),
                            F.when(F.col("tokens") > 0, F.col("source"))))
    rows = rows.withColumn("raw", F.coalesce(raw.cast("double"), F.lit(0.0)))
    rows = materialize(rows.where("raw > 0"), "mix-sources")
    all_raw = rows.agg(F.sum("raw")).first()[0]
    if not all_raw or not gt or not ht:
        return None
    g = np.array([1.0 if k in gt else 0.0 for k in langs])
    h = np.array([1.0 if k in ht else 0.0 for k in topics])
    want_g, want_h = (np.array([t.get(k, 0.0) for k in ks]) for t, ks in ((gt, langs), (ht, topics)))

    def factor(i, t, row, gh) -> float:
        met = float((t * gh[i]).sum())
        return row.raw / all_raw / met if met > 0 else 0.0

    error = 1.0
    for rounds in range(1, ROUNDS + 1):
        gh = np.outer(g, h).ravel()
        m = _summed(rows, lambda i, t, row, gh=gh: factor(i, t, row, gh) * t, len(gh)).reshape(shape)
        now = m * g[:, None] * h[None, :]
        error = float(max(np.abs(now.sum(1) - want_g).max(), np.abs(now.sum(0) - want_h).max()))
        if error < TOLERANCE:
            break
        for _ in range(20):
            by = (m * h[None, :]).sum(1)
            g = np.where(by > 0, want_g / np.where(by > 0, by, 1), 0)
            by = (m * g[:, None]).sum(0)
            h = np.where(by > 0, want_h / np.where(by > 0, by, 1), 0)
    gh = np.outer(g, h).ravel()

    def weighted(batches):
        for pdf in batches:
            pdf["f"] = [factor(np.asarray(r.i, np.int64), np.asarray(r.t, float), r, gh) for r in pdf.itertuples(index=False)]
            yield pdf[["source", "raw", "f", "i", "t"]]

    rows = materialize(rows.mapInPandas(weighted, "source string, raw double, f double, i array<long>, t array<double>"), "mix-weights")
    scale = _scale(rows, gh, keep_share * total, total)
    sources, draw_g, draw_h, draw_error = _bounded(rows, g, h, want_g, want_h, scale, keep_share * total)
    named = lambda ks, v: dict(zip(ks, map(float, v), strict=True))
    return Rake(sources, named(langs, g), named(topics, h), scale, error, rounds,
                named(langs, draw_g), named(topics, draw_h), draw_error)


def _filled(want: np.ndarray, most: np.ndarray, budget: float) -> np.ndarray:
    """``budget`` dealt in proportion to ``want``, at most ``most`` each; what
    one cannot take goes to the others."""
    full = np.zeros(len(want), bool)
    while True:
        left = budget - most[full].sum()
        open_ = np.where(full, 0.0, want)
        out = np.where(full, most, open_ * (left / open_.sum() if open_.sum() else 0.0))
        new = ~full & (out >= most) & (want > 0)
        if not new.any():
            return out
        full |= new


def _bounded(rows: DataFrame, g: np.ndarray, h: np.ndarray, want_g: np.ndarray, want_h: np.ndarray, scale: float, budget: float):
    """Raking of min(1, F G H) to the budget and the targets that the tokens
    can meet; ``rows``: source, raw, f, i, t. One small pass over the sources a
    round, in which each source's factor is solved for exactly."""
    shape, on = (len(g), len(h)), (np.outer(g, h) > 0).ravel()
    most = _summed(rows, lambda i, t, row: np.where(on[i], t, 0.0), len(on)).reshape(shape)
    budget = min(budget, float(most.sum()))
    goal_g, goal_h = _filled(want_g, most.sum(1), budget), _filled(want_h, most.sum(0), budget)

    def reachable(batches):
        for pdf in batches:
            pdf["most"] = [float(np.asarray(t, float)[on[np.asarray(i, np.int64)]].sum()) for i, t in zip(pdf["i"], pdf["t"], strict=True)]
            yield pdf

    held = rows.mapInPandas(reachable, "source string, raw double, f double, i array<long>, t array<double>, most double").where("most > 0")
    held = materialize(held, "mix-reachable")
    factor = 0.0                                     # a source's goal: least(most, raw * factor)
    for _ in range(ROUNDS):
        full = F.col("raw") * factor >= F.col("most")
        whole, open_ = held.agg(F.sum(F.when(full, F.col("most")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("raw")))).first()
        if not open_ or (budget - whole) / open_ <= factor * (1 + 1e-12):
            break
        factor = (budget - whole) / open_
    held = materialize(held.withColumn("goal", F.least("most", F.col("raw") * factor)), "mix-goals")
    G, H = g * scale, h.copy()

    def solved(source, i, t, goal, top, gh):
        """A source's factor (without end: all its cells at 1), and the free
        and held tokens of its cells."""
        m, own = np.where(on[i], t, 0.0), gh[i]
        w, live = m * own, m * own > 0
        if goal >= top * (1 - 1e-12):
            x = np.inf
        else:
            # cells reach 1 in the order of gh; met[k]: the tokens drawn as the k-th does
            order = np.argsort(-own[live], kind="stable")
            mm, ww, vv = m[live][order], w[live][order], own[live][order]
            full = np.r_[0.0, np.cumsum(mm)]
            free = np.r_[np.cumsum(ww[::-1])[::-1], 0.0]
            k = int(np.searchsorted(full[:-1] + free[:-1] / vv, goal)) if len(vv) else 0
            x = (goal - full[k]) / free[k] if k < len(vv) and free[k] > 0 else np.inf
        p = np.where(live, x * np.where(live, own, 1.0), 0.0)
        return min(x, 1e300), np.where(p < 1, p * m, 0.0), np.where(p >= 1, m, 0.0)

    def parts(i, t, row, gh):
        _, free, full = solved(row.source, i, t, row.goal, row.most, gh)
        return np.concatenate([free, full])

    best = None
    for _ in range(DRAW_ROUNDS):
        gh = np.outer(G, H).ravel()
        both = _summed(held, lambda i, t, row, gh=gh: parts(i, t, row, gh), 2 * len(gh), len(gh))
        free, full = both[:len(gh)].reshape(shape), both[len(gh):].reshape(shape)
        now = free + full
        error = float(max(np.abs(now.sum(1) - goal_g).max(), np.abs(now.sum(0) - goal_h).max()) / budget)
        if best is None or error < best[2]:
            best = (G, H, error)
        if error < DRAW_TOLERANCE:
            break
        u, v = np.ones(shape[0]), np.ones(shape[1])
        for _ in range(5):
            u = _ratio(goal_g - full.sum(1), (free * v[None, :]).sum(1), goal_g, now.sum(1), u)
            v = _ratio(goal_h - full.sum(0), (free * u[:, None]).sum(0), goal_h, now.sum(0), v)
        G, H = G * u, H * v
    G, H, error = best
    gh = np.outer(G, H).ravel()

    def factors(batches):
        for pdf in batches:
            out = [(r.source, r.f, solved(r.source, np.asarray(r.i, np.int64), np.asarray(r.t, float), r.goal, r.most, gh)[0])
                   for r in pdf.itertuples(index=False)]
            yield pd.DataFrame(out, columns=["source", "f", "draw_f"])

    return held.mapInPandas(factors, "source string, f double, draw_f double"), G, H, error


def _ratio(left: np.ndarray, free: np.ndarray, goal: np.ndarray, now: np.ndarray, old: np.ndarray) -> np.ndarray:
    """The factors that bring the free tokens to what is left, within 1/8 and
    8 a round; where the held ones are too many, those that lower the group."""
    lower = np.where(now > 0, goal / np.where(now > 0, now, 1), 1.0)
    out = np.where(left > 0, left / np.where(free > 0, free, 1), lower)
    return np.clip(np.where((free > 0) | (left < 0), out, old), 0.125, 8.0)


def _scale(rows: DataFrame, gh: np.ndarray, budget: float, total: float) -> float:
    """The factor s with sum(min(1, s * weight) * tokens) = budget, by narrowing
    a grid of 32 factors three times; one small pass each."""
    def extremes(batches):
        low, high = [], []
        for pdf in batches:
            for f, i, t in zip(pdf["f"], pdf["i"], pdf["t"], strict=True):
                w = (f * gh[np.asarray(i, np.int64)])[np.asarray(t, float) > 0]
                w = w[w > 0]
                if len(w):
                    low.append(float(w.min()))
                    high.append(float(w.max()))
        yield pd.DataFrame({"low": [min(low)] if low else [], "high": [max(high)] if high else []}, dtype=float)

    def drawn(grid):
        def run(batches):
            met = np.zeros(len(grid))
            for pdf in batches:
                for f, i, t in zip(pdf["f"], pdf["i"], pdf["t"], strict=True):
                    w = f * gh[np.asarray(i, np.int64)]
                    met += (np.minimum(1.0, w[None, :] * np.exp(grid)[:, None]) * np.asarray(t, float)[None, :]).sum(axis=1)
            yield pd.DataFrame({"k": np.arange(len(grid)), "met": met})
        return run

    least, most = rows.mapInPandas(extremes, "low double, high double").agg(F.min("low"), F.max("high")).first()
    if least is None:
        return 0.0
    low, high = np.log(1e-3 * budget / total / most), np.log(2 / least)
    for _ in range(4):
        grid = np.linspace(low, high, 32)
        met = sorted((r["k"], r["met"]) for r in rows.mapInPandas(drawn(grid), "k long, met double").groupBy("k").agg(F.sum("met").alias("met")).collect())
        k = int(np.searchsorted(np.maximum.accumulate(np.array([x for _, x in met], float)), budget))
        low, high = grid[max(k - 1, 0)], grid[min(k, 31)]
    return float(np.exp(high))


def _axes(docs: DataFrame, source_col: str, lang_col: str, topic: Column | None, id_col: str, text_col: str,
          kept: list[str] | None) -> DataFrame:
    name = lambda c: F.coalesce(F.col(f"row.`{c}`").cast("string"), F.lit(NONE))
    rows = packed(docs, id_col, text_col)
    row = F.col("row") if kept is None else F.struct(*[F.col("row").getField(c).alias(c) for c in kept]).alias("row")
    named = (row, "id", "h", name(source_col).alias("source"), name(lang_col).alias("lang"))
    if topic is not None:
        rows = rows.withColumn("topic", topic).select(*named, "topic", n_tokens(F.col("text")).alias("tokens"))
    else:
        rows = materialize(count_words(rows).select(*named, "_hash", "_words"), "mix-words")
        rows = learn_topics(rows).assign(rows).withColumn("tokens", F.col("_words.n").cast("double"))
    rows = rows.select("row", "id", "h", "source", "lang", F.coalesce(F.col("topic").cast("string"), F.lit(NONE)).alias("topic"), "tokens")
    return rows if kept is None else materialize(rows, "mix-topics")


def mix(docs: DataFrame, source_col: str = "source", lang_col: str = "lang", topic: Column | None = None,
        id_col: str = "doc_id", text_col: str = "text", seed: int = 17, kept: list[str] | None = None, **targets) -> DataFrame:
    """The drawn rows with ``row``, id, source, lang, topic, tokens, weight and
    probability. ``topic`` is an expression over row, id and text; ``row`` holds
    the columns ``kept`` of ``docs`` (all by default)."""
    rows = _axes(docs, source_col, lang_col, topic, id_col, text_col, kept)
    cells = materialize(rows.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")), "mix-cells")
    raked = rake(cells, **targets)
    if raked is None:
        return rows.withColumn("weight", F.lit(0.0)).withColumn("probability", F.lit(0.0)).where("false")
    out = (rows.join(materialize(raked.sources, "mix-factors"), "source")
           .withColumn("weight", raked.weight())
           .withColumn("probability", raked.probability()).drop("f", "draw_f"))
    draw = F.pmod(F.xxhash64(F.lit(seed), "id", "h"), F.lit(1 << 40)) / float(1 << 40)
    return out.where(draw < F.col("probability"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    return unpacked(mix(docs, **options), docs.columns)


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    drawn = mix(table(spark, sf_dir, "documents"), kept=["doc_id"])
    return drawn.select(F.col("id").alias("doc_id"), "source", "lang", "topic", F.col("tokens").cast("long").alias("n_tokens"),
                        "weight", "probability")
