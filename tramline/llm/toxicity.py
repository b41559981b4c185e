"""Toxicity by gradient-boosted trees over dense features.

1. At most ``MAX_FIT_ROWS`` different labelled texts are taken for the fit (by
   the smallest hash), never a held-out one; copies count once and are toxic if
   one of their labels says so. They are dealt by text
   hash, so that copies stay together: half learns the lexicon, three tenths
   the trees, two tenths the calibration.
2. Lexicon: words and word beginnings (4 to 8 letters) that mark toxic
   documents, by the z-score of their document counts, from one Spark
   aggregation; the ``LEXICON_SIZE`` strongest are kept.
3. Features of a text: lexicon densities, nearness of second-person words to
   lexicon words, capitals, punctuation and obfuscation rates (``FEATURES``).
4. Spark ML's gradient-boosted trees, then its isotonic regression of the
   label on the trees' probability, fitted on documents neither step saw.

Label, language, source and id are never inputs of a score. Defined results:
null text counts as empty; an id with several labels is toxic if one says so;
null labels and labels of unknown ids are ignored; if the fit rows hold one
class only (or none), every document gets that class's smoothed share; equal
texts get equal scores; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialize, packed, table
from .prefilter import may_be_in

MAX_FIT_ROWS = 12_000
LEXICON_SIZE = 1_500
LEXICON_Z = 5.0
#: Second-person words of the four languages.
SECOND_PERSON = frozenset((
    "you your yours yourself du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros").split())
#: Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("013457@$!", "oieastasi")
FEATURES = ("word_hits", "word_weight", "stem_hits", "stem_weight", "log_hits", "distinct_hits", "dense_window",
            "near_second_person", "second_person", "capitals", "capital_words", "exclamations", "questions",
            "punctuation", "obfuscated", "disguised_hits", "letter_runs", "symbols", "log_words", "repetition")

_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"(?<![^\s])[^\W\d_]+[0-9@$!*#]+[^\W\d_]+")
_RUN = re.compile(r"([^\W\d_])\1\1")


def text_features(text: str, words: dict[str, float], stems: dict[str, float], window: int = 50) -> list[float]:
    """Dense features of one text, whatever its length (order of FEATURES)."""
    text = text or ""
    low = text.lower()
    tokens = _WORD.findall(low)
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    counts = Counter(tokens)
    hits = stem_hits = stem_weight = weight = 0.0
    marked = {}
    for w, k in counts.items():
        v = words.get(w, 0.0)
        s = max((stems.get(w[:j], 0.0) for j in range(4, min(len(w), 8) + 1)), default=0.0)
        if v:
            hits += k
            weight += v * k
        if s:
            stem_hits += k
            stem_weight += s * k
        if v or s:
            marked[w] = v + s
    near = dense = second = 0.0
    yous = sum(counts[w] for w in SECOND_PERSON if w in counts)
    if marked:
        at = np.array([i for i, w in enumerate(tokens) if w in marked])
        dense = np.max(np.searchsorted(at, at + window) - np.arange(len(at))) / min(window, n)
        if yous:
            you = np.array([i for i, w in enumerate(tokens) if w in SECOND_PERSON])
            left = np.searchsorted(you, at - 5)
            near = float(np.mean((left < len(you)) & (you[np.minimum(left, len(you) - 1)] <= at + 5)))
    second = yous / n
    upper = sum(map(str.isupper, text))
    letters = sum(map(len, tokens))
    caps = sum(1 for w in _WORD.findall(text) if len(w) > 1 and w.isupper()) if upper else 0
    mixed = _MIXED.findall(low)
    disguised = sum(1 for m in mixed if (p := m.translate(DISGUISE)) in words or p[:6] in stems)
    length = len(text)
    punctuation = sum(low.count(c) for c in ".,;:!?")
    symbols = sum(low.count(c) for c in "#*$%&|<>@")
    return [100 * hits / n, 100 * weight / n, 100 * stem_hits / n, 100 * stem_weight / n, float(np.log1p(hits + stem_hits)),
            float(np.log1p(len(marked))), float(dense), near, second, upper / letters, caps / n,
            low.count("!") / length, low.count("?") / length, punctuation / length, len(mixed) / n,
            100 * disguised / n, len(_RUN.findall(low)) / n, symbols / length, float(np.log1p(n)), 1 - len(counts) / n]


def features_column(text: Column, words: dict[str, float], stems: dict[str, float]) -> Column:
    """The lexicon goes with the function; it holds at most LEXICON_SIZE entries."""
    @F.pandas_udf("array<double>")
    def featurize(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: text_features(t, words, stems))

    return featurize(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """(text, label, part): the bounded sample that all fits use."""
    label = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("label").cast("double").alias("label")))
    part = F.pmod(F.xxhash64(F.lit("part"), "text"), F.lit(10))
    # the rows are chosen by id and hash alone; only the texts of those chosen are fetched
    chosen = materialize(docs.select("id", "h").join(label, "id").groupBy("h")
                         .agg(F.min("id").alias("id"), F.max("label").alias("label")).orderBy("h").limit(max_rows), "toxicity-rows")
    likely = may_be_in(chosen, "id", F.col("id"))
    texts = docs if likely is None else docs.where(likely)
    return (texts.select("id", F.coalesce("text", F.lit("")).alias("text"), "h").join(chosen, ["id", "h"]).dropDuplicates(["h"])
            .select("text", "label", "h", part.alias("part")))


def learn_lexicon(fit: DataFrame, size: int) -> tuple[dict[str, float], dict[str, float]]:
    """Words and word beginnings with a z-score of their toxic document count
    of at least LEXICON_Z, the strongest ``size``."""
    n, toxic = fit.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not n or not toxic or toxic == n:
        return {}, {}
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    stems = F.array_distinct(F.flatten(F.transform(F.lit([4, 5, 6, 7, 8]), lambda k: F.transform(
        F.filter("words", lambda w: F.length(w) >= k), lambda w: F.concat(F.lit("^"), F.substring(w, F.lit(1), k))))))
    share = float(toxic) / n
    expected = F.col("n") * share
    found = (fit.select("label", words.alias("words"))
             .select("label", F.explode(F.concat("words", stems)).alias("entry"))
             .groupBy("entry").agg(F.count("*").alias("n"), F.sum("label").alias("toxic"))
             .where("n >= 4 AND entry <> '' AND entry <> '^'")
             .withColumn("z", (F.col("toxic") - expected) / F.sqrt(expected * (1 - share)))
             .where(F.col("z") >= LEXICON_Z)
             .select("entry", "z", (F.log((F.col("toxic") + 0.5) / (F.col("n") - F.col("toxic") + 0.5))
                                    - float(np.log(share / (1 - share)))).alias("weight"))
             .orderBy(F.desc("z"), "entry").limit(size).collect())
    return ({r.entry: r.weight for r in found if r.entry[0] != "^"},
            {r.entry[1:]: r.weight for r in found if r.entry[0] == "^"})


class ToxicityModel:
    """Lexicon, trees and calibration; ``share`` alone if there was nothing to learn from."""

    def __init__(self, words, stems, share, trees=None, calibration=None):
        self.words, self.stems, self.share = words, stems, share
        self.trees, self.calibration = trees, calibration

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with a column text) plus ``score`` and ``predicted``."""
        if self.trees is None:
            out = rows.withColumn("score", F.lit(float(self.share)))
        else:
            keep = [c for c in rows.columns]
            featured = rows.withColumn("features", array_to_vector(
                features_column(F.coalesce("text", F.lit("")), self.words, self.stems)))
            raw = _with_margin(self.trees, featured)
            out = self.calibration.transform(raw).select(
                *keep, _score(F.col("calibrated"), F.col("margin")).alias("score"))
        return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _with_margin(trees, featured: DataFrame) -> DataFrame:
    return trees.transform(featured).withColumn("margin", vector_to_array("probability")[1])


def _score(calibrated: Column, margin: Column) -> Column:
    """Isotonic value; a thousandth of the raw probability orders its plateaus."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), calibrated * 0.999 + margin * 0.001))


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS,
                 lexicon_size: int = LEXICON_SIZE) -> ToxicityModel:
    """``docs``: columns id, text, h (see ``packed``)."""
    fit = materialize(fit_rows(docs, labels, max_rows), "toxicity-fit")
    words, stems = learn_lexicon(fit.where("part < 5"), lexicon_size)
    classes = {r["part"]: (r["n"], r["toxic"]) for r in fit.groupBy(
        F.when(F.col("part") < 5, 0).when(F.col("part") < 8, 1).otherwise(2).alias("part"))
        .agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).collect()}
    n, toxic = (sum(x) for x in zip(*classes.values(), strict=True)) if classes else (0, 0)
    share = (toxic + 1) / (n + 2) if n else 0.0
    if any(not 0 < classes.get(k, (0, 0))[1] < classes.get(k, (0, 0))[0] for k in (1, 2)):
        return ToxicityModel(words, stems, share)
    # at most max_rows rows of 20 numbers: one sorted partition makes the trees repeatable
    featured = materialize(
        fit.where("part >= 5").repartition(8).withColumn("f", features_column(F.col("text"), words, stems))
        .select("label", "part", "f", "h"), "toxicity-features")
    featured = (featured.coalesce(1).sortWithinPartitions("h", "label")
                .select("label", "part", array_to_vector("f").alias("features")))
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=24, maxDepth=4, stepSize=0.25,
                          minInstancesPerNode=5, seed=11).fit(featured.where("part < 8"))
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="calibrated").fit(
        _with_margin(trees, featured.where("part >= 8")).select("margin", "label"))
    return ToxicityModel(words, stems, share, trees, calibration)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **fit) -> DataFrame:
    """(row, id, text, h, score, predicted) of every row of ``docs``."""
    rows = packed(docs, id_col, text_col)
    return fit_toxicity(rows.select("id", "text", "h"), labels, **fit).scored(rows)


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, with their columns."""
    return score_documents(docs, labels, **options).where("predicted = 0").select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns])


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", "predicted")
