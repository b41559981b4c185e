"""Hard negatives by angular triangle filtering.

For unit vectors a, b and a reference direction r, the angle between a and b
lies between ``|A - B|`` and ``min(A + B, 2 pi - A - B)``, A and B being their
angles to r. Stored angles to ``REFS`` directions thus give an interval for
the cosine; times the norms, it bounds the inner product. Only where that
interval meets the window of scores that are still wanted, the integer product
is computed.

1. Components become integers; every row stores its norm and its angles to the
   reference directions (chosen far from each other in a bounded sample; any
   choice gives the same result, a good one prunes more).
2. The index is written sorted by (label, nearest direction, angle to it), by
   ranges, so that a label or a vector with a third of the rows is spread.
   Consecutive rows of a label form blocks with a range of angles and norms.
3. Anchors are taken in groups of bounded size, each broadcast to one pass
   over the index (a stated query set against all rows, in blocks). In a task,
   blocks whose score interval misses an anchor's window are left out, then
   rows; what remains is scored. The window closes as better rows are found.
4. The tasks' first rows per anchor are merged by a window over the anchor.

The first search finds the positives (same label, window open upwards), the
second the negatives of each positive (other labels, the given share of its
score).

Scores are exact: products of doubles while norms multiply to less than 2**53,
64-bit integers beyond; where even those could overflow, the search raises.
Angles carry a slack above the rounding of arccos, bounds are widened by one.

Defined results: rows with a null label, a null vector, or a null or
non-finite component take no part; rows equal in id, label and integer vector
count once; rows that share an id but differ are rows of their own, and ties
between them go by their order in the index; a null id is never an anchor and
comes last among equal scores; shorter vectors count as padded with zeros; an
empty vector scores 0; an empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import col, materialize, table

#: Reference directions; rows of the sample they are chosen from; rows of a block.
REFS, SAMPLE, BLOCK = 16, 2048, 256
#: Bytes of one broadcast group of anchors.
GROUP_BYTES = 8 << 20
#: Beyond the error of arccos near its ends (the root of the double's epsilon).
SLACK = 1e-7
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def quantized(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int = 256) -> DataFrame:
    """(vec_id, label, vec): integer components, rows that take part only."""
    v = F.transform(col(vec_col), lambda x: F.lit(float(scale)) * x.cast("double"))
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float(1 << 31)))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.select(col(id_col).cast("long").alias("vec_id"), col(label_col).cast("long").alias("label"), v.alias("v"))
            .where(F.col("label").isNotNull() & F.col("v").isNotNull()).where(finite)
            .select("vec_id", "label", F.when(fit, F.transform("v", lambda x: F.floor(x))).otherwise(
                F.raise_error(F.lit("a component times the scale does not fit 32 bits"))).alias("vec")))


def _directions(sample: np.ndarray, refs: int) -> np.ndarray:
    """Unit vectors of the sample, each as far from the others as can be."""
    norm = np.linalg.norm(sample, axis=1)
    unit = sample[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return np.eye(1, max(sample.shape[1], 1))[:, :sample.shape[1]]
    chosen = [0]
    near = unit @ unit[0]
    while len(chosen) < min(refs, len(unit)):
        far = int(np.argmin(near))
        if near[far] > 1 - 1e-9:
            break
        chosen.append(far)
        near = np.maximum(near, unit @ unit[far])
    return unit[chosen]


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(rows, -1)


def _angled(directions: np.ndarray):
    """Adds norm, angles to the directions, the nearest one and its angle."""
    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            vec = _matrix(batch.column("vec"), len(batch), np.float64)
            norm = np.sqrt(np.einsum("ij,ij->i", vec, vec))
            cos = vec @ directions.T / np.maximum(norm, 1e-300)[:, None]
            angles = np.arccos(np.clip(cos, -1, 1))
            home = angles.argmin(axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, angles.size + 1, angles.shape[1], dtype=np.int32)), pa.array(angles.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norm), lists, pa.array(home.astype(np.int32)), pa.array(angles[np.arange(len(vec)), home])],
                names=[*batch.schema.names, "norm", "angles", "home", "near"])
    return run


def build_index(rows: DataFrame, refs: int = REFS) -> tuple[DataFrame, int]:
    """The written index (rid, vec_id, label, vec, norm, angles), sorted
    by label, nearest direction and angle; and the dimension."""
    spark = rows.sparkSession
    rows = materialize(rows.select("vec_id", "label", "vec", F.xxhash64("vec").alias("tie"))
                       .dropDuplicates(["vec_id", "label", "vec"]), "negatives-rows")
    width = rows.agg(F.max(F.size("vec"))).first()[0] or 1
    padded = F.concat("vec", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("vec")))
    rows = rows.withColumn("vec", F.when(F.size("vec") < width, padded).otherwise(F.col("vec")))
    few = max(1, min(SAMPLE, GROUP_BYTES // (8 * width)))
    sample = np.array([r[0] for r in rows.orderBy("tie", "vec_id").limit(few).select("vec").collect()], np.float64).reshape(-1, width)
    angled = rows.mapInArrow(_angled(_directions(sample, refs)),
                             "vec_id long, label long, vec array<bigint>, tie long, norm double, angles array<double>, home int, near double")
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    by = ["label", "home", "near", "vec_id", "tie"]
    placed = materialize(angled, "negatives-angles").repartitionByRange(n, *by).sortWithinPartitions(*by)
    index = placed.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "vec", "norm", "angles")
    index = materialize(index, "negatives-index")
    if (index.agg(F.max("norm")).first()[0] or 0.0) ** 2 >= 2.0 ** 62:
        raise OverflowError("inner products may not fit 64 bits")
    return index, width


class Anchors:
    """One group of anchors and the windows of scores they ask for."""

    def __init__(self, rid, label, vec, norm, angles, low, high):
        self.rid, self.label, self.vec, self.norm, self.angles = rid, label, vec, norm, angles
        self.low, self.high = low, high            # whole numbers, anchors x slots; no window: low > high


def _products(a: np.ndarray, b: np.ndarray, most: float) -> np.ndarray:
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _bounds(angles: np.ndarray, low: np.ndarray, high: np.ndarray, norm: np.ndarray, short: np.ndarray, long: np.ndarray):
    """Bounds of the products of anchors (rows) with vectors (columns) whose
    angles lie in [low, high] and whose norms lie in [short, long]."""
    least = np.zeros((len(angles), len(low)))
    most = np.full(least.shape, np.pi)
    for r in range(angles.shape[1]):
        a, lo, hi = angles[:, r, None], low[None, :, r], high[None, :, r]
        np.maximum(least, np.maximum(a - hi, lo - a), out=least)
        np.minimum(most, np.minimum(a + hi, 2 * np.pi - a - lo), out=most)
    top, bottom = np.cos(np.maximum(least - SLACK, 0)), np.cos(np.minimum(most + SLACK, np.pi))
    n, s, l = norm[:, None], short[None, :], long[None, :]
    above = n * np.where(top > 0, l, s) * top
    below = n * np.where(bottom > 0, s, l) * bottom
    return below - np.abs(below) * 1e-12 - 1, above + np.abs(above) * 1e-12 + 1


class Best:
    """The first ``k`` rows of every (anchor, slot), by score, id, place."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.k, self.kept = k, np.empty((0, 6), np.int64)
        self.floor = np.full((anchors, slots), LEAST)       # the last kept score of full lists

    def add(self, anchor, slot, score, vec_id, none, rid):
        rows = np.column_stack([anchor, slot, -score, none, vec_id, rid]).astype(np.int64)
        rows = np.concatenate([self.kept, rows])
        rows = rows[np.lexsort(rows.T[::-1])]
        change = np.flatnonzero(np.any(np.diff(rows[:, :2], axis=0) != 0, axis=1)) + 1
        starts = np.concatenate([[0], change]).astype(np.int64)
        place = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
        self.kept = rows[place < self.k]
        full = rows[place == self.k - 1]
        self.floor[full[:, 0], full[:, 1]] = -full[:, 2]


def _searching(group, k: int, same: bool):
    """Scans the index for the first ``k`` rows per anchor and slot."""
    def run(batches):
        g = group.value
        best = Best(len(g.rid), g.low.shape[1], k)
        for batch in batches:
            if not (n := len(batch)):
                continue
            label = batch.column("label").to_numpy()
            rid = batch.column("rid").to_numpy()
            vec = _matrix(batch.column("vec"), n, np.int64)
            angles = _matrix(batch.column("angles"), n, np.float64)
            norm = batch.column("norm").to_numpy()
            none = batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            ids = batch.column("vec_id").fill_null(0).to_numpy()
            cuts = np.union1d(np.flatnonzero(np.diff(label)) + 1, np.arange(0, n, BLOCK))
            starts = np.union1d([0], cuts).astype(np.int64)
            ends = np.append(starts[1:], n)
            low, high = np.minimum.reduceat(angles, starts), np.maximum.reduceat(angles, starts)
            short, long = np.minimum.reduceat(norm, starts), np.maximum.reduceat(norm, starts)
            below, above = _bounds(g.angles, low, high, g.norm, short, long)
            fit = (g.label[:, None] == label[starts][None, :]) == same
            order = np.argsort(-above.max(axis=0), kind="stable") if len(g.rid) else []
            for b in order:
                s, e = starts[b], ends[b]
                wanted = np.maximum(g.low, best.floor)              # ties may still win by id
                meets = (above[:, b, None] >= wanted) & (below[:, b, None] <= g.high) & (wanted <= g.high)
                who = np.flatnonzero(fit[:, b] & meets.any(axis=1))
                if not len(who):
                    continue
                lo, hi = _bounds(g.angles[who], angles[s:e], angles[s:e], g.norm[who], norm[s:e], norm[s:e])
                floor, ceil = wanted[who].min(axis=1), g.high[who].max(axis=1)
                open_ = (hi >= floor[:, None]) & (lo <= ceil[:, None]) & (g.rid[who][:, None] != rid[None, s:e])
                rows, cols = open_.any(axis=1), open_.any(axis=0)
                if not rows.any():
                    continue
                who, at = who[rows], np.flatnonzero(cols) + s
                open_ = open_[np.ix_(rows, cols)]
                score = _products(g.vec[who], vec[at], float(g.norm[who].max() * norm[at].max()))
                found = []
                for slot in range(g.low.shape[1]):
                    i, j = np.nonzero(open_ & (score >= wanted[who, slot, None]) & (score <= g.high[who, slot, None]))
                    if len(i):
                        found.append((who[i], np.full(len(i), slot), score[i, j], at[j]))
                if found:
                    a, sl, sc, row = (np.concatenate(x) for x in zip(*found, strict=True))
                    best.add(a, sl, sc, ids[row], none[row], rid[row])
        if len(best.kept):
            a, slot, score, none, ids, rid = best.kept.T
            yield pa.RecordBatch.from_arrays([
                pa.array(g.rid[a]), pa.array(slot.astype(np.int32)), pa.array(rid), pa.array(-score),
                pa.array(ids, mask=none.astype(bool))], names=FOUND.replace(",", "").split()[::2])
    return run


FOUND = "anchor long, slot int, rid long, score long, vec_id long"


def search(index: DataFrame, width: int, asking: DataFrame, slots: int, k: int, same: bool, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The first ``k`` rows of the index for every row of ``asking`` (rid,
    label, vec, norm, angles, low array<long>, high array<long>: the
    windows), of the same label or of others: (anchor, slot, rid, score,
    vec_id, rank). Anchors come in groups of ``group_bytes``."""
    spark = index.sparkSession
    size = max(1, group_bytes // (8 * (width + REFS + 2 * slots + 3)))
    total = asking.count()
    groups = -(-total // size)
    parts = []
    keyed = materialize(asking.withColumn("_group", F.pmod(F.xxhash64("rid"), F.lit(max(groups, 1)))), "negatives-asking")
    for no in range(groups):
        # a group of hashed rows holds ``size`` rows on average
        got = keyed.where(F.col("_group") == no).drop("_group").toArrow()
        if not len(got):
            continue
        group = spark.sparkContext.broadcast(Anchors(
            got["rid"].to_numpy(), got["label"].to_numpy(), _matrix(got["vec"].combine_chunks(), len(got), np.int64),
            got["norm"].to_numpy(), _matrix(got["angles"].combine_chunks(), len(got), np.float64),
            _matrix(got["low"].combine_chunks(), len(got), np.int64), _matrix(got["high"].combine_chunks(), len(got), np.int64)))
        found = index.mapInArrow(_searching(group, k, same), FOUND)
        first = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "rid")
        parts.append(materialize(found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k), "negatives-found"))
        group.unpersist()
    if not parts:
        return spark.createDataFrame([], FOUND + ", rank int")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mine(rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``rows`` (vec_id, label, vec) -> for each anchor (rows with
    ``is_anchor``) and each of its ``positives`` first rows of the same label,
    the ``negatives`` first rows of other labels whose score is ``low`` to
    ``high`` hundredths of the positive's."""
    index, width = build_index(rows)
    anchors = index.where(is_anchor)
    asking = anchors.select("rid", "label", "vec", "norm", "angles", F.array(F.lit(LEAST)).alias("low"), F.array(F.lit(MOST)).alias("high"))
    near = search(index, width, asking, 1, positives, True, group_bytes)
    # 100 n >= low p and 100 n <= high p: the least and the greatest integers
    hundredths = lambda x: f"((CAST(score AS DECIMAL(20, 0)) * {x}) - pmod(CAST(score AS DECIMAL(20, 0)) * {x}, 100)) div 100"
    least, most = F.expr(f"-({hundredths(-low)})"), F.expr(hundredths(high))
    wide = materialize(near.select(F.col("anchor").alias("rid"), F.struct(
        (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
        least.cast("long").alias("least"), most.cast("long").alias("most")).alias("p"))
        .groupBy("rid").agg(F.array_sort(F.collect_list("p")).alias("p")), "negatives-windows")
    fill = lambda name, none: F.concat(F.transform("p", lambda x: x[name]),
                                       F.array_repeat(F.lit(none), F.lit(positives) - F.size("p")))
    named = anchors.select("rid", "vec_id", "label", "vec", "norm", "angles").join(wide, "rid")
    asking = named.select("rid", "label", "vec", "norm", "angles", fill("least", MOST).alias("low"),
                          fill("most", LEAST).alias("high"))
    far = search(index, width, asking, positives, negatives, False, group_bytes)
    slots = named.select(F.col("rid").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.explode("p").alias("p")).select(
        "anchor", "anchor_id", F.col("p.slot").cast("int").alias("slot"), "p.positive_id", "p.positive_score")
    return far.join(slots, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = quantized(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH q AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
           AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
      CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other) <= 3
"""
