"""Merkle manifest of a dataset: a tree per group of rows, a tree over the
groups' roots, and for every row the siblings that prove it.

A node is labelled with the interval of leaf ranks it covers: a node of level
``k`` covers ``[i * fan**k, min((i + 1) * fan**k, n))``. A node lies below
another if its interval is contained in the other's, and the siblings of a
node are what is left of its parent's interval without its own.

1. ``ranked``: a range-partitioned sort (tree, keys) tags the rows with
   partition and position; counts per (tree, partition) give each row its rank
   in its tree and the tree's size. No window runs over a tree's rows, so a
   tree that holds a third of all rows is spread like the others.
2. ``build``: ``BAND`` levels at a time. The nodes of one bucket, that is of
   one interval of ``fan**BAND`` ranks, are gathered in one row (243 leaves at
   most) and nested by interval; a bucket's top is a leaf of the next band.
   The rows shrink by the factor 243 per band: 10**12 leaves take 6 bands.
3. ``paths``: from the top band down, a bucket meets the ancestor that covers
   it by a join on (tree, bucket of the level) with interval containment and
   takes over its path. Inside a bucket, a node's siblings are those of its
   parent's nodes whose intervals lie before or behind its own. What a leaf
   carries (``row``) travels with it, so its path is never shuffled.

Each leaf's path is a list of (left, right), bottom first: the siblings'
digests before and behind it. ``fold`` computes a root from a leaf and a path.

Defined results: rows without a key come first in their tree; rows that share
a key come in the order of their digests, equal rows each are a leaf; a null
tree is a tree of its own; a tree of one row has the leaf as its root and an
empty path; an empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import col, materialize, table

#: Children per node, and levels that one bucket holds.
FAN, BAND = 3, 5


def encoded(value: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def row_digest(columns: dict[str, Column]) -> Column:
    """The leaf digest of a row: its fields, each encoded, in this order."""
    return sha(F.concat(*[encoded(c) for c in columns.values()]))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with the column ``tree``, never null) with ``rank`` (from 0)
    and ``size`` of their tree. ``order`` begins with what orders the trees."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    # the running id only deals equal rows over several partitions
    keyed = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(c).asc_nulls_first() for c in [*order, "_tie"]]
    tagged = materialize(keyed.repartitionByRange(n, *by).sortWithinPartitions(*by).drop("_tie")
                         .select("*", F.monotonically_increasing_id().alias("_at")), "merkle-sorted")
    part = F.shiftright("_at", 33)
    tagged = tagged.withColumn("_part", part).withColumn("_place", F.col("_at") - F.shiftleft(part, 33)).drop("_at")
    # one row per tree and partition that holds some of it
    counts = tagged.groupBy("tree", "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    tree = Window.partitionBy("tree")
    before = F.sum("_n").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = materialize(counts.select("tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_base"),
                                        F.sum("_n").over(tree).alias("size")), "merkle-offsets")
    return (tagged.join(offsets, ["tree", "_part"])
            .withColumn("rank", F.col("_base") + F.col("_place")).drop("_part", "_place", "_base"))


def _parents(nodes: Column, fan: int, more: Column) -> Column:
    """The next level over a sorted list of nodes that begins a bucket: runs
    of ``fan`` nodes become their parent's ``kids``. Where the tree has only
    one node left (not ``more``), a node is handed up as it is."""
    width = F.when(more, F.lit(fan)).otherwise(F.lit(1))
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / width).cast("int"))

    def parent(i):
        run = F.slice(nodes, i * width + 1, width)
        joined = sha(F.array_join(F.transform(run, lambda x: x["digest"]), ""))
        return F.struct(F.element_at(run, 1)["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi"),
                        F.when(more, joined).otherwise(F.element_at(run, 1)["digest"]).alias("digest"), run.alias("kids"))
    return F.transform(runs, parent)


def build(leaves: DataFrame, fan: int = FAN, band: int = BAND) -> list[DataFrame]:
    """``leaves`` (tree, rank, size, digest, row) -> per band a written table
    of buckets: tree, bucket, size (nodes of the tree at the band's bottom),
    top (the bucket's nodes, nested: lo, hi, digest, kids). The last band
    holds each tree in one bucket; trees that end earlier have no rows in
    later bands."""
    wide = fan ** band
    rows = leaves.select("tree", F.col("rank").alias("at"), "size",
                         F.struct(F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", "row").alias("node"))
    bands = []
    while True:
        made = (rows.groupBy("tree", F.floor(F.col("at") / F.lit(wide)).alias("bucket"))
                .agg(F.array_sort(F.collect_list("node"), lambda x, y: (x["lo"] - y["lo"]).cast("int")).alias("nodes"),
                     F.first("size").alias("size")))
        for k in range(band):
            made = made.withColumn("nodes", _parents(F.col("nodes"), fan, F.col("size") > fan ** k))
        made = materialize(made.select("tree", "bucket", "size", F.element_at("nodes", 1).alias("top")), "merkle-band")
        bands.append(made)
        unfinished = made.where(F.col("size") > wide)
        if unfinished.isEmpty():
            return bands
        rows = unfinished.select(
            "tree", F.col("bucket").alias("at"), F.ceil(F.col("size") / F.lit(wide)).alias("size"),
            F.struct("top.lo", "top.hi", "top.digest", F.lit(None).cast("string").alias("row")).alias("node"))


def roots(bands: list[DataFrame], fan: int = FAN, band: int = BAND) -> DataFrame:
    """(tree, root): one row per tree, the top of its only bucket."""
    return reduce(DataFrame.unionByName, [
        b.where(F.col("size") <= fan ** band).select("tree", F.col("top.digest").alias("root")) for b in bands])


PATH = "array<struct<left:string,right:string>>"


def paths(bands: list[DataFrame], outer: DataFrame | None = None, fan: int = FAN, band: int = BAND) -> DataFrame:
    """(tree, rank, digest, row, path, label) of every leaf. ``outer`` (tree,
    above, label) gives the path of each tree's root in an outer tree and
    whatever its leaves shall carry."""
    wide, carried = fan ** band, None
    for buckets in reversed(bands):
        here = buckets.where(F.col("size") <= wide)
        if outer is not None:
            here = here.join(outer, "tree")
        else:
            here = here.withColumn("above", F.array().cast(PATH)).withColumn("label", F.lit(None).cast("string"))
        if carried is not None:
            # the ancestor of a bucket: same tree, same bucket of the level, and an interval that holds the bucket's
            a = carried.select(F.col("tree").alias("_t"), F.col("at").alias("_at"), F.col("node.lo").alias("_lo"),
                               F.col("node.hi").alias("_hi"), F.col("path").alias("above"), "label")
            holds = (F.col("tree") == F.col("_t")) & (F.col("bucket") == F.col("_at")) & (
                F.col("top.lo") >= F.col("_lo")) & (F.col("top.hi") <= F.col("_hi"))
            here = here.unionByName(buckets.where(F.col("size") > wide).join(a, holds).drop("_t", "_at", "_lo", "_hi"))
        here = here.select("tree", F.col("bucket").alias("at"), "size", F.col("top").alias("node"), F.col("above").alias("path"), "label")
        for k in range(band - 1, -1, -1):
            kids = F.col("node.kids")
            # what the parent's interval holds before and behind the node's own
            split = F.transform(kids, lambda x: F.struct(
                x.alias("node"),
                F.array_join(F.transform(F.filter(kids, lambda y: y["hi"] <= x["lo"]), lambda y: y["digest"]), "").alias("left"),
                F.array_join(F.transform(F.filter(kids, lambda y: y["lo"] >= x["hi"]), lambda y: y["digest"]), "").alias("right")))
            more = F.col("size") > fan ** k
            here = here.select("tree", "at", "size", "path", "label", F.posexplode(split).alias("_i", "_x")).select(
                "tree", (F.col("at") * F.when(more, fan).otherwise(1) + F.col("_i")).alias("at"), "size",
                F.col("_x.node").alias("node"), "label",
                F.when(more, F.concat(F.array(F.struct("_x.left", "_x.right")), F.col("path"))).otherwise(F.col("path")).alias("path"))
        carried = here
    return carried.select("tree", F.col("node.lo").alias("rank"), "node.digest", "node.row", "path", "label")


def fold(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf digest and its path."""
    return F.aggregate(path, leaf, lambda acc, s: sha(F.concat(s["left"], acc, s["right"])))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings, level by level, left to right."""
    return sha(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def manifest(leaves: DataFrame, order: list[str], fan: int = FAN, band: int = BAND) -> DataFrame:
    """``leaves`` (group, digest, row) -> row, group's ``subroot``, ``root``,
    ``digest`` and ``path`` of every row. Groups are ordered bytewise, null
    first, rows in a group by ``order`` (fields of ``row``), then by digest."""
    keyed = leaves.select(encoded(F.col("group")).alias("tree"), "group", "digest", "row",
                          *[F.col(f"row.{c}").alias(f"_{c}") for c in order])
    ranks = ranked(keyed, ["group", *[f"_{c}" for c in order], "digest"])
    bands = build(ranks, fan, band)
    tops = roots(bands, fan, band).select(F.lit("").alias("tree"), F.col("root").alias("digest"), F.col("tree").alias("row"))
    # the tree's name says its group: null, or what follows the byte count
    tops = tops.withColumn("group", F.when(F.col("row") != "-", F.expr("substring(row, instr(row, ':') + 1)")))
    outer_bands = build(ranked(tops, ["group"]), fan, band)
    root = roots(outer_bands, fan, band)
    above = paths(outer_bands, None, fan, band).join(root, "tree").select(
        F.col("row").alias("tree"), F.col("path").alias("above"), F.struct(F.col("digest").alias("subroot"), "root").alias("label"))
    return paths(bands, materialize(above, "merkle-above"), fan, band).select("row", "digest", "path", "label.*")


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    named = lambda text: {"doc_id": col("doc_id"), "source": col("source"), "lang": col("lang"),
                          "n_chars": col("n_chars"), "text": text}
    hit = F.crc32(col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaves = docs.select(
        col("source").alias("group"), row_digest(named(col("text"))).alias("digest"),
        F.struct(col("doc_id").alias("doc_id"), F.when(hit, row_digest(named(
            F.replace(col("text"), F.lit("\n"), F.lit(""))))).alias("tampered")).alias("row"))
    rows = manifest(materialize(leaves, "merkle-leaves"), ["doc_id"])
    folded = fold(F.coalesce("row.tampered", "digest"), F.col("path"))
    return (rows.select("row.doc_id", F.col("digest").alias("leaf"), "subroot", "root",
                        proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def _op13_sql(levels: int = 16) -> str:
    """The tree level by level, with joins by run number (fan 3)."""
    enc = lambda e: f"coalesce(CAST(octet_length(encode(CAST({e} AS VARCHAR))) AS VARCHAR) || ':' || CAST({e} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256({' || '.join(enc(e) for e in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    step = "list_reduce(list_prepend(x, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)"
    out = [f"""WITH bytes AS (SELECT *, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS b FROM documents),
crc AS (SELECT * EXCLUDE (b), xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b),
    lambda s, c: {step.replace('(x,', '(xor(s, c),')}), 4294967295) AS crc FROM bytes),
leaves AS (SELECT doc_id, source, {leaf('text')} AS leaf,
    CASE WHEN crc % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS seen FROM crc),
u0 AS (SELECT {enc('source')} AS g, source, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    leaf AS d, count(*) OVER (PARTITION BY source) AS n, doc_id, seen FROM leaves),
p0 AS (SELECT g, doc_id, d AS leaf, i, '' AS proof, seen AS acc FROM u0)"""]
    state = "SELECT p.g, p.doc_id, p.leaf, CASE WHEN r.n > 1 THEN p.i // 3 ELSE p.i END AS i, " \
        "p.proof || CASE WHEN r.n > 1 THEN coalesce(r.l, '') || coalesce(r.r, '') ELSE '' END AS proof, " \
        "CASE WHEN r.n > 1 THEN sha256(coalesce(r.l, '') || p.acc || coalesce(r.r, '')) ELSE p.acc END AS acc"

    def climb(u: str, p: str, k: int, last_u: str, last_p: str):
        sib = (f"SELECT a.g, a.i, a.n, string_agg(b.d, '' ORDER BY b.i) FILTER (b.i < a.i) AS l, "
               f"string_agg(b.d, '' ORDER BY b.i) FILTER (b.i > a.i) AS r FROM {last_u} a JOIN {last_u} b "
               f"ON a.g = b.g AND a.i // 3 = b.i // 3 GROUP BY ALL")
        out.append(f"{p}{k} AS ({state} FROM {last_p} p JOIN ({sib}) r ON p.g = r.g AND p.i = r.i)")
        out.append(f"{u}{k} AS (SELECT g, any_value(source) AS source, i // 3 AS i, CASE WHEN any_value(n) > 1 "
                   f"THEN sha256(string_agg(d, '' ORDER BY i)) ELSE any_value(d) END AS d, (any_value(n) + 2) // 3 AS n "
                   f"FROM {last_u} GROUP BY g, i // 3)")
    for k in range(1, levels + 1):
        climb("u", "p", k, f"u{k - 1}", f"p{k - 1}")
    out.append(f"v0 AS (SELECT '' AS g, g AS source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, d, count(*) OVER () AS n FROM u{levels})")
    out.append(f"q0 AS (SELECT '' AS g, struct_pack(doc_id := p.doc_id, subroot := v.d) AS doc_id, p.leaf, v.i, p.proof, p.acc FROM p{levels} p JOIN v0 v ON v.source = p.g)")
    for k in range(1, levels // 2 + 1):
        climb("v", "q", k, f"v{k - 1}", f"q{k - 1}")
    k = levels // 2
    return ",\n".join(out) + f"""
SELECT q.doc_id.doc_id AS doc_id, q.leaf, q.doc_id.subroot AS subroot, v.d AS root, sha256(q.proof) AS proof_sha256,
       q.acc AS folded_root, q.acc = v.d AS verified FROM q{k} q, v{k} v
"""


OP13_SQL = _op13_sql()
