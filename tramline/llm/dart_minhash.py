"""Near-duplicate classes by DartMinHash signatures and a banded join.

A document is the weighted set of its five-word shingles (weight: count).
Darts are thrown by hash: a shingle's weight axis is cut into [0, 1), [1, 2),
[2, 4), ...; every such strip receives a Poisson process of darts over rank,
drawn from the hash of shingle and strip alone. A dart counts if it lies below
the shingle's weight. Each dart belongs to one coordinate; the dart of least
rank per coordinate is the signature's value there. Two documents agree in a
coordinate with a probability of their weighted Jaccard similarity. Ranks are
searched up to a horizon that shrinks as the text grows, so the cost is one
hash per shingle and about k ln k + 3k darts.

Plan:
1. Signatures in one pass; documents with equal signatures collapse into one
   node (partial aggregation), so exact copies cost nothing further.
2. Nodes meet in ``BANDS`` buckets of ``ROWS`` coordinates each. A bucket of
   two is a candidate pair. A larger one is compared inside one task of at
   most ``CELL`` nodes; a still larger one is dealt to several tasks, each
   with the bucket's pivots. A task puts out a spanning forest of the links
   found (and the closest uncertain ones): its output grows with its nodes.
3. Links whose estimate is clear are taken; those in between are verified by
   the exact weighted Jaccard similarity of the texts.
4. Components of the links. In buckets of more than two nodes, those outside
   the bucket's largest component are then compared with all its nodes, in
   tiles. The nodes of a tile that have an uncertain link to another component
   get their texts, and a second pass over the tile verifies these links where
   they are: it puts out only links that hold and join components, so its
   output grows with its nodes, not with its pairs. Of all buckets that two
   nodes share, the least one tests them. No link between components is left
   untested; links inside a component add nothing.

Defined results: texts without words (null, empty, blank) stay alone; texts of
fewer than five words are one shingle; words are lower-cased; rows equal in id
and text are one document; of a class, the smallest (id, text hash) is its
representative, null ids first; an empty table gives an empty table. A node
is a 64-bit digest of the signature: of n different documents, about
n * n / 2 ** 65 pairs fall together by chance.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import col, materialize, packed, table, unpacked
from .components import components
from .prefilter import may_be_in
from .shingles import WHITE_SPACE, WordHashes, mix, shingles, weighted_jaccard

SIMILARITY = 0.8
COORDINATES, BANDS, ROWS = 128, 25, 5
#: 3.5 standard deviations of the estimate at the threshold; exact outside of chance 0.0005.
UNSURE = 0.12
CELL, BLOCK, PIVOTS = 400, 200, 15
#: Characters of text on each side of a tile.
BLOCK_CHARS = 16 << 20


def dart_signatures(documents: list[tuple[np.ndarray, np.ndarray]], k: int = COORDINATES) -> np.ndarray:
    """The signatures of several documents (distinct shingles and counts, none
    empty), one row each: per coordinate the id of its first dart."""
    sizes = [len(e) for e, _ in documents]
    doc = np.repeat(np.arange(len(documents)), sizes)
    element = np.concatenate([e for e, _ in documents])
    weight = np.concatenate([w for _, w in documents]).astype(np.float64)
    strip = np.zeros(len(element), np.int64)
    parts = [(doc, element, weight, strip)]
    for v in range(1, int(np.ceil(np.log2(weight.max()))) + 1):
        on = weight > 2.0 ** (v - 1)
        parts.append((doc[on], element[on], weight[on], np.full(int(on.sum()), v)))
    total = np.bincount(doc, weight)
    doc, element, limit, strip = (np.concatenate(x) for x in zip(*parts, strict=True))
    low = np.where(strip > 0, 2.0 ** (strip - 1.0), 0.0)
    width = np.where(strip > 0, low, 1.0)
    key = mix(element ^ (strip.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    horizon = k * (math.log(k) + 3) / total
    signature = np.zeros((len(documents), k), np.uint64)
    todo = np.ones(len(documents), bool)
    while todo.any():
        on = todo[doc]
        found, full = _throw(doc[on], key[on], low[on], width[on], limit[on], horizon, k)
        signature[todo] = found[todo]
        todo &= ~full
        horizon = horizon * 2
    return signature


def _throw(doc, key, low, width, limit, horizon, k):
    """All darts of rank below each document's horizon: the first of each
    coordinate, and whether all coordinates of a document have one."""
    rank, at, throw = np.zeros(len(key)), np.arange(len(key)), 0
    until = horizon[doc]
    ranks, ids, strips = [], [], []
    while len(at):
        many = max(1, min(256, 6000 // len(at)))    # few strips left: several darts of each at once
        no = np.array([(throw + j) * 0xD1342543DE82EF95 & (2 ** 64 - 1) for j in range(1, many + 1)], np.uint64)
        throw += many
        dart = mix(key[at][:, None] + no)
        gap = np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53)
        when = rank[at][:, None] - np.cumsum(gap, axis=1) / width[at][:, None]
        on = when < until[at][:, None]
        row = np.nonzero(on)[0]
        ranks.append(when[on])
        ids.append(dart[on])
        strips.append(at[row])
        rank[at] = when[:, -1]
        at = at[on[:, -1]]
    ranks, ids, strips = np.concatenate(ranks), np.concatenate(ids), np.concatenate(strips)
    cut = np.flatnonzero((limit < low + width)[strips])       # strips that the weight fills in part
    share = (mix(ids[cut] ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
    above = cut[low[strips[cut]] + width[strips[cut]] * share >= limit[strips[cut]]]
    ranks, ids, docs = np.delete(ranks, above), np.delete(ids, above), np.delete(doc[strips], above)
    signature, seen = np.zeros((len(horizon), k), np.uint64), np.zeros((len(horizon), k), bool)
    coordinate = (mix(ids + np.uint64(0x632BE59BD9B4E019)) % np.uint64(k)).astype(np.int64)
    order = np.argsort(ranks)[::-1]                 # written last: the least rank
    signature[docs[order], coordinate[order]] = ids[order]
    seen[docs, coordinate] = True
    return signature, seen.all(axis=1)


def _bands(signature: np.ndarray) -> np.ndarray:
    part = signature[:BANDS * ROWS].reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) ^ part[:, j])
    return key.view(np.int64)


def _chunks(pdf: pd.DataFrame, words: WordHashes, most: int = 20_000):
    """Rows with words, their lengths and their shingles, in runs of about
    ``most`` shingles."""
    rows, sizes, sets, n = [], [], [], 0
    for i, h, text in zip(pdf["id"], pdf["h"], pdf["text"], strict=True):
        elements, counts = shingles(text, words)
        if len(elements):
            rows.append((i, h))
            sizes.append(len(text))
            sets.append((elements, counts))
            n += len(elements)
        if n >= most:
            yield rows, sizes, sets
            rows, sizes, sets, n = [], [], [], 0
    if rows:
        yield rows, sizes, sets


def _signature_rows(batches):
    words = WordHashes()
    for pdf in batches:
        for rows, sizes, sets in _chunks(pdf, words):
            signed = dart_signatures(sets)
            frame = pd.DataFrame(rows, columns=["id", "h"])
            frame["id"] = frame["id"].astype("Int64")
            frame["node"] = [int(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).view(np.int64)) for s in signed]
            frame["sig"] = [s.tobytes() for s in (signed & np.uint64(255)).astype(np.uint8)]
            frame["bands"] = [_bands(s).tolist() for s in signed]
            frame["size"] = sizes
            yield frame


def signatures(docs: DataFrame) -> DataFrame:
    """(id, h, node, sig, bands, size) of the documents with words; ``docs``: id, h, text."""
    rows = docs.select(F.col("id").cast("long").alias("id"), "h", "text")
    return rows.mapInPandas(_signature_rows, "id long, h long, node long, sig binary, bands array<long>, size long")


def _likely(sig: np.ndarray, first: int, label: np.ndarray | None = None):
    """(left, right, estimate) of the pairs with an end before row ``first``
    whose similarity may hold; with ``label``: of different labels."""
    left, right, score = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
    floor = SIMILARITY - UNSURE
    for i in range(min(first, len(sig))):
        estimate = (sig[i] == sig[i + 1:]).mean(axis=1)
        likely = estimate >= floor
        j = np.flatnonzero(likely if label is None else likely & (label[i + 1:] != label[i]))
        left.append(np.full(len(j), i))
        right.append(j + i + 1)
        score.append(estimate[j])
    return np.concatenate(left), np.concatenate(right), np.concatenate(score)


def _finder(root: np.ndarray):
    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    return find, root


def _forest(nodes: np.ndarray, sig: np.ndarray, first: int) -> pd.DataFrame:
    """Links among the rows of ``sig`` with an end before row ``first`` (all
    rows: first = len): a maximum spanning forest of the estimates, and a second
    uncertain link of nodes that have one, should the first not hold. What this
    leaves untested the tiles test."""
    left, right, score = _likely(sig, first)
    find, root = _finder(np.arange(len(nodes)))
    near = np.zeros(len(nodes), np.int64)
    keep = []
    for e in np.argsort(-score, kind="stable"):
        x, y = left[e], right[e]
        fx, fy = find(x), find(y)
        if fx != fy:
            root[max(fx, fy)] = min(fx, fy)
            keep.append(e)
        elif score[e] < SIMILARITY + UNSURE and min(near[x], near[y]) < 2:
            keep.append(e)
        else:
            continue
        near[x] += 1
        near[y] += 1
    a, b = nodes[left[keep]], nodes[right[keep]]
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "estimate": score[keep]})


def _cell_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """One task's nodes; those marked ``asking`` are compared with all."""
    pdf = pdf.sort_values(["asking", "node"], ascending=[False, True]).drop_duplicates("node")
    sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)
    return _forest(pdf["node"].to_numpy(np.int64), sig, int(pdf["asking"].sum()))


LINKS = "a long, b long, estimate double"
#: One row of a tile: ``reps`` are all buckets of the node, ``asking`` rows are compared with all.
TILE = "bucket long, cell long, node long, sig binary, label long, reps array<long>, asking boolean"


def _across(pdf: pd.DataFrame):
    """The rows of a tile, asking ones first, and its likely pairs between
    components (left, right, estimate; best first) that no lesser bucket tests."""
    pdf = pdf.sort_values(["asking", "node"], ascending=[False, True]).drop_duplicates("node").reset_index(drop=True)
    _, label = np.unique(pdf["label"].to_numpy(np.int64), return_inverse=True)
    sig = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)
    left, right, score = _likely(sig, int(pdf["asking"].sum()), label)
    reps, here = [set(x) for x in pdf["reps"]], pdf["bucket"].iloc[0]
    own = np.array([min(reps[x] & reps[y]) == here for x, y in zip(left, right, strict=True)], bool)
    left, right, score = left[own], right[own], score[own]
    order = np.argsort(-score, kind="stable")
    return pdf, label, left[order], right[order], score[order]


def _unsure_rows(pdf: pd.DataFrame) -> pd.DataFrame:
    """The rows of a tile that have a likely link to another component."""
    pdf, _, left, right, _ = _across(pdf)
    return pdf.iloc[np.union1d(left, right)]


def _tile_links(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links of a tile that hold and join components: clear ones by their
    estimate, the others by the texts."""
    pdf, label, left, right, score = _across(pdf)
    find, root = _finder(np.arange(len(label)))
    words, texts, known = WordHashes(), pdf["text"].to_numpy(), {}

    def shingled(x):
        if x not in known:
            if len(known) >= BLOCK:                  # bounds what is kept of long texts
                known.clear()
            known[x] = shingles(texts[x], words)
        return known[x]

    keep = []
    for x, y, estimate in zip(left, right, score, strict=True):
        fx, fy = find(label[x]), find(label[y])
        if fx != fy and (estimate >= SIMILARITY + UNSURE or weighted_jaccard(shingled(x), shingled(y)) >= SIMILARITY):
            root[max(fx, fy)] = min(fx, fy)
            keep.append((x, y))
    nodes = pdf["node"].to_numpy(np.int64)
    return pd.DataFrame([(nodes[x], nodes[y]) for x, y in keep], columns=["a", "b"], dtype=np.int64)


def _dealt(cells: DataFrame):
    """Cells by bucket and number, in as many partitions as shuffles have: they
    are few bytes and much work, so they are not to be put together by size."""
    n = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return cells.repartition(n, "bucket", "cell").groupBy("bucket", "cell")


def _pair_links(batches):
    for pdf in batches:
        if len(pdf):
            a = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)
            b = np.frombuffer(b"".join(pdf["sig_b"]), np.uint8).reshape(len(pdf), -1)
            out = pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "estimate": (a == b).mean(axis=1)})
            yield out[out["estimate"] >= SIMILARITY - UNSURE]


def _verified(links: DataFrame, texts: DataFrame) -> DataFrame:
    """The links that hold: by a clear estimate, or by the exact similarity."""
    clear = links.where(F.col("estimate") >= SIMILARITY + UNSURE).select("a", "b")
    unsure = links.where(F.col("estimate") < SIMILARITY + UNSURE).select("a", "b")
    ends = unsure.select(F.col("a").alias("node")).union(unsure.select(F.col("b").alias("node"))).distinct()
    found = materialize(texts(ends), "dart-texts")

    def holds(batches):
        words = WordHashes()
        for pdf in batches:
            ok = [weighted_jaccard(shingles(x, words), shingles(y, words)) >= SIMILARITY
                  for x, y in zip(pdf["text"], pdf["text_b"], strict=True)]
            yield pdf.loc[ok, ["a", "b"]]

    pairs = (unsure.join(found.select(F.col("node").alias("a"), "text"), "a")
             .join(found.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return clear.unionByName(pairs.select("a", "b", "text", "text_b").mapInPandas(holds, "a long, b long"))


def near_duplicate_nodes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, h, node) of every document with words, and (node, label) of every
    node that has a link; both written below the checkpoint folder."""
    spark = docs.sparkSession
    signed = materialize(signatures(docs), "dart-signatures")
    nodes = materialize(
        signed.groupBy("node").agg(F.min(F.struct("id", "h")).alias("rep"), F.first("sig").alias("sig"),
                                   F.first("bands").alias("bands"), F.first("size").alias("size")), "dart-nodes")

    def texts(ends: DataFrame) -> DataFrame:
        reps = materialize(nodes.join(ends, "node").select("node", "rep", F.xxhash64("rep.id", "rep.h").alias("key")), "dart-ends")
        wanted = docs.select(F.struct(F.col("id").cast("long").alias("id"), "h").alias("rep"), "text")
        likely = may_be_in(reps, "key", F.xxhash64("rep.id", "rep.h"))
        wanted = wanted if likely is None else wanted.where(likely)
        return wanted.join(reps, "rep").select("node", "text").dropDuplicates(["node"])

    at = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = materialize(at.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("a"),
                                                   F.max("node").alias("b"), F.bit_xor(F.xxhash64("node")).alias("x"))
                          .where("n > 1"), "dart-buckets")
    sigs = nodes.select("node", "sig", "size")
    pairs = buckets.where("n = 2").select("a", "b").distinct()
    pairs = (pairs.join(sigs.select(F.col("node").alias("a"), "sig"), "a")
             .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b"))
    links = pairs.select("a", "b", "sig", "sig_b").mapInPandas(_pair_links, LINKS)

    # bands that put the same nodes together need one comparison
    crowds = buckets.where("n > 2").groupBy("n", "a", "b", "x").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    crowd = materialize(at.join(crowds, "bucket").join(sigs, "node").select("bucket", "n", "node", "sig", "size"), "dart-crowd")
    block = F.when(F.col("n") > CELL, F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK))).otherwise(F.lit(0))
    members = crowd.withColumn("cell", block.cast("long")).withColumn("asking", F.lit(True))
    pivots = _pivots(crowd)
    dealt = members.where(F.col("n") > CELL).select("bucket", "cell").distinct().join(pivots, "bucket")
    cells = (members.select("bucket", "cell", "node", "sig", "asking")
             .unionByName(dealt.select("bucket", "cell", "node", "sig", F.lit(True).alias("asking"))))
    links = links.unionByName(_dealt(cells).applyInPandas(_cell_links, LINKS))
    links = materialize(links.groupBy("a", "b").agg(F.max("estimate").alias("estimate")), "dart-links")
    edges = materialize(_verified(links, texts), "dart-edges")
    labels = components(spark, edges)

    if (rest := _unsettled(crowd, labels)) is not None:
        unsure = materialize(_dealt(rest).applyInPandas(_unsure_rows, TILE), "dart-unsure")
        if not unsure.isEmpty():
            found = materialize(texts(unsure.select("node").distinct()), "dart-texts")
            held = _dealt(unsure.join(found, "node")).applyInPandas(_tile_links, "a long, b long")
            held = materialize(held.distinct(), "dart-more-edges")
            if not held.isEmpty():
                labels = _joined(spark, labels, held)
    return signed.select("id", "h", "node"), labels


def _joined(spark, labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links; only the labels at their ends are joined."""
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    known = materialize(labels.unionByName(ends.join(labels, "node", "left_anti")
                                           .select("node", F.col("node").alias("label"))), "dart-labels")
    pairs = (links.join(known.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
             .join(known.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
             .select(F.col("x").alias("a"), F.col("y").alias("b")))
    step = components(spark, pairs).select(F.col("node").alias("label"), F.col("label").alias("to"))
    return materialize(known.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label")),
                       "dart-labels")


def _pivots(crowd: DataFrame) -> DataFrame:
    """Up to PIVOTS nodes of each dealt bucket: per class of a hash, the node
    that meets the most others over all buckets (an original meets its copies
    in every band, they meet each other in few)."""
    met = crowd.groupBy("node").agg(F.sum("n").alias("met"))
    best = (crowd.where(F.col("n") > CELL).join(met, "node")
            .groupBy("bucket", F.pmod(F.xxhash64(F.lit("pivot"), "node"), F.lit(PIVOTS)).alias("class"))
            .agg(F.max(F.struct("met", "node", "sig")).alias("best")))
    return best.select("bucket", "best.node", "best.sig")


def _unsettled(crowd: DataFrame, labels: DataFrame) -> DataFrame | None:
    """Tiles that compare every node outside a bucket's largest component with
    all nodes of the bucket; bounded in nodes and in characters of text."""
    if crowd.isEmpty():
        return None
    reps = crowd.groupBy("node").agg(F.collect_set("bucket").alias("reps"))     # a bucket per band at most
    known = materialize(crowd.join(labels, "node", "left").join(reps, "node")
                        .withColumn("label", F.coalesce("label", "node")), "dart-known")
    sizes = known.groupBy("bucket", "label").agg(F.count("*").alias("size"), F.sum("size").alias("chars"))
    largest = sizes.groupBy("bucket").agg(F.max(F.struct("size", "label", "chars")).alias("m"), F.sum("size").alias("n"),
                                          F.sum("chars").alias("chars"))
    parts = lambda n, chars: F.ceil(F.greatest(n / BLOCK, chars / BLOCK_CHARS, F.lit(1.0)))
    outside = largest.select(
        "bucket", F.col("m.label").alias("main"), (F.col("n") - F.col("m.size")).alias("n_out"),
        parts(F.col("n"), F.col("chars")).alias("blocks"),
        parts(F.col("n") - F.col("m.size"), F.col("chars") - F.col("m.chars")).alias("chunks")).where("n_out > 0")
    outside = materialize(outside, "dart-outside")
    if outside.isEmpty():
        return None
    there = known.join(outside, "bucket")
    mine = F.pmod(F.xxhash64(F.lit("chunk"), "node"), F.col("chunks"))
    asking = (there.where("label <> main").withColumn("chunk", mine)
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("asking", F.lit(True)))
    asked = (there.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .withColumn("asking", F.lit(False)))
    cell = (F.col("chunk") * F.col("blocks") + F.col("block")).alias("cell")
    columns = ["bucket", cell, "node", "sig", "label", "reps", "asking"]
    return asking.select(*columns).unionByName(asked.select(*columns))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with words: (id, h, rep, class_size), where rep is
    the (id, h) of its class's representative and class_size counts rows."""
    rows = packed(docs, id_col, text_col).select("id", "h", "text")
    members, labels = near_duplicate_nodes(rows)
    return _classes(members, labels)


def _classes(members: DataFrame, labels: DataFrame) -> DataFrame:
    # a class's nodes are summed up before its documents meet it: one row per node
    node = (members.groupBy("node").agg(F.min(F.struct("id", "h")).alias("rep"), F.count("*").alias("n"))
            .join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    node = materialize(node, "dart-node-classes")
    cls = node.groupBy("label").agg(F.min("rep").alias("rep"), F.sum("n").alias("class_size"))
    per_node = materialize(node.select("node", "label").join(cls, "label").select("node", "rep", "class_size"),
                           "dart-classes")
    return members.join(per_node, "node").select("id", "h", "rep", "class_size")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that are not their class's representative;
    of rows equal in id and text one stays."""
    rows = packed(docs, id_col, text_col)
    classes = materialize(near_duplicates(docs, id_col, text_col), "dart-members")
    # struct keys: null ids match each other
    gone = classes.where(~F.struct("id", "h").eqNullSafe(F.col("rep"))).select(F.struct("id", "h").alias("key")).distinct()
    gone = materialize(gone, "dart-gone")
    rows = rows.withColumn("key", F.struct(F.col("id").cast("long").alias("id"), "h"))
    likely = may_be_in(gone.select(F.xxhash64("key.id", "key.h").alias("key64")), "key64", F.xxhash64("key.id", "key.h"))
    if likely is None:
        kept = rows.join(gone, "key", "left_anti")
    else:                                        # most texts are not shuffled
        kept = rows.where(~likely).unionByName(rows.where(likely).join(gone, "key", "left_anti"))
    twice = materialize(classes.where(F.struct("id", "h").eqNullSafe(F.col("rep"))).groupBy("id", "h")
                        .agg(F.count("*").alias("n")).where("n > 1").select(F.struct("id", "h").alias("key")), "dart-twice")
    if not twice.isEmpty():
        once = kept.join(twice, "key", "left_semi").dropDuplicates(["key"])
        kept = kept.join(twice, "key", "left_anti").unionByName(once)
    return unpacked(kept, docs.columns)


def op3_dart_minhash(spark, sf_dir: str) -> DataFrame:
    """Every document with its class: (doc_id, class_id, class_size, kept)."""
    docs = table(spark, sf_dir, "documents")
    found = near_duplicates(docs)
    alone = docs.where(F.translate(F.coalesce("text", F.lit("")), WHITE_SPACE, "") == "")
    return (found.select(F.col("id").alias("doc_id"), F.col("rep.id").alias("class_id"), "class_size",
                         F.struct("id", "h").eqNullSafe(F.col("rep")).alias("kept"))
            .unionByName(alone.select(col("doc_id"), col("doc_id").alias("class_id"),
                                      F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept"))))
