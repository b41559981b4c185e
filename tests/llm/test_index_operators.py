"""Token files, hard negatives and the Merkle manifest against brute force,
with nulls, empty and long texts, ties, repeated rows, empty tables and extra
columns named like working columns."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tramline.llm import hard_negatives, merkle, token_file
from tramline.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, h string, tie int, part string, tree string, row string"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "h", 1, "p", "t", "r") for i, t in rows], DOCS).repartition(3)


# --- token files ------------------------------------------------------------

@pytest.mark.parametrize("ids", [
    np.zeros(0), np.zeros(700), np.arange(1000), np.full(513, 2 ** 32 - 1), np.random.default_rng(1).integers(0, 50257, 20_000),
    np.random.default_rng(2).geometric(0.001, 9_999), 2 ** np.random.default_rng(3).integers(0, 32, 5_000)])
def test_codes_give_any_id(ids):
    ids = ids.astype(np.uint32)
    data = token_file.segment(3, 4, [7], [0], [0], ids)
    s = token_file.Segment(data)
    assert (s.part, s.number, s.n, list(s.doc_ids)) == (3, 4, len(ids), [7])
    for a, b in [(0, len(ids)), (len(ids) // 3, len(ids) // 2), (len(ids) - 1, len(ids)), (5, 5), (255, 257), (256, 300)]:
        if 0 <= a <= b <= len(ids):
            assert np.array_equal(s.codes.slice(a, b), ids[a:b])
    some = np.random.default_rng(4).integers(0, max(len(ids), 1), 200 if len(ids) else 0)
    assert np.array_equal(s.codes.at(some), ids[some])
    assert [s.codes[i] for i in range(0, len(ids), 997)] == [int(x) for x in ids[::997]]


def test_widths_take_the_fewest_bits():
    ids = np.random.default_rng(5).integers(0, 300, 4_000).astype(np.uint32)
    got = token_file.widths_for(ids)
    assert sum(got) == 9
    assert len(token_file.encode(ids)) <= min(len(token_file.encode(np.append(ids, np.uint32(1 << 20)))), 2 * len(ids))


def test_crc_of_parts():
    rng = random.Random(1)
    for _ in range(20):
        parts = [rng.randbytes(rng.randint(0, 3000)) for _ in range(rng.randint(0, 5))]
        assert token_file.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def odd_texts(rng):
    marks = [" ", "\n", "\t", "\r\n", "  ", " \n ", " ", "　", "​", "\x1c", "\x85", "'s", "don't", "<|endoftext|>", "é", "中文",
             "word", "Word,", "12", "3.5", "...", "🙂", " "]
    return ["".join(rng.choice(marks) for _ in range(rng.randint(0, 60))) for _ in range(400)]


def test_pieces_give_the_ids_of_whole_texts(monkeypatch):
    whole = Tokenizer.from_file(TOKENIZER)
    texts = [*odd_texts(random.Random(2)), "", "x" * 5000, " " * 3000, "one two\nthree four. Five", " lead", "trail ", "\n", "a\n\nb", "a\n\n\nb\n\n",
             "\nx y\n", "a<|endoftext|> b <|endoftext|>", "x\x1c y", "a\u2028b c", "e\u0301 \ud7ff x"]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    for cache in (400_000, 30):
        monkeypatch.setattr(token_file, "CACHE", cache)
        enc = token_file.Encoder(open(TOKENIZER, encoding="utf-8").read())
        assert [list(enc.text(t)) for t in texts] == want
        assert [list(x) for x in enc.batch(pa.array(texts, pa.large_string()))] == want
        assert [list(x) for x in enc.batch(pa.array(texts[::-1], pa.large_string()))] == want[::-1]
    other = public_tokenizers.path("word_bpe_49k.json")            # lower case, white space dropped: whole texts
    enc, whole = token_file.Encoder(open(other, encoding="utf-8").read()), Tokenizer.from_file(other)
    assert [list(x) for x in enc.batch(pa.array(texts[:60]))] == [whole.encode(t, add_special_tokens=False).ids for t in texts[:60]]


def test_files_round_trip(spark):
    rng = random.Random(4)
    rows = [(i * 3 - 30, t) for i, t in enumerate(odd_texts(rng)[:60])]
    rows += [(None, "no id"), (None, None), (5000, None), (5001, ""), (5002, "a long one " * 900), rows[3], rows[3], (rows[4][0], "other text")]
    rows += [(777, "the same")] * 120
    docs = docs_frame(spark, rows)
    path = token_file.write_tokens(docs, scratch_path(spark, "t-tokens"), TOKENIZER, segment_ids=500)
    got = token_file.read_tokens(spark, path, with_ids=True).collect()
    t = Tokenizer.from_file(TOKENIZER)
    want = {}
    for i, text in rows:
        want.setdefault(i, []).append([*t.encode(text or "", add_special_tokens=False).ids, 0])
    assert len(got) == len(rows)
    stream, seen = [], {}
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == len(stream) and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        seen.setdefault(r.doc_id, []).append(r.ids)
        stream += r.ids
    assert list(seen) == sorted(seen, key=lambda i: (i is not None, i or 0))          # ascending, null first
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}
    heads = token_file.bases(spark, path).collect()
    assert max(h.n for h in heads) == 500 and len(heads) > 10                          # bounded, whatever the document
    asked = spark.createDataFrame([(p,) for p in [0, 1, 499, 500, 501, len(stream) - 1, len(stream), -1, 7, 7]], "position long")
    found = sorted(tuple(r) for r in token_file.tokens_at(spark, path, asked, 500).collect())
    assert found == sorted((p, stream[p]) for p in [0, 1, 499, 500, 501, len(stream) - 1, 7, 7])


def test_files_of_an_empty_table(spark):
    docs = docs_frame(spark, [(1, "x")]).limit(0)
    path = token_file.write_tokens(docs, scratch_path(spark, "t-tokens"), TOKENIZER)
    assert token_file.read_tokens(spark, path).collect() == []


def test_op11_over_the_table(spark):
    sf = "/root/testdata/sf0.001"
    from tramline.llm.queries import QUERIES
    got = sorted(tuple(r) for r in QUERIES["op11_token_file"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    t, at, want = Tokenizer.from_file(TOKENIZER), 0, []
    for r in sorted(spark.read.parquet(f"{sf}/documents.parquet").collect(), key=lambda r: r.doc_id):
        ids = [*t.encode(r.text or "", add_special_tokens=False).ids, 0]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want


# --- hard negatives ---------------------------------------------------------

VECS = "vec_id long, embedding array<float>, label int, rid string, norm int, score long"


def vec_frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, "r", 1, 2)
                                  for i, v, y in rows], VECS).repartition(3)


def mined_by_hand(rows, every, positives=5, negatives=3):
    ok = {}
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        ok[i, y, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)] = 1
    ok = list(ok)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))  # noqa: E731  (shorter ones are padded)
    last = lambda i: (i is None, i or 0)
    out = []
    for a in ok:
        if a[0] is None or a[0] % every:
            continue
        others = [(-dot(a[2], b[2]), last(b[0]), b) for b in ok if b != a]
        for s, _, p in sorted(x for x in others if x[2][1] == a[1])[:positives]:
            fit = sorted(x for x in others if x[2][1] != a[1] and 50 * -s <= 100 * -x[0] <= 95 * -s)
            out += [(a[0], p[0], k + 1, n[0], -s, -t) for k, (t, _, n) in enumerate(fit[:negatives])]
    return sorted(out, key=str)


def mined(spark, rows, every, **more):
    q = hard_negatives.quantized(vec_frame(spark, rows), "vec_id", "embedding", "label")
    got = hard_negatives.mine(q, F.col("vec_id") % every == 0, **more)
    return sorted((tuple(r) for r in got.collect()), key=str)


def clustered(seed, n, dim=12, centres=6):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim))
    return [(i, c[i % centres] + 0.4 * rng.normal(size=dim) * rng.choice([0.1, 1.0]), int(rng.integers(0, 4))) for i in range(n)]


def test_negatives_equal_brute_force(spark):
    rows = clustered(1, 600)
    same = rows[7][1]
    rows += [(1000 + i, same, 1) for i in range(200)]                         # one vector in a third of the rows
    rows += [(2000, None, 1), (2001, [1.0, None] * 6, 1), (2002, [float("nan")] * 12, 1), (2003, [float("inf")] * 12, 1),
             (2004, rows[0][1], None), (2010, [0.0] * 12, 2), (2020, [], 3), (2030, rows[3][1][:5], 1), (None, rows[9][1], 2), rows[5], rows[5]]
    want = mined_by_hand(rows, 10)
    assert len(want) > 100
    assert mined(spark, rows, 10) == want
    assert mined(spark, rows, 10, group_bytes=4000) == want                   # several groups of anchors
    assert mined(spark, rows, 3000) == mined_by_hand(rows, 3000)


def test_negatives_of_few_rows(spark):
    assert mined(spark, clustered(2, 30)[:1], 1) == []
    rows = [(i, [1.0, 0.1 * i], i % 2) for i in range(4)]
    assert mined(spark, rows, 1) == mined_by_hand(rows, 1)
    assert mined(spark, [(i, None, 1) for i in range(3)], 1) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-2 ** 20, 2 ** 20, 8) * 1.0), i % 2) for i in range(60)]
    assert mined(spark, rows, 5) == mined_by_hand(rows, 5)                    # products beyond 2**53
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(i, [8e6] * 64, 1) for i in range(2)], 1)
    with pytest.raises(Exception, match="32 bits"):
        mined(spark, [(1, [1e30], 1)], 1)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    vec = np.floor(256 * (rng.normal(size=(4, 16))[rng.integers(0, 4, 300)] + 0.05 * rng.normal(size=(300, 16)))).astype(np.int64)
    norm = np.linalg.norm(vec, axis=1)
    refs = hard_negatives._directions(vec.astype(float), 8)
    angles = np.arccos(np.clip(vec @ refs.T / norm[:, None], -1, 1))
    low, high = hard_negatives._bounds(angles, angles, angles, norm, norm, norm)
    score = vec @ vec.T
    assert (low <= score).all() and (score <= high).all()
    assert (high < np.sort(score, axis=1)[:, -6:-5]).mean() > 0.5            # most rows are out for the first five


# --- Merkle manifest --------------------------------------------------------

def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree_by_hand(leaves, fan=3):
    """root and per leaf the (left, right) of every level."""
    level, paths = list(leaves), [[] for _ in leaves]
    own = list(range(len(leaves)))
    while len(level) > 1:
        for leaf, at in enumerate(own):
            run = level[at // fan * fan:at // fan * fan + fan]
            paths[leaf].append(("".join(run[:at % fan]), "".join(run[at % fan + 1:])))
        level = [sha("".join(level[i:i + fan])) for i in range(0, len(level), fan)]
        own = [at // fan for at in own]
    return level[0], paths


def manifest_by_hand(rows, fan=3):
    """rows: (group, id, digest) -> sorted (id, digest, subroot, root, path)"""
    groups = {}
    for g, i, d in rows:
        groups.setdefault(g, []).append(((i is not None, i or 0), d, i))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree_by_hand([d for _, d, _ in sorted(groups[g], key=lambda x: x[:2])], fan) for g in names}
    root, outer = tree_by_hand([trees[g][0] for g in names], fan)
    out = []
    for k, g in enumerate(names):
        for (_, d, i), p in zip(sorted(groups[g], key=lambda x: x[:2]), trees[g][1], strict=True):
            out.append((i, d, trees[g][0], root, [*p, *outer[k]]))
    return sorted(out, key=str)


def leaves_frame(spark, rows):
    made = spark.createDataFrame(rows, "group string, id long, digest string").repartition(3)
    return made.select("group", "digest", F.struct("id", F.lit(1).alias("tree"), F.lit("x").alias("size")).alias("row"))


@pytest.mark.parametrize("fan, band", [(3, 5), (2, 2), (3, 1), (4, 3)])
def test_manifest_equals_brute_force(spark, fan, band):
    rng = random.Random(fan)
    rows = [("hot", i, sha(str(i))) for i in rng.sample(range(10_000), 300)]
    rows += [(f"s{g}", i, sha(f"{g}-{i}")) for g, n in enumerate([1, 2, 3, 4, 9, 10, 27, 28, 81, 82]) for i in range(n)]
    rows += [(None, i, sha(f"n{i}")) for i in (5, 3, None, None)] + [("", 1, sha("e")), ("é", 1, sha("é")), ("-", 1, sha("m"))]
    rows += [("ties", 7, sha(str(i % 5))) for i in range(20)]
    got = merkle.manifest(leaves_frame(spark, rows), ["id"], fan, band)
    folded = got.select(F.col("row.id"), "digest", "subroot", "root", "path", merkle.fold(F.col("digest"), F.col("path")).alias("f"),
                        merkle.proof_digest(F.col("path")).alias("p"), merkle.fold(F.lit("wrong"), F.col("path")).alias("w")).collect()
    assert sorted(((r.id, r.digest, r.subroot, r.root, [tuple(x) for x in r.path]) for r in folded), key=str) == manifest_by_hand(rows, fan)
    assert all(r.f == r.root != r.w for r in folded)
    assert all(r.p == sha("".join(a + b for a, b in r.path)) for r in folded)


def test_manifest_of_few_rows(spark):
    one = merkle.manifest(leaves_frame(spark, [(None, None, sha("a"))]), ["id"]).collect()
    assert [(r.subroot, r.root, r.path) for r in one] == [(sha("a"), sha("a"), [])]
    assert merkle.manifest(leaves_frame(spark, [("a", 1, "d")]).limit(0), ["id"]).collect() == []


def test_op13_fields(spark, tmp_path):
    rows = [(1, "a\nb", "en", "s", 3), (2, None, None, "s", None), (3, "", "de", None, 0), (None, "é", "en", "t", 1), (4, "x" * 10_000 + "\n", "en", "t", 2),
            (4, "x" * 10_000 + "\n", "en", "t", 2)]
    spark.createDataFrame([(*r, "e", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, tree string, rank int") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: sha(enc(r[0]) + enc(r[3]) + enc(r[2]) + enc(r[4]) + enc(t))
    want = {leaf(r, r[1]): (r, leaf(r, r[1] and r[1].replace("\n", "")) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else leaf(r, r[1]))
            for r in rows}
    got = merkle.op13_merkle(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.leaf) for r in got), key=str) == sorted(((r[0], leaf(r, r[1])) for r in rows), key=str)
    assert len({r.root for r in got}) == 1
    for r in got:
        assert r.verified == (r.folded_root == r.root) == (want[r.leaf][1] == r.leaf)
