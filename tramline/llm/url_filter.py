"""URL filter: path rules, and a Bloom filter cascade for everything else.

The cascade holds a set of listed keys exactly, over the complete universe of
the corpus's keys. Level 1 is a Bloom filter of the listed keys; level 2 holds
the unlisted keys that level 1 lets through, level 3 the listed keys that level
2 lets through, and so on until a level lets nothing wrong through. A key is
listed if the first level that rejects it is an even one (or if none does and
their number is odd). Membership is a bit test per level on the row itself.

Native functions only. A level is cut into shards of 32,768 bits by a hash of
the key; ``bitmap_construct_agg`` builds them with map-side partial bitmaps.
As long as all levels fit in ``MAX_BYTES``, they go with the plan as one
literal per level. A larger cascade stays a table of shards (one row each, all
levels in it) that meets the rows by shard number.

The keys are addresses (host and path). The list is a statistic of the corpus
that no row knows alone: thin addresses, all of whose pages hold less than
1 / ``THIN`` of the mean payload of their host's pages. Any other list is passed
as ``universe``. The rules come first (longest host + path wins).

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule, is never listed and is allowed; a null payload has 0 bytes; equal
rows get equal verdicts; an empty table or an empty list gives an empty
cascade, which lists nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import col, materialize, table

SHARD_BITS = 32_768
SHARD_BYTES = SHARD_BITS // 8
#: Literals of all levels together; beyond it the shards are joined.
MAX_BYTES = 4 << 20
#: A page is thin if this many of it do not reach the mean of its host.
THIN = 2
#: Fixed values: (verdict, host, path) of the path rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER), F.regexp_extract(url, pattern, 2)


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    name = verdict = None
    for kind, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return (F.lit(None).cast("string"),) * 2 if name is None else (name, verdict)


def _shard(key: Column, n_shards: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("shard"), key), F.lit(n_shards))


def _bit(key: Column, level: int, probe: int, width: int = SHARD_BITS) -> Column:
    return F.pmod(F.xxhash64(F.lit(f"{level}/{probe}"), key), F.lit(width))


class Level:
    """One Bloom filter: its number, probes per key, and its bits as one
    literal (shards in order) or as the column of a joined shard table. The
    only shard of a small list uses its first ``width`` bits."""

    def __init__(self, number: int, probes: int, n_shards: int, bits: bytes | None, width: int = SHARD_BITS):
        self.number, self.probes, self.n_shards, self.bits, self.width = number, probes, n_shards, bits, width

    def holds(self, key: Column, shard_bits: Column | None = None) -> Column:
        bits = F.lit(self.bits) if shard_bits is None else shard_bits
        base = _shard(key, self.n_shards) * SHARD_BYTES if shard_bits is None else F.lit(0)
        tests = None
        for i in range(self.probes):
            bit = _bit(key, self.number, i, self.width)
            byte = F.conv(F.hex(F.substring(bits, (base + F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
            test = F.getbit(byte, (bit % 8).cast("int")) == 1
            tests = test if tests is None else tests & test
        return F.coalesce(tests, F.lit(False))


class Cascade:
    def __init__(self, levels: list[Level], shards: DataFrame | None, n_shards: int):
        self.levels, self.shards, self.n_shards = levels, shards, n_shards

    def listed(self, rows: DataFrame, key: Column, name: str) -> DataFrame:
        """``rows`` plus the boolean ``name``: whether the key is listed."""
        if self.shards is None:
            return rows.withColumn(name, self._listed([lv.holds(key) for lv in self.levels]))
        shards = self.shards.select("shard", F.struct(*[F.col(f"l{lv.number}") for lv in self.levels]).alias("levels"))
        met = rows.select(F.struct("*").alias("own"), _shard(key, self.n_shards).alias("shard"), key.alias("key"))
        met = met.join(shards, "shard", "left")
        own = [lv.holds(F.col("key"), F.col(f"levels.l{lv.number}")) for lv in self.levels]
        return met.select("own.*", self._listed(own).alias(name))

    def _listed(self, holds: list[Column]) -> Column:
        out = F.lit(len(holds) % 2 == 1)
        for i in range(len(holds) - 1, -1, -1):
            out = F.when(~holds[i], F.lit(i % 2 == 1)).otherwise(out)
        return out


def build_cascade(universe: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade:
    """``universe``: every key of the corpus once, with a boolean ``listed``."""
    keys = materialize(universe.select("key", "listed").where("key IS NOT NULL"), "cascade-keys")
    counts = {r["listed"]: r["n"] for r in keys.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    n_in, n_out = counts.get(True, 0), counts.get(False, 0)
    # bits per key for the first level; its false positives are about as many as half the listed keys
    rate = min(0.5, max(n_in, 1) / math.sqrt(2) / max(n_out, 1))
    need = 1.5 * n_in * 1.44 * math.log2(1 / rate)
    n_shards = max(1, math.ceil(need / SHARD_BITS))
    width = SHARD_BITS if n_shards > 1 else max(64, math.ceil(need))
    joined = 2 * n_shards * SHARD_BYTES > max_bytes
    levels, table_ = [], None
    inside, outside = keys.where("listed").select("key"), keys.where("NOT listed").select("key")
    n = n_in
    while n:
        number = len(levels) + 1
        probes = max(1, round(math.log2(1 / rate)))
        bits = [F.struct(_shard(F.col("key"), n_shards).alias("shard"), _bit(F.col("key"), number, i, width).alias("bit"))
                for i in range(probes)]
        built = (inside.select(F.explode(F.array(*bits)).alias("b")).groupBy("b.shard")
                 .agg(F.bitmap_construct_agg("b.bit").alias("bits")))
        if joined:
            built = materialize(built.select("shard", F.col("bits").alias(f"l{number}")), "cascade-level")
            table_ = built if table_ is None else materialize(table_.join(built, "shard", "full"), "cascade-shards")
            level = Level(number, probes, n_shards, None, width)
            checked = (outside.withColumn("shard", _shard(F.col("key"), n_shards)).join(built, "shard", "left")
                       .where(level.holds(F.col("key"), F.col(f"l{number}"))).select("key"))
        else:
            data = bytearray(n_shards * SHARD_BYTES)
            for r in built.collect():
                data[r["shard"] * SHARD_BYTES:(r["shard"] + 1) * SHARD_BYTES] = r["bits"]
            level = Level(number, probes, n_shards, bytes(data), width)
            checked = outside.where(level.holds(F.col("key")))
        levels.append(level)
        wrong = materialize(checked, "cascade-wrong")       # what this level lets through by chance
        inside, outside, n = wrong, inside, wrong.count()
        rate = 0.5
    return Cascade(levels, table_, n_shards)


def thin_addresses(rows: DataFrame, thin: int = THIN) -> DataFrame:
    """(key, listed) of every address; ``rows``: host, key, bytes. A host's
    sums are aggregated per task; hosts are few beside their pages."""
    hosts = rows.groupBy("host").agg(F.sum("bytes").alias("all"), F.count("*").alias("n"))
    addresses = rows.groupBy("host", "key").agg(F.max("bytes").alias("most"))
    return addresses.join(hosts, "host").select("key", (thin * F.col("most") * F.col("n") < F.col("all")).alias("listed"))


def judge_urls(pages: DataFrame, universe: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", rules=RULES, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(id, host, path, rule, verdict, listed) of every row. ``universe``: all
    addresses (host + path) of the corpus with ``listed``; by default those of
    ``pages``, the thin ones listed."""
    host, path = url_parts(col(url_col))
    rows = pages.select(col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    key = F.when(F.col("host") != "", F.concat("host", "path"))
    if universe is None:
        seen = pages.select(host.alias("host"), path.alias("path"), F.coalesce(F.octet_length(col(html_col)), F.lit(0)).cast("long").alias("bytes"))
        universe = thin_addresses(seen.select("host", key.alias("key"), "bytes").where("key IS NOT NULL"))
    rows = build_cascade(universe, max_bytes).listed(rows, key, "listed")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return rows.select(id_col, "host", "path", rule.alias("rule"),
                       F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


OP6_SQL = r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
p AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
q AS (SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw, rest FROM p),
h AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM q),
rules(kind, rh, rp) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                        ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(kind, length(rh || rp)) AS kind
      FROM h JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
z AS (SELECT h.*, octet_length(encode(coalesce(html, ''))) AS bytes FROM h JOIN pages USING (page_id) WHERE host <> ''),
w AS (SELECT host || path AS address FROM z GROUP BY host, path
      HAVING 2 * max(bytes) * (SELECT count(*) FROM z y WHERE y.host = z.host) < (SELECT sum(bytes) FROM z y WHERE y.host = z.host)),
v AS (SELECT h.*, h.host || h.path IN (SELECT address FROM w) AS listed FROM h)
SELECT v.page_id, v.host, v.path, m.rule, v.listed,
       coalesce(m.kind, CASE WHEN v.listed THEN 'block' ELSE 'allow' END) AS verdict
FROM v LEFT JOIN m ON v.page_id = m.page_id
"""
