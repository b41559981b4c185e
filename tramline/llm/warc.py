"""WARC archives, written by Spark and read back by boundary-chain verification.

Writing: a record is one value of Spark's text writer with an empty line as
the separator, so the archives are committed like any other Spark output and a
lost executor leaves no half record. Of equal payloads, the record of the
smallest page id carries the payload (response); the others refer to it
(revisit).

Reading: archives are split by byte ranges wherever they happen to fall. The
text reader cuts them at every line that begins like a record (the candidates;
text inside a payload may look the same), and keeps bytes as they are.

1. Each task sums up the lengths of its pieces and reads from every candidate's
   header where that record would end: an edge to its successor's offset. It
   follows these edges inside its split, which leaves one exit per candidate.
2. The splits' lengths add up to offsets in the file.
3. Pointer jumping over the exits, from offset 0 of each file: every round
   doubles the jump, so the rounds grow with the logarithm of the splits of a
   file. It yields the offset at which the true chain enters each split.
4. A second walk per split keeps the candidates on the chain. All others lie
   inside payloads, as the pieces of their record.

A record of one piece is digested where it is read; only records whose payload
was cut (or all, if the payloads are asked for) are put together again from a
second scan.

Defined results: a null payload is written as an empty one; null urls as an
empty header; line ends in urls are percent-encoded; a null page id is written
empty and read back as null, it never is the id that others refer to, and
payloads with null ids only are all responses; rows equal in id and payload
are alike responses if theirs is the smallest id; an empty table gives an
archive without records; bytes behind the last whole record of a file are
ignored. A record that a split cuts is put together as one hexadecimal string,
so a payload of more than about 1 GB cannot be rebuilt (the read fails).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import col, materialize, scratch_path, table

LINE = "\r\n"
BLANK = "\r\n\r\n"
#: Every record but a file's first begins behind a line end.
MAGIC = "\r\nWARC/1."
#: Bytes of MAGIC that belong to the record itself.
HEAD = len(MAGIC) - len(LINE)
HTTP = f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: ten hex digits are eight base-32 digits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0) -> str:
    """One record per row of ``pages``; payloads of fewer than ``min_bytes``
    bytes are never replaced by a reference."""
    html = F.coalesce(col(html_col), F.lit(""))
    rows = pages.select(col(id_col).cast("long").alias("page"), F.coalesce(col(url_col), F.lit("")).alias("url"),
                        html.alias("html"))
    rows = rows.withColumn("digest", base32_sha1(F.col("html").cast("binary"))).withColumn("bytes", F.octet_length("html"))
    # one row per payload that occurs again; written first, so that its size is known to the join
    again = materialize(rows.where(F.col("bytes") >= min_bytes).groupBy("digest")
                        .agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
                        .select("digest", "first"), "warc-again")
    joined = rows.join(again, "digest", "left")
    revisit = (F.col("bytes") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    uri = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    page = F.coalesce(F.col("page").cast("string"), F.lit(""))
    lines = F.concat_ws(
        LINE, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">"))),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        F.concat(F.lit("WARC-Target-URI: "), uri), F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("X-Payload-Length: "), F.col("bytes").cast("string"))),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "),
                 (len(HTTP) + len(BLANK) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string")))
    record = F.concat(lines, F.lit(BLANK + HTTP + BLANK), F.when(revisit, "").otherwise(F.col("html")))
    joined.select(record.alias("value")).write.text(path, lineSep=BLANK)
    return path


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.option("recursiveFileLookup", "true").text(path, lineSep=MAGIC)
            .select("value", F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block")))


def _header(name: str, pattern: str) -> Column:
    return F.nullif(F.regexp_extract("head", f"(?i)\r\n{name}:[ \t]*{pattern}", 1), F.lit(""))


#: Of each piece, what the walk and the result need; no payload.
PIECE = ("file string, block long, length long, head_bytes long, content long, http_bytes long, record_type string, "
         "record string, refers string, uri string, declared string, declared_bytes long, payload_digest string")


def _parsed(pieces: DataFrame) -> DataFrame:
    """Header fields of each piece as if it were a record, and the digest of
    the payload as if the record were this piece alone."""
    seen = F.concat("value", F.lit(LINE))        # the line end that the next candidate begins with
    head = F.substring_index(seen, BLANK, 1)
    found = F.instr(seen, BLANK) > 0
    named = pieces.select("file", "block", "value", F.octet_length(F.substring_index(seen, BLANK, 2)).cast("long").alias("two"), F.octet_length("value").cast("long").alias("length"),
                          F.when(found & head.rlike(r"\A(WARC/1\.)?[01]\r\n"), head).alias("head"))
    fields = named.select(
        "file", "block", "value", "length", F.octet_length("head").cast("long").alias("head_bytes"),
        F.expr("try_cast(nullif(regexp_extract(head, '(?i)\\r\\nContent-Length:[ \\t]*([0-9]{1,18})[ \\t]*(\\r|\\\\z)', 1), '') AS BIGINT)").alias("content"),
        "two",
        _header("WARC-Type", "([a-z]+)").alias("record_type"),
        _header("WARC-Record-ID", "<?urn:page:([^>\r]*)").alias("record"),
        _header("WARC-Refers-To", "<?urn:page:([^>\r]*)").alias("refers"),
        _header("WARC-Target-URI", "([^\r]*)").alias("uri"),
        _header("WARC-Payload-Digest", "sha1:([A-Z2-7]+)").alias("declared"),
        _header("X-Payload-Length", "([0-9]{1,18})").cast("long").alias("declared_bytes"))
    http = F.when(F.col("record_type").isin("response", "revisit"), F.col("two") - F.col("head_bytes")).otherwise(F.lit(4))
    fields = fields.withColumn("http_bytes", http.cast("long"))
    payload = F.substring(F.col("value").cast("binary"), (F.col("head_bytes") + F.col("http_bytes") + 5).cast("int"),
                          (F.col("content") - F.col("http_bytes")).cast("int"))
    alone = (F.col("content") >= F.col("http_bytes")) & (F.col("head_bytes") + 4 + F.col("content") <= F.col("length"))
    return fields.withColumn("payload_digest", F.when(alone, base32_sha1(payload))).select(
        *[c.split()[0] for c in PIECE.split(", ")])


def _placed(batches):
    """Offsets inside the split, the successor of each candidate, and where
    its chain leaves the split. A split's pieces come in order, in one task."""
    part, key = [], None
    for pdf in batches:
        for one, rows in pdf.groupby(["file", "block"], sort=False):
            if key is not None and one != key:
                yield _walked(pd.concat(part))
                part = []
            key = one
            part.append(rows)
    if part:
        yield _walked(pd.concat(part))


def _walked(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.reset_index(drop=True)
    ends = np.cumsum(rows["length"].to_numpy(np.int64) + len(MAGIC))
    at = ends - rows["length"].to_numpy(np.int64) - len(MAGIC)         # where the text of each piece begins
    first = (rows["block"].to_numpy() == 0) & (np.arange(len(rows)) == 0)
    start = at - np.where(first, 0, HEAD)
    head = rows["head_bytes"].fillna(-1).to_numpy(np.int64)
    content = rows["content"].fillna(-1).to_numpy(np.int64)
    good = (head >= 0) & (content >= 0)
    after = np.where(good, at + head + 2 * len(BLANK) + content, -1)
    exits = np.full(len(rows), -1, np.int64)
    index = np.searchsorted(start, after)
    for i in range(len(rows) - 1, -1, -1):
        if good[i]:
            j = index[i]
            exits[i] = after[i] if j == len(rows) else exits[j] if start[j] == after[i] and good[j] else -1
    return rows.assign(start=start, at=at, after=after, exit=exits, total=int(ends[-1]), good=good)


PLACED = PIECE + ", start long, at long, after long, exit long, total long, good boolean"


def _chain(pdf: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one split with the record they belong to, named by the
    offset behind it; ``on_chain`` marks the records' own first pieces."""
    pdf = pdf.sort_values("start").reset_index(drop=True)
    start, after, good = (pdf[c].to_numpy() for c in ("start", "after", "good"))
    on = np.zeros(len(pdf), bool)
    owner = np.full(len(pdf), -1, np.int64)
    entry, left = pdf["entry"].iloc[0], pdf["inside"].iloc[0]
    place = len(pdf) if pd.isna(entry) else int(np.searchsorted(start, int(entry)))
    if not pd.isna(left):
        owner[:place] = int(left)
    while place < len(pdf) and good[place]:
        on[place] = True
        follow = int(np.searchsorted(start, after[place]))
        owner[place:follow] = after[place]
        if follow < len(pdf) and start[follow] != after[place]:
            break
        place = follow
    return pdf.assign(on_chain=on, owner=owner).drop(columns=["entry", "inside"])


def _entries(spark: SparkSession, placed: DataFrame) -> DataFrame:
    """(file, block, entry, inside): the offset at which the chain enters each
    split (null if a record covers it all), and the end of the record that
    reaches into it."""
    edges = placed.where("exit >= 0").select("file", F.col("start").alias("at"), F.col("exit").alias("to"))
    ends = edges.select("file", F.col("to").alias("at")).union(
        edges.select("file", F.lit(0).cast("long").alias("at"))).distinct()
    jump = materialize(edges.join(ends, ["file", "at"]), "warc-jump")
    reached = materialize(jump.where("at = 0").select("file", "at"), "warc-reached")
    known = reached.count()
    while known:
        new = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = materialize(reached.union(new).distinct(), "warc-reached")
        grown = reached.count()
        if grown == known:
            break
        known = grown
        far = jump.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        jump = materialize(jump.join(far, ["file", "to"], "left").select(
            "file", "at", F.coalesce("far", "to").alias("to")), "warc-jump")
    # one row per split: its extent, the least chain offset at or behind its beginning
    splits = placed.groupBy("file", "block").agg(F.min("start").alias("low"), F.max("start").alias("high"))
    from pyspark.sql import Window
    marks = (splits.select("file", F.col("low").alias("at"), "block", "high")
             .unionByName(reached.select("file", "at", F.lit(None).cast("long").alias("block"), F.lit(None).cast("long").alias("high"))))
    later = Window.partitionBy("file").orderBy("at", F.col("block").isNull()).rowsBetween(1, Window.unboundedFollowing)
    nxt = F.min(F.when(F.col("block").isNull(), F.col("at"))).over(later)
    return (marks.withColumn("next", nxt).where("block IS NOT NULL")
            .select("file", "block", F.when(F.col("next") <= F.col("high"), F.col("next")).alias("entry"),
                    F.when(F.col("next") != F.col("at"), F.col("next")).alias("inside")))


def read_pieces(spark: SparkSession, path: str) -> DataFrame:
    """All pieces of all files with absolute offsets and their record."""
    from pyspark.sql import Window
    local = materialize(_parsed(_pieces(spark, path)).mapInPandas(_placed, PLACED), "warc-pieces")
    # one row per split and file
    totals = local.groupBy("file", "block").agg(F.max("total").alias("total"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = materialize(totals.withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0))).drop("total"), "warc-bases")
    move = lambda c: F.when(F.col(c) >= 0, F.col(c) + F.col("base")).otherwise(F.col(c)).alias(c)
    plain = [c for c in local.columns if c not in ("start", "at", "after", "exit", "total")]
    placed = (local.join(bases, ["file", "block"])
              .select(*plain, (F.col("start") + F.col("base")).alias("start"), (F.col("at") + F.col("base")).alias("at"),
                      move("after"), move("exit")))
    entered = placed.join(materialize(_entries(spark, placed), "warc-entries"), ["file", "block"])
    schema = ", ".join(f"{c} {t}" for c, t in placed.dtypes) + ", on_chain boolean, owner long"
    return entered.groupBy("file", "block").applyInPandas(_chain, schema)


def read_archives(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """One row per record: page_id, record_type, refers_to, url, payload_bytes,
    payload_digest (computed from the payload of a response, as declared for a
    revisit), digest_ok, and with ``payload`` the bytes themselves."""
    chain = materialize(read_pieces(spark, path), "warc-chain")
    records = chain.where("on_chain")
    whole = F.col("head_bytes") + len(BLANK) + F.col("content") <= F.col("length")
    cut = records.where(F.lit(payload) | ~whole)
    joined = None
    if payload or not cut.isEmpty():
        texts = _pieces(spark, path).select("file", "block", F.octet_length("value").cast("long").alias("length"),
                                            F.col("value").cast("binary").alias("value"))
        offsets = materialize(chain.select("file", "block", "start", "at", "owner"), "warc-offsets")
        keyed = texts.mapInPandas(_numbered, "file string, block long, no long, value binary")
        order = offsets.groupBy("file", "block").agg(F.min("at").alias("base"))
        parts = (keyed.join(order, ["file", "block"]).withColumn("at", F.col("base") + F.col("no"))
                 .join(offsets.select("file", "at", "owner"), ["file", "at"])
                 .join(cut.select("file", F.col("after").alias("owner")).distinct(), ["file", "owner"], "left_semi"))
        joined = parts.groupBy("file", "owner").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("at", F.hex("value").alias("x")))), lambda p: p["x"]),
            MAGIC.encode().hex().upper()).alias("x")).select("file", F.col("owner").alias("after"), F.unhex("x").alias("bytes"))
        records = records.join(joined, ["file", "after"], "left")
        body = F.substring(F.col("bytes"), (F.col("head_bytes") + F.col("http_bytes") + 5).cast("int"),
                           (F.col("content") - F.col("http_bytes")).cast("int"))
        records = records.withColumn("payload", body).withColumn(
            "payload_digest", F.when(F.col("payload").isNotNull(), base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest")))
    own = F.col("record_type") != "revisit"
    out = [F.expr("try_cast(record AS BIGINT)").alias("page_id"),
           F.when(own, F.col("content") - F.col("http_bytes")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
           F.when(own, F.col("payload_digest")).otherwise(F.col("declared")).alias("payload_digest"), "record_type",
           F.expr("try_cast(refers AS BIGINT)").alias("refers_to"), F.col("uri").alias("url"),
           (~own | F.coalesce(F.col("payload_digest") == F.col("declared"), F.lit(False))).alias("digest_ok")]
    return records.select(*out, *(["payload"] if payload else []))


def _numbered(batches):
    """The place of each piece behind its split's first, in bytes."""
    key, place = None, 0
    for pdf in batches:
        nos = []
        for one, n in zip(zip(pdf["file"], pdf["block"], strict=True), pdf["length"], strict=True):
            if one != key:
                key, place = one, 0
            nos.append(place)
            place += n + len(MAGIC)
        yield pdf.assign(no=nos)[["file", "block", "no", "value"]]


def op1_warc(spark, sf_dir: str) -> DataFrame:
    path = write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc-archives"))
    return read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                                             "digest_ok")


#: SHA-1 in base32 digit by digit; records of equal payloads refer to the smallest page id.
OP1_SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex,
             min(page_id) OVER (PARTITION BY sha1(body)) AS first FROM p),
b AS (SELECT *, [CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT) FOR i IN range(0, 8)] AS v FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST((v[CAST(j // 4 AS INTEGER) + 1] >> (15 - 5 * (j % 4))) & 31 AS INTEGER) + 1, 1) FOR j IN range(0, 32)], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to, true AS digest_ok
FROM b
"""
