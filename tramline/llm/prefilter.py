"""A Bloom filter ahead of a join: most rows without a partner need no shuffle.

It changes no result, the join still decides. Up to ``MAX_BYTES`` it goes with
the plan as a literal; more keys than that get no filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .url_filter import SHARD_BITS, SHARD_BYTES, Level, _bit, _shard

MAX_BYTES = 4 << 20
PROBES = 5


def may_be_in(keys: DataFrame, column: str, of: Column) -> Column | None:
    """A condition that holds for every ``of`` that is a value of ``column``,
    and for about one in a hundred others; None if there are too many keys."""
    n = keys.count()
    shards = max(1, math.ceil(9 * n / SHARD_BITS))
    if shards * SHARD_BYTES > MAX_BYTES:
        return None
    key = F.col(column)
    bits = F.array(*[F.struct(_shard(key, shards).alias("shard"), _bit(key, 0, i).alias("bit")) for i in range(PROBES)])
    built = (keys.select(F.explode(bits).alias("b")).groupBy("b.shard")
             .agg(F.bitmap_construct_agg("b.bit").alias("bits")).collect())
    data = bytearray(shards * SHARD_BYTES)
    for r in built:
        data[r["shard"] * SHARD_BYTES:(r["shard"] + 1) * SHARD_BYTES] = r["bits"]
    return Level(0, PROBES, shards, bytes(data)).holds(of)
