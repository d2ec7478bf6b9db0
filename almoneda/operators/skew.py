"""Per-key aggregates where a few keys hold most rows: two-stage salted aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoneda.plans.runtime import materialize

KEY, SALT, HEAVY = "__key", "__salt", "__heavy"


def heavy_keys(keyed: DataFrame, fraction: float) -> DataFrame:
    """Keys with at least that fraction of all rows. There are at most 1/fraction of them, whatever the input: safe to broadcast."""
    counts = materialize(keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") >= F.lit(max(2.0, fraction * total))).select(KEY, F.lit(True).alias(HEAVY))


def salted_aggregate(df: DataFrame, key: Column, name: str, sums: dict[str, Column], mins: dict[str, Column], maxs: dict[str, Column], distinct: dict[str, Column], salt_by: Column, fraction: float = 0.01, salts: int = 32) -> DataFrame:
    """One row per key with sums, minima, maxima and at most one distinct count.

    Rows of a heavy key (at least ``fraction`` of all rows) get a salt below ``salts``; partial results are made per key and salt
    and then merged per key. The salt is a hash of ``salt_by``, pseudo-random but the same when a lost task runs again; it is a
    function of the distinct column, so that the distinct counts of the salts are disjoint and can be added.

    A null key is a key of its own. An empty table gives no rows. Sums over only null values are null. Names in ``df`` can't clash:
    only the expressions given are read.
    """
    assert len(distinct) <= 1
    one = list(distinct)
    keyed = df.select(key.alias(KEY), salt_by.alias("__by"), *[e.alias(f"__s_{n}") for n, e in sums.items()], *[e.alias(f"__i_{n}") for n, e in mins.items()], *[e.alias(f"__a_{n}") for n, e in maxs.items()], *[e.alias("__d") for e in distinct.values()])
    heavy = F.broadcast(heavy_keys(keyed.select(KEY), fraction).withColumnRenamed(KEY, "__hk"))
    rows = keyed.join(heavy, F.col(KEY).eqNullSafe(F.col("__hk")), "left")
    rows = rows.withColumn(SALT, F.when(F.col(HEAVY), F.pmod(F.xxhash64("__by", F.lit(17)), F.lit(salts))).otherwise(F.lit(0)).cast("int"))

    def merged() -> list[Column]:
        return [F.sum(f"__s_{n}").alias(f"__s_{n}") for n in sums] + [F.min(f"__i_{n}").alias(f"__i_{n}") for n in mins] + [F.max(f"__a_{n}").alias(f"__a_{n}") for n in maxs]

    if one:
        rows = rows.groupBy(KEY, SALT, "__d").agg(*merged())
        partial = rows.groupBy(KEY, SALT).agg(*merged(), F.count("__d").alias("__n"))
    else:
        partial = rows.groupBy(KEY, SALT).agg(*merged())
    total = partial.groupBy(KEY).agg(*merged(), *[F.sum("__n").alias(n) for n in one])
    return total.select(F.col(KEY).alias(name), *[F.col(f"__s_{n}").alias(n) for n in sums], *[F.col(f"__i_{n}").alias(n) for n in mins], *[F.col(f"__a_{n}").alias(n) for n in maxs], *one)
