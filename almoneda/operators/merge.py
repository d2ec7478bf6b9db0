"""Snapshots of records merged by rewriting: dedup, upsert, replacement of children, change logs, deltas, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond &= a[k].eqNullSafe(b[k])
    return cond


def pick(df: DataFrame, keys: list[str], order: Column, newest: bool = True) -> DataFrame:
    """One row per key, by a partial maximum (or minimum) of ``order``: combined map-side, no sort of a key's rows, no window."""
    rest = [c for c in df.columns if c not in keys]
    best = (F.max_by if newest else F.min_by)(F.struct(*rest), order)
    return df.groupBy(*keys).agg(best.alias("__r")).select(*keys, *[F.col("__r").getField(c).alias(c) for c in rest]).select(*df.columns)


def upsert(base: DataFrame, batch: DataFrame, keys: list[str], refresh: list[str], keep: list[str] = ()) -> DataFrame:
    """The base with the batch's rows: new keys are inserted; of known keys ``refresh`` columns are overwritten (also by null) and ``keep``
    columns stay, the rest stays where the batch has null. Both sides have one row per key."""
    b = batch.select(*keys, *[F.col(c).alias(f"__n_{c}") for c in batch.columns if c not in keys], F.lit(True).alias("__in"))
    j = base.withColumn("__was", F.lit(True)).join(b, keys, "full_outer")
    out = []
    for c in base.columns:
        new = f"__n_{c}"
        if c in keys or new not in b.columns:
            out.append(F.col(c))
        elif c in refresh:
            out.append(F.when(F.col("__in"), F.col(new)).otherwise(F.col(c)).alias(c))
        elif c in keep:
            out.append(F.when(F.col("__was"), F.col(c)).otherwise(F.col(new)).alias(c))
        else:
            out.append(F.coalesce(F.col(new), F.col(c)).alias(c))
    return j.select(*out)


def replace_children(base: DataFrame, batch: DataFrame, parent: str) -> DataFrame:
    """Children of every parent in the batch are replaced by the batch's. A parent that comes without children keeps its old ones."""
    return base.join(batch.select(parent).distinct(), parent, "left_anti").select(*base.columns).unionByName(batch.select(*base.columns))


def insert_missing(base: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The base and those rows of the batch whose key it doesn't have."""
    return base.unionByName(batch.join(base.select(*keys).distinct(), keys, "left_anti").select(*base.columns))


def fold_changes(log: DataFrame, keys: list[str], order: Column, tombstone: Column) -> DataFrame:
    """The last write of each key, without those that are deletions."""
    return pick(log, keys, order).where(~F.coalesce(tombstone, F.lit(False)))


def delta(new: DataFrame, old: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of ``new`` that differ from the row of the same key in ``old``, null-safe; keys that ``old`` lacks aren't reported."""
    o = old.select(*keys, *[F.col(c).alias(f"__o_{c}") for c in columns])
    changed = F.lit(False)
    for c in columns:
        changed |= ~F.col(c).eqNullSafe(F.col(f"__o_{c}"))
    return new.join(o, keys).where(changed).select(*new.columns)


def purge(df: DataFrame, key: str, old: Column, protected: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(what stays, what goes): rows that are ``old`` go unless a protected table has their key. A null condition keeps the row."""
    gone = df.where(F.coalesce(old, F.lit(False)))
    for p in protected:
        gone = gone.join(p.select(key), key, "left_anti")
    return df.join(gone.select(key).distinct(), key, "left_anti"), gone


def filled(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Defaults in place of nulls, and of columns that aren't there."""
    out = df
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v))
    return out
