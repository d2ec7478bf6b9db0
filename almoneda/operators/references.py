"""References to records that do not exist, by compressed bitmaps over dictionary-encoded keys."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoneda.plans.runtime import materialize

#: Keys per bitmap: what bitmap_construct_agg holds (4 KB).
RANGE = 32768


def pack(bits: bytes) -> bytes:
    """The smallest of three containers: sorted positions, runs, or the plain bitmap."""
    at = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")).astype(np.uint16)
    cut = np.flatnonzero(np.diff(at.astype(np.int32)) != 1) + 1 if len(at) else np.array([], int)
    first, last = np.r_[0, cut] if len(at) else cut, np.r_[cut - 1, len(at) - 1] if len(at) else cut
    forms = [b"p" + at.tobytes(), b"r" + np.column_stack([at[first], at[last]]).astype(np.uint16).tobytes(), b"b" + bytes(bits)]
    return min(forms, key=len)


def unpack(data: bytes) -> np.ndarray:
    """The container as booleans, one a position."""
    kind, body, out = data[:1], data[1:], np.zeros(RANGE, bool)
    if kind == b"b":
        return np.unpackbits(np.frombuffer(body, np.uint8), bitorder="little").astype(bool)
    if kind == b"p":
        out[np.frombuffer(body, np.uint16)] = True
        return out
    step = np.zeros(RANGE + 1, np.int8)
    runs = np.frombuffer(body, np.uint16).reshape(-1, 2).astype(np.int64)
    step[runs[:, 0]] += 1
    step[runs[:, 1] + 1] -= 1
    return np.cumsum(step[:RANGE]).astype(bool)


def _pack_all(bits: pd.Series) -> pd.Series:
    return bits.map(pack)


def _packed(bits: str) -> Column:
    return F.pandas_udf(_pack_all, "binary")(bits)


def _bitmaps(codes: DataFrame, by: list[str]) -> DataFrame:
    """Compressed bitmaps per key range and the columns of ``by``; the bitmaps are combined map-side before the shuffle."""
    built = codes.groupBy(*by, F.expr("bitmap_bucket_number(code)").alias("rango")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(code))").alias("bits"))
    return built.select(*by, "rango", _packed("bits").alias("bits"))


def _and_not(refs: pd.DataFrame, parents: pd.DataFrame) -> pd.DataFrame:
    """Of one key range: references of a period AND NOT the parents known before that period. A range has a few bitmaps a period."""
    known, found, codes, left = np.zeros(RANGE, bool), [], [], 0
    parents = parents.sort_values("periodo")
    months, bits = parents["periodo"].tolist(), parents["bits"].tolist()
    refs = refs.sort_values("periodo")
    for r in refs.itertuples():
        while left < len(months) and months[left] < r.periodo:
            known |= unpack(bits[left])
            left += 1
        at = np.flatnonzero(unpack(r.bits) & ~known)
        codes.append((r.rango - 1) * RANGE + at + 1)  # codes and ranges count from 1
        found.append(len(at))
    names = {c: np.repeat(np.array(refs[c].tolist(), object), found) for c in ("tabla", "periodo")}
    return pd.DataFrame({c: pd.Series(v, dtype=object) for c, v in names.items()} | {"code": np.concatenate(codes) if codes else np.array([], np.int64)})


def orphan_references(refs: DataFrame, parents: DataFrame, withdrawals: DataFrame, salts: int = 8) -> DataFrame:
    """refs (tabla, fila_id, clave, momento), parents (clave, recibido), withdrawals (clave, baja): one row per orphan reference with
    its period and class.

    ``ausente``: the parent was never received. ``borrada``: withdrawn after its last receipt. ``tardia``: first received after the
    reference's own moment. A null key refers to nothing and counts as absent; a null moment gives the period null and can't be late.
    Repeated references count each; withdrawals of unknown parents change nothing; empty tables give no rows or only absent parents.

    The bitmaps decide by key, table and month: they leave references whose parent wasn't there before that month began, or was
    withdrawn. Only those are compared with the exact times, afterwards.
    """
    refs = refs.select("tabla", "fila_id", "clave", "momento", F.coalesce(F.date_format("momento", "yyyy-MM"), F.lit("")).alias("periodo"))
    ts = "timestamp"
    facts = parents.select("clave", F.col("recibido").cast(ts).alias("recibido"), F.lit(None).cast(ts).alias("baja"), F.lit(True).alias("hay")).unionByName(
        withdrawals.select("clave", F.lit(None).cast(ts).alias("recibido"), F.col("baja").cast(ts).alias("baja"), F.lit(None).cast("boolean").alias("hay"))).unionByName(
        refs.select("clave").distinct().select("clave", F.lit(None).cast(ts).alias("recibido"), F.lit(None).cast(ts).alias("baja"), F.lit(None).cast("boolean").alias("hay")))
    per_key = facts.where("clave is not null").groupBy("clave").agg(F.min("recibido").alias("primera"), F.max("recibido").alias("ultima"), F.max("baja").alias("baja"), F.max("hay").alias("hay"))
    # Ids of this function are dense within a task and apart between tasks: few bitmaps, and fixed once written.
    dictionary = materialize(per_key.withColumn("code", F.monotonically_increasing_id() + 1), "dictionary")
    withdrawn = F.coalesce(F.col("baja") > F.col("ultima"), F.lit(False))
    uses = refs.where("clave is not null").select("tabla", "periodo", "clave").distinct()
    coded = uses.join(dictionary.select("clave", "code"), "clave").select("tabla", "periodo", "code")
    ref_bits = _bitmaps(coded, ["tabla", "periodo"])
    solid = dictionary.where(F.col("hay") & ~withdrawn & F.col("primera").isNotNull()).select("code", F.date_format("primera", "yyyy-MM").alias("periodo"))
    parent_bits = _bitmaps(solid, ["periodo"])
    left = ref_bits.groupBy("rango").cogroup(parent_bits.groupBy("rango")).applyInPandas(_and_not, "tabla string, periodo string, code long")
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    suspects = left.join(dictionary.select("code", "clave", "primera", "ultima", "baja", "hay"), "code").select("tabla", "periodo", "clave", "primera", "ultima", "baja", "hay", salt)
    # A key may hold a third of all references: its rows are spread over the salts.
    rows = refs.withColumn("salt", F.pmod(F.xxhash64("fila_id"), F.lit(salts)).cast("int")).join(suspects, ["tabla", "periodo", "clave", "salt"])
    kind: Column = F.when(F.col("hay").isNull(), "ausente").when(withdrawn, "borrada").when(F.col("primera") > F.col("momento").cast(ts), "tardia")
    found = rows.withColumn("clase", kind).where("clase is not null").select("tabla", "periodo", "fila_id", "clase")
    absent = refs.where("clave is null").select("tabla", "periodo", "fila_id", F.lit("ausente").alias("clase"))
    return found.unionByName(absent).withColumn("periodo", F.nullif(F.col("periodo"), F.lit("")))
