"""Best representative of each group of duplicate records, field by field.

The fields are unpivoted to long rows; each usable value gets votes, its source's trust times a decay with its age against the field's
newest value; votes are summed per normalised value; max_by takes the winner, and the winners are pivoted back to one row a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoneda.llm.names import ends_whole, is_stand_in, squeezed
from almoneda.plans.runtime import materialize, maybe_broadcast

#: Longer names are compared within those that begin with the same letters; shorter ones with the beginnings of all names.
HEAD = 4


def judged_names(long: DataFrame) -> DataFrame:
    """Adds ``norma`` (the name's letters) and ``posible`` to rows with ``valor`` and ``empresa`` (true: company, false: person, null:
    unknown). A stand-in isn't possible, nor a company's name without its legal form or a person's of under three words.
    Every distinct name is judged once."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = [not is_stand_in(v) and (e is None or e != e or ends_whole(v, bool(e)) or not v.isascii() and not squeezed(v).isascii()) for v, e in zip(b["valor"], b["empresa"], strict=True)]
            yield b.assign(norma=[squeezed(v) for v in b["valor"]], posible=ok)

    distinct = long.where("valor is not null").select("valor", "empresa").distinct()
    judged = materialize(distinct.mapInPandas(run, "valor string, empresa boolean, norma string, posible boolean"), "judged-names")
    judged = maybe_broadcast(judged)
    return long.join(judged, (long["valor"] == judged["valor"]) & long["empresa"].eqNullSafe(judged["empresa"])).drop(judged["valor"]).drop(judged["empresa"])


def cut_names(names: DataFrame, by: str) -> DataFrame:
    """(by, norma): names that are the beginning of a longer one under the same ``by``, however short.

    Names are first made distinct. In the order of the letters a name's extensions directly follow it, so one look ahead suffices; names
    under one key are split by how they begin, as a cut name begins like the whole one. What is too short for that is looked up among
    the short beginnings of all names, which are few.
    """
    distinct = names.select(by, "norma").where((F.length("norma") > 0) & F.col(by).isNotNull()).distinct()
    w = Window.partitionBy(by, F.substring("norma", 1, HEAD)).orderBy("norma")
    long = distinct.where(F.length("norma") >= HEAD).withColumn("sigue", F.lead("norma").over(w)).where(F.col("sigue").startswith(F.col("norma"))).select(by, "norma")
    heads = F.explode(F.array(*[F.when(F.length("norma") > k, F.substring("norma", 1, k)) for k in range(1, HEAD)])).alias("norma")
    short = distinct.where(F.length("norma") < HEAD).join(distinct.select(by, heads).where("norma is not null").distinct(), [by, "norma"])
    return long.unionByName(short)


def elect(long: DataFrame, half_life_s: float) -> DataFrame:
    """grupo, campo, valor, registro, votos from rows (grupo, campo, norma, valor, registro, momento, confianza) of usable values.

    Repeated deliveries of one value at one moment vote once, by their most trusted source, so that redelivery gives no weight. Ties
    go to the value with the newest, then the smallest record. A null moment counts as the oldest, null trust as 1. All steps combine
    map-side before the shuffle: no group's rows are gathered.
    """
    votes = long.select("grupo", "campo", "norma", "valor", "registro", F.coalesce(F.col("momento").cast("timestamp").cast("double"), F.lit(-6.2e10)).alias("t"), F.coalesce(F.col("confianza").cast("double"), F.lit(1.0)).alias("c"))
    once = materialize(votes.groupBy("grupo", "campo", "norma", "t").agg(F.max("c").alias("c"), F.min("registro").alias("registro"), F.min_by("valor", "registro").alias("valor")), "votes")
    newest = once.groupBy("grupo", "campo").agg(F.max("t").alias("ultimo"))
    aged = once.join(newest, ["grupo", "campo"]).withColumn("voto", F.col("c") * F.pow(F.lit(2.0), (F.col("t") - F.col("ultimo")) / half_life_s))
    order = F.struct("t", -F.col("registro"))
    per_value = aged.groupBy("grupo", "campo", "norma").agg(F.sum("voto").alias("votos"), F.max(order).alias("mejor"), F.max_by("valor", order).alias("valor"))
    rank: Column = F.struct(F.round("votos", 9), F.col("mejor"))
    winner = per_value.groupBy("grupo", "campo").agg(F.max_by(F.struct("valor", F.col("mejor.col2").alias("r"), "votos"), rank).alias("g"))
    return winner.select("grupo", "campo", F.col("g.valor").alias("valor"), (-F.col("g.r")).alias("registro"), F.col("g.votos").alias("votos"))


def pivot_back(winners: DataFrame, fields: list[str]) -> DataFrame:
    """One surviving record a group: grupo and a column per field, null where no record had a usable value."""
    return winners.groupBy("grupo").pivot("campo", fields).agg(F.first("valor"))
