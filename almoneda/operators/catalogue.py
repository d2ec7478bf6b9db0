"""Aggregates over the catalogue: competitors, lot outcomes, facets, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoneda.functions.normalize import fold_upper


def competitors(awards: DataFrame, as_of: Column) -> DataFrame:
    """One row per valid identifier: commonest name (then the smallest), its spellings, lots, files, amount, share of lots with a single bid among
    all its lots, dates. ``awards`` has each award once.

    Two levels: per identifier and name, then per identifier, so that distinct names and the mode need no row expansion; distinct files
    are counted from a second narrow aggregate. A null name is a spelling of nothing, but the commonest name is never null."""
    a = awards.where(F.col("cif_adjudicatario").rlike(r"^[A-Z0-9]+\z")).withColumnRenamed("cif_adjudicatario", "cif")
    when = F.when(F.col("fecha_adjudicacion").between(F.lit("2000-01-01").cast("date"), F.date_add(as_of, 730)), F.col("fecha_adjudicacion"))
    per_name = a.groupBy("cif", "adjudicatario").agg(F.count(F.lit(1)).alias("n"), F.sum("importe_sin_iva").alias("importe"), F.sum(F.when(F.col("n_ofertas") == 1, 1).otherwise(0)).alias("unicas"), F.min(when).alias("primera"), F.max(when).alias("ultima"))
    files = a.groupBy("cif", "licitacion_id").agg(F.lit(1).alias("x")).groupBy("cif").agg(F.count("licitacion_id").alias("n_expedientes"))
    most = F.min(F.when(F.col("adjudicatario").isNotNull(), F.struct(-F.col("n"), F.col("adjudicatario").alias("nombre"))))
    variants = F.array_join(F.array_sort(F.collect_set(F.coalesce("adjudicatario", F.lit("")))), " ")
    total = per_name.groupBy("cif").agg(
        most.alias("mas"), fold_upper(variants).alias("nombre_busqueda"), F.sum("n").alias("n_lotes"), F.sum("importe").cast("decimal(30,2)").alias("importe_total_sin_iva"),
        F.round(F.lit(100).cast("decimal(10,0)") * F.sum("unicas").cast("decimal(18,0)") / F.nullif(F.sum("n"), F.lit(0)).cast("decimal(18,0)"), 1).cast("decimal(5,1)").alias("pct_una_oferta"), F.min("primera").alias("primera_adjudicacion"), F.max("ultima").alias("ultima_adjudicacion"))
    return total.withColumn("nombre_canonico", F.col("mas.nombre")).drop("mas").join(files, "cif", "left")


def lot_outcomes(awards: DataFrame) -> DataFrame:
    """Per notice: how its lots ended, by counts of winners, deserted (code 3) and withdrawn (4, 5) lots."""
    won = F.col("cif_adjudicatario") != ""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    c = awards.groupBy("licitacion_id").agg(n(won).alias("g"), n(~won & (F.col("resultado_code") == "3")).alias("d"), n(~won & F.col("resultado_code").isin("4", "5")).alias("r"))
    state = F.when((F.col("g") == 0) & (F.col("d") > 0), "desierta_total").when((F.col("g") > 0) & (F.col("d") > 0), "desierta_parcial").when((F.col("g") == 0) & (F.col("r") > 0), "retirada").when(F.col("g") > 0, "adjudicada").otherwise("sin_ganador")
    return c.select("licitacion_id", state.alias("estado"), F.col("d").alias("n_lotes_desiertos"))


def facet(df: DataFrame, codes: str, name: str) -> DataFrame:
    """Rows per distinct code, each row counted once per code."""
    return df.select(F.explode(F.array_distinct(codes)).alias(name)).where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def first_seen(df: DataFrame, key: str, period: Column) -> DataFrame:
    """New keys by the first period in which they appear, and keys present in each period."""
    p = df.select(F.col(key).alias("k"), period.alias("periodo")).where("k is not null and periodo is not null").distinct()
    new = p.groupBy("k").agg(F.min("periodo").alias("periodo")).groupBy("periodo").agg(F.count(F.lit(1)).alias("nuevos"))
    return p.groupBy("periodo").agg(F.count(F.lit(1)).alias("presentes")).join(new, "periodo", "left").withColumn("nuevos", F.coalesce("nuevos", F.lit(0).cast("long")))


def population(df: DataFrame) -> DataFrame:
    """Non-null values per column, from one pass."""
    one = df.agg(F.count(F.lit(1)).alias("__t"), *[F.count(c).alias(c) for c in df.columns])
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).alias("con_valor"), F.col("__t").alias("filas")) for c in df.columns])).alias("s")).select("s.*")


def overlap(df: DataFrame, key: str, period: Column) -> DataFrame:
    """One row over all periods: how many, the mean of distinct keys a period, distinct keys in all, the mean of new keys in the periods after the
    first (in the first all are new), and twelve times that."""
    per = first_seen(df, key, period)
    first = per.agg(F.min("periodo").alias("p0"), F.count(F.lit(1)).alias("periodos"), F.avg("presentes").alias("media"), F.sum("nuevos").alias("distintos"))
    later = per.select("periodo", "nuevos").join(F.broadcast(first.select("p0")), F.col("periodo") > F.col("p0"), "left_semi").agg(F.avg("nuevos").alias("nuevos_medios"))
    both = first.withColumn("u", F.lit(1)).join(later.withColumn("u", F.lit(1)), "u", "left")  # one row each
    return both.select("periodos", F.round("media", 4).alias("media"), "distintos", F.round("nuevos_medios", 4).alias("nuevos_medios"), F.round(F.col("nuevos_medios") * 12, 2).alias("por_anio"))
