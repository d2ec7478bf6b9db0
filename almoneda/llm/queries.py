"""Queries of the training-data problems, with production parameters, over whole tables."""

from __future__ import annotations

from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almoneda.functions.normalize import CIF_FORM, cif
from almoneda.llm.bpe import encode_corpus
from almoneda.llm.linkage import cluster_spellings, link_spellings
from almoneda.llm.lookalike import canonical, normalized
from almoneda.llm.mixing import mix
from almoneda.llm.mojibake import garbled_documents, restored_documents
from almoneda.llm.names import ends_whole
from almoneda.llm.survivors import cut_names, elect, judged_names, pivot_back
from almoneda.plans.runtime import materialize, maybe_broadcast, table

#: Seconds in which a vote loses half its weight: a day. Values delivered within hours of one another are weighed against each other by
#: trust and number; what was delivered days later outweighs what older records agree on.
HALF_LIFE_S = 86400.0
#: A total of at most the first is a stand-in, as is exactly the second (real totals go beyond it); the years a date may have.
LEAST, FILLER, YEARS = Decimal("0.01"), Decimal("9999999999.99"), (1990, 2090)


def _canonical_codes(values: pd.Series) -> pd.Series:
    return values.map(lambda v: canonical(v, True))


def with_cif(df: DataFrame, column: str) -> DataFrame:
    """Adds ``cif``: the usable CIF, also of one written in other characters; else null. Only odd values go through Python."""
    plain = F.coalesce(F.col(column).rlike(r"^[\x00-\x7F]*\z"), F.lit(True))
    code = lambda c: F.when(cif(c).rlike(CIF_FORM), cif(c))
    odd = df.where(~plain).withColumn("cif_limpio", F.pandas_udf(_canonical_codes, "string")(column))
    return df.where(plain).withColumn("cif_limpio", F.col(column)).unionByName(odd).withColumn("cif_usable", code("cif_limpio")).drop("cif_limpio")


def _named(a: str, b: str) -> Column:
    return F.col(a).alias(b)


def _award_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "adjudicaciones").select("fila_id", "licitacion_id", "lote", "cif_adjudicatario", "adjudicatario", "updated_at")
    group = F.concat_ws("\x1f", F.lit("adjudicaciones"), *[F.coalesce(F.concat(F.lit("="), F.col(k)), F.lit("")) for k in ("licitacion_id", "lote", "cif_adjudicatario")])
    a = with_cif(a, "cif_adjudicatario").withColumn("grupo", group)
    return a.select("grupo", _named("fila_id", "registro"), _named("updated_at", "momento"), _named("adjudicatario", "valor"), "cif_usable", F.coalesce("cif_usable", "grupo").alias("dueno"), F.col("cif_usable").rlike("^[A-Z]").alias("empresa"))


def _competitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The competitor records with a usable CIF, each with its source's trust."""
    trust = maybe_broadcast(table(spark, sf_dir, "fuentes").groupBy("fuente").agg(F.max("confianza").alias("confianza")))
    c = table(spark, sf_dir, "competidores").withColumn("k", cif("cif")).where(F.col("k").rlike(CIF_FORM)).join(trust, "fuente", "left")
    return c.withColumn("grupo", F.concat_ws("\x1f", F.lit("competidores"), "k"))


def _facts(c: DataFrame) -> DataFrame:
    """Usable amounts and dates as long rows."""
    amount, dates = F.col("importe_total_sin_iva"), ("primera_adjudicacion", "ultima_adjudicacion")
    facts = [F.struct(F.lit("importe_total_sin_iva").alias("campo"), F.when((amount > LEAST) & (amount != FILLER), amount.cast("string")).alias("valor"))]
    facts += [F.struct(F.lit(d).alias("campo"), F.when(F.year(d).between(*YEARS), F.col(d).cast("string")).alias("valor")) for d in dates]
    unpivoted = c.select("grupo", _named("ficha_id", "registro"), _named("updated_at", "momento"), "confianza", F.explode(F.array(*facts)).alias("f")).where("f.valor is not null")
    return unpivoted.select("grupo", "f.campo", F.col("f.valor").alias("norma"), "f.valor", "registro", "momento", "confianza")


def _several(groups: DataFrame) -> DataFrame:
    return groups.select("grupo").groupBy("grupo").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("grupo")


def _survivors(spark: SparkSession, sf_dir: str, half_life_s: float = HALF_LIFE_S) -> DataFrame:
    """The winners: grupo, campo, valor, registro, votos."""
    awards = materialize(_award_names(spark, sf_dir), "award-names")
    c = _competitors(spark, sf_dir)
    firms = c.select("grupo", _named("ficha_id", "registro"), _named("updated_at", "momento"), _named("nombre_canonico", "valor"), _named("k", "cif_usable"), _named("k", "dueno"), F.col("k").rlike("^[A-Z]").alias("empresa"), "confianza")
    names = firms.unionByName(awards.withColumn("confianza", F.lit(1)))
    names = materialize(judged_names(names), "names")
    whole = names.where("posible").join(cut_names(names, "dueno"), ["dueno", "norma"], "left_anti")
    field = F.when(F.col("grupo").startswith("competidores"), "nombre_canonico").otherwise("adjudicatario")
    long = whole.select("grupo", field.alias("campo"), "norma", "valor", "registro", "momento", "confianza").unionByName(_facts(c))
    return elect(long.join(_several(awards.select("grupo").unionByName(c.select("grupo"))), "grupo", "left_semi"), half_life_s)


FIELDS = ["nombre_canonico", "importe_total_sin_iva", "primera_adjudicacion", "ultima_adjudicacion", "adjudicatario"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survivors(spark, sf_dir).select(F.substring_index("grupo", "\x1f", 1).alias("tabla"), F.col("registro").alias("registro_id"), "campo")


def p1_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving records, one a group."""
    return pivot_back(_survivors(spark, sf_dir), FIELDS)


def p1_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of p1_found that needs no reading of names: amounts and dates."""
    c = _competitors(spark, sf_dir)
    won = elect(_facts(c).join(_several(c), "grupo", "left_semi"), HALF_LIFE_S)
    return won.select(F.col("registro").alias("registro_id"), "campo", "valor")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = with_cif(table(spark, sf_dir, "competidores").select("ficha_id", "cif", "nombre_canonico", "nombre_busqueda"), "cif")
    spelled = F.explode(F.array("nombre_canonico", "nombre_busqueda")).alias("texto")
    c = materialize(c.select("ficha_id", "cif_usable", spelled).where("texto is not null"), "competitor-names")
    a = with_cif(table(spark, sf_dir, "adjudicaciones").select("fila_id", "cif_adjudicatario", "adjudicatario"), "cif_adjudicatario").where("adjudicatario is not null")
    a = materialize(a.select("fila_id", "cif_usable", F.col("adjudicatario").alias("texto")), "winner-names")
    listed = c.where("cif_usable is not null").select(F.col("cif_usable").alias("clave")).distinct()
    # A registered company's whole names, in either table.
    known = c.select("cif_usable", "texto").unionByName(a.select("cif_usable", "texto")).where("cif_usable is not null").distinct().mapInPandas(_whole, "clave string, texto string")
    known = known.join(maybe_broadcast(materialize(listed, "listed")), "clave", "left_semi")
    asked = a.where("cif_usable is null").select(F.lit("adjudicaciones").alias("tabla"), F.col("fila_id").alias("registro_id"), "texto")
    asked = asked.unionByName(c.where("cif_usable is null").select(F.lit("competidores").alias("tabla"), F.col("ficha_id").alias("registro_id"), "texto"))
    links = materialize(link_spellings(asked, known), "links")
    found = asked.join(maybe_broadcast(links), "texto").groupBy("tabla", "registro_id").agg(F.max_by("clave", F.struct("parecido", "clave")).alias("cif"))
    return found.select("tabla", "registro_id", "cif")


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings without a registered CIF, clustered among themselves: the text and its group's central spelling."""
    c = with_cif(table(spark, sf_dir, "competidores").select("cif", "nombre_canonico"), "cif").where("cif_usable is null").select(F.col("nombre_canonico").alias("texto"))
    a = with_cif(table(spark, sf_dir, "adjudicaciones").select("cif_adjudicatario", "adjudicatario"), "cif_adjudicatario").where("cif_usable is null").select(F.col("adjudicatario").alias("texto"))
    return cluster_spellings(c.unionByName(a))


def _whole(batches):
    for b in batches:
        ok = [ends_whole(t, c[0].isalpha()) for c, t in zip(b["cif_usable"], b["texto"], strict=True)]
        yield b[ok].rename(columns={"cif_usable": "clave"})[["clave", "texto"]]


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(table(spark, sf_dir, "adjudicaciones"), "fila_id", {"adjudicatario": False, "cif_adjudicatario": True}, changed_only=True).select(F.col("id").alias("fila_id"), "campo")


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalized(table(spark, sf_dir, "adjudicaciones"), "fila_id", {"adjudicatario": False, "cif_adjudicatario": True}).select(F.col("id").alias("fila_id"), "campo", "limpio")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("doc", "doc_id")


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = materialize(encode_corpus(table(spark, sf_dir, "documents"), "doc_id", "text", also={"source": F.col("source")}), "corpus-ids")
    return mix(docs, table(spark, sf_dir, "pesos_fuente"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[0].withColumnRenamed("doc", "doc_id")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled_documents(table(spark, sf_dir, "documents"), "doc_id", "text").select(F.col("doc").alias("doc_id"))


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored_documents(table(spark, sf_dir, "documents"), "doc_id", "text").withColumnRenamed("doc", "doc_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_survivors, p1_facts, p4_found, p4_groups, p7_found, p7_clean, p8_ids, p9_mix, p9_shares, p10_found, p10_restored)}

_CIF = r"upper(regexp_replace(coalesce(cif, ''), '[\s./\-\x{1c}-\x{1f}\x{85}\p{Z}]', '', 'g'))"

SQL: dict[str, str] = {
    "p1_facts": f"""
WITH c AS (SELECT *, {_CIF} AS k FROM competidores), g AS (SELECT * FROM c WHERE regexp_full_match(k, '[A-Z][0-9]{{8}}|[0-9]{{8}}[A-Z]') AND k IN (SELECT k FROM c GROUP BY 1 HAVING count(*) > 1)),
     f AS (SELECT k, ficha_id, updated_at, 'importe_total_sin_iva' AS campo, importe_total_sin_iva::VARCHAR AS valor FROM g WHERE importe_total_sin_iva > 0.01 AND importe_total_sin_iva <> 9999999999.99
           UNION ALL SELECT k, ficha_id, updated_at, 'primera_adjudicacion', primera_adjudicacion::VARCHAR FROM g WHERE year(primera_adjudicacion) BETWEEN 1990 AND 2090
           UNION ALL SELECT k, ficha_id, updated_at, 'ultima_adjudicacion', ultima_adjudicacion::VARCHAR FROM g WHERE year(ultima_adjudicacion) BETWEEN 1990 AND 2090)
SELECT ficha_id AS registro_id, campo, valor FROM (SELECT *, row_number() OVER (PARTITION BY k, campo ORDER BY updated_at DESC NULLS LAST, ficha_id) AS n FROM f) WHERE n = 1""",
}
