"""Queries of the general data problems, with production parameters, over whole tables; and their SQL where SQL can express them."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoneda.functions.normalize import cif
from almoneda.operators.delivery import DeliveryStore
from almoneda.operators.feed_tables import feed_awards, feed_bodies, lots, notices
from almoneda.operators.references import orphan_references
from almoneda.operators.skew import salted_aggregate
from almoneda.plans.runtime import fresh_path, table

KEYS = {"licitaciones": ["licitacion_id"], "adjudicaciones": ["licitacion_id", "lote", "cif_adjudicatario"]}


def _duplicates(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Loads the older deliveries, then takes in the later ones as a batch; the rows the store didn't keep are the repeated ones."""
    keys = KEYS[name]
    rows = table(spark, sf_dir, name).select(*keys, "recibido_en", "fila_id")
    lo, hi = rows.agg(F.min("recibido_en"), F.max("recibido_en")).first()
    store = DeliveryStore(spark, fresh_path(spark, f"store-{name}"), keys, "recibido_en", "fila_id")
    if lo is None:
        store.apply(rows)
    else:
        cut = F.lit(lo + (hi - lo) * 3 / 4).cast("timestamp_ntz")
        late = F.coalesce(F.col("recibido_en") >= cut, F.lit(True))
        store.apply(rows.where(~late))
        store.apply(rows.where(late))
    kept = store.snapshot()
    # An anti join on the unique row number spreads evenly, however many rows share an identifier.
    repeated = rows.select("fila_id") if kept is None else rows.select("fila_id").join(kept.select("fila_id"), "fila_id", "left_anti")
    return repeated.select(F.lit(name).alias("tabla"), "fila_id")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    with ThreadPoolExecutor(len(KEYS)) as pool:  # the tables' stores have nothing in common: their jobs fill one another's gaps
        a, b = pool.map(lambda name: _duplicates(spark, sf_dir, name), KEYS)
    return a.unionByName(b)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    refs = table(spark, sf_dir, "adjudicaciones").select(F.lit("adjudicaciones").alias("tabla"), "fila_id", F.col("licitacion_id").alias("clave"), F.col("recibido_en").alias("momento"))
    refs = refs.unionByName(table(spark, sf_dir, "decisiones").select(F.lit("decisiones").alias("tabla"), "fila_id", F.col("licitacion_id").alias("clave"), F.col("updated_at").alias("momento")))
    parents = table(spark, sf_dir, "licitaciones").select(F.col("licitacion_id").alias("clave"), F.col("recibido_en").alias("recibido"))
    withdrawals = table(spark, sf_dir, "bajas").select(F.col("licitacion_id").alias("clave"), F.col("baja_en").alias("baja"))
    return orphan_references(refs, parents, withdrawals)


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans by table, month and class."""
    return p3_found(spark, sf_dir).groupBy("tabla", "periodo", "clase").agg(F.count(F.lit(1)).alias("n"))


def p5_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "adjudicaciones")
    return salted_aggregate(
        a, cif("cif_adjudicatario"), "cif",
        {"n_filas": F.lit(1).cast("bigint"), "importe_sin_iva": F.col("importe_sin_iva"), "importe_con_iva": F.col("importe_con_iva"), "n_ofertas": F.col("n_ofertas").cast("bigint")},
        {"primera_fecha": F.col("fecha_adjudicacion"), "importe_minimo": F.col("importe_sin_iva")},
        {"ultima_fecha": F.col("fecha_adjudicacion"), "importe_maximo": F.col("importe_sin_iva")},
        {"n_licitaciones": F.col("licitacion_id")}, F.col("licitacion_id"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_awards(table(spark, sf_dir, "entradas"))


def p6_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of notices and lots with their parent links: tabla, entrada_id, nodo, padre, clave."""
    bodies = feed_bodies(table(spark, sf_dir, "entradas"))
    n = notices(bodies).select(F.lit("aviso").alias("tabla"), F.col("doc").alias("entrada_id"), F.col("entrada_nodo").alias("nodo"), F.lit(None).cast("string").alias("padre"), F.col("licitacion_id").alias("clave"))
    return n.unionByName(lots(bodies).select(F.lit("lote").alias("tabla"), F.col("doc").alias("entrada_id"), F.col("lote_nodo").alias("nodo"), F.col("entrada_nodo").alias("padre"), F.col("lote").alias("clave")))


QUERIES = {f.__name__: f for f in (p2_found, p3_found, p3_report, p5_totals, p6_found, p6_tables)}

_P3 = """
WITH r AS (SELECT 'adjudicaciones' AS tabla, fila_id, licitacion_id, recibido_en AS t FROM adjudicaciones
           UNION ALL SELECT 'decisiones', fila_id, licitacion_id, updated_at FROM decisiones),
     l AS (SELECT licitacion_id, min(recibido_en) AS primera, max(recibido_en) AS ultima FROM licitaciones GROUP BY 1),
     b AS (SELECT licitacion_id, max(baja_en) AS baja FROM bajas GROUP BY 1),
     c AS (SELECT r.tabla, strftime(r.t, '%Y-%m') AS periodo, r.fila_id,
                  CASE WHEN l.licitacion_id IS NULL THEN 'ausente' WHEN b.baja > l.ultima THEN 'borrada' WHEN l.primera > r.t THEN 'tardia' END AS clase
           FROM r LEFT JOIN l USING (licitacion_id) LEFT JOIN b USING (licitacion_id))
"""

SQL = {
    "p2_found": """
SELECT 'licitaciones' AS tabla, fila_id FROM (SELECT fila_id, row_number() OVER (PARTITION BY licitacion_id ORDER BY recibido_en, fila_id) AS n FROM licitaciones) WHERE n > 1
UNION ALL
SELECT 'adjudicaciones', fila_id FROM (SELECT fila_id, row_number() OVER (PARTITION BY licitacion_id, lote, cif_adjudicatario ORDER BY recibido_en, fila_id) AS n FROM adjudicaciones) WHERE n > 1""",
    "p3_found": _P3 + "SELECT tabla, periodo, fila_id, clase FROM c WHERE clase IS NOT NULL",
    "p3_report": _P3 + "SELECT tabla, periodo, clase, count(*) AS n FROM c WHERE clase IS NOT NULL GROUP BY 1, 2, 3",
    "p5_totals": r"""
SELECT upper(regexp_replace(coalesce(cif_adjudicatario, ''), '[\s./\-\x{1c}-\x{1f}\x{85}\p{Z}]', '', 'g')) AS cif, count(*) AS n_filas, sum(importe_sin_iva)::DECIMAL(30,2) AS importe_sin_iva,
       sum(importe_con_iva)::DECIMAL(30,2) AS importe_con_iva, sum(n_ofertas)::BIGINT AS n_ofertas, min(fecha_adjudicacion) AS primera_fecha,
       min(importe_sin_iva) AS importe_minimo, max(fecha_adjudicacion) AS ultima_fecha, max(importe_sin_iva) AS importe_maximo,
       count(DISTINCT licitacion_id) AS n_licitaciones
FROM adjudicaciones GROUP BY 1""",
}
