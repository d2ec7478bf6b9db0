"""Queries of the catalogue's own operators over whole tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from almoneda.functions import normalize as n
from almoneda.functions.labels import RESULTS, SYSTEMS, TYPES, label
from almoneda.operators import catalogue, merge, search, views
from almoneda.operators.search import Search
from almoneda.plans.runtime import Files, fresh_path, table
from almoneda.streaming.daily import Sightings, collected, distinct_stream, run_available, stream_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
AS_OF = datetime(2025, 6, 1)
TS = "TIMESTAMP '2025-06-01'"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


_FOLD = "strip_accents({})"
#: Upper case by full case mapping, as the engine's upper() has it.
_UPPER = "upper(replace(replace({}, 'ﬁ', 'FI'), 'ß', 'SS'))"


def _lic(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "licitaciones")


def _adj(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "adjudicaciones")


AWARD_KEY = ["licitacion_id", "lote", "cif_adjudicatario"]
#: One row per award: the delivery updated last.
AWARDS = "(SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY licitacion_id, lote, cif_adjudicatario ORDER BY updated_at DESC NULLS LAST, fila_id DESC) AS k FROM adjudicaciones) WHERE k = 1)"


def awards_once(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """One row per award (notice, lot, winner) with these columns."""
    rest = [c for c in columns if c not in (*AWARD_KEY, "updated_at", "fila_id")]
    return merge.pick(_adj(spark, sf).select(*AWARD_KEY, "updated_at", "fila_id", *rest), AWARD_KEY, F.struct("updated_at", "fila_id"))


#: One row per notice: the delivery received last.
_LATEST = "(SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY licitacion_id ORDER BY recibido_en DESC, fila_id DESC) AS k FROM licitaciones) WHERE k = 1)"


def latest(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """One row per notice with these columns; the others aren't read."""
    return merge.pick(_lic(spark, sf).select("licitacion_id", "recibido_en", "fila_id", *columns), ["licitacion_id"], F.struct("recibido_en", "fila_id"))


_KEPT: dict[tuple[str, str], str] = {}


def catalogue_of(spark: SparkSession, sf: str) -> DataFrame:
    """The catalogue that searches read: a row per notice, written once a session in the order of publication, so that their filters reach
    the scan and skip what can't match. No search looks for latest deliveries itself."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _KEPT or not Files(spark, _KEPT[key]).exists(_KEPT[key]):
        _KEPT[key] = fresh_path(spark, "catalogue")
        ordered = latest(spark, sf, *SEARCHED).repartitionByRange("fecha_publicacion", "licitacion_id").sortWithinPartitions("fecha_publicacion")
        search.with_lexemes(ordered).write.parquet(_KEPT[key])
    return spark.read.schema(search.with_lexemes(latest(spark, sf, *SEARCHED)).schema).parquet(_KEPT[key])


#: What a search can filter on or show.
SEARCHED = ("titulo", "objeto", "organo_contratacion", "num_expediente", "cpv", "fuente", "estado_adjudicacion", "valor_estimado", "fecha_publicacion", "fecha_fin_plazo")


# --- aggregates -------------------------------------------------------------------------------------------------------------------


@query(f"""
WITH a AS (SELECT cif_adjudicatario AS cif, adjudicatario AS nom, licitacion_id, importe_sin_iva AS imp, n_ofertas,
                  CASE WHEN fecha_adjudicacion BETWEEN DATE '2000-01-01' AND DATE '2025-06-01' + 730 THEN fecha_adjudicacion END AS f
           FROM {AWARDS} WHERE regexp_full_match(cif_adjudicatario, '[A-Z0-9]+')),
     m AS (SELECT cif, nom, row_number() OVER (PARTITION BY cif ORDER BY count(*) DESC, nom) AS k FROM a WHERE nom IS NOT NULL GROUP BY 1, 2)
SELECT a.cif, any_value(m.nom) AS nombre_canonico, {_FOLD.format(_UPPER.format("string_agg(DISTINCT coalesce(a.nom, ''), ' ' ORDER BY coalesce(a.nom, ''))"))} AS nombre_busqueda,
       count(*) AS n_lotes, count(DISTINCT licitacion_id) AS n_expedientes, sum(imp)::DECIMAL(30,2) AS importe_total_sin_iva,
       round(100::DECIMAL(10,0) * count(*) FILTER (n_ofertas = 1) / nullif(count(*), 0), 1)::DECIMAL(5,1) AS pct_una_oferta, min(f) AS primera_adjudicacion, max(f) AS ultima_adjudicacion
FROM a LEFT JOIN m ON a.cif = m.cif AND m.k = 1 GROUP BY 1""")
def a1_competitors(spark, sf):
    return catalogue.competitors(awards_once(spark, sf, "adjudicatario", "importe_sin_iva", "n_ofertas", "fecha_adjudicacion"), F.lit(AS_OF).cast("date"))


@query(f"""
SELECT licitacion_id, CASE WHEN g = 0 AND d > 0 THEN 'desierta_total' WHEN g > 0 AND d > 0 THEN 'desierta_parcial' WHEN g = 0 AND r > 0 THEN 'retirada' WHEN g > 0 THEN 'adjudicada' ELSE 'sin_ganador' END AS estado, d AS n_lotes_desiertos
FROM (SELECT licitacion_id, count(*) FILTER (cif_adjudicatario <> '') AS g, count(*) FILTER (cif_adjudicatario = '' AND resultado_code = '3') AS d,
             count(*) FILTER (cif_adjudicatario = '' AND resultado_code IN ('4', '5')) AS r FROM {AWARDS} GROUP BY 1)""")
def a2_lot_outcomes(spark, sf):
    return catalogue.lot_outcomes(awards_once(spark, sf, "resultado_code"))


@query("SELECT estado_adjudicacion AS estado, count(*) AS n FROM licitaciones GROUP BY 1")
def a16_histogram(spark, sf):
    return _lic(spark, sf).groupBy(F.col("estado_adjudicacion").alias("estado")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT licitacion_id, cif_adjudicatario, lote, importe_sin_iva FROM (SELECT *, row_number() OVER (PARTITION BY licitacion_id ORDER BY importe_sin_iva DESC NULLS LAST, cif_adjudicatario, lote, fila_id) AS k
FROM adjudicaciones WHERE cif_adjudicatario <> '') WHERE k = 1""")
def a4_largest_award(spark, sf):
    a = _adj(spark, sf).where("cif_adjudicatario <> ''").select("licitacion_id", "cif_adjudicatario", "lote", "importe_sin_iva", "fila_id")
    order = F.struct(F.coalesce(-F.col("importe_sin_iva"), F.lit("99999999999999999999").cast("decimal(22,2)")), "cif_adjudicatario", "lote", "fila_id")
    return merge.pick(a, ["licitacion_id"], order, newest=False).drop("fila_id")


@query("SELECT fuente, year(fecha_publicacion)::INTEGER AS anio, count(DISTINCT licitacion_id) AS n, min(fecha_publicacion) AS primera, max(fecha_publicacion) AS ultima FROM licitaciones GROUP BY GROUPING SETS ((), (fuente), (fuente, year(fecha_publicacion)))")
def a5_a18_summary(spark, sf):
    """Distinct notices in all, by source and by source and year, from one pre-aggregate."""
    ids = _lic(spark, sf).withColumn("anio", F.year("fecha_publicacion"))
    return ids.groupingSets([[], [F.col("fuente")], [F.col("fuente"), F.col("anio")]], "fuente", "anio").agg(F.countDistinct("licitacion_id").alias("n"), F.min("fecha_publicacion").alias("primera"), F.max("fecha_publicacion").alias("ultima"))


@query("SELECT fuente, sum(strlen(titulo))::BIGINT AS titulo_bytes, sum(strlen(objeto))::BIGINT AS objeto_bytes, avg(strlen(titulo)) AS titulo_media FROM licitaciones GROUP BY 1")
def a6_row_bytes(spark, sf):
    return _lic(spark, sf).groupBy("fuente").agg(F.sum(F.octet_length("titulo").cast("long")).alias("titulo_bytes"), F.sum(F.octet_length("objeto").cast("long")).alias("objeto_bytes"), F.avg(F.octet_length("titulo")).alias("titulo_media"))


@query("""
WITH p AS (SELECT DISTINCT licitacion_id AS k, strftime(recibido_en, '%Y-%m') AS periodo FROM licitaciones WHERE licitacion_id IS NOT NULL AND recibido_en IS NOT NULL), f AS (SELECT k, min(periodo) AS periodo FROM p GROUP BY 1)
SELECT p.periodo, count(*) AS presentes, count(f.k) AS nuevos FROM p LEFT JOIN f ON p.k = f.k AND p.periodo = f.periodo GROUP BY 1""")
def a7_month_overlap(spark, sf):
    return catalogue.first_seen(_lic(spark, sf), "licitacion_id", F.date_format("recibido_en", "yyyy-MM"))


@query("SELECT fuente, tanda, count(*) AS n FROM licitaciones GROUP BY 1, 2")
def a8_counts(spark, sf):
    return _lic(spark, sf).groupBy("fuente", "tanda").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT c AS codigo, count(*) AS n FROM (SELECT unnest(list_distinct(cpv)) AS c FROM {_LATEST}) WHERE c IS NOT NULL GROUP BY 1")
def a9_cpv_facet(spark, sf):
    return catalogue.facet(latest(spark, sf, "cpv"), "cpv", "codigo")


@query(f"SELECT licitacion_id, count(*) AS n_lotes, count(*) FILTER (cif_adjudicatario = '') AS sin_ganador, count(DISTINCT nullif(cif_adjudicatario, '')) AS n_ganadores, max(fecha_adjudicacion) AS ultima FROM {AWARDS} GROUP BY 1")
def a19_award_summary(spark, sf):
    return awards_once(spark, sf, "fecha_adjudicacion").groupBy("licitacion_id").agg(F.count(F.lit(1)).alias("n_lotes"), F.sum((F.col("cif_adjudicatario") == "").cast("long")).alias("sin_ganador"), F.countDistinct(F.nullif("cif_adjudicatario", F.lit(""))).alias("n_ganadores"), F.max("fecha_adjudicacion").alias("ultima"))


_CAL = f"(SELECT 'plazo' AS tipo, fecha_fin_plazo::DATE AS fecha, licitacion_id AS id FROM {_LATEST} WHERE fecha_fin_plazo >= {TS} UNION ALL SELECT 'adjudicacion', fecha_adjudicacion, licitacion_id FROM {AWARDS} WHERE fecha_adjudicacion IS NOT NULL)"


@query(f"SELECT fecha, count(*) AS n, string_agg(DISTINCT tipo, ',' ORDER BY tipo) AS tipos FROM {_CAL} GROUP BY 1")
def a20_d7_calendar(spark, sf):
    ends = latest(spark, sf, "fecha_fin_plazo").where(F.col("fecha_fin_plazo") >= F.lit(AS_OF).cast("timestamp_ntz")).select(F.lit("plazo").alias("tipo"), F.to_date("fecha_fin_plazo").alias("fecha"), F.col("licitacion_id").alias("id"))
    won = awards_once(spark, sf, "fecha_adjudicacion").where("fecha_adjudicacion is not null").select(F.lit("adjudicacion").alias("tipo"), F.col("fecha_adjudicacion").alias("fecha"), F.col("licitacion_id").alias("id"))
    return ends.unionByName(won).groupBy("fecha").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("tipo")), ",").alias("tipos"))


_PAGE = Search(prefijos=["4"], estado="todas", orden="valor_estimado", descendente=True, pagina=3, as_of=AS_OF)
_COLUMNS = ["titulo", "objeto", "num_expediente", "cpv", "valor_estimado", "fecha_fin_plazo", "estado_adjudicacion"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS columna, count({c}) AS con_valor, count(*) AS filas FROM licitaciones" for c in _COLUMNS))
def a15_population(spark, sf):
    return catalogue.population(_lic(spark, sf).select(*_COLUMNS))


@query("SELECT fuente, arg_max(organo_contratacion, (recibido_en, fila_id)) AS ultimo_organo FROM licitaciones WHERE organo_contratacion IS NOT NULL GROUP BY 1")
def a17_last_name(spark, sf):
    return _lic(spark, sf).where("organo_contratacion is not null").groupBy("fuente").agg(F.max_by("organo_contratacion", F.struct("recibido_en", "fila_id")).alias("ultimo_organo"))


# --- dedup, merge, sinks ------------------------------------------------------------------------------------------------------------


@query(f"SELECT licitacion_id, fila_id, titulo, recibido_en FROM {_LATEST}")
def d2_latest_notice(spark, sf):
    return latest(spark, sf, "titulo").select("licitacion_id", "fila_id", "titulo", "recibido_en")


@query("SELECT licitacion_id, lote, cif_adjudicatario, fila_id, importe_sin_iva FROM (SELECT *, row_number() OVER (PARTITION BY licitacion_id, lote, cif_adjudicatario ORDER BY updated_at DESC, fila_id DESC) AS k FROM adjudicaciones) WHERE k = 1")
def d1_award_key(spark, sf):
    a = _adj(spark, sf).select("licitacion_id", "lote", "cif_adjudicatario", "fila_id", "importe_sin_iva", "updated_at")
    return merge.pick(a, ["licitacion_id", "lote", "cif_adjudicatario"], F.struct("updated_at", "fila_id")).drop("updated_at")


@query("SELECT count(DISTINCT licitacion_id) AS n FROM licitaciones")
def d3_distinct_ids(spark, sf):
    return _lic(spark, sf).select("licitacion_id").distinct().agg(F.count("licitacion_id").alias("n"))


@query("SELECT licitacion_id, 'ambas' AS donde FROM (SELECT licitacion_id FROM licitaciones INTERSECT SELECT licitacion_id FROM adjudicaciones) UNION ALL SELECT licitacion_id, 'solo_adjudicaciones' FROM (SELECT licitacion_id FROM adjudicaciones EXCEPT SELECT licitacion_id FROM licitaciones)")
def d6_sets(spark, sf):
    a, b = _adj(spark, sf).select("licitacion_id").distinct(), _lic(spark, sf).select("licitacion_id").distinct()
    return a.join(b, "licitacion_id", "left_semi").withColumn("donde", F.lit("ambas")).unionByName(a.join(b, "licitacion_id", "left_anti").withColumn("donde", F.lit("solo_adjudicaciones")))


CUT = "2025-01-01"
_HALF = "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY licitacion_id ORDER BY recibido_en DESC, fila_id DESC) AS k FROM licitaciones WHERE recibido_en {} TIMESTAMP '" + CUT + "') WHERE k = 1"


def _halves(spark, sf):
    rows = _lic(spark, sf).select("licitacion_id", "titulo", "cpv", "primera_vez", "ultima_vez", "recibido_en", "fila_id")
    at = F.lit(CUT).cast("timestamp_ntz")
    return [merge.pick(rows.where(c), ["licitacion_id"], F.struct("recibido_en", "fila_id")) for c in (F.col("recibido_en") < at, F.col("recibido_en") >= at)]


@query(f"""
WITH b AS ({_HALF.format("<")}), n AS ({_HALF.format(">=")})
SELECT coalesce(b.licitacion_id, n.licitacion_id) AS licitacion_id, coalesce(n.titulo, b.titulo) AS titulo, CASE WHEN b.licitacion_id IS NOT NULL THEN b.primera_vez ELSE n.primera_vez END AS primera_vez,
       CASE WHEN n.licitacion_id IS NOT NULL THEN n.ultima_vez ELSE b.ultima_vez END AS ultima_vez FROM b FULL JOIN n ON b.licitacion_id = n.licitacion_id""")
def k1_d4_upsert(spark, sf):
    old, new = _halves(spark, sf)
    return merge.upsert(old, new, ["licitacion_id"], refresh=["ultima_vez"], keep=["primera_vez"]).select("licitacion_id", "titulo", "primera_vez", "ultima_vez")


@query(f"SELECT licitacion_id, lote, fila_id FROM adjudicaciones a WHERE recibido_en >= TIMESTAMP '{CUT}' OR licitacion_id NOT IN (SELECT licitacion_id FROM adjudicaciones WHERE recibido_en >= TIMESTAMP '{CUT}')")
def k3_replace_children(spark, sf):
    a, at = _adj(spark, sf).select("licitacion_id", "lote", "fila_id", "recibido_en"), F.lit(CUT).cast("timestamp_ntz")
    return merge.replace_children(a.where(F.col("recibido_en") < at), a.where(F.col("recibido_en") >= at), "licitacion_id").drop("recibido_en")


@query("SELECT licitacion_id, estado, favorita FROM (SELECT *, row_number() OVER (PARTITION BY licitacion_id ORDER BY updated_at DESC, fila_id DESC) AS k FROM decisiones) WHERE k = 1 AND NOT (estado IS NULL AND NOT coalesce(favorita, false))")
def k7_fold_decisions(spark, sf):
    gone = F.col("estado").isNull() & ~F.coalesce("favorita", F.lit(False))
    return merge.fold_changes(table(spark, sf, "decisiones"), ["licitacion_id"], F.struct("updated_at", "fila_id"), gone).select("licitacion_id", "estado", "favorita")


@query(f"WITH b AS ({_HALF.format('<')}), n AS ({_HALF.format('>=')}) SELECT n.licitacion_id, n.titulo FROM n JOIN b USING (licitacion_id) WHERE n.titulo IS DISTINCT FROM b.titulo OR n.cpv IS DISTINCT FROM b.cpv")
def k14_j3_delta(spark, sf):
    old, new = _halves(spark, sf)
    return merge.delta(new, old, ["licitacion_id"], ["titulo", "cpv"]).select("licitacion_id", "titulo")


@query("SELECT licitacion_id FROM decisiones UNION ALL SELECT DISTINCT licitacion_id FROM adjudicaciones WHERE cif_adjudicatario <> '' AND licitacion_id NOT IN (SELECT licitacion_id FROM decisiones)")
def k15_insert_missing(spark, sf):
    won = _adj(spark, sf).where("cif_adjudicatario <> ''").select("licitacion_id").distinct()
    return merge.insert_missing(table(spark, sf, "decisiones").select("licitacion_id"), won, ["licitacion_id"])


@query(f"""
SELECT licitacion_id FROM {_LATEST} WHERE fecha_publicacion < {TS} - INTERVAL 1 YEAR AND (fecha_fin_plazo IS NULL OR fecha_fin_plazo < {TS})
AND licitacion_id NOT IN (SELECT licitacion_id FROM decisiones) AND licitacion_id NOT IN (SELECT licitacion_id FROM bajas)""")
def f18_k17_purge(spark, sf):
    now = F.lit(AS_OF).cast("timestamp_ntz")
    old = (F.col("fecha_publicacion") < F.lit(AS_OF.replace(year=AS_OF.year - 1)).cast("timestamp_ntz")) & (F.col("fecha_fin_plazo").isNull() | (F.col("fecha_fin_plazo") < now))
    return merge.purge(latest(spark, sf, "fecha_publicacion", "fecha_fin_plazo"), "licitacion_id", old, [table(spark, sf, "decisiones"), table(spark, sf, "bajas")])[1].select("licitacion_id")


@query("SELECT fila_id, CASE WHEN fecha_adjudicacion BETWEEN DATE '2000-01-01' AND DATE '2025-06-01' + 730 THEN fecha_adjudicacion END AS fecha_adjudicacion FROM adjudicaciones")
def k18_c5_date_cleanse(spark, sf):
    return _adj(spark, sf).select("fila_id", n.plausible_date(F.col("fecha_adjudicacion").cast("string"), F.lit(AS_OF).cast("date")).alias("fecha_adjudicacion"))


# --- filters and search -------------------------------------------------------------------------------------------------------------


def _search(sql_where: str | None, **how):
    def sql(tail: str = "") -> str:
        return f"SELECT licitacion_id, titulo, valor_estimado FROM {_LATEST} WHERE {sql_where}{tail}"

    return sql, Search(as_of=AS_OF, **how)


def _hits(name: str, where: str, **how) -> None:
    sql, s = _search(where, **how)
    QUERIES[name], SQL[name] = (lambda spark, sf: search.hits(catalogue_of(spark, sf), s).select("licitacion_id", "titulo", "valor_estimado")), sql()


_WORDS = f"regexp_extract_all({_FOLD.format('lower(concat_ws(chr(32) || chr(1) || chr(32), titulo, objeto, organo_contratacion))')}, '[\\p{{L}}\\p{{N}}_]+|\\x01')"
_hits("f6_text", f"list_contains({_WORDS}, 'conservacion') AND (list_contains({_WORDS}, 'zonas') OR list_contains({_WORDS}, 'alumbrado')) AND NOT list_contains({_WORDS}, 'ayuntamiento')", texto="conservación zonas OR alumbrado -Ayuntamiento", estado="todas")
_hits("f6_phrase", f"contains(' ' || array_to_string({_WORDS}, ' ') || ' ', ' obras de ')", texto='"obras de"', estado="todas")
_hits("f7_cpv_prefix", "len(list_filter(cpv, lambda c: starts_with(c, '45') OR starts_with(c, '773'))) > 0", prefijos=["45", "773"], estado="todas")
_hits("f8_cpv_overlap", "list_has_any(cpv, ['45233222', '71240000'])", codigos=["45233222", "71240000"], estado="todas")
_hits("f9_file_number", r"contains(upper(regexp_replace(coalesce(num_expediente, ''), '[\s/.\-]', '', 'g')), '2025')", expediente="20-25", estado="todas")
_hits("f10_deserted", "estado_adjudicacion IN ('desierta_total', 'desierta_parcial')", desiertas="todas")
_hits("f11_f12_source_amount", "fuente = 'estatal' AND valor_estimado BETWEEN 10000 AND 50000", fuente="estatal", importe=(10000, 50000))
_hits("f13_dates", "fecha_publicacion >= TIMESTAMP '2024-01-01' AND fecha_publicacion <= TIMESTAMP '2024-03-31 23:59:59'", publicacion=(datetime(2024, 1, 1), datetime(2024, 3, 31, 23, 59, 59)))
_hits("f14_f15_open", f"fecha_fin_plazo >= {TS}")
_hits("f14_closed", f"fecha_fin_plazo < {TS}", estado="cerrada")



@query(f"SELECT licitacion_id, valor_estimado FROM {_LATEST} WHERE len(list_filter(cpv, lambda c: starts_with(c, '4'))) > 0 ORDER BY valor_estimado DESC NULLS LAST, licitacion_id LIMIT 25 OFFSET 50")
def o1_o2_page(spark, sf):
    return search.page(catalogue_of(spark, sf), _PAGE).select("licitacion_id", "valor_estimado")


@query(f"SELECT least(count(*), 5000) AS total, count(*) > 5000 AS topado FROM {_LATEST} WHERE fecha_fin_plazo < {TS}")
def a13_capped_count(spark, sf):
    return search.capped_count(catalogue_of(spark, sf), Search(estado="cerrada", as_of=AS_OF))


CRITERIA = [("verde", ["773"], ["jardín", "zonas verdes"]), ("obra", ["45"], ["pavimentación"]), ("tic", ["72", "48"], ["informátic", "digitaliz"])]
_COMPAT = "translate(strip_accents(lower({})), 'ªº²³¹', 'ao231')"
_TITLE = _COMPAT.format("titulo")
_CASE = " ".join(
    "WHEN " + " OR ".join([f"coalesce(len(list_filter(cpv, lambda c: {' OR '.join(f'starts_with(c, {p!r})' for p in ps)})) > 0, false)", *[f"coalesce(contains({_TITLE}, {_COMPAT.format(repr(k))}), false)" for k in ks]]) + f" THEN '{c}'"
    for c, ps, ks in CRITERIA
)


@query(f"SELECT licitacion_id, categoria FROM (SELECT licitacion_id, CASE {_CASE} END AS categoria FROM {_LATEST}) WHERE categoria IS NOT NULL")
def f1_f4_classify(spark, sf):
    return latest(spark, sf, "titulo", "cpv").withColumn("categoria", search.first_match("titulo", "cpv", CRITERIA)).where("categoria is not null").select("licitacion_id", "categoria")


@query(f"SELECT ficha_id FROM competidores WHERE contains({_FOLD.format(_UPPER.format('nombre_busqueda'))}, 'TRANSPORTES')")
def f22_name_contains(spark, sf):
    return table(spark, sf, "competidores").where(F.contains(n.fold_upper("nombre_busqueda"), n.fold_upper(F.lit("Transportés")))).select("ficha_id")


# --- joins, sorts -------------------------------------------------------------------------------------------------------------------


@query(f"SELECT a.fila_id, l.titulo, l.organo_contratacion, l.licitacion_id IS NULL AS fuera FROM adjudicaciones a LEFT JOIN {_LATEST} l USING (licitacion_id)")
def j6_award_titles(spark, sf):
    t = latest(spark, sf, "titulo", "organo_contratacion").select("licitacion_id", "titulo", "organo_contratacion", F.lit(True).alias("hay"))
    return _adj(spark, sf).select("fila_id", "licitacion_id").join(t, "licitacion_id", "left").select("fila_id", "titulo", "organo_contratacion", F.col("hay").isNull().alias("fuera"))


_MET = "d.estado IN ('ganada', 'perdida', 'presentada') AND a.cif_adjudicatario <> ''"


@query(f"""
SELECT a.licitacion_id, a.lote, a.cif_adjudicatario, d.estado, a.fecha_adjudicacion, l.titulo FROM decisiones d JOIN {AWARDS} a USING (licitacion_id) LEFT JOIN {_LATEST} l USING (licitacion_id)
WHERE {_MET} ORDER BY a.fecha_adjudicacion DESC NULLS LAST, a.licitacion_id, a.lote, a.cif_adjudicatario""")
def j7_o7_head_to_head(spark, sf):
    """All meetings, newest first."""
    won = awards_once(spark, sf, "fecha_adjudicacion")
    return views.head_to_head(table(spark, sf, "decisiones"), won, catalogue_of(spark, sf)).select("licitacion_id", "lote", "cif_adjudicatario", "estado", "fecha_adjudicacion", "titulo")


@query(f"""
SELECT d.licitacion_id, coalesce(l.titulo, '(sin título)') AS titulo, coalesce(d.favorita, false) AS favorita, l.licitacion_id IS NULL AS minima FROM decisiones d LEFT JOIN {_LATEST} l USING (licitacion_id)
WHERE d.licitacion_id NOT IN (SELECT licitacion_id FROM bajas)""")
def j8_j9_decision_cards(spark, sf):
    """Decisions that the withdrawn ones don't cover, each with its notice, or a minimal row where the catalogue has none."""
    d = table(spark, sf, "decisiones").select("licitacion_id", "favorita").join(table(spark, sf, "bajas"), "licitacion_id", "left_anti")
    cards = d.join(catalogue_of(spark, sf).select("licitacion_id", "titulo", F.lit(True).alias("hay")), "licitacion_id", "left")
    return cards.select("licitacion_id", F.coalesce("titulo", F.lit("(sin título)")).alias("titulo"), F.coalesce("favorita", F.lit(False)).alias("favorita"), F.col("hay").isNull().alias("minima"))


_PAGE_SQL = f"(SELECT licitacion_id, valor_estimado FROM {_LATEST} WHERE len(list_filter(cpv, lambda c: starts_with(c, '4'))) > 0 ORDER BY valor_estimado DESC NULLS LAST, licitacion_id LIMIT 25 OFFSET 50)"


@query(f"""
SELECT p.licitacion_id, coalesce(a.lotes, '') AS lotes FROM {_PAGE_SQL} p
LEFT JOIN (SELECT licitacion_id, string_agg(lote || '=' || cif_adjudicatario, ';' ORDER BY lote, cif_adjudicatario) AS lotes FROM {AWARDS} GROUP BY 1) a USING (licitacion_id)""")
def j10_o9_page_lots(spark, sf):
    """A search's page, each notice with its lots; they sort as text."""
    shown = search.page(catalogue_of(spark, sf), _PAGE).select("licitacion_id")
    won = views.look_up(_adj(spark, sf).select(*AWARD_KEY), shown, "licitacion_id").distinct()
    g = won.groupBy("licitacion_id").agg(F.array_sort(F.collect_list(F.struct("lote", "cif_adjudicatario"))).alias("r"))
    lots = g.select("licitacion_id", F.array_join(F.transform("r", lambda x: F.concat(x["lote"], F.lit("="), x["cif_adjudicatario"])), ";").alias("lotes"))
    return shown.join(lots, "licitacion_id", "left").select("licitacion_id", F.coalesce("lotes", F.lit("")).alias("lotes"))


@query("""
WITH e AS (SELECT upper(regexp_replace(coalesce(num_expediente, ''), '[\\s/.\\-]', '', 'g')) AS e, licitacion_id FROM licitaciones GROUP BY 1, 2), u AS (SELECT e, count(*) AS n FROM e WHERE e <> '' GROUP BY 1 HAVING count(*) = 1)
SELECT e.e AS expediente, licitacion_id FROM e JOIN u USING (e)""")
def j14_unique_match(spark, sf):
    e = _lic(spark, sf).select(n.file_number("num_expediente").alias("expediente"), "licitacion_id").distinct().where("expediente <> ''")
    return e.groupBy("expediente").agg(F.count(F.lit(1)).alias("n"), F.min("licitacion_id").alias("licitacion_id")).where("n = 1").drop("n")


@query("SELECT ficha_id, importe_total_sin_iva FROM competidores ORDER BY importe_total_sin_iva DESC NULLS LAST, ficha_id LIMIT 20")
def o4_top_competitors(spark, sf):
    return table(spark, sf, "competidores").orderBy(F.desc_nulls_last("importe_total_sin_iva"), "ficha_id").limit(20).select("ficha_id", "importe_total_sin_iva")


_AMOUNT_ORDER = "nullif(importe_sin_iva, 0) DESC NULLS LAST, "


def _dossier_sql(first: str) -> str:
    return f"SELECT cif_adjudicatario, fila_id, puesto FROM (SELECT cif_adjudicatario, fila_id, row_number() OVER (PARTITION BY cif_adjudicatario ORDER BY {first}fecha_adjudicacion DESC NULLS LAST, licitacion_id, lote) AS puesto FROM {AWARDS} WHERE cif_adjudicatario <> '') WHERE puesto <= 1000"


@query(_dossier_sql(""))
def o5_dossiers(spark, sf):
    """Every winner's newest thousand awards."""
    return views.dossiers(awards_once(spark, sf, "fecha_adjudicacion", "importe_sin_iva")).select("cif_adjudicatario", "fila_id", "puesto")


@query(_dossier_sql(_AMOUNT_ORDER))
def o5_dossiers_by_amount(spark, sf):
    return views.dossiers(awards_once(spark, sf, "fecha_adjudicacion", "importe_sin_iva"), by_amount=True).select("cif_adjudicatario", "fila_id", "puesto")


# --- scalar functions ---------------------------------------------------------------------------------------------------------------


@query(rf"""
SELECT fila_id, nullif(trim(titulo), '') AS titulo, upper(regexp_replace(coalesce(num_expediente, ''), '[\s/.\-]', '', 'g')) AS expediente, strip_accents(lower(titulo)) AS plegado,
       ' ' || coalesce(array_to_string(list_filter(cpv, lambda c: c IS NOT NULL), ' '), '') AS cpv_texto, strlen(titulo) AS bytes, TRY_CAST(regexp_extract(num_expediente, '^[A-Za-z ]*([0-9]+)', 1) AS INTEGER) AS numero,
       year(coalesce(fecha_publicacion, fecha_fin_plazo, ultima_vez))::INTEGER AS anio, date_diff('day', DATE '2025-06-01', fecha_fin_plazo::DATE)::INTEGER AS dias,
       CASE WHEN fecha_fin_plazo::DATE < DATE '2025-06-01' THEN 'caducada' ELSE 'activa' END AS vigencia, coalesce(list_slice(cpv, 1, 6), []) AS primeros
FROM licitaciones""")
def c1_c18_notice_functions(spark, sf):
    days = F.datediff(F.to_date("fecha_fin_plazo"), F.lit(AS_OF).cast("date"))
    return _lic(spark, sf).select(
        "fila_id", n.clean_text("titulo").alias("titulo"), n.file_number("num_expediente").alias("expediente"), n.fold("titulo").alias("plegado"), n.codes_text("cpv").alias("cpv_texto"), F.octet_length("titulo").alias("bytes"),
        n.integer(F.regexp_extract("num_expediente", "^[A-Za-z ]*([0-9]+)", 1)).alias("numero"), F.year(F.coalesce("fecha_publicacion", "fecha_fin_plazo", "ultima_vez")).alias("anio"), days.alias("dias"),
        F.when(days < 0, "caducada").otherwise("activa").alias("vigencia"), F.coalesce(F.slice("cpv", 1, 6), F.array().cast("array<string>")).alias("primeros"))


@query(r"""
SELECT ficha_id, upper(regexp_replace(coalesce(cif, ''), '[\s./\-]', '', 'g')) AS cif, regexp_full_match(upper(regexp_replace(coalesce(cif, ''), '[\s./\-]', '', 'g')), '[A-Z0-9]{8,10}') AND regexp_matches(coalesce(cif, ''), '[0-9]') AS parece,
       regexp_full_match(upper(regexp_replace(coalesce(cif, ''), '[\s./\-]', '', 'g')), '[A-Z][0-9]{8}|[0-9]{8}[A-Z]') AS util FROM competidores""")
def c6_c12_identifiers(spark, sf):
    c = table(spark, sf, "competidores")
    return c.select("ficha_id", n.cif("cif").alias("cif"), n.looks_like_cif("cif").alias("parece"), n.usable_cif("cif").alias("util"))


def _cases(codes: dict[str, str], column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.items()) + " END"


@query(f"SELECT fila_id, {_cases(RESULTS, 'resultado_code')} AS etiqueta, {_cases(SYSTEMS, 'sistema_contratacion')} AS sistema, {_cases(TYPES, 'tipo_contrato')} AS tipo FROM adjudicaciones")
def code_labels(spark, sf):
    return _adj(spark, sf).select("fila_id", label(RESULTS, "resultado_code").alias("etiqueta"), label(SYSTEMS, "sistema_contratacion").alias("sistema"), label(TYPES, "tipo_contrato").alias("tipo"))


@query(f"""
SELECT fila_id, date_diff('day', DATE '2025-06-01', fecha_fin_plazo::DATE)::INTEGER AS dias, CASE WHEN fecha_fin_plazo IS NULL OR fecha_fin_plazo::DATE < DATE '2025-06-01' THEN 'ninguna'
       WHEN fecha_fin_plazo::DATE < DATE '2025-06-04' THEN 'roja' WHEN fecha_fin_plazo::DATE < DATE '2025-06-08' THEN 'ambar' ELSE 'verde' END AS urgencia,
       coalesce(primera_vez::DATE >= DATE '2025-06-01' - 7, false) AS nueva FROM licitaciones""")
def c15_c16_c18_days(spark, sf):
    """Days left, urgency by them, and whether a notice is new."""
    today = F.lit(AS_OF).cast("date")
    days = F.datediff(F.to_date("fecha_fin_plazo"), today)
    urgency = F.when(days.isNull() | (days < 0), "ninguna").when(days < 3, "roja").when(days < 7, "ambar").otherwise("verde")
    return _lic(spark, sf).select("fila_id", days.alias("dias"), urgency.alias("urgencia"), F.coalesce(F.to_date("primera_vez") >= F.date_sub(today, 7), F.lit(False)).alias("nueva"))


@query(f"SELECT licitacion_id, array_to_string(list_concat(list_filter(c, lambda x: starts_with(x, '45')), list_filter(c, lambda x: NOT starts_with(x, '45')))[1:6], ' ') AS visibles FROM (SELECT licitacion_id, unnested.c AS c FROM (SELECT licitacion_id, cpv FROM {_LATEST} WHERE cpv IS NOT NULL) t, LATERAL (SELECT list(x ORDER BY i) AS c FROM (SELECT x, min(i) AS i FROM (SELECT unnest(t.cpv) AS x, generate_subscripts(t.cpv, 1) AS i) GROUP BY x)) unnested)")
def p10_code_order(spark, sf):
    """Distinct codes in their order, those of a prefix first, six shown."""
    rows = latest(spark, sf, "cpv").where("cpv is not null").withColumn("c", F.array_distinct("cpv"))
    ours = F.concat(F.filter("c", lambda x: x.startswith("45")), F.filter("c", lambda x: ~x.startswith("45")))
    return rows.select("licitacion_id", F.array_join(F.slice(ours, 1, 6), " ").alias("visibles"))


QUERIES["code_order"], SQL["code_order"] = QUERIES.pop("p10_code_order"), SQL.pop("p10_code_order")


_OWN = ["A38810605"]
_RIVALS = f"""
SELECT a.cif_adjudicatario, count(DISTINCT a.licitacion_id) AS expedientes, count(DISTINCT a.licitacion_id) FILTER (d.estado = 'perdida') AS perdidos, sum(a.importe_sin_iva)::DECIMAL(30,2) AS importe,
       arg_max(a.adjudicatario, (coalesce(a.fecha_adjudicacion, DATE '1900-01-01'), a.licitacion_id, a.lote)) FILTER (trim(a.adjudicatario) <> '') AS nombre
FROM decisiones d JOIN {AWARDS} a USING (licitacion_id) WHERE {_MET} AND a.cif_adjudicatario NOT IN ('{_OWN[0]}') GROUP BY 1"""


def _rivals(spark, sf):
    return views.rivals(table(spark, sf, "decisiones"), awards_once(spark, sf, "adjudicatario", "importe_sin_iva", "fecha_adjudicacion"), _OWN)


@query(f"SELECT *, row_number() OVER (ORDER BY perdidos DESC, expedientes DESC, importe DESC NULLS LAST, cif_adjudicatario) AS puesto FROM ({_RIVALS}) ORDER BY puesto LIMIT 100")
def a10_o6_rivals(spark, sf):
    """The hundred rivals met most, with their place."""
    top = _rivals(spark, sf).limit(100)
    w = Window.orderBy(F.desc("perdidos"), F.desc("expedientes"), F.desc_nulls_last("importe"), "cif_adjudicatario")  # a hundred rows
    return top.withColumn("puesto", F.row_number().over(w))


_COMPARED = ["B91897028", "A38810605", "B15353819"]


@query(f"""
WITH s AS (SELECT unnest([0, 1, 2]) AS orden, unnest({_COMPARED}) AS cif), r AS ({_RIVALS}), c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cif ORDER BY updated_at DESC NULLS LAST, ficha_id) AS k FROM competidores) WHERE k = 1)
SELECT s.orden::INTEGER AS orden, s.cif, c.nombre_canonico AS nombre, coalesce(c.n_lotes, 0)::INTEGER AS n_lotes, c.importe_total_sin_iva AS importe, coalesce(r.expedientes, 0) AS expedientes, coalesce(r.perdidos, 0) AS perdidos
FROM s LEFT JOIN c ON s.cif = c.cif LEFT JOIN r ON s.cif = r.cif_adjudicatario""")
def j12_o11_comparator(spark, sf):
    """Three competitors side by side."""
    return views.comparison(_COMPARED, table(spark, sf, "competidores"), _rivals(spark, sf))


@query(f"""
SELECT c.ficha_id, coalesce(c.n_lotes, a.lotes, 0)::BIGINT AS n_lotes, coalesce(a.lotes, 0) AS lotes_vistos, coalesce(c.importe_total_sin_iva, a.importe, 0)::DECIMAL(30,2) AS importe
FROM competidores c LEFT JOIN (SELECT cif_adjudicatario AS k, count(*) AS lotes, sum(importe_sin_iva) AS importe FROM {AWARDS} GROUP BY 1) a ON c.cif = a.k""")
def a21_dossier_figures(spark, sf):
    """Every competitor's figures: stored ones, else those of its awards, else 0."""
    a = awards_once(spark, sf, "importe_sin_iva").groupBy(F.col("cif_adjudicatario").alias("cif")).agg(F.count(F.lit(1)).alias("lotes"), F.sum("importe_sin_iva").alias("importe"))
    zero = F.lit(0)
    return table(spark, sf, "competidores").select("ficha_id", "cif", "n_lotes", "importe_total_sin_iva").join(a, "cif", "left").select(
        "ficha_id", F.coalesce(F.col("n_lotes").cast("long"), "lotes", zero.cast("long")).alias("n_lotes"), F.coalesce("lotes", zero.cast("long")).alias("lotes_vistos"), F.coalesce("importe_total_sin_iva", "importe", zero).cast("decimal(30,2)").alias("importe"))


@query(f"SELECT licitacion_id, fecha_fin_plazo FROM {_LATEST} ORDER BY fecha_fin_plazo < {TS} NULLS LAST, fecha_fin_plazo NULLS LAST, licitacion_id LIMIT 100")
def o3_o8_soonest(spark, sf):
    """The hundred that end soonest; ended ones and those without a date come last."""
    past = F.col("fecha_fin_plazo") < F.lit(AS_OF).cast("timestamp_ntz")
    return latest(spark, sf, "fecha_fin_plazo").orderBy(past.asc_nulls_last(), F.asc_nulls_last("fecha_fin_plazo"), "licitacion_id").limit(100).select("licitacion_id", "fecha_fin_plazo")


# --- streams ------------------------------------------------------------------------------------------------------------------------


@query("SELECT user_id, min(ts) AS primera_vez, max(ts) AS ultima_vez, count(*) AS n FROM events GROUP BY 1")
def t5_sightings(spark, sf):
    """First and last sighting, batch by batch: each is summed up and merged with what was known."""
    seen = Sightings(spark, fresh_path(spark, "sightings"), "user_id", "ts")
    run_available(stream_file(spark, sf, "events"), seen.merge, fresh_path(spark, "stream-checkpoint"))
    return seen.snapshot()


@query("SELECT DISTINCT licitacion_id FROM licitaciones")
def t3_stream_dedup(spark, sf):
    s = stream_file(spark, sf, "licitaciones").select("licitacion_id")
    return collected(distinct_stream(s, ["licitacion_id"]), "append").select("licitacion_id")


# --- the engine on the sales tables -----------------------------------------------------------------------------------------------


@query("""
SELECT s_name, n_name, count(*) AS lineas, sum(l_quantity)::BIGINT AS cantidad, min(l_shipdate) AS primera, max(l_shipdate) AS ultima
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE l_returnflag <> 'R' GROUP BY 1, 2""")
def a1_suppliers(spark, sf):
    li = table(spark, sf, "lineitem").where("l_returnflag <> 'R'").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lineas"), F.sum(F.col("l_quantity").cast("long")).alias("cantidad"), F.min("l_shipdate").alias("primera"), F.max("l_shipdate").alias("ultima"))
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select("s_name", "n_name", "lineas", "cantidad", "primera", "ultima")


@query("SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity >= 50) GROUP BY 1, 2")
def j4_orders_without_large_lines(spark, sf):
    large = table(spark, sf, "lineitem").where("l_quantity >= 50").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf, "orders").join(large, "o_orderkey", "left_anti").groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
