"""More queries over whole tables with their SQL: feed extraction, upserts, radar, look-ups, envelopes, tabs, small functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almoneda.functions import normalize as n
from almoneda.operators import catalogue, feed_tables, merge, search, views
from almoneda.operators.delivery import DeliveryStore
from almoneda.operators.published import Published
from almoneda.operators.search import Search
from almoneda.plans.runtime import fresh_path, table
from almoneda.reference_queries import _LATEST, AS_OF, AWARD_KEY, AWARDS, CUT, TS, _CASE, awards_once, catalogue_of
from almoneda.sources.feeds import table_or_empty
from almoneda.streaming.daily import run_available, stream_file

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
TODAY = "DATE '2025-06-01'"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _today():
    return F.lit(AS_OF).cast("date")


# --- nested feeds

_BARE = r"""regexp_replace({}, '"[A-Za-z_\-]+:([A-Za-z]+)"\s*:', '"\1":', 'g')"""


def _list(j: str) -> str:
    return f"CASE json_type({j}) WHEN 'ARRAY' THEN list_filter(from_json({j}, '[\"JSON\"]'), lambda x: json_type(x) = 'OBJECT') WHEN 'OBJECT' THEN [({j})::JSON] ELSE []::JSON[] END"


def _value(j: str, name: str) -> str:
    """A value at a path, bare or beside attributes."""
    at = f"({j})->'$.{name}'"
    return f"CASE json_type({at}) WHEN 'OBJECT' THEN coalesce({at}->>'$.\"#text\"', {at}->>'$._VALUE', {at}->>'$.value') ELSE ({j})->>'$.{name}' END"


_FEED = f"""
b AS (SELECT entrada_id, {_BARE.format("cuerpo")}::JSON AS j FROM entradas WHERE coalesce(json_valid(cuerpo), false)),
e AS (SELECT entrada_id, unnest({_list("j->'$.feed.entry'")}) AS e FROM b UNION ALL SELECT entrada_id, j FROM b WHERE json_type(j->'$.ContractFolderStatus') IN ('OBJECT', 'VARCHAR')),
c AS (SELECT entrada_id, e, CASE json_type(e->'$.ContractFolderStatus') WHEN 'VARCHAR' THEN {_BARE.format("e->>'$.ContractFolderStatus'")}::JSON ELSE e->'$.ContractFolderStatus' END AS c FROM e),
p AS (SELECT entrada_id, e->>'$.id' AS licitacion_id, e, c FROM c)"""


@query(f"""
WITH {_FEED}
SELECT entrada_id, licitacion_id, e->>'$.title' AS titulo, e->>'$.link.href' AS enlace, e->>'$.updated' AS fecha_actualizacion, c->>'$.ContractFolderID' AS num_expediente, c->>'$.ProcurementProject.Name' AS objeto,
       c->>'$.LocatedContractingParty.Party.PartyName.Name' AS organo_contratacion, array_to_string(list_transform({_list("c->'$.ProcurementProject.RequiredCommodityClassification'")}, lambda x: x->>'$.ItemClassificationCode'), ' ') AS cpv FROM p""")
def e_notices(spark, sf):
    """Notices of all feed bodies."""
    a = feed_tables.notices(feed_tables.feed_bodies(table(spark, sf, "entradas")))
    return a.select(F.col("doc").alias("entrada_id"), "licitacion_id", "titulo", "enlace", "fecha_actualizacion", "num_expediente", "objeto", "organo_contratacion", F.array_join("cpv", " ").alias("cpv"))


@query(f"""
WITH {_FEED}, l AS (SELECT entrada_id, licitacion_id, unnest({_list("c->'$.ProcurementProjectLot'")}) AS l FROM p)
SELECT entrada_id, licitacion_id, {_value("l", "ID")} AS lote, trim(l->>'$.ProcurementProject.Name') AS nombre, ({_value("l", "ProcurementProject.BudgetAmount.TaxExclusiveAmount")})::DECIMAL(20,2) AS presupuesto FROM l""")
def e_lots(spark, sf):
    """Lots of all feed bodies, tied to their notices by the surrogate key."""
    bodies = feed_tables.feed_bodies(table(spark, sf, "entradas"))
    ids = feed_tables.notices(bodies).select("doc", "entrada_nodo", "licitacion_id")
    return feed_tables.lots(bodies).join(ids, ["doc", "entrada_nodo"]).select(F.col("doc").alias("entrada_id"), "licitacion_id", "lote", "nombre", F.col("presupuesto_sin_iva").alias("presupuesto"))


@query(f"""
WITH {_FEED}, r AS (SELECT entrada_id, licitacion_id, c->>'$.ContractFolderStatusCode' AS estado_expediente, c->>'$.ProcurementProject.TypeCode' AS tipo_contrato, {_list("c->'$.ProcurementProjectLot'")} AS lotes, unnest({_list("c->'$.TenderResult'")}) AS r FROM p),
w AS (SELECT *, {_list("r->'$.WinningParty'")} AS ws FROM r), x AS (SELECT * EXCLUDE (ws), unnest(CASE WHEN len(ws) = 0 THEN [NULL] ELSE ws END) AS w FROM w),
i AS (SELECT *, list_transform({_list("w->'$.PartyIdentification'")}, lambda q: q->'$.ID') AS ids, coalesce({_value("r", "AwardedTenderedProject.ProcurementProjectLotID")}, '') AS lote FROM x),
k AS (SELECT *, coalesce(list_filter(ids, lambda d: upper(d->>'$.schemeName') = 'NIF')[1], ids[1]) AS id FROM i)
SELECT entrada_id, licitacion_id, lote, r->>'$.ResultCode' AS resultado_code, upper(regexp_replace(coalesce(id->>'$."#text"', id->>'$._VALUE', id->>'$.value', ''), '[\\s./\\-]', '', 'g')) AS cif_adjudicatario, id->>'$.schemeName' AS id_scheme,
       nullif(trim(w->>'$.PartyName.Name'), '') AS adjudicatario, ({_value("r", "AwardedTenderedProject.LegalMonetaryTotal.TaxExclusiveAmount")})::DECIMAL(20,2) AS importe_sin_iva, (r->>'$.AwardedTenderedProject.LegalMonetaryTotal.PayableAmount')::DECIMAL(20,2) AS importe_con_iva,
       (r->>'$.ReceivedTenderQuantity')::INTEGER AS n_ofertas, CASE WHEN TRY_CAST(r->>'$.AwardDate' AS DATE) BETWEEN DATE '2000-01-01' AND {TODAY} + 730 THEN TRY_CAST(r->>'$.AwardDate' AS DATE) END AS fecha_adjudicacion, estado_expediente, tipo_contrato,
       list_last(list_transform(list_filter(lotes, lambda l: lote <> '' AND l->>'$.ID' = lote AND json_type(l->'$.ProcurementProject.BudgetAmount.TaxExclusiveAmount') <> 'NULL'), lambda l: (l->>'$.ProcurementProject.BudgetAmount.TaxExclusiveAmount')::DECIMAL(20,2))) AS presupuesto_lote_sin_iva FROM k""")
def e_awards(spark, sf):
    """Awards of all feed bodies with their own lot's budget."""
    a = feed_tables.awards(feed_tables.feed_bodies(table(spark, sf, "entradas")), _today())
    return a.select(F.col("doc").alias("entrada_id"), "licitacion_id", "lote", "resultado_code", "cif_adjudicatario", "id_scheme", "adjudicatario", "importe_sin_iva", "importe_con_iva", "n_ofertas", "fecha_adjudicacion", "estado_expediente", "tipo_contrato", "presupuesto_lote_sin_iva")


# --- writes

_FIRST = "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY licitacion_id, lote, cif_adjudicatario ORDER BY recibido_en DESC, fila_id DESC) AS k FROM adjudicaciones WHERE recibido_en {} TIMESTAMP '" + CUT + "') WHERE k = 1"


@query(f"""
WITH b AS ({_FIRST.format("<")}), x AS ({_FIRST.format(">=")})
SELECT licitacion_id, lote, cif_adjudicatario, coalesce(x.fila_id, b.fila_id) AS fila_id, CASE WHEN x.fila_id IS NOT NULL THEN x.importe_sin_iva ELSE b.importe_sin_iva END AS importe_sin_iva FROM b FULL JOIN x USING (licitacion_id, lote, cif_adjudicatario)""")
def k2_d1_award_upsert(spark, sf):
    """Awards upserted by their three keys; within the batch the last wins, and what it has, nulls too, replaces what was."""
    a, at = table(spark, sf, "adjudicaciones").select(*AWARD_KEY, "fila_id", "importe_sin_iva", "recibido_en"), F.lit(CUT).cast("timestamp_ntz")
    old, new = (merge.pick(a.where(c), AWARD_KEY, F.struct("recibido_en", "fila_id")).drop("recibido_en") for c in (F.col("recibido_en") < at, F.col("recibido_en") >= at))
    return merge.upsert(old, new, AWARD_KEY, refresh=["fila_id", "importe_sin_iva"])


@query(f"""
SELECT estado, count(*) AS n, sum(d)::BIGINT AS lotes FROM (
  SELECT CASE WHEN g = 0 AND d > 0 THEN 'desierta_total' WHEN g > 0 AND d > 0 THEN 'desierta_parcial' WHEN g = 0 AND r > 0 THEN 'retirada' WHEN g > 0 THEN 'adjudicada' ELSE 'sin_ganador' END AS estado, d
  FROM (SELECT licitacion_id, count(*) FILTER (cif_adjudicatario <> '') AS g, count(*) FILTER (cif_adjudicatario = '' AND resultado_code = '3') AS d, count(*) FILTER (cif_adjudicatario = '' AND resultado_code IN ('4', '5')) AS r FROM {AWARDS} GROUP BY 1)) GROUP BY 1""")
def k13_published_rebuild(spark, sf):
    """The lots' outcomes rebuilt twice and published whole; what is read is the second version."""
    store = Published(spark, fresh_path(spark, "outcomes"))
    outcomes = catalogue.lot_outcomes(awards_once(spark, sf, "resultado_code"))
    store.publish(outcomes.where("estado = 'adjudicada'"))
    store.publish(outcomes)
    store.expire(0)
    return store.read().groupBy("estado").agg(F.count(F.lit(1)).alias("n"), F.sum("n_lotes_desiertos").cast("long").alias("lotes"))


@query(f"""
WITH s AS (SELECT licitacion_id, CASE WHEN g = 0 AND d > 0 THEN 'desierta_total' WHEN g > 0 AND d > 0 THEN 'desierta_parcial' WHEN g = 0 AND r > 0 THEN 'retirada' WHEN g > 0 THEN 'adjudicada' ELSE 'sin_ganador' END AS estado, d
  FROM (SELECT licitacion_id, count(*) FILTER (cif_adjudicatario <> '') AS g, count(*) FILTER (cif_adjudicatario = '' AND resultado_code = '3') AS d, count(*) FILTER (cif_adjudicatario = '' AND resultado_code IN ('4', '5')) AS r FROM {AWARDS} GROUP BY 1))
SELECT s.licitacion_id, s.estado, s.d::INTEGER AS n_lotes_desiertos FROM s JOIN {_LATEST} l USING (licitacion_id) WHERE l.estado_adjudicacion IS DISTINCT FROM s.estado OR l.n_lotes_desiertos IS DISTINCT FROM s.d""")
def k14_j3_status_delta(spark, sf):
    """Notices whose stored outcome isn't that of their awards; those not in the catalogue aren't touched."""
    from almoneda.reference_queries import latest

    new = catalogue.lot_outcomes(awards_once(spark, sf, "resultado_code")).select("licitacion_id", "estado", F.col("n_lotes_desiertos").cast("int").alias("n_lotes_desiertos"))
    old = latest(spark, sf, "estado_adjudicacion", "n_lotes_desiertos").select("licitacion_id", F.col("estado_adjudicacion").alias("estado"), "n_lotes_desiertos")
    return merge.delta(new, old, ["licitacion_id"], ["estado", "n_lotes_desiertos"])


@query(f"""
SELECT d.licitacion_id, coalesce(CASE WHEN a.licitacion_id IS NOT NULL THEN 'adjudicada' END, d.estado) AS estado, coalesce(d.favorita, false) AS favorita
FROM decisiones d LEFT JOIN (SELECT DISTINCT licitacion_id FROM {AWARDS} WHERE cif_adjudicatario <> '') a USING (licitacion_id)""")
def k8_k11_partial_update(spark, sf):
    """A change of one column: what the change doesn't name stays."""
    won = awards_once(spark, sf).where("cif_adjudicatario <> ''").select("licitacion_id").distinct()
    d = table(spark, sf, "decisiones").select("licitacion_id", "estado", F.coalesce("favorita", F.lit(False)).alias("favorita"))
    changes = won.join(d.select("licitacion_id"), "licitacion_id", "left_semi").withColumn("estado", F.lit("adjudicada"))
    return merge.upsert(d, changes, ["licitacion_id"], refresh=[]).select("licitacion_id", "estado", "favorita")


@query("SELECT licitacion_id, lote, cif_adjudicatario, fila_id FROM (SELECT *, row_number() OVER (PARTITION BY licitacion_id, lote, cif_adjudicatario ORDER BY recibido_en, fila_id) AS k FROM adjudicaciones) WHERE k = 1")
def t1_t2_daily_store(spark, sf):
    """Awards taken in as a stream with a named checkpoint, twice: the second run finds nothing new."""
    store, mark = DeliveryStore(spark, fresh_path(spark, "daily"), AWARD_KEY, "recibido_en", "fila_id"), fresh_path(spark, "mark")
    rows = stream_file(spark, sf, "adjudicaciones").select(*AWARD_KEY, "recibido_en", "fila_id")
    for _ in range(2):
        run_available(rows, lambda batch, _: store.apply(batch), mark)
    return store.snapshot().select(*AWARD_KEY, "fila_id")


@query("SELECT licitacion_id, lote, fila_id FROM adjudicaciones a WHERE recibido_en = (SELECT max(recibido_en) FROM adjudicaciones b WHERE b.licitacion_id = a.licitacion_id)")
def t4_republished(spark, sf):
    """A notice's awards are those of its latest publication: earlier ones are replaced as a whole."""
    a = table(spark, sf, "adjudicaciones").select("licitacion_id", "lote", "fila_id", "recibido_en")
    last = a.groupBy("licitacion_id").agg(F.max("recibido_en").alias("recibido_en"))
    return a.join(last, ["licitacion_id", "recibido_en"]).drop("recibido_en")


# --- radar and filters

@query("SELECT doc_id FROM documents WHERE coalesce(source, 'Estado') IN ('Estado', 'perfil', 'boletin') AND lang IN ('es', 'ca')")
def f2_territory(spark, sf):
    """Rows of some platforms and regions; null is the state's platform, and of no region."""
    return table(spark, sf, "documents").where(views.territory("source", "lang", ["Estado", "perfil", "boletin"], ["es", "ca"])).select("doc_id")


_CONFIG = {"categorias": {"verde": {"cpv": ["773", {"v": "998", "on": False}, " "], "palabras_clave": [{"v": "jardín", "on": True}, "zonas verdes"]}, "mal": 3, "obra": {"cpv": ["45"], "palabras_clave": ["pavimentación", {"v": "nada"}, 7]}, "vacia": {"cpv": []}, "tic": {"cpv": ["72", "48"], "palabras_clave": ["informátic", "digitaliz"]}}}


@query(f"SELECT licitacion_id, categoria FROM (SELECT licitacion_id, valor_estimado, CASE {_CASE} END AS categoria FROM {_LATEST} WHERE fuente = 'estatal') WHERE categoria IS NOT NULL AND valor_estimado >= 1000")
def f3_f4_f5_radar(spark, sf):
    """Stored rows pruned by the configured categories: source, then the first category, then the territory (here an amount)."""
    criteria = views.active_criteria(_CONFIG, [])
    criteria = [(name, codes, [w for w in words if w != "nada"]) for name, codes, words in criteria]
    return views.radar(catalogue_of(spark, sf), "titulo", "cpv", criteria, F.col("valor_estimado") >= 1000, ["estatal"]).select("licitacion_id", "categoria")


for _mode, _states in {"total": "'desierta_total'", "parcial": "'desierta_parcial'"}.items():
    QUERIES[f"f10_deserted_{_mode}"] = lambda spark, sf, m=_mode: search.hits(catalogue_of(spark, sf), Search(desiertas=m, as_of=AS_OF)).select("licitacion_id")
    SQL[f"f10_deserted_{_mode}"] = f"SELECT licitacion_id FROM {_LATEST} WHERE estado_adjudicacion IN ({_states})"


@query()
def f6_stems(spark, sf):
    """Full text by stems, without stop words: singular and plural, noun and adjective meet."""
    return search.hits(catalogue_of(spark, sf), Search(texto='obras de conservación OR limpieza -"zonas verdes"', lexemas="lexemas", estado="todas")).select("licitacion_id", "titulo")


@query("SELECT ficha_id, n FROM (SELECT ficha_id, row_number() OVER (ORDER BY importe_total_sin_iva DESC NULLS LAST, cif, ficha_id) AS n FROM competidores WHERE contains(strip_accents(upper(nombre_busqueda)), 'SL')) WHERE n <= 50")
def f22_o4_name_search(spark, sf):
    from pyspark.sql import Window

    found = views.find_competitors(table(spark, sf, "competidores"), " sl ")
    w = Window.orderBy(F.desc_nulls_last("importe_total_sin_iva"), "cif", "ficha_id")  # fifty rows
    return found.select("ficha_id", F.row_number().over(w).alias("n"))


@query(r"SELECT ficha_id FROM competidores WHERE upper(regexp_replace(coalesce(cif, ''), '[\s./\-]', '', 'g')) = 'A38810605'")
def f22_identifier_search(spark, sf):
    """A term that looks like an identifier finds its records."""
    return views.find_competitors(table(spark, sf, "competidores"), "a-38.810.605").select("ficha_id")


@query("SELECT count(*) AS n FROM competidores WHERE contains(nombre_busqueda, '%') OR contains(nombre_busqueda, '_')")
def c27_wild_cards(spark, sf):
    """LIKE with escaped wild cards finds what holds the signs themselves."""
    like = lambda t: F.col("nombre_busqueda").like(f"%{n.like_escaped(t)}%")
    return table(spark, sf, "competidores").where(like("%") | like("_")).agg(F.count(F.lit(1)).alias("n"))


# --- look-ups and envelopes

_FIND = Search(prefijos=["45"], estado="todas", orden="fecha_publicacion", descendente=True, pagina=2, por_pagina=10, as_of=AS_OF)


@query(f"""
WITH h AS (SELECT * FROM {_LATEST} WHERE len(list_filter(cpv, lambda c: starts_with(c, '45'))) > 0), p AS (SELECT licitacion_id, fecha_publicacion FROM h ORDER BY fecha_publicacion DESC NULLS LAST, licitacion_id LIMIT 10 OFFSET 10)
SELECT licitacion_id, least((SELECT count(*) FROM h), 20) AS total, (SELECT count(*) FROM h) > 20 AS topado, 2 AS pagina, 10 AS por_pagina FROM p""")
def a13_j5_envelope(spark, sf):
    """A search's page with its capped total (the cap is low, so that it is met)."""
    found = search.run(catalogue_of(spark, sf), _FIND, cap=20, by_text=True)
    return found.rows.select("licitacion_id", F.lit(found.total).cast("long").alias("total"), F.lit(found.topado).alias("topado"), F.lit(found.pagina).alias("pagina"), F.lit(found.por_pagina).alias("por_pagina"))


@query(f"SELECT count(*) AS total, count(*) FILTER (fecha_fin_plazo >= {TS}) AS abiertas, count(*) FILTER (fecha_fin_plazo < {TS}) AS cerradas, count(*) FILTER (fecha_fin_plazo IS NULL) AS sin_fecha FROM {_LATEST}")
def s13_a14_counts(spark, sf):
    """Exact counts by mode, from one pass over one column."""
    end, now = F.col("fecha_fin_plazo"), F.lit(AS_OF).cast("timestamp_ntz")
    return catalogue_of(spark, sf).agg(F.count(F.lit(1)).alias("total"), *[F.sum(c.cast("long")).alias(a) for a, c in (("abiertas", F.coalesce(end >= now, F.lit(False))), ("cerradas", F.coalesce(end < now, F.lit(False))), ("sin_fecha", end.isNull()))])


@query(f"SELECT licitacion_id, titulo FROM {_LATEST} WHERE licitacion_id = (SELECT min(licitacion_id) FROM licitaciones)")
def s14_point(spark, sf):
    c = catalogue_of(spark, sf)
    return views.point(c, "licitacion_id", c.agg(F.min("licitacion_id")).first()[0]).select("licitacion_id", "titulo")


@query(f"SELECT licitacion_id, titulo FROM {_LATEST} WHERE licitacion_id IN (SELECT licitacion_id FROM decisiones)")
def s15_look_up(spark, sf):
    return views.look_up(catalogue_of(spark, sf), table(spark, sf, "decisiones"), "licitacion_id").select("licitacion_id", "titulo")


@query("SELECT 0::BIGINT AS n")
def s9_s16_missing_table(spark, sf):
    """A stored state that isn't there reads as an empty table."""
    return table_or_empty(spark, f"{sf}/no-such-table.parquet", "id string, primera_vez timestamp").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT fuente, count(*) AS n, min_by(entrada_id, entrada_id) AS primera FROM entradas GROUP BY 1")
def s18_preview(spark, sf):
    """How many records a feed has, and its first."""
    return table(spark, sf, "entradas").groupBy("fuente").agg(F.count(F.lit(1)).alias("n"), F.min("entrada_id").alias("primera"))


@query(f"""
SELECT a.licitacion_id, a.lote, a.cif_adjudicatario, a.importe_sin_iva, l.valor_estimado FROM {AWARDS} a LEFT JOIN {_LATEST} l USING (licitacion_id)
WHERE a.licitacion_id = (SELECT min(licitacion_id) FROM adjudicaciones)""")
def j11_detail(spark, sf):
    """One notice's awards with its value, the filter pushed to both scans."""
    a = table(spark, sf, "adjudicaciones")
    one = a.agg(F.min("licitacion_id")).first()[0]
    own = merge.pick(a.where(F.col("licitacion_id") == one).select(*AWARD_KEY, "importe_sin_iva", "updated_at", "fila_id"), AWARD_KEY, F.struct("updated_at", "fila_id"))
    return own.join(views.point(catalogue_of(spark, sf), "licitacion_id", one).select("licitacion_id", "valor_estimado"), "licitacion_id", "left").select(*AWARD_KEY, "importe_sin_iva", "valor_estimado")


@query(f"SELECT c.codigo, n.nombre, count(*) AS n FROM (SELECT unnest(list_distinct(cpv)) AS codigo FROM {_LATEST}) c LEFT JOIN (SELECT cpv[1] AS codigo, min(titulo) AS nombre FROM {_LATEST} WHERE len(cpv) = 1 GROUP BY 1) n USING (codigo) WHERE c.codigo IS NOT NULL GROUP BY 1, 2 ORDER BY 1")
def j13_o10_code_names(spark, sf):
    """The code facet with names, by code; a code without a name stays. Names are those of notices with that code alone."""
    c = catalogue_of(spark, sf)
    names = c.where(F.size("cpv") == 1).select(F.get("cpv", 0).alias("codigo"), "titulo").groupBy("codigo").agg(F.min("titulo").alias("nombre"))
    return catalogue.facet(c, "cpv", "codigo").join(names, "codigo", "left").select("codigo", "nombre", "n").orderBy("codigo")


# --- aggregates and sorts


@query("""
WITH p AS (SELECT DISTINCT licitacion_id AS k, strftime(recibido_en, '%Y-%m') AS periodo FROM licitaciones WHERE licitacion_id IS NOT NULL AND recibido_en IS NOT NULL), f AS (SELECT k, min(periodo) AS periodo FROM p GROUP BY 1),
     q AS (SELECT p.periodo, count(*) AS presentes, count(f.k) AS nuevos FROM p LEFT JOIN f ON p.k = f.k AND p.periodo = f.periodo GROUP BY 1), m AS (SELECT avg(nuevos) AS x FROM q WHERE periodo > (SELECT min(periodo) FROM q))
SELECT count(*) AS periodos, round(avg(presentes), 4) AS media, sum(nuevos)::BIGINT AS distintos, (SELECT round(x, 4) FROM m) AS nuevos_medios, (SELECT round(round(x, 4) * 12, 2) FROM m) AS por_anio FROM q""")
def a7_overlap_totals(spark, sf):
    return catalogue.overlap(table(spark, sf, "licitaciones"), "licitacion_id", F.date_format("recibido_en", "yyyy-MM"))


@query(f"SELECT strftime(fecha_adjudicacion, '%Y-%m') AS mes, count(*) AS n, count(DISTINCT fecha_adjudicacion) AS dias FROM {AWARDS} WHERE fecha_adjudicacion IS NOT NULL GROUP BY 1")
def a20_by_month(spark, sf):
    """The calendar by month, from a pre-aggregate by day."""
    days = awards_once(spark, sf, "fecha_adjudicacion").where("fecha_adjudicacion is not null").groupBy("fecha_adjudicacion").agg(F.count(F.lit(1)).alias("n"))
    return days.groupBy(F.date_format("fecha_adjudicacion", "yyyy-MM").alias("mes")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("dias"))


@query("SELECT fuente, arg_max(trim(organo_contratacion), (coalesce(primera_vez, TIMESTAMP '1900-01-01'), fila_id)) AS ultimo_organo FROM licitaciones WHERE trim(organo_contratacion) <> '' GROUP BY 1")
def a17_last_name_by_first_seen(spark, sf):
    """The last name that isn't blank, in the order in which notices were first seen."""
    rows = table(spark, sf, "licitaciones").select("fuente", F.trim("organo_contratacion").alias("o"), F.coalesce("primera_vez", F.lit("1900-01-01").cast("timestamp_ntz")).alias("t"), "fila_id").where("o <> ''")
    return rows.groupBy("fuente").agg(F.max_by("o", F.struct("t", "fila_id")).alias("ultimo_organo"))


_CARDS = f"SELECT d.licitacion_id, d.estado, coalesce(d.favorita, false) AS favorita, l.licitacion_id IS NOT NULL AS radar, coalesce(l.fecha_fin_plazo >= {TS}, true) AS viva FROM decisiones d LEFT JOIN {_LATEST} l USING (licitacion_id)"


@query(f"""
WITH c AS ({_CARDS}), t AS (SELECT CASE WHEN favorita THEN 'favoritas' END AS p FROM c UNION ALL SELECT estado || 's' FROM c WHERE estado IN ('ganada', 'perdida', 'presentada', 'descartada')
  UNION ALL SELECT CASE WHEN viva THEN 'activas' ELSE 'caducadas' END FROM c WHERE estado IS NULL AND radar) SELECT p AS pestana, count(*) AS n FROM t WHERE p IS NOT NULL GROUP BY 1""")
def f20_a12_tabs(spark, sf):
    """Cards by tab; one may be in several."""
    d = table(spark, sf, "decisiones").select("licitacion_id", "estado", F.coalesce("favorita", F.lit(False)).alias("favorita"))
    c = d.join(catalogue_of(spark, sf).select("licitacion_id", "fecha_fin_plazo", F.lit(True).alias("hay")), "licitacion_id", "left")
    cards = c.withColumn("radar", F.col("hay").isNotNull()).withColumn("viva", F.coalesce(F.col("fecha_fin_plazo") >= F.lit(AS_OF).cast("timestamp_ntz"), F.lit(True)))
    return views.tabs(cards).select(F.explode("pestanas").alias("pestana")).groupBy("pestana").agg(F.count(F.lit(1)).alias("n"))


for _name, _by, _sql in (
    ("publicacion", [F.desc_nulls_last, "fecha_publicacion"], "fecha_publicacion DESC NULLS LAST"),
    ("importe", [F.desc_nulls_last, "valor_estimado"], "valor_estimado DESC NULLS LAST"),
    ("nombre", [F.asc_nulls_last, "plegado"], "nullif(strip_accents(lower(trim(titulo))), '') ASC NULLS LAST"),
):

    def _sorted(spark, sf, by=_by):
        c = catalogue_of(spark, sf).withColumn("plegado", F.nullif(n.fold(F.trim("titulo")), F.lit("")))
        return c.orderBy(by[0](by[1]), "licitacion_id").limit(100).select("licitacion_id")

    QUERIES[f"o3_by_{_name}"] = _sorted
    SQL[f"o3_by_{_name}"] = f"SELECT licitacion_id FROM {_LATEST} ORDER BY {_sql}, licitacion_id LIMIT 100"


@query(f"SELECT a.licitacion_id FROM {_LATEST} a WHERE fuente = 'estatal' AND year(fecha_publicacion) BETWEEN 2023 AND 2024 AND list_contains(cpv, '45233222')")
def f24_drill_down(spark, sf):
    """A facet's rows: source, years and one code."""
    year = F.year("fecha_publicacion")
    return catalogue_of(spark, sf).where((F.col("fuente") == "estatal") & year.between(2023, 2024) & F.array_contains("cpv", "45233222")).select("licitacion_id")


# --- small functions


@query(f"""
SELECT fila_id, CASE WHEN d < 0 THEN 'vencida' WHEN d < 180 THEN 'ambar' WHEN d IS NOT NULL THEN 'verde' END AS vigencia,
       CASE WHEN d = 0 THEN 'hoy' WHEN d = 1 THEN 'mañana' WHEN d > 1 THEN 'en ' || d || ' días' WHEN d = -1 THEN 'ayer' WHEN d < -1 THEN 'hace ' || -d || ' días' END AS plazo,
       coalesce(strftime(fecha_publicacion, '%d/%m/%Y'), '—') AS publicada, coalesce(year(fecha_publicacion)::VARCHAR, year(fecha_fin_plazo)::VARCHAR, 's/f') AS anio,
       CASE estado_adjudicacion WHEN 'desierta_total' THEN 'Desierta' WHEN 'retirada' THEN 'Retirada' WHEN 'desierta_parcial' THEN n_lotes_desiertos || CASE WHEN n_lotes_desiertos = 1 THEN ' lote desierto' ELSE ' lotes desiertos' END END AS insignia
FROM (SELECT *, date_diff('day', {TODAY}, fecha_fin_plazo::DATE) AS d FROM licitaciones)""")
def c19_c20_p11_p12_texts(spark, sf):
    """Validity, relative days, a Spanish date, the year of the first usable date, the badge."""
    d = n.days_left("fecha_fin_plazo", _today())
    return table(spark, sf, "licitaciones").select("fila_id", n.validity("fecha_fin_plazo", _today()).alias("vigencia"), n.relative_days(d).alias("plazo"), n.spanish_date("fecha_publicacion").alias("publicada"), n.first_year("fecha_publicacion", "fecha_fin_plazo").alias("anio"), views.badge("estado_adjudicacion", "n_lotes_desiertos").alias("insignia"))


@query("SELECT fila_id, to_json({'e': estado, 'f': favorita}) AS j, json_extract_string(to_json({'e': estado, 'f': favorita}), '$.e') AS e, json_extract_string(to_json({'e': estado, 'f': favorita}), '$.f')::BOOLEAN AS f FROM decisiones")
def c29_json(spark, sf):
    """JSON made, with nulls, and read again."""
    j = F.to_json(F.struct(F.col("estado").alias("e"), F.col("favorita").alias("f")), {"ignoreNullFields": "false"})
    return table(spark, sf, "decisiones").select("fila_id", j.alias("j"), F.get_json_object(j, "$.e").alias("e"), F.get_json_object(j, "$.f").cast("boolean").alias("f"))


@query("SELECT fila_id, coalesce(replace(replace(replace(format('{:,.2f}', importe_sin_iva::DOUBLE), ',', '#'), '.', ','), '#', '.') || ' €', '—') AS euros FROM adjudicaciones")
def c25_amounts(spark, sf):
    return table(spark, sf, "adjudicaciones").select("fila_id", n.spanish_amount("importe_sin_iva").alias("euros"))


# --- radar state, defaults, sizes, purge

_RADAR = ["objeto", "organo_contratacion", "num_expediente", "presupuesto_con_iva", "presupuesto_sin_iva", "valor_estimado", "fecha_publicacion", "fecha_fin_plazo", "ultima_vez", "estado_adjudicacion", "n_lotes_desiertos"]
_KEEP = ["primera_vez", "fuente", "titulo", "enlace"]
_STATE = "SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY licitacion_id ORDER BY recibido_en DESC, fila_id DESC) AS k FROM licitaciones WHERE recibido_en {} TIMESTAMP '" + CUT + "') WHERE k = 1"


@query(f"""
WITH b AS ({_STATE.format("<")}), x AS ({_STATE.format(">=")})
SELECT licitacion_id, {", ".join(f"CASE WHEN x.fila_id IS NOT NULL THEN x.{c} ELSE b.{c} END AS {c}" for c in _RADAR)}, {", ".join(f"CASE WHEN b.fila_id IS NOT NULL THEN b.{c} ELSE x.{c} END AS {c}" for c in _KEEP)} FROM b FULL JOIN x USING (licitacion_id)""")
def d4_radar_merge(spark, sf):
    """The state merged with a new reading: eleven fields are refreshed, also by null; what was first seen stays."""
    rows = table(spark, sf, "licitaciones").select("licitacion_id", "recibido_en", "fila_id", *_RADAR, *_KEEP)
    at = F.lit(CUT).cast("timestamp_ntz")
    old, new = (merge.pick(rows.where(c), ["licitacion_id"], F.struct("recibido_en", "fila_id")).drop("recibido_en", "fila_id") for c in (F.col("recibido_en") < at, F.col("recibido_en") >= at))
    return merge.upsert(old, new, ["licitacion_id"], refresh=_RADAR, keep=_KEEP)


@query("SELECT licitacion_id, coalesce(estado, 'sin decidir') AS estado, coalesce(favorita, false) AS favorita, 'decision' AS origen FROM decisiones UNION ALL SELECT licitacion_id, 'sin decidir', false, coalesce(fuente, '—') FROM bajas")
def d5_d8_defaults(spark, sf):
    """Records of two shapes under one, missing keys and nulls filled in."""
    a = table(spark, sf, "decisiones").select("licitacion_id", "estado", "favorita", F.lit("decision").alias("origen"))
    return merge.filled(a.unionByName(table(spark, sf, "bajas").select("licitacion_id", F.col("fuente").alias("origen")), allowMissingColumns=True), {"estado": "sin decidir", "favorita": False, "origen": "—"})


@query("SELECT d.licitacion_id FROM decisiones d WHERE d.licitacion_id NOT IN (SELECT licitacion_id FROM licitaciones)")
def d9_stale_rows(spark, sf):
    """Hydrated rows whose notice is gone."""
    return table(spark, sf, "decisiones").select("licitacion_id").join(table(spark, sf, "licitaciones").select("licitacion_id").distinct(), "licitacion_id", "left_anti")


@query(f"""
SELECT strftime(fecha_publicacion, '%Y-%m') AS periodo, count(*) AS n, sum(strlen(coalesce(titulo, '')) + strlen(coalesce(objeto, '')) + strlen(coalesce(organo_contratacion, '')))::BIGINT AS bytes,
       round(sum(strlen(coalesce(titulo, '')) + strlen(coalesce(objeto, '')) + strlen(coalesce(organo_contratacion, ''))) * 1.75)::BIGINT AS con_indices FROM {_LATEST} GROUP BY 1""")
def a5_a6_bytes_by_period(spark, sf):
    """Bytes of the texts by month of publication, and with three quarters on top for indexes."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in ("titulo", "objeto", "organo_contratacion")), F.lit(0))
    c = catalogue_of(spark, sf).groupBy(F.date_format("fecha_publicacion", "yyyy-MM").alias("periodo")).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes"))
    return c.withColumn("con_indices", F.round(F.col("bytes").cast("decimal(20,2)") * F.lit("1.75").cast("decimal(4,2)"), 0).cast("long"))


@query(f"""
SELECT licitacion_id FROM {_LATEST} WHERE NOT coalesce(fecha_publicacion < {TS} - INTERVAL 1 YEAR AND (fecha_fin_plazo IS NULL OR fecha_fin_plazo < {TS})
AND licitacion_id NOT IN (SELECT licitacion_id FROM decisiones), false)""")
def k17_kept_after_purge(spark, sf):
    """What a purge leaves: a null publication date keeps a notice, as does a decision on it."""
    now = F.lit(AS_OF).cast("timestamp_ntz")
    old = (F.col("fecha_publicacion") < F.lit(AS_OF.replace(year=AS_OF.year - 1)).cast("timestamp_ntz")) & (F.col("fecha_fin_plazo").isNull() | (F.col("fecha_fin_plazo") < now))
    return merge.purge(catalogue_of(spark, sf), "licitacion_id", old, [table(spark, sf, "decisiones")])[0].select("licitacion_id")
