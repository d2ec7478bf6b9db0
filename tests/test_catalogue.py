import datetime as d
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from almoneda.functions import normalize as n
from almoneda.operators import merge, search
from almoneda.operators.feed_tables import awards, feed_bodies, notices
from almoneda.operators.search import Search
from almoneda.sources import feeds
from almoneda.streaming.daily import collected, deliver, distinct_stream, sightings

ENTRY = """<entry><id>e{i}</id><title>Aviso {i}</title><link href="http://x/{i}"/><ContractFolderStatus xmlns="urn:x"><ContractFolderID>1/{i}</ContractFolderID>
<TenderResult><ResultCode>9</ResultCode><WinningParty><PartyIdentification><ID schemeName="NIF"> a-28.141-935 </ID></PartyIdentification></WinningParty><WinningParty><PartyIdentification><ID schemeName="UTE">U1</ID></PartyIdentification></WinningParty>
<AwardedTenderedProject><ProcurementProjectLotID>1</ProcurementProjectLotID></AwardedTenderedProject></TenderResult><TenderResult><ResultCode>3</ResultCode></TenderResult></ContractFolderStatus></entry>"""


def document(ids, following=None):
    link = f'<link rel="next" href="{following}"/>' if following else ""
    return f'<feed xmlns="http://www.w3.org/2005/Atom">{link}{"".join(ENTRY.format(i=i) for i in ids)}</feed>'.encode()


def test_archives_nested_and_damaged(spark, tmp_path):
    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("b.atom", document([3]))
        z.writestr("bad.atom", b"<feed><entry>")
        z.writestr("note.txt", b"x")
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("a.atom", document([1, 2]))
        z.writestr("in.zip", inner.getvalue())
    (tmp_path / "o.zip").write_bytes(outer.getvalue())
    (tmp_path / "broken.zip").write_bytes(b"PK")
    (tmp_path / "half.atom").write_bytes(document([4, 5])[:-120])
    every = feeds.read_archives(spark, str(tmp_path))
    rows = feeds.entries(every).withColumn("k", F.monotonically_increasing_id())
    assert rows.count() == 4
    bad = {(r.archivo.rpartition("/")[2], r.documento) for r in feeds.damages(every).collect()}
    assert bad == {("broken.zip", None), ("o.zip", "bad.atom"), ("half.atom", "half.atom")}
    small = spark.read.format("archive_feed").option("task_bytes", 1).load(str(tmp_path))
    assert sorted(map(str, feeds.entries(small).collect())) == sorted(map(str, feeds.entries(every).collect())) and small.rdd.getNumPartitions() >= 4
    assert feeds.read_archives(spark, f"file://{tmp_path}/o.zip").count() == 4
    flat = feed_bodies(rows, "k", "cuerpo")
    assert sorted(r.licitacion_id for r in notices(flat).collect()) == ["e1", "e2", "e3", "e4"]
    assert {(r.lote, r.cif_adjudicatario) for r in awards(flat).collect()} == {("1", "A28141935"), ("1", "U1"), ("", "")}


def test_paged_feed_follows_links_and_survives_a_missing_page(spark, tmp_path):
    (tmp_path / "1.atom").write_bytes(document([1, 2], "2.atom"))
    (tmp_path / "2.atom").write_bytes(document([3], "missing.atom"))
    spark.dataSource.register(feeds.PagedFeed)
    read = lambda n: spark.read.format("paged_feed").option("urls", f"file://{tmp_path}/1.atom file://{tmp_path}/none.atom file://{tmp_path}/3.atom").option("max_pages", n).load()
    (tmp_path / "3.atom").write_bytes(document([7]))
    df = read(20)
    first = df.where(f"feed like '%/1.atom' and cuerpo is not null")
    assert [(r.pagina, json.loads(r.cuerpo)["entry"]["id"]) for r in first.orderBy("pagina", "posicion").collect()] == [(1, "e1"), (1, "e2"), (2, "e3")]
    state = lambda d: {r.feed[-6:]: r.estado for r in d.where("estado is not null").collect()}
    assert state(df) == {"1.atom": "fallida", "e.atom": "fallida", "3.atom": "completa"} and state(read(1))["1.atom"] == "topada"


def test_a_feed_of_many_pages_tells_that_it_was_cut(spark, tmp_path):
    for i in range(25):
        (tmp_path / f"{i}.atom").write_bytes(document([i], f"{i + 1}.atom" if i < 24 else None))
    spark.dataSource.register(feeds.PagedFeed)
    read = lambda **o: spark.read.format("paged_feed").options(urls=f"file://{tmp_path}/0.atom", **o).load()
    assert read().where("cuerpo is not null").count() == 20 and read().where("estado = 'topada'").count() == 1
    assert read(max_pages=100).where("cuerpo is not null").count() == 25 and read(max_pages=100).where("estado = 'completa'").count() == 1


def test_code_list_periods_and_missing_table(spark, tmp_path):
    (tmp_path / "c.xml").write_text('<L><Row><Value ColumnRef="code"><SimpleValue>1</SimpleValue></Value><Value ColumnRef="nombre"><SimpleValue>Uno</SimpleValue></Value></Row><Row><Value ColumnRef="code"><SimpleValue>2</SimpleValue></Value></Row></L>')
    assert [tuple(r) for r in feeds.code_list(spark, str(tmp_path / "c.xml")).collect()] == [("1", "Uno")]
    assert feeds.recent_months(3, d.date(2025, 2, 9)) == ["202502", "202501"]
    assert feeds.load_periods(d.date(2025, 2, 9)) == ["202502", "202501", "2024", "2023"]
    assert feeds.table_or_empty(spark, str(tmp_path / "nothing"), "a int").count() == 0


def test_normalizers(spark):
    df = spark.createDataFrame([("  12.7 ", "NaN", "sí", "2025-02-30", " a-28.141/935 ")], "a string, b string, c string, e string, f string")
    r = df.select(n.clean_text("a"), n.integer("a"), n.number("b"), n.boolean("c"), n.plausible_date("e", F.lit("2025-01-01").cast("date")), n.cif("f"), n.usable_cif("f"), n.code_prefix(F.lit("4521-9")), n.digits(F.lit("45.21 x")), n.fold(F.lit("ÁÑü")), n.codes_text(F.array(F.lit("1"), F.lit("2")))).first()
    assert tuple(r) == ("12.7", 12, None, True, None, "A28141935", True, "4521", "4521", "anu", " 1 2")


def test_merge_operators(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], "k int, t string, first string")
    new = spark.createDataFrame([(1, None, "q"), (3, "c", "w")], "k int, t string, first string")
    assert sorted(map(tuple, merge.upsert(base, new, ["k"], refresh=["t"], keep=["first"]).collect()), key=str) == [(1, None, "x"), (2, "b", "y"), (3, "c", "w"), (None, "n", "z")]
    assert sorted(map(tuple, merge.replace_children(base, new, "k").collect()), key=str) == [(1, None, "q"), (2, "b", "y"), (3, "c", "w"), (None, "n", "z")]
    assert merge.insert_missing(base, new, ["k"]).count() == 4
    assert [r.k for r in merge.delta(new, base, ["k"], ["t"]).collect()] == [1]
    stays, goes = merge.purge(base, "k", F.col("k") > 0, [new])
    assert [r.k for r in goes.collect()] == [2] and stays.count() == 2
    log = spark.createDataFrame([(1, 1, "a"), (1, 2, None), (2, 1, "b")], "k int, o int, v string")
    assert [r.k for r in merge.fold_changes(log, ["k"], F.col("o"), F.col("v").isNull()).collect()] == [2]


def test_search_pages_do_not_overlap_and_accents_do_not_matter(spark, sf):
    t = spark.read.parquet(f"{sf}/licitaciones.parquet")
    ids = lambda p: [r.fila_id for r in search.page(t, Search(estado="todas", pagina=p, por_pagina=7)).collect()]
    assert len(set(ids(1)) | set(ids(2))) == 14
    count = lambda q: search.hits(t, Search(texto=q)).count()
    assert count("conservación") == count("CONSERVACION") > 0
    assert count('"de la" -conservacion') + count('"de la" conservacion') == count('"de la"') > 0
    with pytest.raises(ValueError):
        search.hits(t, Search())
    assert search.capped_count(t, Search(estado="todas"), cap=5).first() == (5, True)
    assert search.text_terms('uno "dos tres" -cuatro OR cinco') == [("and", ["uno"]), ("and", ["dos", "tres"]), ("not", ["cuatro"]), ("or", ["cinco"])]


def test_null_sorts_last_both_ways(spark):
    t = spark.createDataFrame([("a", None), ("b", d.datetime(2025, 1, 1)), ("c", d.datetime(2026, 1, 1))], "licitacion_id string, fecha_fin_plazo timestamp")
    for down in (True, False):
        assert search.page(t, Search(estado="todas", descendente=down)).collect()[-1].licitacion_id == "a"


def test_streams(spark, sf, tmp_path):
    from almoneda.operators.delivery import DeliveryStore
    from almoneda.plans.runtime import fresh_path

    rows = spark.read.parquet(f"{sf}/licitaciones.parquet").select("licitacion_id", F.col("recibido_en").cast("timestamp").alias("recibido_en"), "fila_id")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    store = DeliveryStore(spark, fresh_path(spark, "test"), ["licitacion_id"], "recibido_en", "fila_id")
    deliver(stream(), store, str(tmp_path / "mark"))
    once = rows.select("licitacion_id").distinct().count()
    assert store.snapshot().count() == once and store.manifest()["version"] == 3
    assert collected(distinct_stream(stream(), ["licitacion_id"]), "append").count() == once
    seen = collected(sightings(stream(), "licitacion_id", "recibido_en"), "complete")
    assert seen.count() == once and seen.agg(F.sum("n")).first()[0] == rows.count()


def test_a_stream_resumes_where_it_stopped(spark, tmp_path):
    """Only files that came since are read; a crash in a batch brings that batch again."""
    from almoneda.streaming.daily import Sightings, maintenance, run_available

    files, mark, got = tmp_path / "in", str(tmp_path / "mark"), []
    seen = Sightings(spark, str(tmp_path / "seen"), "k", "t")

    def put(name, data):
        spark.createDataFrame(data, "k string, t int").coalesce(1).write.parquet(str(files / name))

    def sink(batch, number, broken=False):
        got.extend(r.k for r in batch.collect())
        seen.merge(batch, number)
        if broken:
            raise OSError("killed")

    def stream():
        return spark.readStream.schema("k string, t int").option("recursiveFileLookup", "true").parquet(str(files))

    put("a", [("x", 1), ("y", 2)])
    run_available(stream(), sink, mark)
    put("b", [("x", 5)])
    with pytest.raises(Exception):  # noqa: B017
        run_available(stream(), lambda b, n: sink(b, n, True), mark)
    run_available(stream(), sink, mark)
    run_available(stream(), sink, mark)
    assert sorted(got) == ["x", "x", "x", "y"]
    assert sorted(map(tuple, seen.snapshot().collect())) == [("x", 1, 5, 2), ("y", 2, 2, 1)]
    order = []
    assert maintenance([("a", lambda: order.append(1)), ("b", lambda: 1 / 0), ("c", lambda: order.append(3))]).keys() == {"a", "b", "c"} and order == [1, 3]


def test_load_state_published_tables_and_configuration(spark, tmp_path):
    from almoneda.operators.published import LoadState, Published, State

    at = f"file://{tmp_path}/load.json"
    load = LoadState(spark, at)
    assert load.pending(["a", "b"]) == ["a", "b"] and not load.seen("a", "1")
    load.done("a", ["1", "2"])
    assert LoadState(spark, at).seen("a", "2") and LoadState(spark, at).pending(["a", "b"]) == ["a", "b"]
    load.done("a")
    assert LoadState(spark, at).pending(["a", "b"]) == ["b"] and not LoadState(spark, at).documents
    (tmp_path / "config.json").write_text("")
    assert State(spark, f"file://{tmp_path}/config.json").load({"x": 1}) == {"x": 1}
    table = Published(spark, f"file://{tmp_path}/t")
    assert table.read() is None and table.publish(spark.range(3)) == 3
    held = table.read()
    assert table.publish(spark.range(5)) == 5 and held.count() == 3 and table.read().count() == 5 == table.rows()
    with pytest.raises(Exception):  # noqa: B017
        table.publish(spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id")))
    assert table.read().count() == 5 and table.expire(0) >= 1 and table.read().count() == 5


def test_envelope_and_loose_parameters(spark, sf):
    from almoneda.operators.search import coerced, run

    t = spark.read.parquet(f"{sf}/licitaciones.parquet")
    now = d.datetime(2025, 6, 1)
    s = coerced({"texto": " ", "prefijos": "45-1, 773;", "importe_min": "x", "importe_max": "1e3", "fin_desde": "2025-01-01", "estado": "quizá", "orden": "otra", "pagina": "0", "por_pagina": "7", "fuente": 3}, now)
    assert (s.texto, s.prefijos, s.importe, s.fin, s.estado, s.orden, s.pagina, s.por_pagina, s.fuente) == ("", ["45", "773"], (None, 1000.0), (d.datetime(2025, 1, 1), None), None, "fecha_fin_plazo", 1, 7, None)
    found = run(t, Search(estado="todas", pagina=2, por_pagina=7, as_of=now), cap=10)
    assert (found.total, found.topado, found.mostradas, found.paginas, found.resumen) == (10, True, (8, 14), 2, "8-14 de 10+")
    made = json.loads(found.json().first().json)
    assert made["total"] == 10 and len(made["filas"]) == 7 and made["topado"] and [r["fila_id"] for r in made["filas"]] == [r.fila_id for r in found.rows.collect()]
    every = run(t, Search(estado="todas", pagina=99, por_pagina=100, as_of=now))
    assert every.mostradas == (0, 0) and not every.topado and every.total == t.count()
    for bad in (Search(expediente="1/", estado="todas"), Search(fuente="estatal", as_of=now)):
        with pytest.raises(ValueError):
            run(t, bad, by_text=True)


def test_views(spark):
    from almoneda.operators import views

    assert views.active_terms(["a", {"v": " b ", "on": True}, {"v": "c", "on": False}, "", 3, {"x": 1}]) == ["a", "b"] and views.active_terms(None) == []
    assert views.active_criteria({"categorias": {"x": {"cpv": ["1"]}, "y": 2, "z": {}}}, []) == [("x", ["1"], [])] and views.active_criteria({}, [("f", [], [])]) == [("f", [], [])]
    assert views.toggled(["a", "b"], "a") == ["b"] and views.toggled(["a", "b", "c"], "d") == ["a", "b", "c"]
    assert views.is_identifier(" a-28.141.935") and not views.is_identifier("TRANSPORTES") and not views.is_identifier("a1")
    rows = spark.createDataFrame([("t1", ["45"], "estatal", None, "ES1"), ("jardín", ["9"], "estatal", "P", None), ("x", ["45"], "otra", "P", "ES1")], "titulo string, cpv array<string>, fuente string, plataforma string, region string")
    seen = views.radar(rows, "titulo", "cpv", [("obra", ["45"], []), ("verde", [], ["jardin"])], views.territory("plataforma", "region", ["Estado", "P"], []), ["estatal"])
    assert sorted((r.titulo, r.categoria) for r in seen.collect()) == [("jardín", "verde"), ("t1", "obra")]
    assert [r.titulo for r in rows.where(views.territory("plataforma", "region", [], ["ES1"])).collect()] == ["t1", "x"]
    dup = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert views.point(dup, "k", 2).count() == 1 and views.point(dup, "k", 9).count() == 0
    with pytest.raises(Exception):  # noqa: B017
        views.point(dup, "k", 1).collect()
    r = spark.createDataFrame([("ﬁn º ÁÑő a\u0301", "1.234,5")], "a string, b string").select(n.fold_compat("a"), n.fold("a"), n.slug("a"), n.decimal_comma(F.lit(" 12,5 ")), n.spanish_amount(F.lit("1234.5")), n.first_year(F.lit("20x4"), F.lit("2023-01-01")), n.first_year(F.lit(None).cast("string"))).first()
    assert tuple(map(str, r)) == ("fin o ano a", "ﬁn º ano a", "fin-o-ano-a", "12.50", "1.234,50 €", "2023", "s/f")


def test_stems_and_stop_words(spark):
    from almoneda.functions.spanish import lexeme, stem
    from almoneda.operators.search import hits, with_lexemes

    pairs = {"limpiezas": "limpiez", "limpieza": "limpiez", "adjudicaciones": "adjud", "rápidamente": "rapid", "obras": "obras", "obra": "obra", "contratos": "contrat", "contrato": "contrat", "suministrando": "suministr", "telefonía": "telefon", "evidencias": "evident", "sol": "sol", "actividades": "activ", "comprarlo": "compr"}
    assert {w: stem(w) for w in pairs} == pairs and lexeme("de") == "" and stem("") == ""
    t = with_lexemes(spark.createDataFrame([("Contratos de conservación", None, "Ayto"), ("El contrato conservado", "limpiezas", "X"), (None, None, None), ("Contrato menor", "", "")], "titulo string, objeto string, organo_contratacion string"))
    ask = lambda q: [r.titulo for r in hits(t, Search(texto=q, lexemas="lexemas", estado="todas")).collect()]
    assert ask("contrato") == ["Contratos de conservación", "El contrato conservado", "Contrato menor"] and ask("limpieza de") == ["El contrato conservado"]
    assert ask('"contrato de conservacion"') == ["Contratos de conservación"] and len(ask("de la")) == 4 and ask("contratos -limpieza menor") == ["Contrato menor"]
