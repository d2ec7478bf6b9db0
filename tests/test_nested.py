import json
import re

import pytest

from pyspark.sql import functions as F

from almoneda.operators.feed_tables import REPEATING, awards, feed_awards, feed_bodies, lots, notices
from almoneda.operators.nested import DEPTH, escaped, read_bodies, unescaped

SCHEMA = "entrada_id long, cuerpo string, doc string, tabla int"


def listed(v):
    return [] if v is None else v if isinstance(v, list) else [v]


def get(o, name):
    """Brute force: a child by its name without prefix, embedded JSON opened."""
    if not isinstance(o, dict):
        return None
    for k, v in o.items():
        if k.split(":")[-1] == name and v is not None:
            if isinstance(v, str) and v[:1] in "{[" and v[:1]:
                try:
                    return json.loads(v)
                except ValueError:
                    return v
            return v
    return None


def leaf(v):
    if isinstance(v, dict):
        for k in ("#text", "_VALUE", "value"):
            if v.get(k) is not None:
                return str(v[k])
        return None
    return None if v is None else str(v)


def brute(doc, body):
    try:
        o = json.loads(body)
    except (TypeError, ValueError):
        return set()
    found, todo = set(), [o]
    while todo:
        x = todo.pop()
        if isinstance(x, list):
            todo += x
        elif isinstance(x, dict):
            cfs = get(x, "ContractFolderStatus")
            if cfs is None:
                todo += [v for v in map(lambda k: get({k: x[k]}, k.split(":")[-1]), x) if isinstance(v, (dict, list))]
                continue
            for r in listed(get(cfs, "TenderResult")):
                lote = leaf(get(get(r, "AwardedTenderedProject"), "ProcurementProjectLotID")) or ""
                for w in listed(get(r, "WinningParty")) or [None]:
                    ids = [get(i, "ID") for i in listed(get(w, "PartyIdentification")) if i is not None]
                    nif = [i for i in ids if isinstance(i, dict) and str(i.get("schemeName", "")).upper() == "NIF"]
                    c = leaf((nif or ids or [None])[0]) or ""
                    found.add((doc, get(x, "id"), lote, re.sub(r"[\s./-]", "", c).upper()))
    return found


def test_awards_match_brute_force(spark, sf):
    e = spark.read.parquet(f"{sf}/entradas.parquet")
    got = {tuple(r) for r in feed_awards(e).collect()}
    want = set().union(*(brute(r.entrada_id, r.cuerpo) for r in e.collect()))
    assert got == want and got


@pytest.fixture(scope="module")
def small(spark):
    entry = {"id": "n1", "cac:X": 1, "place:ContractFolderStatus": {"cac:TenderResult": [{"WinningParty": None}, {"AwardedTenderedProject": {"ProcurementProjectLotID": 7}, "WinningParty": [{"PartyIdentification": [{"ID": {"schemeName": "UTE", "#text": "u"}}, {"ID": {"schemeName": "nif", "value": " b-1.2 "}}]}, {"PartyIdentification": None}]}]}}
    bodies = [json.dumps({"feed": {"entry": entry}}), json.dumps([entry, None, 3]), json.dumps(entry), "{", "", None, "null", "5", "NaN", "[" * 100000, json.dumps({"feed": {"entry": {"id": "n2", "ContractFolderStatus": json.dumps(entry["place:ContractFolderStatus"])}}}), json.dumps({"id": "long", "ContractFolderStatus": {"Name": "x" * 300000, "TenderResult": {"ResultCode": "9"}}})]
    return spark.createDataFrame([(i, b, "clash", i) for i, b in enumerate(bodies)], SCHEMA)


def test_shapes_damage_and_clashing_names(small):
    got = {tuple(r) for r in feed_awards(small).collect()}
    want = {(d, n, lote, c) for d, n in ((0, "n1"), (1, "n1"), (2, "n1"), (10, "n2")) for lote, c in (("", ""), ("7", "B12"), ("7", ""))} | {(11, "long", "", "")}
    assert got == want


def test_children_keep_parent_and_ordinal(small):
    bodies = feed_bodies(small)
    tables = {p: bodies.table(p, REPEATING) for p in bodies.tables(REPEATING)}
    assert {p[-1] for p in tables if p} == set(REPEATING) - {"ProcurementProjectLot"}
    rows = {(r.doc, r.nodo) for t in tables.values() for r in t.select("doc", "nodo").collect()}
    for p, t in tables.items():
        for r in t.select("doc", "padre").collect():
            assert (r.padre is None) == (not p) and (not p or (r.doc, r.padre) in rows)
    at = next(p for p in tables if p[:1] == ("feed",) and p[-1] == "WinningParty")
    assert sorted((r.ordinal, r.nodo) for r in tables[at].where("doc = 0").collect()) == [(0, "r0/entry0/TenderResult1/WinningParty0"), (1, "r0/entry0/TenderResult1/WinningParty1")]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert feed_awards(none).count() == 0
    bodies = feed_bodies(none)
    assert notices(bodies).count() == 0 and lots(bodies).count() == 0 and awards(bodies).count() == 0 and bodies.tables() == [()]


def test_schema_is_merged_and_typed(spark):
    deep = "1"
    for _ in range(DEPTH + 8):
        deep = f'{{"d": {deep}}}'
    bodies = [
        '{"a": {"b": 1, "n": 7, "m": 2, "ID": "up", "id": "low", "t": [1, "x", true]}}', '{"x:a": [{"b": "s", "n": 9007199254740993, "m": 2.5}, null, {"b": true}], "k": {"v": {"w": 1}}}',
        '[[{"a": {"b": "in"}}], 5, {"a": null}]', r'{"ñ.\t^": "\ud800", "a": 1e999}', deep, '{"p:z": {"q": 1}, "r:z": {"q": 2}, "p:s": null, "r:s": 3}',
    ]
    read = read_bodies(spark.createDataFrame([(f"d{i}", b, 1) for i, b in enumerate(bodies)], "k string, b string, doc int"), "k", "b")
    types = dict(read.table(("a",)).dtypes)
    assert types["b"] == "string" and types["n"] == "bigint" and types["m"] == "double" and types["t[]"] == "array<string>" and {"ID", "id_"} <= set(types) or {"ID_", "id"} <= set(types)
    rows = [(r.doc, r.padre, r.ordinal, r.b, r.n, r.m) for r in read.table(("a",)).collect()]
    assert sorted(rows) == [("d0", "r0", 0, "1", 7, 2.0), ("d1", "r0", 0, "s", 9007199254740993, 2.5), ("d1", "r0", 2, "true", None, None), ("d2", "r0", 0, "in", None, None)]
    root = {(r.doc, r.nodo): r for r in read.table(()).collect()}
    assert root["d1", "r0"]["k.v.w"] == 1 and root["d3", "r0"]["a"] == "Infinity" and ("d2", "r1") in root
    assert sorted(r.q for r in read.table(("z",)).collect()) == [1, 2] and root["d5", "r0"]["s"] == 3
    text = read.table(()).where("doc = 'd4'").first()
    assert any(isinstance(v, str) and v.startswith('{"d"') for v in text.asDict().values())
    assert all(unescaped(escaped(k)) == k for k in ("TenderResult", "id", "ID", "ÑaÉ", "a^B", "^"))


ENTRY = {
    "id": " n1 ", "title": " T\u00a0", "link": {"href": "http://x/1"}, "updated": "2024-01-02T00:00:00", "place:ContractFolderStatus": {
        "cbc:ContractFolderID": "1/24", "pce:ContractFolderStatusCode": "RES", "cac:ProcurementProject": {"cbc:Name": "O", "cbc:TypeCode": 2, "cac:BudgetAmount": {"cbc:TotalAmount": {"#text": "121.005", "currencyID": "EUR"}, "cbc:TaxExclusiveAmount": 100, "cbc:EstimatedOverallContractAmount": "x"}, "cac:RequiredCommodityClassification": [{"cbc:ItemClassificationCode": "45"}, {"cbc:ItemClassificationCode": {"value": "72"}}], "cac:RealizedLocation": {"cbc:CountrySubentity": "Soria", "cbc:CountrySubentityCode": "ES417"}},
        "cac:ProcurementProjectLot": [{"cbc:ID": {"schemeName": "ID_LOTE", "value": "1"}, "cac:ProcurementProject": {"cbc:TypeCode": "3", "cac:BudgetAmount": {"cbc:TaxExclusiveAmount": 10}, "cac:RequiredCommodityClassification": {"cbc:ItemClassificationCode": "773"}}}, {"cbc:ID": 2}, {"cbc:ID": "1", "cac:ProcurementProject": {"cac:BudgetAmount": {"cbc:TaxExclusiveAmount": "20.5"}}}, {"cbc:ID": "1"}],
        "cac:TenderingProcess": {"cbc:ContractingSystemCode": "3", "cac:TenderSubmissionDeadlinePeriod": {"cbc:EndDate": "2024-02-01"}}, "place:LocatedContractingParty": {"cac:Party": {"cac:PartyName": {"cbc:Name": "Buyer"}, "cac:AgentParty": {"cac:PartyName": {"cbc:Name": "Platform"}}}},
        "place:ValidNoticeInfo": [{"cbc:X": 1}, {"cac:Ref": {"cbc:IssueDate": "2024-01-01"}}],
        "cac:TenderResult": [
            {"cbc:ResultCode": "9", "cbc:AwardDate": "2024-03-01T10:00:00", "cbc:ReceivedTenderQuantity": "2.0", "cbc:SMEAwardedIndicator": "Sí", "cac:AwardedTenderedProject": {"cbc:ProcurementProjectLotID": 1, "cac:LegalMonetaryTotal": {"cbc:TaxExclusiveAmount": {"_VALUE": 9.5}, "cbc:PayableAmount": 11.5}}, "cac:WinningParty": [{"cac:PartyIdentification": [{"cbc:ID": {"schemeName": "OTROS", "value": "z"}}, {"cbc:ID": {"schemeName": "nif", "value": " a-28.141-935 "}}], "cac:PartyName": {"cbc:Name": " Uno SL "}}, {"cac:PartyIdentification": {"cbc:ID": {"schemeName": "UTE", "#text": "U-1"}}}]},
            {"cbc:ResultCode": "3", "cbc:AwardDate": "1999-01-01", "cac:AwardedTenderedProject": {"cbc:ProcurementProjectLotID": "2"}},
        ],
    },
}


def test_all_fields_of_notices_lots_and_awards(spark):
    from decimal import Decimal as D

    bodies = feed_bodies(spark.createDataFrame([(1, json.dumps({"feed": {"entry": [ENTRY]}}), "", 1), (2, json.dumps({"feed": {"entry": {"link": {"href": "only"}}}}), "", 1)], SCHEMA))
    n = {r.doc: r for r in notices(bodies).collect()}
    r = n[1]
    assert (r.licitacion_id, r.titulo, r.objeto, r.enlace, r.num_expediente, r.organo_contratacion, r.plataforma, r.region, r.region_codigo) == ("n1", "T", "O", "http://x/1", "1/24", "Buyer", "Platform", "Soria", "ES417")
    assert sorted(r.cpv) == ["45", "72", "773"] and (r.presupuesto_con_iva, r.presupuesto_sin_iva, r.valor_estimado) == (D("121.01"), D("100.00"), None)
    assert (r.fecha_fin_plazo, r.fecha_publicacion, r.fecha_actualizacion) == ("2024-02-01", "2024-01-01", "2024-01-02T00:00:00")
    assert (n[2].licitacion_id, n[2].titulo, n[2].cpv, n[2].objeto) == ("only", "(sin título)", [], None)
    assert [(x.lote, x.ordinal, x.presupuesto_sin_iva) for x in lots(bodies).orderBy("ordinal").collect()] == [("1", 0, D("10.00")), ("2", 1, None), ("1", 2, D("20.50")), ("1", 3, None)]
    a = awards(bodies, F.lit("2025-01-01").cast("date")).orderBy("orden", "orden_ganador").collect()
    assert [(x.lote, x.cif_adjudicatario, x.id_scheme, x.adjudicatario) for x in a] == [("1", "A28141935", "nif", "Uno SL"), ("1", "U1", "UTE", None), ("2", "", None, None)]
    assert [(x.resultado, x.es_pyme, x.importe_sin_iva, x.importe_con_iva, x.n_ofertas, str(x.fecha_adjudicacion), x.presupuesto_lote_sin_iva) for x in a[1:]] == [("Formalizado", True, D("9.50"), D("11.50"), 2, "2024-03-01", D("20.50")), ("Desierto", None, None, None, None, "None", None)]
    assert {(x.licitacion_id, x.estado_expediente, x.sistema_contratacion, x.tipo_contrato) for x in a} == {("n1", "RES", "3", "2")}
