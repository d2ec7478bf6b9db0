"""Notice, lot and award rows out of nested feed bodies: all fields, one parse, no join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almoneda.functions.labels import RESULTS, label
from almoneda.functions.normalize import boolean, cif, clean_text, integer, money, plausible_date
from almoneda.operators.nested import VALUE, Bodies, Node, escaped, everywhere, objects, read_bodies, scalar

#: Elements that may repeat in an entry.
REPEATING = ("entry", "TenderResult", "WinningParty", "PartyIdentification", "ProcurementProjectLot")
FOLDER = "ContractFolderStatus"
#: Keys on the way to what identifies an award.
IDENTIFYING = ("feed", "entry", "id", "link", "href", FOLDER, "TenderResult", "AwardedTenderedProject", "ProcurementProjectLotID", "WinningParty", "PartyIdentification", "ID", "schemeName", *VALUE)


def feed_bodies(entries: DataFrame, key: str = "entrada_id", body: str = "cuerpo") -> Bodies:
    return read_bodies(entries, key, body)


def _named(**fields: Column) -> Column:
    """A struct whose names hold within lambdas too."""
    return F.named_struct(*[x for k, v in fields.items() for x in (F.lit(k), v)])


def _entries(bodies: Bodies) -> list[tuple[DataFrame, Node]]:
    """(doc, nodo, x) of the entries, wherever bodies have them: at the root, if it holds a folder status, and under every key 'entry'."""
    found = []
    paths = bodies.tables(REPEATING)
    ways = {p[0] for p in paths if p and p[-1] == "entry"}
    for path in paths:
        n = bodies.node(path)
        if path and path[-1] == "entry":
            found.append((bodies.at(path, REPEATING).select("doc", "nodo", "x"), n))
        elif not path and n.child(FOLDER) is not None:
            df = bodies.at(path, REPEATING, ways)
            n = n.pruned(None, {escaped(w) for w in ways})
            found.append((df.where(F.size(objects(F.col("x"), n, FOLDER)[0]) > 0).select("doc", "nodo", "x"), n))
    return found


def _union(frames: list[DataFrame], bodies: Bodies, schema: str) -> DataFrame:
    if not frames:
        key = bodies.rows.schema["doc"].dataType.simpleString()
        return bodies.rows.sparkSession.createDataFrame([], f"doc {key}, {schema}")
    return reduce(DataFrame.unionByName, frames)


def _folder(n: Node) -> tuple[Column, Node | None]:
    """The folder status of an entry; an entry without one has null fields."""
    child = n.child(FOLDER)
    if child is None or "object" not in child.kinds:
        return F.lit(None), None
    return F.get(objects(F.col("x"), n, FOLDER)[0], 0), child


def _identity(n: Node) -> tuple[Column, Column]:
    """(id, link): the id falls back to the link."""
    link = F.coalesce(scalar(F.col("x"), n, "link", "href"), F.lit("(sin enlace)"))
    return F.coalesce(clean_text(scalar(F.col("x"), n, "id")), link), link


NOTICE = "entrada_nodo string, licitacion_id string, titulo string, objeto string, enlace string, cpv array<string>, num_expediente string, organo_contratacion string, plataforma string, region string, region_codigo string, presupuesto_con_iva decimal(20,2), presupuesto_sin_iva decimal(20,2), valor_estimado decimal(20,2), fecha_fin_plazo string, fecha_publicacion string, fecha_actualizacion string"
LOT = "entrada_nodo string, lote_nodo string, ordinal int, lote string, nombre string, presupuesto_sin_iva decimal(20,2)"
AWARD = "entrada_nodo string, licitacion_id string, orden int, orden_ganador int, lote string, resultado_code string, resultado string, cif_adjudicatario string, id_scheme string, adjudicatario string, es_pyme boolean, importe_sin_iva decimal(20,2), importe_con_iva decimal(20,2), n_ofertas int, fecha_adjudicacion date, estado_expediente string, presupuesto_lote_sin_iva decimal(20,2), sistema_contratacion string, tipo_contrato string"


def notices(bodies: Bodies) -> DataFrame:
    """A row per entry, with its surrogate key: all fields but the source and the awards. The title is '(sin título)' where there is none,
    the link '(sin enlace)'; the codes are all below the entry, those of its lots too."""
    frames = []
    for df, n in _entries(bodies):
        x, (c, m) = F.col("x"), _folder(n)
        of = lambda *p, c=c, m=m: clean_text(scalar(c, m, *p))
        party, place = ("LocatedContractingParty", "Party"), ("ProcurementProject", "RealizedLocation")
        budget = lambda name: money(scalar(c, m, "ProcurementProject", "BudgetAmount", name))  # noqa: B023, E731
        ident, link = _identity(n)
        frames.append(df.select(
            "doc", F.col("nodo").alias("entrada_nodo"), ident.alias("licitacion_id"), F.coalesce(F.regexp_replace(scalar(x, n, "title"), r"(?U)^\s+|\s+\z", ""), F.lit("(sin título)")).alias("titulo"), of("ProcurementProject", "Name").alias("objeto"), link.alias("enlace"),
            everywhere(x, n, "ItemClassificationCode").alias("cpv"), of("ContractFolderID").alias("num_expediente"), of(*party, "PartyName", "Name").alias("organo_contratacion"), of(*party, "AgentParty", "PartyName", "Name").alias("plataforma"),
            of(*place, "CountrySubentity").alias("region"), of(*place, "CountrySubentityCode").alias("region_codigo"), budget("TotalAmount").alias("presupuesto_con_iva"), budget("TaxExclusiveAmount").alias("presupuesto_sin_iva"), budget("EstimatedOverallContractAmount").alias("valor_estimado"),
            of("TenderingProcess", "TenderSubmissionDeadlinePeriod", "EndDate").alias("fecha_fin_plazo"), _issue_date(n).alias("fecha_publicacion"), F.coalesce(scalar(x, n, "updated"), F.lit("")).alias("fecha_actualizacion")))
    return _union(frames, bodies, NOTICE)


def _issue_date(n: Node) -> Column:
    """The first issue date under a notice's validity block."""
    c, m = _folder(n)
    info = objects(c, m, "ValidNoticeInfo")
    if info is None:
        return F.lit(None).cast("string")
    return clean_text(F.get(F.flatten(F.transform(info[0], lambda i: everywhere(i, info[1], "IssueDate"))), 0))


def _lots(c: Column, m: Node | None) -> Column | None:
    """The entry's lots: an array of (lote, nombre, presupuesto), in their order."""
    found = objects(c, m, "ProcurementProjectLot")
    if found is None:
        return None
    a, n = found
    return F.transform(a, lambda x: _named(lote=clean_text(scalar(x, n, "ID")), nombre=clean_text(scalar(x, n, "ProcurementProject", "Name")), presupuesto=money(scalar(x, n, "ProcurementProject", "BudgetAmount", "TaxExclusiveAmount"))))


def lots(bodies: Bodies) -> DataFrame:
    """A row per lot element, repeated ones too, tied to its entry."""
    frames = []
    for df, n in _entries(bodies):
        every = _lots(*_folder(n))
        if every is not None:
            e = df.select("doc", F.col("nodo").alias("entrada_nodo"), F.posexplode(every).alias("ordinal", "l"))
            frames.append(e.select("doc", "entrada_nodo", F.concat("entrada_nodo", F.lit("/ProcurementProjectLot"), "ordinal").alias("lote_nodo"), "ordinal", F.coalesce("l.lote", F.lit("")).alias("lote"), F.col("l.nombre").alias("nombre"), F.col("l.presupuesto").alias("presupuesto_sin_iva")))
    return _union(frames, bodies, LOT)


def _winner(w: Column, n: Node | None) -> Column:
    """(valor, esquema, nombre): the identifier is the first of scheme NIF (any case), else the first."""
    none = F.lit(None).cast("string")
    party = objects(w, n, "PartyIdentification") if n is not None else None
    if party is None:
        chosen = _named(valor=none, esquema=none)
    else:
        ids = F.transform(party[0], lambda p: _identifier(p, party[1]))
        ids = F.flatten(ids)
        chosen = F.coalesce(F.get(F.filter(ids, lambda i: F.coalesce(F.upper(i["esquema"]) == "NIF", F.lit(False))), 0), F.get(ids, 0))
    return _named(valor=chosen["valor"], esquema=chosen["esquema"], nombre=clean_text(scalar(w, n, "PartyName", "Name")) if n is not None else none)


def _identifier(p: Column, n: Node) -> Column:
    """The identifiers of one party identification: an array, one each in the data as published."""
    none = F.lit(None).cast("string")
    found = []
    inner = objects(p, n, "ID")
    if inner is not None:
        a, m = inner
        places = [escaped(v) for v in VALUE if (c := m.child(v)) is not None and c.scalar is not None]
        value = lambda i: F.coalesce(*[i[f"s:{v}"].cast("string") for v in places], none)
        found.append(F.transform(a, lambda i: _named(valor=value(i), esquema=scalar(i, m, "schemeName"))))
    c, bare = n.child("ID"), f"s:{escaped('ID')}"
    if c is not None and c.scalar is not None:
        found.append(F.when(p[bare].isNotNull(), F.array(_named(valor=p[bare].cast("string"), esquema=scalar(p, n, "schemeName")))).otherwise(F.array().cast("array<struct<valor:string,esquema:string>>")))
    if not found:
        return F.array(_named(valor=scalar(p, n, "value"), esquema=scalar(p, n, "schemeName")))
    return F.concat(*found)


def awards(bodies: Bodies, as_of: Column | None = None) -> DataFrame:
    """One row per result and winner, and one with an empty identifier per result without winner, with its entry's surrogate key and the
    ordinals of result and winner. Lot and identifier are '' where there is none; the file's state, system and type are those of the
    entry itself, not of a lot; the lot's budget is the last one given for that lot's id."""
    as_of = F.current_date() if as_of is None else as_of
    frames = []
    for df, n in _entries(bodies):
        c, m = _folder(n)
        found = objects(c, m, "TenderResult") if m is not None else None
        if found is None:
            continue
        results, k = found
        win = k.child("WinningParty")
        budgets = _lots(c, m)
        empty = F.array().cast("array<struct<lote:string,nombre:string,presupuesto:decimal(20,2)>>")
        e = df.select("doc", F.col("nodo").alias("entrada_nodo"), _identity(n)[0].alias("licitacion_id"), clean_text(scalar(c, m, "ContractFolderStatusCode")).alias("estado_expediente"), clean_text(scalar(c, m, "TenderingProcess", "ContractingSystemCode")).alias("sistema_contratacion"),
                      clean_text(scalar(c, m, "ProcurementProject", "TypeCode")).alias("tipo_contrato"), (empty if budgets is None else budgets).alias("lotes"), F.posexplode(results).alias("orden", "r"))
        r = F.col("r")
        people = objects(r, k, "WinningParty")
        winners = F.array(_winner(F.lit(None), None)) if people is None else F.when(F.size(people[0]) > 0, F.transform(people[0], lambda w: _winner(w, win))).otherwise(F.array(_winner(F.lit(None), None)))
        total = ("AwardedTenderedProject", "LegalMonetaryTotal")
        of = lambda *p: scalar(r, k, *p)  # noqa: B023, E731
        e = e.select("doc", "entrada_nodo", "licitacion_id", "estado_expediente", "sistema_contratacion", "tipo_contrato", "lotes", "orden", clean_text(of("AwardedTenderedProject", "ProcurementProjectLotID")).alias("lote"), clean_text(of("ResultCode")).alias("resultado_code"),
                     boolean(of("SMEAwardedIndicator")).alias("es_pyme"), money(of(*total, "TaxExclusiveAmount")).alias("importe_sin_iva"), money(of(*total, "PayableAmount")).alias("importe_con_iva"), integer(of("ReceivedTenderQuantity")).alias("n_ofertas"),
                     plausible_date(of("AwardDate"), as_of).alias("fecha_adjudicacion"), F.posexplode(winners).alias("orden_ganador", "w"))
        own = F.try_element_at(F.filter("lotes", lambda x: (x["lote"] == F.col("lote")) & x["presupuesto"].isNotNull()), F.lit(-1))["presupuesto"]
        frames.append(e.select("doc", "entrada_nodo", "licitacion_id", "orden", "orden_ganador", F.coalesce("lote", F.lit("")).alias("lote"), "resultado_code", label(RESULTS, "resultado_code").alias("resultado"), cif("w.valor").alias("cif_adjudicatario"), clean_text("w.esquema").alias("id_scheme"), F.col("w.nombre").alias("adjudicatario"), "es_pyme", "importe_sin_iva", "importe_con_iva", "n_ofertas", "fecha_adjudicacion", "estado_expediente", own.alias("presupuesto_lote_sin_iva"), "sistema_contratacion", "tipo_contrato"))
    return _union(frames, bodies, AWARD)


def feed_awards(entries: DataFrame, key: str = "entrada_id", body: str = "cuerpo") -> DataFrame:
    """entrada_id, licitacion_id, lote, cif_adjudicatario: distinct rows, each of its entry."""
    bodies = feed_bodies(entries, key, body).only(IDENTIFYING)
    every = awards(bodies)
    return every.select(F.col("doc").alias("entrada_id"), "licitacion_id", "lote", "cif_adjudicatario").distinct()
