from almoneda.llm.names import ends_whole, is_stand_in
from almoneda.llm.queries import p1_found, p1_survivors
from almoneda.llm.survivors import cut_names, elect, judged_names, pivot_back

COLS = "grupo string, campo string, norma string, valor string, registro long, momento timestamp, confianza int, extra string"


def rows(spark, data):
    import datetime as d

    return spark.createDataFrame([(g, c, n, v, r, None if t is None else d.datetime(2024, 1, 1) + d.timedelta(seconds=t), k, "x") for g, c, n, v, r, t, k in data], COLS)


def test_newest_then_smallest_id_then_trust(spark):
    df = rows(spark, [("a", "f", "x", "X", 1, 10, 4), ("a", "f", "y", "Y", 2, 500, 1), ("a", "f", "y", "y", 3, 500, 1), ("b", "f", "x", "X", 9, 5, 1), ("b", "f", "y", "Y", 8, 5, 1), ("c", "f", "x", "X", 7, None, None), ("a", "h", "z", "Z", 1, 10, 1)] * 2)
    got = {(r.grupo, r.campo): (r.valor, r.registro) for r in elect(df, 1.0).collect()}
    assert got == {("a", "f"): ("Y", 2), ("b", "f"): ("Y", 8), ("c", "f"): ("X", 7), ("a", "h"): ("Z", 1)}
    wide = {r.grupo: (r.f, r.h) for r in pivot_back(elect(df, 1.0), ["f", "h"]).collect()}
    assert wide == {"a": ("Y", "Z"), "b": ("Y", None), "c": ("X", None)}


def test_votes_of_older_values_add_up_with_a_long_half_life(spark):
    df = rows(spark, [("a", "f", "x", "X", 1, 0, 1), ("a", "f", "x", "X", 2, 10, 1), ("a", "f", "y", "Y", 3, 20, 1)])
    assert elect(df, 1e9).first().registro == 2 and elect(df, 1.0).first().registro == 3
    assert elect(df.limit(0), 1.0).count() == 0


def test_votes_by_days(spark):
    """With the half-life in use: days outweigh agreement, hours don't; trust counts."""
    from almoneda.llm.queries import HALF_LIFE_S

    day, hour = 86400, 3600
    df = rows(spark, [("a", "f", "x", "X", 1, 0, 1), ("a", "f", "x", "X", 2, hour, 1), ("a", "f", "y", "Y", 3, 10 * day, 1), ("b", "f", "x", "X", 1, 0, 1), ("b", "f", "x", "X", 2, hour, 1), ("b", "f", "y", "Y", 3, 2 * hour, 1), ("c", "f", "x", "X", 1, 0, 4), ("c", "f", "y", "Y", 2, hour, 1)])
    assert {r.grupo: r.valor for r in elect(df, HALF_LIFE_S).collect()} == {"a": "Y", "b": "X", "c": "X"}


def test_stand_ins_and_cut_names(spark):
    assert all(map(is_stand_in, [None, "", "  ", "n.a.", "N/D", "???", "XXXXX", "No consta", "Ver resolución", "-", "s/n"])) and not is_stand_in("Строймонт 7")
    assert ends_whole("Uno Dos, S.L.U.", True) and ends_whole("UNO S․COOP.", True) and not ends_whole("Uno Dos Tr", True) and not ends_whole("Isabel Gude", False)
    df = spark.createDataFrame([("k", "ISABELGUDEFE"), ("k", "ISABELGUDEFEBELO"), ("k", "ISABELGUDEFEBELORIFA"), ("j", "ISABELGUDEFE"), (None, "X"), ("k", "BELO"), ("s", "IS"), ("s", "ISABEL"), ("s", "B"), ("t", "B"), ("t", "BE"), ("t", "BEL"), ("", ""), ("t", "")], "d string, norma string")
    assert {(r.d, r.norma) for r in cut_names(df, "d").collect()} == {("k", "ISABELGUDEFE"), ("k", "ISABELGUDEFEBELO"), ("s", "IS"), ("t", "B"), ("t", "BE")}
    long = spark.createDataFrame([("A B C", False), ("A B", False), ("A B", None), (None, True), ("y" * 50000, None)], "valor string, empresa boolean")
    assert sorted(((r.valor[:5], r.empresa, r.posible) for r in judged_names(long).collect()), key=str) == sorted([("A B C", False, True), ("A B", False, False), ("A B", None, True), ("yyyyy", None, True)], key=str)


def test_dates_and_amounts_match_brute_force(spark, sf):
    import re

    groups = {}
    for r in spark.read.parquet(f"{sf}/competidores.parquet").collect():
        k = re.sub(r"[\s./-]", "", r.cif or "").upper()
        if re.fullmatch(r"[A-Z]\d{8}|\d{8}[A-Z]", k):
            groups.setdefault(k, []).append(r)
    want = set()
    for g in groups.values():
        if len(g) > 1:
            for f, ok in (("importe_total_sin_iva", lambda v: 0.01 < v < 9999999999), ("primera_adjudicacion", lambda v: 1990 <= v.year <= 2090), ("ultima_adjudicacion", lambda v: 1990 <= v.year <= 2090)):
                usable = [r for r in g if r[f] is not None and ok(r[f])]
                if usable:
                    want.add((max(usable, key=lambda r: (r.updated_at, -r.ficha_id)).ficha_id, f))
    got = {(r.registro_id, r.campo) for r in p1_found(spark, sf).collect() if r.campo not in ("nombre_canonico", "adjudicatario")}
    assert got == want
    assert p1_survivors(spark, sf).count() >= 1


def test_totals_above_the_filler_are_real(spark, sf, tmp_path):
    """Expected by hand: the newest total of each CIF that is none of the stand-ins, however large."""
    import datetime as d
    from decimal import Decimal
    from pathlib import Path

    for t in ("adjudicaciones", "fuentes"):
        (tmp_path / f"{t}.parquet").symlink_to(Path(sf, f"{t}.parquet"))
    data = [
        (10, "A11111111", "5000000.00", 1), (11, "A11111111", "13000000000.50", 2),
        (20, "B22222222", "46000000000.00", 1), (21, "B22222222", "9999999999.99", 2),
        (30, "B33333333", "1.00", 1), (31, "B33333333", "9999999999.00", 2), (32, "B33333333", "0.01", 3), (33, "B33333333", "0.00", 4), (34, "B33333333", "-1.00", 5),
        (40, "B44444444", "2.00", 1), (41, "B44444444", "123456789012345678901234.56", 2),
        (50, "B55555555", "9999999999.99", 1), (51, "B55555555", "0.01", 2),
        (60, "B66666666", "10000000000.00", 1), (61, "B66666666", None, 2),
    ]
    data = [(i, c, None if v is None else Decimal(v), d.datetime(2024, 1, day)) for i, c, v, day in data]
    like = spark.read.parquet(f"{sf}/competidores.parquet")
    rows = spark.createDataFrame(data, "ficha_id long, cif string, importe_total_sin_iva decimal(30,2), updated_at timestamp")
    like.limit(0).unionByName(rows, allowMissingColumns=True).write.parquet(f"{tmp_path}/competidores.parquet")
    assert {r.registro_id for r in p1_found(spark, str(tmp_path)).where("campo = 'importe_total_sin_iva'").collect()} == {11, 20, 31, 41, 60}
