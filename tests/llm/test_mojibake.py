import pytest

from almoneda.llm.mojibake import chains, garble, garbled_documents, restored_documents, ungarble

TEXT = "La duración del contrato será de años; garantía técnica según cláusula. Precio € «único»"


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, f"{TEXT} {i}", i) for i in range(12)] + [(20, None, 0), (21, "", 0), (22, "plain", 0), (23, "Ãmbar® Âncora© ≤ ≥ LICITAÇÃO ╔═╗ d’EXÉCUTION", 0), (24, "x" * 200000 + " fin", 0)]
    broken = {}
    for j, c in enumerate(chains()):
        g = garble(TEXT, c)
        if g is not None:
            broken[100 + j] = c
            rows.append((100 + j, g, 0))
    rows.append((300, "sound text, licitación " + garble("duración", ("utf-8", "cp1252")), 0))
    return spark.createDataFrame(rows + [rows[0]], "k long, t string, w int"), broken


def test_round_trip_of_every_chain_with_an_inverse():
    for c in chains():
        g = garble("señal técnica", c)
        if g is not None and "utf-8" not in c[1::2]:
            assert ungarble(g, c) == "señal técnica"
    assert garble("plain", ("utf-8", "cp1252")) is None and garble("€", ("mac_roman", "latin-1")) == "Û"


def test_found_and_restored(corpus):
    df, broken = corpus
    found = {r.doc for r in garbled_documents(df, "k", "t").collect()}
    assert found == set(broken) | {300}
    back = {r.doc: r.text for r in restored_documents(df, "k", "t").collect()}
    lossless = [k for k, c in broken.items() if "utf-8" not in c[1::2]]
    assert sum(back[k] == TEXT for k in lossless) >= 0.9 * len(lossless)
    assert back[300] == "sound text, licitación duración"


def test_words_that_occur_nowhere_else_are_led_back_too(spark):
    chain = ("mac_roman", "cp1250")
    rows = [(i, f"{TEXT} {i}") for i in range(12)] + [(100, garble(TEXT + " Tifisó Lopoés", chain)), (101, garble("la duración de Bufotuín", chain) + " y Zorobelú—Mañé: 2020–2021 — Ålesund")]
    back = {r.doc: r.text for r in restored_documents(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()}
    assert back[100] == TEXT + " Tifisó Lopoés" and back[101].startswith("la duración de Bufotuín y") and back[101].endswith(": 2020–2021 — Ålesund")


def test_a_lone_symbol_needs_much_better_attestation(spark):
    rows = [(i, "cuesta 5 € hoy") for i in range(400)] + [(500, "cuesta 5 Ç hoy")] + [(600 + i, "art. § 3") for i in range(5)] + [(700 + i, "n.º 4") for i in range(60)]
    assert [r.doc for r in garbled_documents(spark.createDataFrame(rows, "k long, t string"), "k", "t").collect()] == [500]


def test_empty(spark):
    none = spark.createDataFrame([], "k long, t string")
    assert garbled_documents(none, "k", "t").count() == 0 and restored_documents(none, "k", "t").count() == 0


@pytest.mark.parametrize("chain", [("utf-8", "latin-1"), ("cp1252", "mac_roman")])
def test_copies_of_a_garbled_text_do_not_hide_it(spark, chain):
    """A garbled text copied to as many rows as there are sound ones is found in every copy, and no sound text is found in its place."""
    sound = [(i, f"{TEXT} {i}") for i in range(12)]
    copies = [(100 + i, garble(TEXT, chain)) for i in range(12)]
    one = [(300, "sound text, licitación " + garble("duración", ("utf-8", "cp1252"))), (301, "la duración y la técnica")]
    df = spark.createDataFrame(sound + copies + one, "k long, t string")
    assert {r.doc for r in garbled_documents(df, "k", "t").collect()} == {k for k, _ in copies} | {300}
    back = {r.doc: r.text for r in restored_documents(df, "k", "t").collect()}
    assert back[300] == "sound text, licitación duración" and all(back[k] == TEXT for k, _ in copies)


def test_utf8_is_garbled_however_often_it_occurs(spark):
    """Distinct garbled texts in the majority: the way back decides, not the frequency. What decodes to nothing known stays."""
    sound = [(i, f"{TEXT} {i}") for i in range(3)] + [(50, "MAÇÃ® ╔═╗ Ç» É– ≤≥ Ãmbar® Âncora© СТРОЙМОНТ» ═╗")]
    bad = [(100 + i, garble(f"{TEXT} {i}", ("utf-8", r))) for i, r in enumerate(["latin-1", "cp1252", "cp1250", "cp437", "mac_roman"] * 8)]
    df = spark.createDataFrame(sound + bad, "k long, t string")
    assert {r.doc for r in garbled_documents(df, "k", "t").collect()} == {k for k, _ in bad}
    assert all(r.text == f"{TEXT} {r.doc - 100}" for r in restored_documents(df, "k", "t").collect())


def test_blank_texts_of_hard_spaces_are_sound(spark):
    df = spark.createDataFrame([(i, f"á {i}") for i in range(300)] + [(500 + i, "\xa0") for i in range(3)], "k long, t string")
    assert garbled_documents(df, "k", "t").count() == 0
