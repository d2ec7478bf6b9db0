import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st

from almoneda.llm.lookalike import canonical, is_stable, normalized, segments


@pytest.mark.parametrize(
    ("text", "code", "want"),
    [
        ("Compañía", False, "Compañía"), ("ＳＯＤＥCILI", False, "SODECILI"), ("S․L.", False, "S.L."), ("X‚ S.L.", False, "X, S.L."), ("a​b⁠c\xad", False, "abc"), ("a b\xa0c", False, "a b c"),
        ("EVENTОS", False, "EVENTOS"), ("Строймонт 71 ООД", False, "Строймонт 71 ООД"), ("Τεχνική Εταιρεία 19 ΑΕ", False, "Τεχνική Εταιρεία 19 ΑΕ"), ("Β84489676", True, "B84489676"), ("A6𝟖440232", True, "A68440232"),
        ("Jardinería S.Α.", False, "Jardinería S.A."), ("Naﬁranu", False, "Nafiranu"), ("Dª Mº Ü ñ", False, "Dª Mº Ü ñ"), ("", False, ""), (None, False, None), ("​", False, ""), ("́a", False, "́a"),
        ("áéíóú ªº", False, "áéíóú ªº"), ("Строймонт​ 71", False, "Строймонт 71"), ("x" * 100000 + "​", False, "x" * 100000),
    ],
)
def test_forms(text, code, want):
    assert canonical(text, code) == want


@given(st.text())
def test_splicing_equals_whole_normalization(text):
    """Brute force: without letters of other scripts, marks, plain signs and invisible ones, the form is NFKC of the whole."""
    kept = "".join(c for c in text if is_stable(c) and c.isascii() or c in "́̃ｅＥﬁñáéẛ")
    assert canonical(kept) == unicodedata.normalize("NFKC", kept)


@given(st.text(alphabet="aeñ ́​ＡОΑ²ª‚"))
def test_idempotent_and_segments_cover(text):
    once = canonical(text)
    assert canonical(once) == once
    inside = {i for a, b in segments(text) for i in range(a, b)}
    assert all(i in inside for i, c in enumerate(text) if not is_stable(c))


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a​", "x"), (3, "a​", "x"), (4, "a", "x")], "k long, v string, campo string")
    assert sorted(r.id for r in normalized(df, "k", {"v": False}, changed_only=True).collect()) == [3, 3]
    assert sorted(((r.id, r.limpio) for r in normalized(df, "k", {"v": False}).collect()), key=str) == [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "a")]
    assert normalized(df.limit(0), "k", {"v": False}).count() == 0
