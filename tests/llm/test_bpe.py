import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from almoneda.llm.bpe import TOKENIZERS, RankQueue, encode_corpus, encoder
from almoneda.llm.queries import p8_ids

tokenizers = pytest.importorskip("tokenizers")
PATH = f"{TOKENIZERS}/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def theirs():
    t = tokenizers.Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_queue_gives_lowest_rank_and_leftmost_first():
    q = RankQueue(50000)
    for rank, at in ((49999, 1), (5, 9), (4096, 2), (5, 3), (64, 0)):
        q.push(rank, at)
    assert [q.pop() for _ in range(5)] == [(5, [3, 9]), (64, [0]), (4096, [2]), (49999, [1]), None]


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text_as_the_tokenizers_library(text):
    t = tokenizers.Tokenizer.from_file(PATH) if not hasattr(test_any_text_as_the_tokenizers_library, "t") else test_any_text_as_the_tokenizers_library.t
    t.encode_special_tokens = True
    test_any_text_as_the_tokenizers_library.t = t
    assert encoder(PATH).encode(text) == t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", "<|endoftext|> x", "a" * 60000, "═" * 20000, "aaaaabaaaa" * 2000, " " * 9000, "\x1c\x85\xa0 x", "😀👩‍👩‍👧 é ́"])
def test_long_and_odd_texts(text, theirs):
    assert encoder(PATH).encode(text) == theirs(text)


def test_whole_table(spark, sf, theirs):
    got = {r.doc_id: r.ids for r in p8_ids(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert got == {d.doc_id: theirs(d.text or "") for d in docs}


def test_null_empty_repeated_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "", 3), (2, "", 3), (3, "x y", 3)], "k long, text string, ids int")
    assert sorted((r.doc, r.ids) for r in encode_corpus(df, "k", "text").collect()) == [(1, []), (2, []), (2, []), (3, [87, 331])]
    assert encode_corpus(df.limit(0), "k", "text").count() == 0
