import numpy as np
import pytest

from pyspark.sql import functions as F

from almoneda.llm.mixing import fit, mix, rates, solve
from almoneda.llm.queries import _mix


def table(spark, docs, weights):
    return spark.createDataFrame(docs, "doc long, source string, ids array<int>, tope string"), spark.createDataFrame(weights, "source string, peso double, max_repeticiones int")


def test_shares_and_caps(spark):
    docs = [(i, "a", [1, 2] * 20, "z") for i in range(40)] + [(100 + i, "b", [7, 8] * 20, "z") for i in range(200)] + [(400, None, [7, 8] * 20, "z"), (401, "c", [3] * 40, "z"), (402, "a", [], "z"), (403, "a", None, "z")]
    df, w = table(spark, docs, [("a", 0.5, 3), ("b", 0.3, 1), ("empty", 0.2, 9), (None, 1.0, 1), ("nul", None, None)])
    df = df.withColumn("ids", F.coalesce("ids", F.array().cast("array<int>")))
    m, report = mix(df, w)
    rows, shares = m.collect(), {r.source: r for r in report.collect()}
    assert all(r.repeticiones <= {"a": 3, "b": 1, None: 1}[r.source] for r in rows) and not any(r.source == "c" for r in rows)
    assert shares["a"].cuota == pytest.approx(0.625, abs=0.02) and shares["b"].cuota == pytest.approx(0.375, abs=0.02) and shares["empty"].tokens == 0
    again = mix(df, w)[0].collect()
    assert sorted(again) == sorted(rows)


def test_empty(spark):
    df, w = table(spark, [], [("a", 1.0, 1)])
    assert mix(df, w)[0].count() == 0 and mix(df, w)[1].count() == 1
    df, w = table(spark, [(1, "a", [1], "z")], [])
    assert mix(df, w)[0].count() == 0


def test_gradient_agrees_with_brute_force(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3] * 3, 300)
    n, cap = rng.integers(5, 200, 300), rng.integers(1, 4, 300)
    df = spark.createDataFrame([(int(a), [float(x) for x in b], int(c)) for a, b, c in zip(n, p, cap)], "n long, p array<double>, tope int")
    shares = np.array([0.5, 0.3, 0.2])
    total = 0.3 * float((n * cap).sum())
    fitted = solve(df, shares, total)
    got = (rates(p, cap.astype(float), fitted.steps) * n) @ p
    assert fitted.converged and fitted.size == total and np.abs(got / got.sum() - shares).max() < 0.01


def test_goals_out_of_reach_are_told(spark):
    """All documents are half of each domain: no rates give nine to one."""
    df = spark.createDataFrame([(10, [0.5, 0.5], 2)] * 20, "n long, p array<double>, tope int")
    fitted = solve(df, np.array([0.9, 0.1]), 200.0)
    assert not fitted.converged and fitted.gap > 0.3


def test_every_token_id_counts_by_itself(spark):
    """Ids that a smaller table would fold together tell the domains apart."""
    rows = [(i, "ab"[i % 2], [7 + 4096 * (i % 2), 50_000]) for i in range(200)]
    model = fit(spark.createDataFrame(rows, "doc long, source string, ids array<int>"), ["a", "b"])
    assert model.posterior(np.array([7])).argmax() == 0 and model.posterior(np.array([4103])).argmax() == 1 and model.posterior(np.array([10**6])).sum() == pytest.approx(1)
    assert model.loss < model.plain


def test_classifier_on_held_out(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "ab"[i % 2], [int(x) for x in rng.integers(0, 50, 60) + 25 * (i % 2)]) for i in range(400)]
    model = fit(spark.createDataFrame(rows, "doc long, source string, ids array<int>"), ["a", "b", "none"])
    fresh = [(i, rng.integers(0, 50, 60) + 25 * (i % 2)) for i in range(200)]
    assert model.temper > 0 and model.domains == ["a", "b"]
    assert np.mean([model.posterior(x).argmax() == i % 2 for i, x in fresh]) > 0.95


def test_classifier_never_loses_to_the_frequencies(spark):
    docs = _docs(spark)
    test = docs.where("doc % 5 = 0 and source is not null").collect()
    model = fit(docs.where("doc % 5 != 0"), sorted({r.source for r in test}))
    place = {d: i for i, d in enumerate(model.domains)}
    loss = lambda m: -np.mean([np.log(m.posterior(np.array(r.ids, dtype=int))[place[r.source]]) for r in test if r.source in place])
    assert loss(model) <= loss(model._replace(temper=0.0)) + 0.02


def _docs(spark):
    from almoneda.llm.bpe import encode_corpus

    return encode_corpus(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id", "text", also={"source": F.col("source")}).cache()


def test_on_the_tables(spark, sf):
    m, report = _mix(spark, "/root/testdata/sf0.01")
    assert m.count() > 0 and max(abs(r.cuota - r.objetivo) for r in report.collect()) < 0.05
