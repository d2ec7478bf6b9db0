"""Mixing sources to target shares of the total tokens.

A classifier fitted on the labelled documents gives every document its membership of each domain; a document with a label is wholly of
its own. Projected-gradient least squares then fits a rate to every document, between nothing and its cap, so that the expected tokens
of each domain meet the targets. An iteration is one pass that sums a number per domain; a document's rate is never stored but
follows from the few residuals so far. The rates are rounded to whole repetitions so that each stratum keeps its sum.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almoneda.plans.runtime import materialize

#: Documents a stratum of the rounding has at most, about.
STRATUM = 200_000


class Model(NamedTuple):
    """Naive Bayes over the whole vocabulary; its log odds are tempered, because neighbouring tokens repeat one another's evidence.
    ``loss`` and ``plain`` are the mean negative log likelihoods of held-out labels with the tempering and by the domains' frequencies alone."""

    domains: list[str]
    prior: np.ndarray
    weight: np.ndarray
    temper: float
    loss: float | None = None
    plain: float | None = None

    def posterior(self, ids: np.ndarray) -> np.ndarray:
        x = self.prior.copy()
        if len(ids):
            x += self.temper * math.sqrt(len(ids)) * self.weight[:, np.minimum(ids, self.weight.shape[1] - 1)].mean(axis=1)
        x = np.exp(x - x.max())
        return x / x.sum()


    def posteriors(self, ids: np.ndarray) -> list[np.ndarray]:
        """For each temper tried."""
        means = math.sqrt(len(ids)) * self.weight[:, np.minimum(ids, self.weight.shape[1] - 1)].mean(axis=1) if len(ids) else np.zeros(len(self.prior))
        x = self.prior + np.array(TEMPERS)[:, None] * means
        x = np.exp(x - x.max(axis=1, keepdims=True))
        return list(x / x.sum(axis=1, keepdims=True))


#: Tempers tried; 0 leaves the domains' frequencies alone.
TEMPERS = (0.0, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7, 1.0, 1.5)


def fit(docs: DataFrame, domains: list[str]) -> Model:
    """From (doc, source, ids): counts of four fifths of all labelled documents, tempered by what explains the last fifth best."""
    labelled = docs.where(F.col("source").isin(*domains)) if domains else docs.limit(0)
    held = F.pmod(F.xxhash64("doc", F.lit(23)), F.lit(5)) == 0
    model = _counts(labelled.where(~held), domains)
    if len(model.domains) < 2:
        return model
    place = {d: i for i, d in enumerate(model.domains)}

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(TEMPERS)), 0
        for b in batches:
            for s, ids in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                i = place.get(s)
                if i is not None:
                    x = ids.values.to_numpy()
                    total += [math.log(max(p[i], 1e-30)) for p in model.posteriors(x)]
                    seen += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(len(TEMPERS)), pa.int32()), pa.array(total), pa.array([seen] * len(TEMPERS), pa.int64())], ["t", "x", "n"])

    scores = labelled.where(held).select("source", "ids").mapInArrow(score, "t int, x double, n long").groupBy("t").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect()
    best = max(scores, key=lambda r: (r.x, -r.t), default=None)
    if best is None or not best.n:
        return model
    return model._replace(temper=TEMPERS[best.t], loss=-best.x / best.n, plain=-next(r.x for r in scores if TEMPERS[r.t] == 0) / best.n)


def _counts(docs: DataFrame, domains: list[str], temper: float = 0.2) -> Model:
    """From (source, ids); domains without any are left out. What reaches the driver is one count per domain and token id, in the end a
    matrix as large as the vocabulary times the domains. An id that no labelled document has counts as once."""
    place = {d: i for i, d in enumerate(domains)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = np.zeros((len(domains), 1 << 12), np.int64), np.zeros(len(domains), np.int64)
        for b in batches:
            for s, ids in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                i = place.get(s)
                if i is not None:
                    seen[i] += 1
                    got = np.bincount(ids.values.to_numpy())
                    if len(got) > n.shape[1]:
                        n = np.pad(n, ((0, 0), (0, max(len(got), 2 * n.shape[1]) - n.shape[1])))
                    n[i, : len(got)] += got
        at = np.argwhere(n)
        d = np.r_[at[:, 0], np.arange(len(domains))].astype(np.int32)
        k = np.r_[at[:, 1], np.full(len(domains), -1)].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(k), pa.array(np.r_[n[n > 0], seen])], ["d", "k", "n"])

    rows = docs.select("source", "ids").mapInArrow(count, "d int, k int, n long").groupBy("d", "k").agg(F.sum("n").alias("n")).toPandas()
    words = rows[rows.k >= 0]
    n, seen = np.ones((len(domains), int(words.k.max()) + 2 if len(words) else 1)), np.zeros(len(domains))  # the last stands for ids beyond
    n[words.d, words.k] += words.n
    seen[rows[rows.k < 0].d] += rows[rows.k < 0].n
    known = np.flatnonzero(seen)
    n, seen = n[known], seen[known]
    return Model([domains[i] for i in known], np.log(seen / max(seen.sum(), 1)), np.log(n / n.sum(axis=1, keepdims=True)), temper)


def memberships(docs: DataFrame, model: Model, caps: dict[str, int]) -> DataFrame:
    """(doc, source, n, p, tope): tokens, shares of membership and the most repetitions. A document without a label gets the cap of its
    likeliest domain; one whose label has no target share gets none."""
    place = {d: i for i, d in enumerate(model.domains)}
    cap = [caps[d] for d in model.domains]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p, tope, n = [], [], []
            for s, ids in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                x = np.zeros(len(cap))
                if s is None and len(cap):
                    x = model.posterior(ids.values.to_numpy())
                elif s in place:
                    x[place[s]] = 1
                p.append(x)
                n.append(len(ids.values))
                tope.append(cap[int(x.argmax())] if x.any() else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(p, pa.list_(pa.float64())), pa.array(tope, pa.int32())], ["doc", "source", "n", "p", "tope"])

    return docs.select(F.col("doc").cast("long").alias("doc"), "source", "ids").mapInArrow(run, "doc long, source string, n long, p array<double>, tope int")


def rates(p: np.ndarray, cap: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """The rates after the steps taken so far, from a start of nothing: each a gradient step in the caps' own scale, then the projection."""
    r = np.zeros(len(cap))
    for v in steps:
        r = np.clip(r - cap * (p @ v), 0, cap)
    return r


def _matrix(p: pd.Series, k: int) -> np.ndarray:
    return np.stack(p.to_numpy()) if len(p) else np.zeros((0, k))


def _sums(docs: DataFrame, steps: list[np.ndarray] | None, k: int) -> np.ndarray:
    """Tokens of each domain at the rates of these steps; with None, at the caps."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(k)
        for b in batches:
            p, cap = _matrix(b["p"], k), b["tope"].to_numpy(float)
            r = cap if steps is None else rates(p, cap, steps)
            total += (r * b["n"].to_numpy(float)) @ p
        yield pd.DataFrame({"d": np.arange(k), "x": total})

    out = np.zeros(k)
    for d, x in docs.select("n", "p", "tope").mapInPandas(run, "d int, x double").groupBy("d").agg(F.sum("x")).collect():
        out[d] = x
    return out


class Fit(NamedTuple):
    """The steps taken, the size aimed at, the largest distance from a domain's goal as a share of the size, and whether it is within bounds."""

    steps: list[np.ndarray]
    size: float
    gap: float
    converged: bool


def solve(docs: DataFrame, shares: np.ndarray, total: float | None, close: float = 1e-4, patience: int = 8) -> Fit:
    """The steps that bring the domains' expected tokens to ``shares`` of ``total`` tokens; by default the most that the caps allow at
    these shares. It goes on until that is met within ``close``, or until ``patience`` passes have brought it no nearer: then the goals
    can't be met, and the fit says so."""
    k = len(shares)
    room = _sums(docs, None, k)
    if not k or not (room > 0).any():
        return Fit([], 0.0, 0.0, True)
    wanted = np.where(room > 0, shares, 0.0)
    wanted = wanted / wanted.sum() if wanted.sum() else wanted
    size = min((room[i] / w for i, w in enumerate(wanted) if w > 0), default=0.0)
    size = size if total is None else total
    goal, steps = wanted * size, []
    now, best, idle = np.zeros(k), math.inf, 0
    while True:
        gap = float(np.abs(now - goal).max()) / max(size, 1e-9)
        if gap <= close or size <= 0:
            return Fit(steps, size, gap, True)
        idle = 0 if gap < best * 0.99 else idle + 1
        best = min(best, gap)
        if idle >= patience:
            return Fit(steps, size, gap, False)
        steps.append(np.where(room > 0, (now - goal) / np.maximum(room, 1e-9), 0.0))
        now = _sums(docs, steps, k)


def _rounded(docs: DataFrame, steps: list[np.ndarray], k: int) -> DataFrame:
    """Adds ``tasa`` and ``repeticiones``. Within a stratum (likeliest domain and a hash of the document) the repetitions up to any document
    differ from the rates' sum by less than one, in the order of length: neither number nor size of the chosen drifts."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = _matrix(b["p"], k)
            r = rates(p, b["tope"].to_numpy(float), steps) if steps else np.zeros(len(b))
            yield b.assign(tasa=r, dominio=p.argmax(axis=1) if k else 0)

    rated = docs.mapInPandas(run, "doc long, source string, n long, p array<double>, tope int, tasa double, dominio int").where("tasa > 0")
    strata = max(1, math.ceil(docs.count() / STRATUM))
    w = Window.partitionBy("dominio", F.pmod(F.xxhash64("doc"), F.lit(strata))).orderBy("n", "doc").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum("tasa").over(w)
    whole = rated.withColumn("hasta", upto).withColumn("repeticiones", F.least(F.floor(F.col("hasta") + 0.5) - F.floor(F.col("hasta") - F.col("tasa") + 0.5), F.col("tope").cast("long")).cast("int"))
    return whole.drop("hasta")


def mix(docs: DataFrame, weights: DataFrame, total: float | None = None) -> tuple[DataFrame, DataFrame]:
    """docs (doc, source, ids) and weights (source, peso, max_repeticiones), a small table, to the mix and the shares reached.

    The mix has doc, source, n_tokens, tasa, repeticiones of the documents used at least once. The shares have, for each weighted source,
    its target (its weight over those of sources that can give anything), the tokens taken, by membership, and their share; and for all
    alike the passes of the fit, its distance from the goals, whether it converged, and the classifier's tempering and held-out losses.
    Sources without documents or tokens get a target of nothing. Documents of sources without a weight aren't used; empty and null
    texts have no tokens and can't move a share. Null weights and caps count as 0; of repeated weights the largest counts. Without
    documents or weights the mix is empty.
    """
    table = weights.where("source is not null").groupBy("source").agg(F.max(F.coalesce("peso", F.lit(0.0))).alias("peso"), F.max(F.coalesce("max_repeticiones", F.lit(0))).alias("tope")).orderBy("source").collect()
    caps = {r.source: r.tope for r in table}
    docs = docs.select("doc", "source", "ids")
    model = fit(docs, [r.source for r in table])
    domains = model.domains
    members = materialize(memberships(docs, model, caps).where("n > 0"), "memberships")
    by_name = {r.source: r.peso for r in table}
    shares = np.array([by_name[d] for d in domains])
    fitted = solve(members, shares, total)
    chosen = materialize(_rounded(members, fitted.steps, len(domains)).where("repeticiones > 0"), "mix")
    spark = docs.sparkSession
    taken = chosen.select(F.posexplode("p").alias("d", "m"), "n", "repeticiones").groupBy("d").agg(F.sum(F.col("m") * F.col("n") * F.col("repeticiones")).alias("tokens"))
    room = _sums(members, None, len(domains))
    wanted = np.where(room > 0, shares, 0.0)
    wanted = wanted / wanted.sum() if wanted.sum() else wanted
    goals = dict(zip(domains, wanted.tolist(), strict=True))
    places = {d: i for i, d in enumerate(domains)}
    aim = spark.createDataFrame([(places.get(r.source, -1), r.source, float(r.peso), float(goals.get(r.source, 0.0)), int(r.tope)) for r in table], "d int, source string, peso double, objetivo double, max_repeticiones int")
    report = aim.join(F.broadcast(taken), "d", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0.0)))
    whole = F.sum("tokens").over(Window.partitionBy(F.lit(0)))  # one row a weighted source
    report = report.select("source", "peso", "objetivo", "max_repeticiones", F.round("tokens", 1).alias("tokens"), F.round(F.when(whole > 0, F.col("tokens") / whole).otherwise(0.0), 6).alias("cuota"),
                           F.lit(len(fitted.steps)).alias("pasos"), F.lit(fitted.gap).alias("distancia"), F.lit(fitted.converged).alias("convergido"), F.lit(model.temper).alias("temple"), F.lit(model.loss).cast("double").alias("perdida"), F.lit(model.plain).cast("double").alias("perdida_sin_texto"))
    return chosen.select("doc", "source", F.col("n").alias("n_tokens"), "tasa", "repeticiones"), report
