import datetime as d
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from almoneda.operators.delivery import DeliveryStore
from almoneda.operators.references import RANGE, orphan_references, pack, unpack
from almoneda.operators.skew import salted_aggregate
from almoneda.plans.runtime import fresh_path, materialize, maybe_broadcast

T0 = d.datetime(2024, 1, 31, 23)


def at(h):
    return None if h is None else T0 + d.timedelta(hours=h)


# --- repeated deliveries

COLS = "clave string, lote string, t timestamp, fila long, value string, __row string"


def kept(store):
    return sorted(((r.clave, r.lote, r.fila) for r in store.snapshot().collect()), key=str)


def brute(rows):
    best = {}
    for r in rows:
        k = (r[2] is None, r[2] or T0, r[3])
        if r[:2] not in best or k < best[r[:2]][0]:
            best[r[:2]] = (k, r)
    return sorted(((k[0], k[1], r[3]) for k, (_, r) in best.items()), key=str)


def test_store_against_brute_force(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", "c", "d", None, ""]), rng.choice(["", "1", None]), at(rng.choice([None, 0, 1, 700, 1500, rng.randrange(3000)])), i, "v", "w") for i in range(300)]
    rows += rows[:20]
    store = DeliveryStore(spark, fresh_path(spark, "test"), ["clave", "lote"], "t", "fila")
    for i in range(0, len(rows), 80):
        store.apply(spark.createDataFrame(rows[i : i + 80], COLS))
        assert kept(store) == brute(rows[: i + 80])
    before = store.manifest()
    store.apply(spark.createDataFrame(rows[:80], COLS))
    assert kept(store) == brute(rows) and store.manifest()["version"] == before["version"] + 1


def test_store_rewrites_only_affected_partitions(spark):
    store = DeliveryStore(spark, fresh_path(spark, "test"), ["clave"], "t", "fila")
    df = lambda rows: spark.createDataFrame([(k, "", at(h), i, "", "") for k, h, i in rows], COLS)
    store.apply(df([("a", 0, 1), ("b", 1000, 2), ("c", 2000, 3)]))
    old = store.manifest()["parts"]
    done = store.apply(df([("b", 1001, 4), ("new", 0, 5)]))
    now = store.manifest()["parts"]
    assert done["affected"] == ["2024-03"] and now["2024-04"] == old["2024-04"] and now["2024-01"][:1] == old["2024-01"] and len(now["2024-01"]) == 2
    assert kept(store) == [("a", "", 1), ("b", "", 2), ("c", "", 3), ("new", "", 5)]
    store.apply(df([("new", -1, 6), ("a", -2, 7)]))
    assert [k[2] for k in kept(store)] == [7, 2, 3, 6]
    store.apply(df([("z", 1002, 8)]))
    assert len(store.manifest()["parts"]["2024-03"]) == 2
    before = kept(store)
    assert store.compact() == len(store.manifest()["parts"]) and kept(store) == before
    assert all(len(f) == 1 for f in store.manifest()["parts"].values())


def test_store_empty(spark):
    store = DeliveryStore(spark, fresh_path(spark, "test"), ["clave"], "t", "fila")
    assert store.snapshot() is None
    store.apply(spark.createDataFrame([], COLS))
    assert store.snapshot() is None and store.compact() == 0


def small(spark, rows):
    return spark.createDataFrame([(k, "", at(h), i, "", "") for k, h, i in rows], COLS)


@pytest.mark.parametrize("step", ["_add_index", "_publish", "claim"])
def test_store_survives_a_crash_at_every_step(spark, monkeypatch, step):
    """The batch fails after its rows or its index were written, or just before or after its manifest; then it comes again."""
    store = DeliveryStore(spark, fresh_path(spark, "test"), ["clave"], "t", "fila")
    store.apply(small(spark, [("a", 0, 1), ("b", 1000, 2)]))
    batch = small(spark, [("a", -5, 3), ("c", 1, 4), ("b", 2000, 5)])
    whole = store.files.claim if step == "claim" else getattr(store, step)

    def dies(*args):
        whole(*args) if step != "_publish" else None
        raise OSError("killed")

    with monkeypatch.context() as m:
        m.setattr(store.files if step == "claim" else store, step, dies)
        with pytest.raises(OSError):
            store.apply(batch)
    again = DeliveryStore(spark, store.root, ["clave"], "t", "fila")
    again.apply(batch)
    assert kept(again) == [("a", "", 3), ("b", "", 2), ("c", "", 4)]
    again.vacuum(0)
    folders = {f for fs in again.manifest()["parts"].values() for f in fs}
    assert set(again.files.names(f"{again.root}/rows")) == folders and kept(again) == [("a", "", 3), ("b", "", 2), ("c", "", 4)]
    assert set(again.files.names(f"{again.root}/index")) == set(again.manifest()["index"])


def test_two_writers_lose_nothing(spark, monkeypatch):
    store = DeliveryStore(spark, fresh_path(spark, "test"), ["clave"], "t", "fila")
    store.apply(small(spark, [("a", 0, 1)]))
    other, whole = DeliveryStore(spark, store.root, ["clave"], "t", "fila"), store._publish

    def late(manifest):
        if manifest["version"] == 2:
            other.apply(small(spark, [("b", 5, 2), ("a", -1, 9)]))
        return whole(manifest)

    monkeypatch.setattr(store, "_publish", late)
    done = store.apply(small(spark, [("c", 6, 3), ("b", 7, 4)]))
    assert done["version"] == 3 and kept(store) == [("a", "", 9), ("b", "", 2), ("c", "", 3)]


def test_index_is_joined_by_buckets_and_merged(spark):
    store = DeliveryStore(spark, fresh_path(spark, "test"), ["clave"], "t", "fila", buckets=4, sets=2)
    for i in range(5):
        store.apply(small(spark, [(f"k{i}", i * 700, i), ("k0", 5000, 100 + i)]))
        assert len(store.manifest()["index"]) <= 2
    plan = store.lookup(small(spark, [("k1", 0, 1)]).hint("merge"), store.index())._jdf.queryExecution().toString()
    assert "SelectedBucketsCount: 4 out of 4" in plan or "Bucketed: true" in plan
    index = store.index()[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = index.join(spark.range(3).withColumnRenamed("id", "__hash"), "__hash", "left_semi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count("Exchange hashpartitioning") == 1  # the batch's side alone
    assert kept(store) == sorted((f"k{i}", "", i) for i in range(5))
    store.compact()
    assert len(store.manifest()["index"]) == 1 and kept(store) == sorted((f"k{i}", "", i) for i in range(5))


# --- orphan references


@pytest.mark.parametrize("at_", [[], [0], [RANGE - 1], list(range(RANGE)), list(range(0, RANGE, 2)), [1, 2, 3, 9, 10]])
def test_containers_round_trip(at_):
    bits = np.zeros(RANGE, bool)
    bits[at_] = True
    raw = np.packbits(bits, bitorder="little").tobytes()
    assert (unpack(pack(raw)) == bits).all() and len(pack(raw)) <= len(raw) + 1


def test_references_against_brute_force(spark):
    rng = random.Random(3)
    keys = [f"k{i}" for i in range(60)] + [None]
    refs = [("t" if i % 3 else "u", i, rng.choice(keys[:3] if i % 2 else keys), at(rng.choice([None, rng.randrange(4000)]))) for i in range(500)]
    parents = [(rng.choice(keys[:40]), at(rng.choice([None, rng.randrange(4000)]))) for _ in range(80)]
    gone = [(k, at(rng.randrange(5000))) for k in keys[:20]] + [("never", at(1)), (None, None)]
    out = orphan_references(spark.createDataFrame(refs, "tabla string, fila_id long, clave string, momento timestamp"), spark.createDataFrame(parents, "clave string, recibido timestamp"), spark.createDataFrame(gone, "clave string, baja timestamp"))
    times = {}
    for k, t in parents:
        if k is not None:
            times.setdefault(k, []).extend([t] if t else [])
    left = {k: t for k, t in gone}
    want = set()
    for tabla, i, k, m in refs:
        kind = None
        if k is None or k not in times:
            kind = "ausente"
        elif times[k] and left.get(k) and left[k] > max(times[k]):
            kind = "borrada"
        elif times[k] and m and min(times[k]) > m:
            kind = "tardia"
        if kind:
            want.add((tabla, m.strftime("%Y-%m") if m else None, i, kind))
    assert {tuple(r) for r in out.collect()} == want


def test_references_empty(spark):
    none = spark.createDataFrame([], "tabla string, fila_id long, clave string, momento timestamp, recibido timestamp, baja timestamp")
    refs = spark.createDataFrame([("t", 1, "a", at(0))], "tabla string, fila_id long, clave string, momento timestamp")
    assert orphan_references(none, none, none).count() == 0
    assert orphan_references(refs, none, none).first().clase == "ausente"


# --- heavy keys


def test_salted_totals(spark):
    rows = [("hot" if i % 3 else f"k{i % 50}", f"d{i % 70}", None if i % 11 == 0 else i, i % 7) for i in range(4000)] + [(None, "x", 1, 1), ("n", None, None, None)]
    df = spark.createDataFrame(rows, "k string, d string, v long, n int")
    args = (F.col("k"), "n", {"s": F.col("v")}, {"lo": F.col("v")}, {"hi": F.col("v")}, {"dist": F.col("d")}, F.col("d"))
    got = {r.n: (r.s, r.lo, r.hi, r.dist) for r in salted_aggregate(df, *args, fraction=0.1, salts=8).collect()}
    want = {r.k: (r.s, r.lo, r.hi, r.dist) for r in df.groupBy("k").agg(F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.countDistinct("d").alias("dist")).collect()}
    assert got == want
    assert salted_aggregate(df.limit(0), *args).count() == 0


def test_heavy_rows_are_spread(spark):
    df = spark.createDataFrame([("hot", f"d{i}") for i in range(2000)], "k string, d string")
    plan = salted_aggregate(df, F.col("k"), "k", {"n": F.lit(1)}, {}, {}, {"x": F.col("d")}, F.col("d"))._jdf.queryExecution().toString()
    assert "__salt" in plan and "xxhash64" in plan


def test_broadcast_is_checked(spark):
    small = materialize(spark.range(10), "small")
    big = spark.range(10_000_000)
    assert "ResolvedHint" in maybe_broadcast(small)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in maybe_broadcast(big)._jdf.queryExecution().analyzed().toString()
