"""Messages delivered at least once: a store that keeps exactly one copy of each.

The rows lie in partitions by the month of the kept row's arrival. An identifier index, bucketed by the key's hash, tells in which
partition a key's kept row lies. A batch looks up its keys bucket by bucket, recomputes the winners of the affected partitions together
with the incoming rows, writes only those partitions into a folder of its own, and then claims the next manifest, which is the only thing
readers follow. Whatever happens before the claim changes nothing and can be tried again; of two writers the later one starts over from
the other's result.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from almoneda.plans.runtime import Files, materialize, maybe_broadcast

PART, NONE, TRY, HASH = "__part", "none", "__try", "__hash"
EMPTY: dict = {"version": 0, "parts": {}, "index": []}


class DeliveryStore:
    """keys: identifying columns, compared as stored (null equals null). Kept is the row first by ``received``, then ``row_id``; a null
    time counts as last. Repeated rows, even with one row_id, leave one copy. An empty batch changes nothing. The names of the store's own
    columns begin with two underscores and a word no other column may have.

    ``buckets`` is the number of index buckets, fixed when the store is made; ``period`` the date pattern of a partition: months here, days
    where a month is too much to rewrite at once. ``sets`` is how many index sets may lie beside one another before they are merged.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], received: str, row_id: str, buckets: int = 16, period: str = "yyyy-MM", sets: int = 8) -> None:
        self.spark, self.root, self.keys, self.received, self.row_id = spark, root.rstrip("/"), keys, received, row_id
        self.buckets, self.period, self.sets = buckets, period, sets
        self.files = Files(spark, self.root)

    # --- manifests: a numbered file each; the highest is the truth

    def manifest(self) -> dict:
        at = f"{self.root}/manifests"
        numbers = [int(n[:-5]) for n in self.files.names(at) if n.endswith(".json") and n[:-5].isdigit()]
        return json.loads(self.files.read(f"{at}/{max(numbers):012d}.json")) if numbers else dict(EMPTY)

    def _publish(self, manifest: dict) -> bool:
        """Readers see the old manifest or the new one, never a mixture; False if another writer has made this version meanwhile."""
        return self.files.claim(f"{self.root}/manifests/{manifest['version']:012d}.json", json.dumps(manifest).encode())

    # --- rows

    def _read(self, parts: dict[str, list[str]]) -> DataFrame | None:
        """The given partitions: other files aren't opened."""
        by_folder: dict[str, list[str]] = {}
        for p, folders in parts.items():
            for f in folders:
                by_folder.setdefault(f, []).append(p)
        found = None
        for f, ps in sorted(by_folder.items()):
            at = f"{self.root}/rows/{f}"
            df = self.spark.read.option("basePath", at).parquet(*[f"{at}/{PART}={p}" for p in ps]).withColumn(PART, F.col(PART).cast("string"))
            found = df if found is None else found.unionByName(df)
        return found

    def snapshot(self) -> DataFrame | None:
        df = self._read(self.manifest()["parts"])
        return None if df is None else df.drop(PART, TRY)

    def _winners(self, rows: DataFrame) -> DataFrame:
        """One row per key by a partial (map-side combined) minimum: no key's rows are gathered in one task."""
        order = F.struct(F.col(self.received).isNull(), F.col(self.received), F.col(self.row_id))
        rest = [c for c in rows.columns if c not in self.keys]
        best = rows.groupBy(*self.keys).agg(F.min_by(F.struct(*rest), order).alias("__row"))
        return best.select(*self.keys, *[F.col("__row").getField(c).alias(c) for c in rest]).select(*rows.columns)

    def _month(self) -> Column:
        return F.coalesce(F.date_format(self.received, self.period), F.lit(NONE))

    # --- the identifier index: (hash of the key, partition)

    def _hash(self) -> Column:
        """Of the keys, nulls told from empty strings. Two keys with one hash only make a partition be looked at in vain."""
        return F.xxhash64(*[x for k in self.keys for x in (F.col(k), F.col(k).isNull())])

    def _table(self, folder: str) -> DataFrame:
        """An index set as a table whose buckets the planner knows: joins on the hash don't shuffle it."""
        name = f"almoneda_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE TABLE {name} ({HASH} BIGINT, {PART} STRING) USING parquet CLUSTERED BY ({HASH}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/index/{folder}'")
        df = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay
        return df

    def _add_index(self, entries: DataFrame) -> str:
        """Writes an index set in a folder of its own, one file a bucket."""
        name, folder = f"almoneda_{uuid.uuid4().hex}", uuid.uuid4().hex
        rows = entries.select(F.col(HASH).cast("long"), F.col(PART).cast("string")).repartition(self.buckets, HASH)
        rows.write.format("parquet").bucketBy(self.buckets, HASH).option("path", f"{self.root}/index/{folder}").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")
        return folder

    def index(self) -> list[DataFrame]:
        return [self._table(f) for f in self.manifest()["index"]]

    def lookup(self, fresh: DataFrame, sets: list[DataFrame]) -> DataFrame:
        """The partitions that hold keys of the batch. Each set is joined bucket by bucket: only the batch's hashes move."""
        asked = maybe_broadcast(fresh.select(self._hash().alias(HASH)).distinct())
        found = [s.join(asked, HASH, "left_semi").select(PART).distinct() for s in sets]
        every = found[0]
        for f in found[1:]:
            every = every.unionByName(f)
        return every.distinct()

    # --- batches

    def apply(self, incoming: DataFrame, tries: int = 5) -> dict:
        """Takes a batch in; returns what happened: the affected partitions and the version. It may be repeated after any failure, and a
        batch that was already taken in changes no kept row."""
        fresh = materialize(self._winners(incoming), "batch")  # used to look up and to write
        for _ in range(tries):
            old = self.manifest()
            done = self._merged(fresh, old)
            if self._publish(done["manifest"]):
                return {"version": done["manifest"]["version"], "affected": done["affected"], "written": done["written"]}
        raise RuntimeError(f"{tries} times another writer was faster")

    def _merged(self, fresh: DataFrame, old: dict) -> dict:
        affected: dict[str, list[str]] = {}
        if old["parts"]:
            names = {r[0] for r in self.lookup(fresh, [self._table(f) for f in old["index"]]).collect()}  # names of months, not keys
            affected = {p: f for p, f in old["parts"].items() if p in names}
        mine = uuid.uuid4().hex
        rows = fresh.withColumn(TRY, F.lit(mine))
        if affected:
            rows = self._winners(rows.unionByName(self._read(affected).drop(PART)))
        # A file or a few for each month; a month that holds most rows is split.
        rows.withColumn(PART, self._month()).hint("rebalance", PART).write.partitionBy(PART).parquet(f"{self.root}/rows/{mine}")
        written = sorted(n.split("=", 1)[1] for n in self.files.names(f"{self.root}/rows/{mine}") if n.startswith(f"{PART}="))
        sets = list(old["index"])
        if written:
            now = self._read({p: [mine] for p in written}).where(F.col(TRY) == mine)
            added = now.select(self._hash().alias(HASH), PART)
            if len(sets) >= self.sets:
                for s in sets:
                    added = added.unionByName(self._table(s))
                added, sets = added.distinct(), []
            sets.append(self._add_index(added))
        # A month that gets new keys only keeps its files and gains a folder.
        parts = {p: list(f) for p, f in old["parts"].items() if p not in affected}
        for p in written:
            parts[p] = [*parts.get(p, []), mine]
        return {"manifest": {"version": old["version"] + 1, "parts": parts, "index": sets}, "affected": sorted(affected), "written": written}

    def compact(self) -> int:
        """Joins what batches have added to a month into one folder and makes the index anew, without entries of keys that have moved;
        returns how many partitions there are. If another writer comes first, nothing changes."""
        old = self.manifest()
        many = {p: f for p, f in old["parts"].items() if len(f) > 1}
        parts = dict(old["parts"])
        if many:
            mine = uuid.uuid4().hex
            self._read(many).hint("rebalance", PART).write.partitionBy(PART).parquet(f"{self.root}/rows/{mine}")
            parts |= {p: [mine] for p in many}
        if parts and (many or len(old["index"]) > 1):
            index = self._add_index(self._read(parts).select(self._hash().alias(HASH), PART))
            self._publish({"version": old["version"] + 1, "parts": parts, "index": [index]})
        return len(parts)

    def vacuum(self, older_s: float = 86400.0) -> list[str]:
        """Deletes folders that no manifest in force names, and manifests no longer in force, once they are older than what a reader or a
        writer may still be busy with; returns what went."""
        now, gone = self.manifest(), []
        held = {"rows": {f for fs in now["parts"].values() for f in fs}, "index": set(now["index"]), "manifests": {f"{now['version']:012d}.json"}}
        for kind, names in held.items():
            for n in self.files.names(f"{self.root}/{kind}"):
                at = f"{self.root}/{kind}/{n}"
                if n not in names and self.files.modified(at) <= (time.time() - older_s) * 1000:
                    self.files.delete(at)
                    gone.append(f"{kind}/{n}")
        return gone
