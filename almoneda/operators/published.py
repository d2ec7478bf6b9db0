"""Derived tables that are rebuilt whole: written aside, then published by one atomic step; readers never see a half."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from almoneda.plans.runtime import Files


class Published:
    """Versions of one table under a folder. A reader that holds a version keeps it until ``expire``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root)

    def _current(self) -> dict | None:
        numbers = [int(n[:-5]) for n in self.files.names(f"{self.root}/manifests") if n.endswith(".json") and n[:-5].isdigit()]
        return json.loads(self.files.read(f"{self.root}/manifests/{max(numbers):012d}.json")) if numbers else None

    def publish(self, df: DataFrame, partition_by: list[str] = ()) -> int:
        """Rebuilds the table from ``df``; returns the rows written. A failure before the last step changes nothing. The later of two
        rebuilds wins."""
        folder = uuid.uuid4().hex
        at = f"{self.root}/data/{folder}"
        df.write.partitionBy(*partition_by).parquet(at)
        n = self.spark.read.schema(df.schema).parquet(at).count()
        while True:
            now = self._current()
            version = now["version"] + 1 if now else 1
            if self.files.claim(f"{self.root}/manifests/{version:012d}.json", json.dumps({"version": version, "folder": folder, "rows": n}).encode()):
                return n

    def read(self) -> DataFrame | None:
        now = self._current()
        return None if now is None else self.spark.read.parquet(f"{self.root}/data/{now['folder']}")

    def rows(self) -> int | None:
        now = self._current()
        return None if now is None else now["rows"]

    def expire(self, older_s: float = 86400.0) -> int:
        """Deletes versions out of force that are older; returns how many."""
        now, gone = self._current(), 0
        for f in self.files.names(f"{self.root}/data"):
            at = f"{self.root}/data/{f}"
            if (now is None or f != now["folder"]) and self.files.modified(at) <= (time.time() - older_s) * 1000:
                self.files.delete(at)
                gone += 1
        return gone


class State:
    """A small record kept as a file and replaced as a whole: checkpoints of a load, a configuration. Missing or empty gives the default."""

    def __init__(self, spark: SparkSession, at: str) -> None:
        self.at, self.files = at, Files(spark, at)

    def load(self, default: dict | None = None) -> dict:
        if not self.files.exists(self.at):
            return dict(default or {})
        try:
            return json.loads(self.files.read(self.at)) or dict(default or {})
        except ValueError:
            return dict(default or {})

    def save(self, record: dict) -> None:
        aside = f"{self.at}.{uuid.uuid4().hex}"
        self.files.write(aside, json.dumps(record, ensure_ascii=False, indent=1, sort_keys=True).encode())
        self.files.replace(aside, self.at)


class LoadState:
    """Which units (archives) are loaded whole, and which documents of the unit under way: a load that stops goes on where it was. When a unit is
    done its documents are dropped from the record."""

    def __init__(self, spark: SparkSession, at: str) -> None:
        self.state = State(spark, at)
        got = self.state.load({"units": [], "documents": {}})
        self.units, self.documents = set(got.get("units", [])), {k: set(v) for k, v in got.get("documents", {}).items()}

    def pending(self, units: list[str]) -> list[str]:
        return [u for u in units if u not in self.units]

    def seen(self, unit: str, document: str) -> bool:
        return document in self.documents.get(unit, ())

    def done(self, unit: str, documents: list[str] | None = None) -> None:
        """Documents of a unit, or, without any, the unit as a whole."""
        if documents is None:
            self.units.add(unit)
            self.documents.pop(unit, None)
        else:
            self.documents.setdefault(unit, set()).update(documents)
        self.state.save({"units": sorted(self.units), "documents": {k: sorted(v) for k, v in self.documents.items()}})
