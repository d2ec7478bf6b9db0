"""Feed pages, archives and lists as DataFrames. The engine starts at files; a paged source follows links between pages."""

from __future__ import annotations

import io
import json
import re
import time
import zipfile
import zlib
from collections.abc import Iterator
from datetime import date
from typing import IO
from urllib.parse import urljoin
from urllib.request import urlopen
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

#: Fixed value: pages read of a feed at most, unless more are asked for; the feed's state tells.
MAX_PAGES = 20


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def as_tree(e: ElementTree.Element) -> object:
    """An element as nested objects: repeated children as arrays, attributes beside the text, names without name spaces."""
    kids: dict[str, object] = {_local(k): v for k, v in e.attrib.items()}
    for c in e:
        v, k = as_tree(c), _local(c.tag)
        if k in kids:
            kids[k] = [*kids[k], v] if isinstance(kids[k], list) else [kids[k], v]
        else:
            kids[k] = v
    text = (e.text or "").strip() or None
    if not kids:
        return text
    return kids | {"#text": text} if text is not None else kids


def entries_in(stream: IO[bytes]) -> Iterator[str | None]:
    """The entries of a feed document, as JSON, one at a time as they are read; a damaged document gives those before the damage and then
    raises ParseError."""
    for _, e in ElementTree.iterparse(stream):
        if _local(e.tag) == "entry":
            yield json.dumps({"entry": as_tree(e)}, ensure_ascii=False)
            e.clear()


def entries_of(data: bytes) -> tuple[list[str], str | None, str | None]:
    """(entries, next link, error) of a feed document."""
    out: list[str] = []
    link = None
    try:
        for _, e in ElementTree.iterparse(io.BytesIO(data)):
            tag = _local(e.tag)
            if tag == "entry":
                out.append(json.dumps({"entry": as_tree(e)}, ensure_ascii=False))
                e.clear()
            elif tag == "link" and e.get("rel") == "next":
                link = e.get("href")
    except ElementTree.ParseError as err:
        return out, link, f"damaged document: {err}"
    return out, link, None


ARCHIVED = "archivo string, documento string, posicion int, cuerpo string, error string"
#: Bytes of members, uncompressed, that one task takes.
TASK_BYTES = 64 << 20


class ArchiveFeed(DataSource):
    """spark.read.format("archive_feed").load(folder): every entry of the archives and feed documents below a folder of the shared store, in
    the columns of ARCHIVED. Only the archives' directories are read for planning; a task opens its members by itself and reads entry after
    entry, so that no archive or document is held as a whole; archives within archives are read from the stream too. What is damaged gives a
    row with ``error`` and no body, after the rows that could be read."""

    @classmethod
    def name(cls) -> str:
        return "archive_feed"

    def schema(self) -> str:
        return ARCHIVED

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader(self.options)


class _ArchiveReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.at = options["path"]
        self.task_bytes = int(options.get("task_bytes", TASK_BYTES))

    def partitions(self):
        """Groups of members, [(archive, member or none for a plain document, error)]."""
        from pyarrow import fs
        from pyspark.sql.datasource import InputPartition

        store, root = fs.FileSystem.from_uri(self.at)
        files = sorted((f.path, f.size) for f in store.get_file_info(fs.FileSelector(root, recursive=True)) if f.is_file) if store.get_file_info(root).type == fs.FileType.Directory else [(root, store.get_file_info(root).size)]
        found: list[tuple[str, str | None, str | None, int]] = []
        for path, size in files:
            if path.lower().endswith(".zip"):
                try:
                    with store.open_input_file(path) as f, zipfile.ZipFile(f) as z:
                        found += [(path, i.filename, None, i.file_size) for i in z.infolist() if not i.is_dir() and _wanted(i.filename)]
                except (zipfile.BadZipFile, OSError, ValueError) as e:
                    found.append((path, None, f"damaged archive: {e}", 0))
            elif _wanted(path):
                found.append((path, None, None, size or 0))
        groups: list[list] = []
        held = 0
        for path, member, error, size in found:
            if not groups or held + size > self.task_bytes:
                groups.append([])
                held = 0
            groups[-1].append((path, member, error))
            held += size
        return [InputPartition(g) for g in groups] or [InputPartition([])]

    def read(self, partition):
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(self.at)
        for path, member, error in partition.value:
            if error:
                yield path, None, None, None, error
            elif member is None:
                with store.open_input_file(path) as f:
                    yield from _document(path, path.rpartition("/")[2], f)
            else:
                try:
                    with store.open_input_file(path) as f, zipfile.ZipFile(f) as z:
                        yield from _member(path, z, member)
                except (zipfile.BadZipFile, OSError, ValueError) as e:
                    yield path, member, None, None, f"damaged archive: {e}"


def _wanted(name: str) -> bool:
    return name.lower().endswith((".atom", ".xml", ".zip"))


def _member(path: str, z: zipfile.ZipFile, name: str) -> Iterator[tuple]:
    try:
        with z.open(name) as f:
            if not name.lower().endswith(".zip"):
                yield from _document(path, name, f)
                return
            with zipfile.ZipFile(f) as inner:
                for i in inner.infolist():
                    if not i.is_dir() and _wanted(i.filename):
                        yield from _member(path, inner, i.filename)
    except (zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError, ValueError) as e:
        yield path, name, None, None, f"damaged archive: {e}"


def _document(path: str, name: str, stream: IO[bytes]) -> Iterator[tuple]:
    k = 0
    try:
        for e in entries_in(stream):
            yield path, name, k, e, None
            k += 1
    except ElementTree.ParseError as e:
        yield path, name, None, None, f"damaged document: {e}"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(archivo, documento, posicion, cuerpo, error): see ArchiveFeed."""
    spark.dataSource.register(ArchiveFeed)
    return spark.read.format("archive_feed").load(path)


def entries(df: DataFrame) -> DataFrame:
    """The rows with a body."""
    return df.where("cuerpo is not null")


def damages(df: DataFrame) -> DataFrame:
    """What couldn't be read: (archivo, documento, error)."""
    return df.where("error is not null").select("archivo", "documento", "error")


class PagedFeed(DataSource):
    """spark.read.format("paged_feed").option("urls", "a b"): a partition per feed, its pages followed by their next links. The last row of a
    feed has no body but its state: 'completa', 'topada' (there was another page beyond ``max_pages``, 20 unless given) or 'fallida', with
    the error. A page that fails ends its feed; what was read before stays."""

    @classmethod
    def name(cls) -> str:
        return "paged_feed"

    def schema(self) -> str:
        return "feed string, pagina int, posicion int, cuerpo string, estado string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.urls = options["urls"].split()
        self.most = int(options.get("max_pages", MAX_PAGES))
        self.pause = float(options.get("pause_s", 0))

    def partitions(self):
        from pyspark.sql.datasource import InputPartition

        return [InputPartition(u) for u in self.urls]

    def read(self, partition):
        feed, url, page, seen = partition.value, partition.value, 0, set()
        while url and url not in seen:
            if page >= self.most:
                yield feed, page, None, None, "topada", None
                return
            seen.add(url)
            try:
                with urlopen(url, timeout=60) as r:  # noqa: S310
                    data = r.read()
            except OSError as e:
                yield feed, page + 1, None, None, "fallida", str(e)
                return
            page += 1
            found, step, error = entries_of(data)
            for k, e in enumerate(found):
                yield feed, page, k, e, None, None
            if error:
                yield feed, page, None, None, "fallida", error
                return
            url = urljoin(url, step) if step else None
            if url and self.pause:
                time.sleep(self.pause)
        yield feed, page, None, None, "completa", None


def code_list(spark: SparkSession, path: str) -> DataFrame:
    """(codigo, nombre) of a code list document; rows without either are left out."""
    rows = spark.read.format("xml").option("rowTag", "Row").schema("Value array<struct<_ColumnRef:string, SimpleValue:string>>").option("ignoreNamespace", "true").load(path)
    value = lambda ref: F.try_element_at(F.filter("Value", lambda v: F.lower(v["_ColumnRef"]) == ref), F.lit(1))["SimpleValue"]
    return rows.select(value("code").alias("codigo"), F.coalesce(value("nombre"), value("name")).alias("nombre")).where("codigo is not null and nombre is not null").distinct()


def recent_months(n: int, as_of: date) -> list[str]:
    """The last n months of the current year, newest first, as YYYYMM."""
    return [f"{as_of.year}{m:02d}" for m in range(as_of.month, max(0, as_of.month - n), -1)]


def load_periods(as_of: date, only: str | None = None) -> list[str]:
    """Archives to load: the current year's months from the newest, then the two years before; ``only`` keeps those that match."""
    every = recent_months(12, as_of) + [str(as_of.year - k) for k in (1, 2)]
    return [p for p in every if only is None or re.fullmatch(only, p)]


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or an empty one of the schema where there is none."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(schema).parquet(path) if there else spark.createDataFrame([], schema)
