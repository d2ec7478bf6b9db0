"""What every plan needs from the session: table readers, shared storage and size-checked broadcasts."""

from __future__ import annotations

import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest side that is broadcast, in bytes of memory. Beyond it the join shuffles.
BROADCAST_BYTES = 16 << 20

_OWN: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only where that is unset and all runs on this machine, one of our own."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="almoneda-")
    return f"file://{_OWN[app]}"


class Files:
    """The Hadoop file system under a folder, whatever its scheme."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(self.conf)

    def exists(self, at: str) -> bool:
        return self.fs.exists(self.path(at))

    def names(self, at: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(at))] if self.exists(at) else []

    def modified(self, at: str) -> int:
        """Milliseconds since 1970."""
        return self.fs.getFileStatus(self.path(at)).getModificationTime()

    def read(self, at: str) -> bytes:
        stream = self.fs.open(self.path(at))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, at: str, data: bytes) -> None:
        out = self.fs.create(self.path(at), True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()

    def claim(self, at: str, data: bytes) -> bool:
        """Makes the file if nobody has: all of it or nothing; whether it was this call that made it."""
        from py4j.protocol import Py4JJavaError

        aside = f"{at}.{uuid.uuid4().hex}"
        self.write(aside, data)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(at).toUri(), self.conf)
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.path(aside), self.path(at), options)
        except Py4JJavaError:
            self.delete(aside)
            if not self.exists(at):
                raise
            return False
        return True

    def replace(self, new: str, at: str) -> None:
        """Puts a file in another's place in one step."""
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(at).toUri(), self.conf)
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        context.rename(self.path(new), self.path(at), options)

    def delete(self, at: str) -> None:
        self.fs.delete(self.path(at), True)


def session_dir(spark: SparkSession) -> str:
    """This session's folder for what it writes between steps; it is deleted when the driver ends, or by ``release``."""
    at = f"{shared_dir(spark)}/almoneda/{spark.sparkContext.applicationId}"
    files = Files(spark, at)
    if not files.exists(at):
        files.fs.mkdirs(files.path(at))
        files.fs.deleteOnExit(files.path(at))
        if spark.sparkContext.applicationId in _OWN:
            files.fs.deleteOnExit(files.path(shared_dir(spark)))
    return at


def release(spark: SparkSession) -> None:
    """Deletes what queries have written between steps so far: for long sessions, once their results are stored. The code stays."""
    at = session_dir(spark)
    files = Files(spark, at)
    for name in files.names(at):
        if not name.startswith("code-"):
            files.delete(f"{at}/{name}")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{session_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage through a written table in the shared folder: it is computed once and outlives lost executors."""
    spark, at = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a plan's size; of written tables it is the size of their files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _width(c: Column, t: T.DataType) -> Column:
    """Bytes of a value in a row held in memory."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 24
    if isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) * 4 + 64
    return F.lit(24)


def memory_bytes(df: DataFrame) -> int:
    """What the rows take as a hash table in memory, counted, not estimated."""
    row = F.lit(64)
    for f in df.schema.fields:
        row = row + _width(F.col(f"`{f.name}`"), f.dataType)
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def maybe_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a side only if its rows fit the limit in memory; else leave the join to shuffle. Only a side whose files are within
    the limit is counted at all; give a written table or a cheap selection of one."""
    return F.broadcast(df) if estimated_bytes(df) <= limit and memory_bytes(df) <= limit else df


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Gives the executors' Python workers this package, once a session, through the shared folder: they need no copy of it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    home = Path(__file__).resolve().parent.parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, str(f.relative_to(home.parent)))
    at = f"{fresh_path(spark, 'code')}/almoneda-code.zip"
    Files(spark, at).write(at, data.getvalue())
    spark.sparkContext.addPyFile(at)
    _SHIPPED.add(app)


def ship_file(spark: SparkSession, path: str) -> str:
    """Copies a file of the driver's machine to the executors, once a session; returns the name that ``shipped`` finds it by."""
    name = Path(path).name
    key = f"{spark.sparkContext.applicationId} {path}"
    if key not in _SHIPPED:
        at = f"{fresh_path(spark, 'code')}/{name}"
        Files(spark, at).write(at, Path(path).read_bytes())
        spark.sparkContext.addFile(at)
        _SHIPPED.add(key)
    return name


def shipped(name: str) -> str:
    """The local path of a shipped file, on an executor or the driver."""
    from pyspark import SparkFiles

    return SparkFiles.get(name)
