"""Where tables go: layer names, resolved tables, views, and scratch tables that cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Tables written at the same time.
WRITERS = 6

# Stand-in for the shared folder in local mode, where driver and executors are one process.
_LOCAL_FOLDER: list[str] = []


def layer_schema(layer: str | None, env: str = "prod", default: str = "main") -> str:
    """Database of a layer. Every environment but prod gets its own prefix."""
    if layer is None:
        return default.strip()
    return layer.strip() if env == "prod" else f"{env.strip()}_{layer.strip()}"


# Most slices of a step of a ``Relay``, and the bytes of the table that make a slice.
SLICES, SLICE_BYTES = 4, 32 << 20

# Spark's setting by which the shuffle files of a query go when it ends, and the writes under way in each session.
_FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_WRITES: Counter[SparkSession] = Counter()
_SET_BEFORE: dict[SparkSession, str] = {}
_LOCK = threading.Lock()


@contextmanager
def frees_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write in here go when it is done, not when the driver happens to collect its garbage.

    The session's own setting is back when its last write is done.
    """
    with _LOCK:
        if not _WRITES[spark]:
            _SET_BEFORE[spark] = spark.conf.get(_FREES, "false")
            spark.conf.set(_FREES, "true")
        _WRITES[spark] += 1
    try:
        yield
    finally:
        with _LOCK:
            _WRITES[spark] -= 1
            if not _WRITES[spark]:
                spark.conf.set(_FREES, _SET_BEFORE.pop(spark))
                del _WRITES[spark]


def materialize(df: DataFrame, layer: str, name: str, env: str = "prod",
                partition_by: list[str] | None = None) -> DataFrame:
    """Write a resolved table and return it as read back."""
    spark = df.sparkSession
    schema = layer_schema(layer, env)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"`{schema}`.`{name}`")
    return spark.table(f"`{schema}`.`{name}`")


class Published:
    """Tables of one run beside those of earlier runs, and views that all follow one pointer.

    Every published table is partitioned by run first. A view shows the partition of the run that the pointer names; the
    pointer is a view of one constant row, so moving it is one change of one catalog entry, and each query that reads
    any number of views sees one run as a whole. The constant is folded into a partition filter while planning: no
    file is read for it, and sessions that have listed files before see the new run at once.

    The run before stays for queries that have begun; older runs, and runs that never became visible, are dropped.
    """

    POINTER = "published_run"

    def __init__(self, spark: SparkSession, env: str, run: str):
        self.spark, self.env, self.run = spark, env, run
        self.schema = layer_schema("unified", env)
        self._added: list[tuple[str, str]] = []

    @property
    def pointer(self) -> str:
        return f"`{self.schema}`.`{self.POINTER}`"

    def current(self) -> str | None:
        """The run that readers see, None before the first."""
        if not self.spark.catalog.tableExists(self.pointer):
            return None
        return self.spark.table(self.pointer).first().run

    def add(self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = ()) -> str:
        """Write this run's part of a table, which nobody sees yet, and return the table's name."""
        if "run" in df.columns:
            raise ValueError(f"{name}: the column `run` is taken by the number of the run")
        schema = layer_schema(layer, self.env)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{schema}`")
        table = f"`{schema}`.`{name}__runs`"
        if self.spark.catalog.tableExists(table):
            self._widen(table, df)
        with frees_shuffles(self.spark):
            (df.withColumn("run", F.lit(self.run)).write.mode("append").format("parquet").partitionBy("run", *partition_by)
             .saveAsTable(table))
        self._added.append((schema, name))
        return table

    def _widen(self, table: str, df: DataFrame) -> None:
        """New columns join the table, null in earlier runs. What changes a column needs an environment of its own."""
        there = dict(self.spark.table(table).dtypes)
        changed = [c for c, t in df.dtypes if there.get(c, t) != t]
        gone = [c for c in there if c != "run" and c not in df.columns]
        if changed or gone:
            raise ValueError(f"{table}: columns {sorted(changed + gone)} have changed since the runs before")
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name not in there]
        if new:
            self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")

    def read(self, table: str) -> DataFrame:
        """This run's part of a table that has been added."""
        return self.spark.table(table).filter(F.col("run") == self.run).drop("run")

    def show(self) -> list[str]:
        """Move the pointer to this run, whose tables are all written: the views' names."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.schema}`")
        before = self.current()
        if before is None:
            # Views need a pointer to be made; until it is moved they are empty.
            self._move("")
        for schema, name in self._added:
            self._view(schema, name)
        self._move(self.run)
        for schema, name in self._added:
            self._drop_runs(f"`{schema}`.`{name}__runs`", keep=(before, self.run))
        return [f"{schema}.{name}" for schema, name in self._added]

    def _move(self, run: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.pointer} AS SELECT '{run}' AS run")

    def _view(self, schema: str, name: str) -> None:
        """A view is made once, and again only for columns that are new."""
        columns = [c for c in self.spark.table(f"`{schema}`.`{name}__runs`").columns if c != "run"]
        view = f"`{schema}`.`{name}`"
        if self.spark.catalog.tableExists(view) and self.spark.table(view).columns == columns:
            return
        listed = ", ".join(f"`{c}`" for c in columns)
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {listed} FROM `{schema}`.`{name}__runs` "
                       f"WHERE run = (SELECT run FROM {self.pointer})")

    def _drop_runs(self, table: str, keep: Sequence[str | None]) -> None:
        old = [p.partition for p in self.spark.sql(f"SHOW PARTITIONS {table}").collect()
               if p.partition.split("/")[0].removeprefix("run=") not in keep]
        for i in range(0, len(old), 100):
            specs = ", ".join(f"PARTITION ({_spec(p)})" for p in old[i:i + 100])
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def _spec(partition: str) -> str:
    """``a=1/b=2`` as SQL; the folder of nulls as null."""
    pairs = (p.partition("=") for p in partition.split("/"))
    return ", ".join(f"`{k}` = " + ("null" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{v}'") for k, _, v in pairs)


def register_view(df: DataFrame, layer: str, name: str, env: str = "prod") -> str:
    """Register a lazy view of the session; temporary views have no database, so the layer goes into the name."""
    view = f"{layer_schema(layer, env)}__{name}"
    df.createOrReplaceTempView(view)
    return view


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir`` of the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    # "local-cluster" has executors of its own.
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _LOCAL_FOLDER:
        _LOCAL_FOLDER.append(tempfile.mkdtemp(prefix="accountlens-"))
    return _LOCAL_FOLDER[0]


class Scratch:
    """Parquet tables of one run, in a folder of their own below the shared folder."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/accountlens/{uuid.uuid4().hex}"


    def remove(self) -> None:
        """Delete the folder, by the file system that holds it."""
        self.delete(self.folder)

    def _place(self, folder: str) -> tuple[JavaObject, JavaObject]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def delete(self, folder: str) -> None:
        files, path = self._place(folder)
        files.delete(path, True)

    def size(self, folder: str) -> int:
        """Bytes of all files."""
        files, path = self._place(folder)
        return files.getContentSummary(path).getLength()

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> str:
        path = self.path(name)
        with frees_shuffles(self.spark):
            df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
        return path

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write once, read many: the result no longer depends on how ``df`` was computed."""
        return self.spark.read.schema(df.schema).parquet(self.write(df, name))


class Relay:
    """A large table on its way through several shuffles: written after each, and only as it was written last.

    A step is done slice by slice of the keys that it shuffles by, so that the shuffle files of one slice are all
    that is on disk beside the table as it was and as it will be.
    """

    def __init__(self, scratch: Scratch, name: str, slices: int = SLICES, slice_bytes: int = SLICE_BYTES):
        self.scratch, self.name, self.slices, self.slice_bytes = scratch, name, slices, slice_bytes
        self._beside: list[str] = []

    def _read(self, path: str, like: DataFrame) -> DataFrame:
        return self.scratch.spark.read.schema(like.schema).parquet(path)

    def _append(self, df: DataFrame, path: str) -> None:
        with frees_shuffles(self.scratch.spark):
            df.write.mode("append").option("compression", "zstd").parquet(path)

    def begin(self, df: DataFrame) -> DataFrame:
        self._path = self.scratch.path(f"{self.name}-step")
        self._append(df, self._path)
        self._table = self._read(self._path, df)
        return self._table

    def beside(self, df: DataFrame) -> DataFrame:
        """A table that every slice of a step is joined to, never by a broadcast: Spark knows only its size in the file."""
        self._beside.append(self.scratch.write(df, f"{self.name}-beside"))
        return self._read(self._beside[-1], df).hint("merge")

    def step(self, keys: Sequence[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``work`` on the table; rows that have to meet have the same ``keys``."""
        n = max(1, min(self.slices, -(-self.scratch.size(self._path) // self.slice_bytes)))
        # Not the hash by which Spark deals out the rows of a shuffle.
        slice_ = F.pmod(F.xxhash64(*keys), F.lit(n))
        path = self.scratch.path(f"{self.name}-step")
        for i in range(n):
            done = work(self._table.filter(slice_ == i) if n > 1 else self._table)
            self._append(done, path)
        self.scratch.delete(self._path)
        self._path, self._table = path, self._read(path, done)
        return self._table

    def end(self) -> None:
        """Delete what is left, when the last step has been read."""
        for path in (self._path, *self._beside):
            self.scratch.delete(path)
