"""What the operators of this package share: reading tables, scratch tables, and passes over texts in Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: White space of the contracts: the bytes 0x20 and 0x09 to 0x0D, which is also where ``bytes.split()`` cuts.
SPACES = b" \t\n\x0b\x0c\r"

_TEST_FOLDER: list[str] = []


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application: their Python workers import it."""
    context = spark.sparkContext
    root = Path(__file__).resolve().parents[2]
    if context.applicationId in _SHIPPED or not root.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="llm-")) / "accountlens.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for module in sorted((root / "accountlens").rglob("*.py")):
            z.write(module, module.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors reach: ``spark.checkpoint.dir``. Only a local master may leave it unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    if not _TEST_FOLDER:
        _TEST_FOLDER.append(tempfile.mkdtemp(prefix="llm-"))
    return _TEST_FOLDER[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once below the shared folder and read back: a lost executor repeats a read, not the whole lineage."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_bytes(column: str = "text") -> Column:
    """A text as its UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def crc_bucket(column: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % buckets


#: Bytes of text that a Python worker has in hand at a time; a longer text is worked on alone.
SLICE_BYTES = 2_000_000


def in_slices(batches: Iterator[pa.RecordBatch], column: int = -1, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in pieces of about ``limit`` bytes in a column of texts, so that memory stays bounded."""
    for batch in batches:
        if not batch.num_rows:
            yield batch
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column % batch.num_columns)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes, dtype=np.int64) // limit
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for begin, end in zip(edges, edges[1:], strict=False):
            yield batch.slice(begin, end - begin)


def map_texts(df: DataFrame, carry: Sequence[str], work: Callable[[list[bytes]], Sequence], new: str,
              text: str = "text", done: Callable[[], None] | None = None) -> DataFrame:
    """``carry`` columns untouched, and the columns ``new`` that ``work`` makes from the texts of an Arrow batch.

    ``done`` is called at the end of a partition: Python workers live on, and what they keep is memory of other stages.
    """
    kept = df.select(*carry)
    fresh = StructType.fromDDL(new)
    kinds = list(to_arrow_schema(fresh))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in in_slices(batches):
                made = work(batch.column(batch.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *(pa.array(c, type=f.type) for c, f in zip(made, kinds, strict=True))],
                    names=[*batch.schema.names[:-1], *(f.name for f in kinds)])
        finally:
            if done:
                done()
            pa.default_memory_pool().release_unused()

    return df.select(*carry, as_bytes(text).alias("__body")).mapInArrow(run, StructType([*kept.schema, *fresh]))


def filter_texts(df: DataFrame, work: Callable[[list[bytes]], Sequence[bool]], text: str = "text") -> DataFrame:
    """The rows of ``df``, with its columns, whose texts ``work`` marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            marks = work(batch.column(batch.num_columns - 1).to_pylist())
            yield batch.select(range(batch.num_columns - 1)).filter(pa.array(marks, type=pa.bool_()))

    return df.select("*", as_bytes(text).alias("__body")).mapInArrow(run, df.schema)
