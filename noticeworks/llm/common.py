"""What the operators of this subpackage share: tables, the held-out rule and working tables."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.session import new_path

#: Columns that operators add on the way carry this prefix, so that a column of the input cannot clash.
OWN = "__lm_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Whether crc32 of the id's text leaves no remainder by 5. A null id is not held out."""
    return F.coalesce(_remainder(doc_id) == 0, F.lit(False))


def may_learn(doc_id: str | Column = "doc_id") -> Column:
    """Whether labels of the row may be learnt from. A null id may not."""
    return F.coalesce(_remainder(doc_id) != 0, F.lit(False))


def _remainder(doc_id: str | Column) -> Column:
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.

    Cuts the lineage, fixes what depends on how rows were dealt out, and survives lost executors.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows that go to a Python worker at once. Texts are long, so fewer than by default.
BATCH_ROWS = 500


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors' Python workers, once per application, and bound what they hold."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    context = spark.sparkContext
    if _shipped.get("to") != context.applicationId:
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="noticeworks-")  # of the driver, which serves the file
        target = f"{folder}/{package.name}_code.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in package.rglob("*.py"):
                z.write(f, f.relative_to(package.parent))
        context.addPyFile(target)
        _shipped["to"] = context.applicationId
    return spark


_shipped: dict[str, str] = {}


def delete_written(df: DataFrame) -> None:
    """Delete the files behind a table made by ``written`` that no later plan reads."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what Arrow no longer needs of one is given back before the next.

    Workers stay between tasks and stages. After the last batch the C library's free memory goes back, too.
    """
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()
    give_back()


def give_back() -> None:
    """Hand memory that is free in this process to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` whose byte column adds up to about ``limit`` bytes; one long value is a part."""
    lengths = [len(v) if v is not None else 0 for v in _buffers(batch.column(column))]
    start = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)


def _buffers(column: pa.Array) -> list:
    return [v.as_buffer() if v.is_valid else None for v in column]
