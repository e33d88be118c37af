"""What the corpus operators share: staging tables, word rules and table access."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

_own_dir: list[str] = []
#: Applications that have this package on their executors.
_shipped: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or one of our own where it is unset in
    local mode. On a cluster an unset one is an error: executors elsewhere could not read a folder of the driver's."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="cloister-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return _own_dir[0]


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends at files that outlive executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    path = getattr(df, "_staged_path", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Make a session fit for Python operators: Arrow batches of whole texts stay small, so that a worker's memory is
    bounded, and executors get this package, wherever they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        folder = Path(tempfile.mkdtemp(prefix="cloister-code-"))
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        with zipfile.ZipFile(folder / "cloister_code.zip", "w") as out:
            for f in sorted(package.rglob("*.py")):
                out.write(f, f.relative_to(package.parent))
        context.addPyFile(str(folder / "cloister_code.zip"))
        _shipped.add(context.applicationId)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what is run inside: for rows that hold whole blocks."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as 0."""
    t = F.coalesce(text, F.lit(""))
    parts = F.size(F.split(t, GAP, -1))
    return (parts - t.rlike("^" + GAP).cast("int") - t.rlike(GAP + r"\z").cast("int") - (t == "").cast("int")).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
