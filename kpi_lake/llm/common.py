"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space that separates words.
WORD_SEPARATORS = b" \t\n\x0b\x0c\r"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, once an application:
    the driver zips it and Spark hands the archive out (no executor reads the driver's folder)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="kpi-lake-")) / f"{top.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read lazily; what reads it may run this package's code in tasks."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a folder of its own (tests); on any other
    master a missing setting is an error, because a machine-local folder would lose data.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="kpi-lake-shared-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in a folder of this application's own."""
    return f"{shared_dir(spark)}/kpi_lake_llm/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a table in the shared folder and read it back: cuts the lineage, and the
    table outlives any executor. Used where several later steps read one costly frame."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of ``scratch_path``."""
    jvm = spark._jvm  # noqa: SLF001
    if "/kpi_lake_llm/" in folder:
        path = jvm.org.apache.hadoop.fs.Path(re.sub(r"^file:/+", "file:///", folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def drop_table(df: DataFrame) -> None:
    """Remove the files of a materialised table that no later step reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        drop_folder(df.sparkSession, folder)


def lower_ascii(column: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores after it a name that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


_CACHES: dict[str, dict] = {}


def give_back() -> None:
    """Return freed memory to the system, as far as the allocators can."""
    import ctypes

    import pyarrow as pa

    gc.collect()
    if not gc.get_freeze_count():
        gc.freeze()  # the modules, once a process: looking through them is most of what a collection takes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def worker_cache(owner: str) -> dict:
    """What a Python worker keeps from task to task of one operator. Claiming it drops what other
    operators left, so that a worker that serves many holds one operator's memory at a time."""
    others = [k for k in _CACHES if k != owner]
    for other in others:
        _CACHES.pop(other).clear()
    if others:
        give_back()
    return _CACHES.setdefault(owner, {})


def slices(batches, rows: int = 1000):
    """Arrow batches in parts of at most ``rows`` rows, so that few texts are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8_column(array):
    """The texts of an Arrow string array as a list of ``bytes`` (null: empty)."""
    import pyarrow as pa

    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return [b"" if x is None else x for x in array.cast(kind).to_pylist()]


__all__ = [
    "WORD_SEPARATORS",
    "drop_folder",
    "drop_table",
    "free_name",
    "give_back",
    "lower_ascii",
    "materialise",
    "read_table",
    "scratch_path",
    "shared_dir",
    "ship_package",
    "slices",
    "utf8_column",
    "worker_cache",
]

