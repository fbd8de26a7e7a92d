"""Session set-up and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, app: str = "replyloom") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="replyloom-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only where nothing is set and the whole engine is one process may a
    temporary folder of the machine stand in.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = configured or spark.sparkContext.getCheckpointDir()
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach.")
        folder = tempfile.mkdtemp(prefix="replyloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so that a lost executor costs nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


class _Scopes(threading.local):
    """The open ``scratch`` blocks of a thread, each with the tables written inside it."""

    def __init__(self) -> None:
        self.open: list[list[str]] = []


_SCOPES = _Scopes()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete every table stored inside the block when it ends, also by an error.

    What a block hands on is stored with ``result=True``: it belongs to the block
    around, or to the caller if there is none.
    """
    _SCOPES.open.append([])
    try:
        yield
    finally:
        conf = spark._jsc.hadoopConfiguration()
        for path in _SCOPES.open.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def scratch_folder(spark: SparkSession, label: str, result: int = False) -> str:
    """A path that does not exist yet; it goes as ``stored`` says."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    depth = 1 + int(result)
    if len(_SCOPES.open) >= depth:
        _SCOPES.open[-depth].append(path)
    return path


#: Shuffle files go when the query that made them has ended, not when the driver collects its garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a megabyte or so: a task that reads them holds some dozen at once.
PACKED = {"parquet.page.size.row.check.min": "4", "parquet.page.size.row.check.max": "16", "parquet.block.size": str(1 << 24)}


@contextmanager
def _clean_up(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def stored(df: DataFrame, label: str, result: int = False, packed: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there ever after.

    Unlike a cache, the rows outlive executors; unlike a lazy frame, whatever
    produced them runs exactly once.  The table goes with the ``scratch`` block
    it is written in, a ``result`` with the block around that, or as many blocks
    further out as ``result`` says.  What was shuffled for it is deleted when it
    is written.  ``packed`` is for rows of a megabyte or so.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label, result)
    with _clean_up(spark):
        df.write.options(compression="zstd", **(PACKED if packed else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores when a scan has fewer splits than there are cores.

    Text work costs far more than reading, so a small file read as one split
    would leave the cluster idle.  Scans with enough splits are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)


def append(df: DataFrame, path: str) -> None:
    """Add the rows to a table of the shared folder that is made in parts."""
    with _clean_up(df.sparkSession):
        df.write.mode("append").option("compression", "zstd").parquet(path)


def together(df: DataFrame, key: str) -> DataFrame:
    """Rows of a key in one partition and in a row, so that what is made of them can be grouped where it lies."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, key).sortWithinPartitions(key)
