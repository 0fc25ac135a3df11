"""Session set-up and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting for what ``passing_shuffles`` does.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Rows that a file of a pinned table holds at least, where their number is known and there is a file for each core.
FILE_ROWS = 10_000

_JOB: ContextVar[str | None] = ContextVar("job folder", default=None)


def local_session(cores: str = "8", app: str = "counterfoil") -> SparkSession:
    """A session for tests and the benchmark; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.variant.allowDuplicateKeys", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that
    folder would not be visible to the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    if not re.match(r"local($|\[)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="counterfoil-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder or the one of the job; nothing is ever overwritten."""
    folder = _JOB.get() or shared_folder(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def job_scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for all scratch tables of a job, removed with them when the job ends.

    For jobs that write their results inside: a DataFrame that leaves the block and still
    reads a pinned table finds it gone.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/job-{uuid.uuid4().hex}"
    token = _JOB.set(folder)
    try:
        yield folder
    finally:
        _JOB.reset(token)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind: they go when it ends, not when the driver collects its garbage.

    For steps whose result is all that is read afterwards, so that disks hold the shuffles of one step at a time.
    """
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def pin(df: DataFrame, *folders: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it from there.

    With ``folders`` rows lie in a folder per value of these columns, and filters on them read
    no others. With ``rows``, about how many there are at most, few rows lie in few files, however many
    partitions a shuffle has: a file for each core, more if each gets ``FILE_ROWS``. A task then writes several
    partitions one after the other, so what is heavy to compute is pinned without.

    Cuts the lineage, survives the loss of executors, and lets several readers see the
    same rows, each reading only its own columns. ``checkpoint()`` would do the same but
    computes its last stage twice. The shuffle files behind it are removed.
    """
    path = scratch_path(df.sparkSession, "pinned")
    if rows is not None:
        df = df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))
    with passing_shuffles(df.sparkSession):
        df.write.partitionBy(*folders).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return written.select(*[f"`{c}`" for c in df.columns]) if folders else written
