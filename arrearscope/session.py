"""Session set-up for tests and benchmarks, and written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Generated methods above this many bytes are never compiled to machine code by
#: the JVM; past it Spark generates many small methods for a plan instead, which
#: runs the wide feature projections several times faster.
JIT_METHOD_LIMIT = "8000"


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the wide generated projections need; safe to repeat."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_LIMIT)
    return spark


def local_session(cores: int | str = 8, app: str = "arrearscope") -> SparkSession:
    """A local session; on a cluster, callers bring their own."""
    n = 8 if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


#: Folders made for local sessions that name none, by application.
_own_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the session names it.

    Only a local master without the setting gets a folder of its own; on a
    cluster a machine-local folder would not be visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_roots:
        _own_roots[app] = tempfile.mkdtemp(prefix="arrearscope-")
    return _own_roots[app]


def scratch_home(spark: SparkSession) -> str:
    """This application's part of the shared folder; others' parts are never touched."""
    return f"{scratch_root(spark)}/arrearscope/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_home(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    Cuts lineage durably (a lost executor re-reads files instead of redoing the
    work), and unlike an RDD checkpoint the scan still prunes columns, skips
    partitions and reports its size to the optimizer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


#: Tables of the innermost ``tidy`` of this thread.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Drop at the end what this thread wrote inside; read all results before."""
    token = _passing.set([])
    try:
        yield
    finally:
        paths = _passing.get()
        _passing.reset(token)
        for path in paths:
            drop_path(spark, path)


def apart(spark: SparkSession, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A written table; those that were written on the way to it are dropped."""
    path = scratch_path(spark, name)
    with tidy(spark):
        made = make()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_written(spark: SparkSession) -> None:
    """Remove every intermediate table this application wrote."""
    drop_path(spark, scratch_home(spark))
