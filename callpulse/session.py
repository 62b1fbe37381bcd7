"""Spark session and small plan helpers shared by the jobs."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "callpulse") -> SparkSession:
    """Session with the settings the transforms assume: UTC wall clock, ANSI, AQE.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data (about
    128-256 MB per partition), AQE coalesces small ones at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # wide derived-column chains make constraint inference grow very fast; filters are explicit here
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master and master.startswith("local"):
        b = b.config("spark.driver.memory", os.environ.get("CALLPULSE_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, taking ``spark.checkpoint.dir`` from the session.

    Only in local mode, where all tasks share the machine, a scratch folder is
    created if the session names none; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not (sc.master or "").startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="callpulse-ckpt-", dir=os.environ.get("CALLPULSE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of an intermediate that several branches read.

    Writes the frame once as a parquet table under the shared checkpoint
    folder and reads it back: a lost executor re-reads it instead of
    recomputing the upstream joins, later scans prune columns, and the
    planner sees its real size (broadcast and AQE decisions).
    """
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{root}/tables/{uuid.uuid4().hex}"
    if _scopes.get():
        _scopes.get()[-1].append(path)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


@contextmanager
def scratch_tables(spark: SparkSession):
    """The tables that ``materialize`` writes inside, by the same thread, are removed at the end, also after an error.

    For jobs, which have written their results by then; a frame that is read later must not depend on such a table.
    """
    mine: list[str] = []
    token = _scopes.set((*_scopes.get(), mine))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in mine:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
