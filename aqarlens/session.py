"""Session helpers: a tuned local session for tests/bench, and lineage cuts.

Library operators never create sessions; they use ``df.sparkSession``.
"""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def session(
    master: str | None = None,
    app_name: str = "aqarlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes.

    AQE stays on so shuffle partitions coalesce at small scale and skewed
    join partitions split at large scale.  ANSI mode stays at Spark's
    default (on); every operator is written to be ANSI-safe.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", os.environ.get("AQARLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext on this client
        return None


def resolve_mode(spark: SparkSession, mode: str = "auto") -> str:
    """The concrete materialize mode ``auto`` stands for in this session."""
    if mode == "auto":
        return "table" if checkpoint_dir(spark) else "persist"
    return mode


_FOLDERS: dict[str, tuple[SparkSession, list[str]]] = {}


def own_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below ``spark.checkpoint.dir`` that ``drop_folders`` and the end of the driver remove."""
    shared = checkpoint_dir(spark)
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    path = f"{shared.rstrip('/')}/aqarlens-{kind}/{uuid.uuid4().hex}"
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = (spark, [])
        atexit.register(_drop_at_exit, app)
    _FOLDERS[app][1].append(path)
    return path


def drop_folders(spark: SparkSession) -> None:
    """Remove the session's stage tables and scratch folders; frames that read them are spent."""
    _drop(spark.sparkContext.applicationId)


def _drop(app: str) -> None:
    spark, folders = _FOLDERS.get(app, (None, []))
    while folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folders.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _drop_at_exit(app: str) -> None:
    try:
        _drop(app)
    except Exception:  # the session was stopped before, or its JVM is gone
        pass


def materialize(df: DataFrame, mode: str = "auto") -> DataFrame:
    """Cut or cache lineage before several actions reuse one plan.

    ``table``: write Parquet into the cluster's shared ``spark.checkpoint.dir``
    and read it back (cuts lineage, survives executor loss, columnar and
    compressed).  ``persist``: MEMORY_AND_DISK cache; lost blocks are
    recomputed from lineage.  ``auto`` writes a table when a checkpoint folder
    is configured, else persists.  ``none`` returns the plan unchanged.
    """
    mode = resolve_mode(df.sparkSession, mode)
    if mode == "none":
        return df
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode != "table":
        raise ValueError(f"unknown materialize mode {mode!r}")
    path = own_folder(df.sparkSession, "stages")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_code(df: DataFrame) -> DataFrame:
    """The same rows, as a frame whose generated code ends here.

    Spark makes one Java method of the projections and broadcast joins that
    follow each other, and the JVM never compiles one of over 8,000 bytes: it
    interprets it for every row.  Counting rows (a metric that nobody reads) is
    no part of such a method, so what comes before and after it are two.
    """
    return df.observe(f"cut_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))
