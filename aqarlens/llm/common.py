"""Helpers shared by the operators: the shared folder, stage tables, chunks, components."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

_LOCAL: dict[str, str] = {}
_CLEANED: set[str] = set()
_HELD: dict[str, object] = {}


def worker_state(name: str, make: Callable[[], T]) -> T:
    """What a Python worker keeps from task to task under ``name``.

    Workers serve one operator after another; the first task of the next one
    drops what the last one left, so tables and memos of several never add up.
    """
    if name not in _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _HELD[name] = make()
    return _HELD[name]


def row_slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Pieces of an Arrow batch, so that a batch of long texts is not unpacked at once."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def shared_dir(spark: SparkSession) -> str:
    """This session's own folder below the cluster's ``spark.checkpoint.dir``.

    Only a single-JVM ``local[...]`` session without that setting gets a
    temporary folder; a cluster without it is an error, because executors
    would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL.setdefault("dir", tempfile.mkdtemp(prefix="aqarlens-llm-"))
    app = spark.sparkContext.applicationId
    if app not in _CLEANED:
        _CLEANED.add(app)
        atexit.register(_remove_session_dir, spark, f"{base.rstrip('/')}/aqarlens-llm/{app}")
    return f"{base.rstrip('/')}/aqarlens-llm/{app}"


def _remove_session_dir(spark: SparkSession, folder: str) -> None:
    """Drop the session's stage tables when the driver ends (its JVM may be gone already)."""
    try:
        remove(spark, folder)
    except Exception:  # nothing left to ask at interpreter exit
        pass


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores put before those that ``df`` has (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The lineage ends there: a lost executor costs no recomputation of what
    came before.  The table lives until the session's folder is removed.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of all texts, from one column-pruned scan."""
    return docs.agg(F.sum(F.octet_length(F.col(column)).cast("long"))).first()[0] or 0


def chunk_count(total_bytes: int, chunk_bytes: int = 12 << 20) -> int:
    """How many chunks of about ``chunk_bytes`` the texts make; it grows with them."""
    return max(8, -(-total_bytes // chunk_bytes))


def in_chunks(docs: DataFrame, chunks: int) -> DataFrame:
    """Rows dealt evenly over ``chunks`` by a hash of the whole row, as column ``chunk``.

    Plans that use the result several times share its one shuffle.
    """
    keyed = docs.withColumn("chunk", F.pmod(F.xxhash64(*docs.columns), F.lit(chunks)).cast("int"))
    return keyed.repartition(chunks, "chunk")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of an undirected graph: (id, component), component the smallest id.

    ``edges`` has long columns ``a`` and ``b``.  Large-star and small-star
    rounds alternate until the edges are stars around roots.  Each round joins
    the edges with their nodes' smallest neighbours (a partially aggregated
    minimum), so a node with very many edges is a skewed join key, which AQE
    splits, and never one group in a task.  Each round's edges are a stage
    table.  Nodes without edges are not returned.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    pairs = pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stage(pairs, name)
    while not _are_stars(pairs):
        # Large star: every larger neighbour of a node is moved to the node's smallest neighbour.
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # Small star: a node and its smaller neighbours are moved to the smallest of these.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low)
        pairs = stage(small.where("a <> b").distinct(), name)
    roots = pairs.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return pairs.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)


def _are_stars(pairs: DataFrame) -> bool:
    """Whether each node on the larger side has one edge only and is on no smaller side."""
    upper = pairs.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("low"))
    lower = pairs.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("low"))
    nodes = upper.union(lower).groupBy("x").agg(F.sum("up").alias("up"), F.max("low").alias("low"))
    return nodes.where("up > 1 or (up = 1 and low = 1)").limit(1).count() == 0
