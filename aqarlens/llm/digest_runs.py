"""Exact deduplication by a tree-merge of sorted digest runs (native Spark only).

Every input partition makes one run: its distinct digests, each with the
smallest identifier and a row count, in ascending order.  Runs then meet in binomial
rounds: in round k the runs whose numbers agree after dropping the lowest
``bits * k`` bits are merged into one.  A merge goes through its runs in digest
order: equal digests stand side by side, smallest identifier first, the first
of them stays and takes the sum of the counts.  After the last round one run
is left.

A run is cut into parts by the leading bits of the digest, the same cut for
all runs, so runs merge part by part, no task holds a whole run, and a part
of the result is in order within itself.  A shuffle keeps no order, so a merge
begins with Spark's external sort of the parts that it gathered.  A text that
makes up a third of all rows is one row per run from the start, and at most
``2 ** bits`` rows of it meet in a merge.

A digest is SHA-256 of the normalised text; the length and a 64-bit hash of
another family travel with it as part of the key and are compared at every
level, so texts whose SHA-256 agrees but whose length or second hash does not
are never merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aqarlens.llm.common import free_names, stage

WHITE_SPACE = r"[\x20\x09-\x0D]+"
KEY = ["digest", "n_bytes", "check"]


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: id, key columns and the partition it came from."""
    norm = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("t"))
    return norm.select(
        "id",
        F.unhex(F.sha2("t", 256)).alias("digest"),
        F.octet_length("t").alias("n_bytes"),
        F.xxhash64("t").alias("check"),
        F.spark_partition_id().alias("run"),
    )


def in_order(runs: DataFrame, parts: int) -> DataFrame:
    """Runs in ascending order of their keys, smallest identifier (null last) first, cut alike into parts."""
    lead = F.conv(F.hex(F.substring("digest", 1, 3)), 16, 10).cast("long")
    placed = runs.withColumn("part", F.floor(lead * parts / (1 << 24))).repartition("run", "part")
    return placed.sortWithinPartitions("run", "part", *KEY, F.col("keep_id").asc_nulls_last())


def merge_runs(rows: DataFrame, bits: int = 3) -> DataFrame:
    """(key, keep_id, group_size) per distinct text; ``2 ** bits`` runs meet in a merge."""
    last = rows.agg(F.max("run")).first()[0] or 0
    # Several parts a task even out.
    parts = 16 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.groupBy("run", *KEY).agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    same = Window.partitionBy("run", "part", *KEY).orderBy(F.col("keep_id").asc_nulls_last())
    everyone = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    while last:
        gathered = in_order(runs.withColumn("run", F.shiftright("run", bits)), parts)
        merged = gathered.withColumn("place", F.row_number().over(same))
        merged = merged.withColumn("group_size", F.sum("group_size").over(everyone))
        runs = merged.where("place = 1").drop("place", "part")
        last >>= bits
    return runs.drop("run")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 3) -> DataFrame:
    """One row per document: its id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised forms are; null counts as empty.
    ``keep_id`` is the smallest id among the equal texts (null only if all of
    them are null) and ``kept`` marks rows with that id, so rows that repeat
    both id and text are marked alike.  Other columns of the input, whatever
    their names, are not read.  An empty table gives an empty result.
    """
    rows = stage(digest_rows(docs, id_col, text_col), "digests")
    # Texts without a copy need no group row: the join carries groups of two or more only.
    groups = merge_runs(rows, bits).where("group_size > 1")
    joined = rows.join(groups, KEY, "left")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay: of equal texts one row, with all its columns.

    Rows without an id are judged by their text alone: one of them stays if
    no equal text has an id.
    """
    groups = exact_groups(docs, id_col, text_col)
    # Columns of the caller's may have any name.
    sha, gone_id, gone_sha = free_names(docs, "__sha", "__id", "__s")
    ids = groups.where(f"not kept and {id_col} is not null")
    own = docs.withColumn(sha, F.sha2(normalised(F.col(text_col)), 256))
    ids = ids.select(F.col(id_col).alias(gone_id), F.col("text_sha256").alias(gone_sha)).distinct()
    left = own.join(ids, (F.col(id_col) == F.col(gone_id)) & (F.col(sha) == F.col(gone_sha)), "left_anti")
    repeated = groups.where("kept").groupBy(id_col, "text_sha256").count().where("count > 1")
    lost = groups.where(f"{id_col} is null and keep_id is not null").limit(1)
    if repeated.limit(1).count() or lost.count():
        named = groups.where(f"{id_col} is null and keep_id is not null").select(F.col("text_sha256").alias(gone_sha))
        left = left.join(named.distinct(), F.col(id_col).isNull() & (F.col(sha) == F.col(gone_sha)), "left_anti")
        left = left.dropDuplicates([id_col, sha])
    return left.drop(sha)


def op4_exact_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs)


OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""
