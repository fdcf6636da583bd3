"""Near-duplicate embeddings by random-hyperplane signs, exact cosines and components.

1. Vectors with equal components are collapsed to the smallest id.
2. Each different vector gets ``tables`` signatures of ``bits`` hyperplane
   signs; vectors with an equal signature share that table's bucket.
3. Buckets of several vectors are cut into blocks of bounded size by a hash of
   the id, and every pair of a bucket's blocks is one group of work, so a hot
   bucket is spread over tasks and no task holds more than two blocks.
4. A group computes the cosines of its pairs in double precision by one
   matrix product.  A pair counts in the first table that both share only,
   so link counts add up exactly.  Each vector's count and a spanning forest
   of the group's links leave the task, never all its pairs.
5. Components come from the forests' edges.

Signatures have as many bits as keep buckets of unlike vectors at ``BUCKET``
rows, and there are as many tables as bring a pair at the threshold into one
bucket with probability ``RECALL`` (closer pairs with more).  So the cosines of
unlike pairs grow with n * tables rather than with the square of n.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqarlens.llm.common import components, row_slices, stage

#: Probability that a pair at the threshold shares a bucket.
RECALL = 0.98
#: Bits of a signature at least and at most (an int holds it), and rows of a bucket beyond the least.
LEAST_BITS, MOST_BITS, BUCKET = 12, 30, 256
BLOCK = 1024
SEED = 20260101


def bits_for(rows: int) -> int:
    """Signs per signature, so that ``rows`` unlike vectors make buckets of ``BUCKET`` at most."""
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(1, rows) / BUCKET))))


def tables_for(bits: int, threshold: float, recall: float = RECALL) -> int:
    """Tables of ``bits`` signs by which a pair of cosine ``threshold`` shares a bucket with probability ``recall``."""
    alike = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    if alike >= 1:
        return 1
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-alike)))


def hyperplanes(dimensions: int, tables: int, bits: int, seed: int = SEED) -> np.ndarray:
    """(dimensions, tables * bits) normal components; the same for the same arguments."""
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((dimensions, tables * bits))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)


def signatures(rows: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """(id, vector, copies, signature array<int>) of vectors, scaled to length one; planes by dimensions."""

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits)
        # Slices whose products with all planes stay small.
        few = max(1, (4 << 20) // (tables * bits))
        for batch in (part for whole in batches for part in row_slices(whole, few)):
            size = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for width in np.unique(size):
                part = batch.filter(pa.array(size == width))
                if width not in planes:
                    planes[width] = hyperplanes(int(width), tables, bits, seed)
                vectors = _matrix(part.column(1))
                # Scaled by the largest component first: squares neither overflow nor vanish.
                vectors = vectors / np.abs(vectors).max(1, keepdims=True)
                vectors /= np.sqrt((vectors * vectors).sum(1, keepdims=True))
                signs = (vectors @ planes[width] > 0).reshape(part.num_rows, tables, bits) @ weights
                flat = pa.array(signs.reshape(-1).astype(np.int32))
                ends = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * tables)
                unit = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * int(width))
                unit = pa.ListArray.from_arrays(unit, pa.array(vectors.reshape(-1)))
                columns = [part.column(0), unit, part.column(2), pa.ListArray.from_arrays(ends, flat)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "vector", "copies", "signature"])

    return rows.mapInArrow(run, "id long, vector array<double>, copies long, signature array<int>")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links (a, b) among n nodes."""
    root = list(range(n))
    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        u, v = x, y
        while root[u] != u:
            root[u] = u = root[root[u]]
        while root[v] != v:
            root[v] = v = root[root[v]]
        if u != v:
            root[v] = u
            kept.append((x, y))
    return kept


def _block_links(group: pa.Table, threshold: float) -> pa.Table:
    """Links of one pair of blocks of a bucket: counts per vector, and a forest's edges."""
    table = group.column("table")[0].as_py()
    left = group.column("block").to_numpy() == group.column("low")[0].as_py()
    ids = group.column("id").to_numpy()
    copies = group.column("copies").to_numpy()
    sign = _matrix(group.column("signature"))
    unit = _matrix(group.column("vector"))
    same = group.column("low")[0].as_py() == group.column("high")[0].as_py()
    rows = np.flatnonzero(left)
    cols = rows if same else np.flatnonzero(~left)
    # A block may hold no row of the bucket.
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(rows), 256):
        r = rows[at : at + 256]
        near = unit[r] @ unit[cols].T >= threshold
        if same:
            near &= ids[r][:, None] < ids[cols][None, :]
        i, j = np.nonzero(near)
        i, j = r[i], cols[j]
        # Counted where both share a bucket for the first time only.
        first = np.ones(len(i), bool)
        for t in range(table):
            first &= sign[i, t] != sign[j, t]
        found_a.append(i[first])
        found_b.append(j[first])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    n_links = np.bincount(a, copies[b], len(ids)) + np.bincount(b, copies[a], len(ids))
    hit = np.flatnonzero(n_links)
    edges = _forest(a, b, len(ids))
    none = pa.nulls(len(edges), pa.int64())
    return pa.table(
        {
            "id": pa.concat_arrays([pa.array(ids[hit], pa.int64()), pa.array([ids[x] for x, _ in edges], pa.int64())]),
            "other": pa.concat_arrays([pa.nulls(len(hit), pa.int64()), pa.array([ids[y] for _, y in edges], pa.int64())]),
            "n": pa.concat_arrays([pa.array(n_links[hit].astype(np.int64)), none]),
        }
    )


def links(rows: DataFrame, threshold: float, tables: int, bits: int, block: int, seed: int = SEED) -> DataFrame:
    """(id, other, n): link counts of vectors (other null), and edges that join what links."""
    signed = stage(signatures(rows, tables, bits, seed), "signatures")
    keys = signed.select(
        "id", F.size("vector").alias("width"), F.posexplode("signature").alias("table", "bucket")
    )
    sizes = keys.groupBy("width", "table", "bucket").agg(F.count("*").alias("c")).where("c > 1")
    keys = keys.join(sizes, ["width", "table", "bucket"]).withColumn("blocks", F.ceil(F.col("c") / block).cast("int"))
    keys = keys.withColumn("block", F.pmod(F.xxhash64("id", "table"), F.col("blocks")).cast("int"))
    keys = keys.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = keys.select(
        "id", "width", "table", "bucket", "block",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    work = keys.join(signed, "id")
    group = work.groupBy("width", "table", "bucket", "low", "high")
    return group.applyInArrow(lambda part: _block_links(part, threshold), "id long, other long, n long")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.9,
    tables: int | None = None,
    bits: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row.

    Cosines are of doubles.  Vectors that are null, zero, or hold null or
    non-finite components link with nothing, nor do vectors of different
    lengths.  Rows without an id link with nothing either and get a null
    component.  Rows that repeat an id and vector are copies of each other
    like any others.  Other columns are not read; an empty table gives an
    empty result.  ``bits`` and ``tables`` follow from the number of different
    vectors and the threshold unless they are given.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    largest = F.array_max(F.transform("vector", F.abs))
    usable = F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & (largest > 0)
    rows = stage(rows.withColumn("usable", F.coalesce(usable, F.lit(False))), "vectors")
    # -0.0 + 0.0 is 0.0: vectors that differ in the sign of zeros only are equal.
    same = F.transform("vector", lambda x: x + F.lit(0.0))
    good = rows.where("usable").select("id", same.alias("vector"))
    first = good.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    first = stage(first, "distinct-vectors")
    bits = bits or bits_for(first.count())
    tables = tables or tables_for(bits, threshold)
    found = stage(links(first.select("id", "vector", "copies"), threshold, tables, bits, block), "vector-links")
    counts = found.where("other is null").groupBy("id").agg(F.sum("n").alias("found"))
    parts = components(found.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    per = first.select("id", "vector", "copies").join(counts, "id", "left").join(parts, "id", "left")
    per = per.select(
        F.col("vector").alias("__vector"),
        (F.col("copies") - 1 + F.coalesce("found", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    key = F.when(F.col("usable"), same)
    joined = rows.withColumn("vector", key).join(per, F.col("vector") == F.col("__vector"), "left")
    part = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        part.alias("component_id"),
        (F.col("id").isNull() | (F.col("id") == part)).alias("kept"),
    )


def op6_embedding_near_dedup(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
