"""Vector code compression: product codes whose nearest entries come from a trie over distinct parts.

Vectors of integers are cut into equal parts; each part position has a codebook.
Equal parts are collapsed to one row with its weight and kept in lexicographic
order, so a stretch of rows is a trie whose levels are dimensions.  A
depth-first walk carries, for every codebook entry, the squared distance
accumulated over the dimensions so far: parts with a common prefix share it, a
branch adds its own dimensions, and leaves add their tails, take the smallest
distance and give their weighted components to the sums of that entry.

Each round reads the table of distinct parts once; a task emits one row per
part position and entry at most.  On the driver are the codebooks only, whose
size the parameters fix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqarlens.llm.common import stage

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Largest size of an integer component: sums of squared distances stay exact in 64 bits.
LARGEST = 1 << 24


def _matrix(array: pa.Array) -> np.ndarray:
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(array), len(flat) // max(1, len(array)))


def _kind(parts: np.ndarray, entries: np.ndarray) -> type:
    """float64 where all distances are exact in it, else int64."""
    most = max([1, *(int(np.abs(x).max()) for x in (parts, entries) if x.size)])
    if most > LARGEST:
        raise ValueError(f"a scaled component is larger than {LARGEST}")
    return np.float64 if 4 * most * most * max(1, parts.shape[1]) < 1 << 52 else np.int64


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest entry of each part; ties go to the lower index.

    ``parts`` are distinct rows in lexicographic order.
    """
    n, width = parts.shape
    index, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    kind = _kind(parts, entries)
    rows, entry = parts.astype(kind), entries.astype(kind)
    # Squares of the entries' tails from each dimension on.
    tail = np.zeros((width + 1, len(entry)), kind)
    tail[:width] = np.cumsum((entry.T * entry.T)[::-1], axis=0)[::-1]

    def leaves(at: np.ndarray, depth: int, shared: np.ndarray) -> None:
        """Rows that share their first ``depth`` dimensions, and no more with any other row."""
        for low in range(0, len(at), 2048):
            own = at[low : low + 2048]
            x = rows[own, depth:]
            far = shared + tail[depth] - 2 * (x @ entry[:, depth:].T)
            best = far.argmin(1)
            index[own] = best
            distance[own] = far[np.arange(len(own)), best] + (x * x).sum(1)

    # Nodes of the walk: rows [first, last), which share ``depth`` dimensions, and the distances over these.
    walk = [(0, n, 0, np.zeros(len(entry), kind))] if n else []
    while walk:
        first, last, depth, shared = walk.pop()
        # The rows are sorted: what the first and the last share, all do.
        differ = np.flatnonzero(parts[first, depth:] != parts[last - 1, depth:])
        deep = depth + int(differ[0]) if len(differ) else width
        if deep > depth:
            shared = shared + ((rows[first, depth:deep] - entry[:, depth:deep]) ** 2).sum(1)
        if deep == width:
            leaves(np.arange(first, last), width, shared)
            continue
        at = first + np.flatnonzero(np.diff(parts[first:last, deep], prepend=parts[first, deep] - 1))
        size = np.diff(at, append=last)
        if (alone := at[size == 1]).size:
            leaves(alone, deep, shared)
        many = np.flatnonzero(size > 1)[::-1]
        walk += [(int(at[k]), int(at[k] + size[k]), deep, shared) for k in many]
    return index, distance


def distinct_sorted(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows in lexicographic order, and each row's place among them."""
    if not parts.shape[1]:
        return parts[:1], np.zeros(len(parts), np.int64)
    order = np.lexsort(parts.T[::-1])
    new = np.ones(len(parts), bool)
    new[1:] = (parts[order[1:]] != parts[order[:-1]]).any(1)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(new) - 1
    return parts[order[new]], place


def distinct_parts(vectors: DataFrame, width: int, parts: int) -> DataFrame:
    """(position, part, weight): each position's different parts in lexicographic order over the partitions."""
    size = width // parts
    slices = F.array(*[F.slice("vector", 1 + p * size, size) for p in range(parts)])
    cut = vectors.select(F.posexplode(slices).alias("position", "part"))
    counted = cut.groupBy("position", "part").agg(F.count(F.lit(1)).alias("weight"))
    return counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part")


def _round(distinct: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(position, entry, n, sums): weights and weighted component sums of the parts nearest to each entry."""
    held = distinct.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        n = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            position = batch.column(0).to_numpy()
            weight = batch.column(2).to_numpy()
            for p in np.unique(position):
                own = np.flatnonzero(position == p)
                rows = _matrix(batch.column(1).take(pa.array(own)))
                index, _ = nearest(rows, books[p])
                np.add.at(n[p], index, weight[own])
                np.add.at(sums[p], index, rows * weight[own][:, None])
        for p in range(len(books)):
            (hit,) = np.nonzero(n[p])
            yield pa.RecordBatch.from_pydict(
                {
                    "position": pa.array(np.full(len(hit), p, np.int32)),
                    "entry": pa.array(hit.astype(np.int32)),
                    "n": pa.array(n[p][hit]),
                    "sums": pa.array(sums[p][hit].tolist(), pa.list_(pa.int64())),
                }
            )

    found = distinct.mapInArrow(run, "position int, entry int, n long, sums array<long>")
    width = books[0].shape[1]
    total = F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).cast("array<long>")
    return found.groupBy("position", "entry").agg(F.sum("n").alias("n"), total.alias("sums"))


def fit_codebooks(vectors: DataFrame, width: int, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """The codebook of each part position, from (id, vector) rows of ``width`` integers."""
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    start = np.array([r.vector for r in first], np.int64).reshape(len(first), parts, width // parts)
    books = [start[:, p].copy() for p in range(parts)]
    distinct = stage(distinct_parts(vectors, width, parts), "distinct-parts")
    for _ in range(rounds):
        for r in _round(distinct, books).collect():
            books[r.position][r.entry] = np.array(r.sums, np.int64) // r.n
    return books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(id, label, code, error) per row of (id, label, vector); a vector of another length has neither."""
    held = vectors.sparkSession.sparkContext.broadcast(books)
    width = sum(b.shape[1] for b in books)
    fields = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = held.value
        digits = np.array([f"{k:02x}" for k in range(max(map(len, books)))])
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            own = np.flatnonzero(lengths == width)
            rows = _matrix(batch.column(2).take(pa.array(own)))
            rows = rows.reshape(len(own), width)
            code = np.full(len(own), "", object)
            error = np.zeros(len(own), np.int64)
            for p, book in enumerate(books):
                size = book.shape[1]
                different, place = distinct_sorted(rows[:, p * size : (p + 1) * size])
                index, far = nearest(different, book)
                code += digits[index[place]].astype(object)
                error += far[place]
            codes, errors = np.full(batch.num_rows, None, object), np.zeros(batch.num_rows, np.int64)
            codes[own], errors[own] = code, error
            none = lengths != width
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, mask=none)],
                names=["id", "label", "code", "error"],
            )

    return vectors.mapInArrow(run, f"id {fields['id']}, label {fields['label']}, code string, error long")


def integer_vectors(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, label, vector array<long>) of the rows whose vector is there and finite; components floor(scale * x)."""
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    return named.where(vector.isNotNull() & finite).select("id", "label", F.transform(vector, lambda x: F.floor(x * scale)).alias("vector"))


def part_codes(
    rows: DataFrame,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) per row that has a usable vector.

    Rows whose vector is null or holds null or non-finite components are left
    out.  The vectors' length is that of the row with the smallest id (null ids
    come last, ties go to the smaller vector) and must be a multiple of
    ``parts``; rows of another length get neither code nor error.  Repeated
    rows weigh as often as they occur and give a row each.  Null labels make one
    group.  Fewer rows than ``entries`` make a smaller codebook; an empty table
    an empty result.  Other columns are not read.  A scaled component beyond
    2^24 is an error.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256: codes have two hex digits a part")
    vectors = stage(integer_vectors(rows, id_col, label_col, vector_col, scale), "integer-vectors")
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").select(F.size("vector").alias("width")).first()
    width = first.width if first else 0
    if width % parts:
        raise ValueError(f"{width} components make no {parts} equal parts")
    even = vectors.where(F.size("vector") == width)
    books = fit_codebooks(even, width, parts, entries, rounds) if first else [np.zeros((1, 0), np.int64)] * parts
    coded = stage(encode(vectors, books), "part-codes")
    labels = coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error"))
    joined = coded.join(labels, F.col("label").eqNullSafe(F.col("same")))
    digest = F.lit(codebooks_digest(books))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", digest.alias("codebooks_sha256"))


def op11_part_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql() -> str:
    """The same in DuckDB: one row per part, dimension and entry."""
    nearest_of = (
        "near{r} AS MATERIALIZED (SELECT vec_id, p, min_by(e, far * 1000 + e) AS e, min(far) AS far FROM (SELECT q.vec_id, q.p, b.e, "
        "list_sum(list_transform(list_zip(q.part, b.part), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS far "
        "FROM parts q JOIN book{r} b ON q.p = b.p) GROUP BY vec_id, p)"
    )
    book_of = (
        "sums{r} AS MATERIALIZED (SELECT p, e, d, sum(x) AS s, count(*) AS n FROM (SELECT n.p, n.e, unnest(q.part) AS x, "
        "unnest(range(1, len(q.part) + 1)) AS d FROM near{r} n JOIN parts q ON q.vec_id = n.vec_id AND q.p = n.p) GROUP BY p, e, d), "
        "book{next} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.part, b.part) AS part FROM book{r} b LEFT JOIN "
        "(SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS part FROM sums{r} GROUP BY p, e) m "
        "ON m.p = b.p AND m.e = b.e)"
    )
    steps = [
        "WITH kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v "
        "FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "parts AS MATERIALIZED (SELECT vec_id, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS part FROM kept, range(4) AS t(p))",
        "book0 AS MATERIALIZED (SELECT p, e, part FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) USING (vec_id) "
        "WHERE e < 256)",
    ]
    for r in range(ROUNDS):
        steps += [nearest_of.format(r=r), book_of.format(r=r, next=r + 1)]
    steps += [
        nearest_of.format(r=ROUNDS),
        f"coded AS MATERIALIZED (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(far) AS BIGINT) AS error FROM near{ROUNDS} GROUP BY vec_id)",
        f"digest AS (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{ROUNDS})",
    ]
    return (
        ",\n".join(steps) + "\nSELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, "
        "(SELECT codebooks_sha256 FROM digest) AS codebooks_sha256 FROM coded JOIN kept USING (vec_id)"
    )


OP11_SQL = _sql()
