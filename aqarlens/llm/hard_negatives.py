"""Hard-negative mining by rotated one-bit codes, interval bounds and integer scores of what they leave.

A row's components are integers; a score is an inner product with an anchor.

1. *Codes.*  A vector is turned by several random rotations and keeps the signs
   as bits.  The bits stand for a code vector in the original space, the sum of
   the turned signs.  Beside the bits a row stores its length, the code
   vector's length and its alignment: the cosine between vector and code vector.
2. *Estimates.*  An anchor is turned alike and its coordinates become small
   integers, one bit plane per binary digit; the product of code vector and
   anchor comes from popcounts of code words and planes.
3. *Intervals.*  A vector is its alignment's share of the code vector's
   direction plus a residual that is orthogonal to it, of known length.  By
   Cauchy-Schwarz the residual's product with the anchor is at most its length
   times that of the anchor's part orthogonal to the code vector; rounding of
   the anchor's coordinates adds what it can have moved at most.  The score
   lies in that interval for certain.
4. *Filter.*  The rows with the best estimates are scored first; a row whose
   interval cannot reach the last place they leave is never scored.  All others
   are scored by integer inner products, so results are exact.

Rows are dealt into blocks, and each block of anchors meets each block of rows
(for positives: of its own label) as one group of bounded size.  A group
returns a few best rows per anchor; the best over all blocks are ranked by a
window that keeps as many rows a key before its shuffle.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aqarlens.llm.common import stage

ROTATIONS = 4
#: Binary digits of an anchor's turned coordinates.
PLANES = 8
SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Percent of the positive's score that a negative's score may have.
SHARE = (50, 95)
#: Anchors and rows that one group holds at most, about.
ANCHORS = 2_048
ROWS = 32_768
#: Rows that a block is not made smaller than for the sake of more tasks.
LEAST_ROWS = 1_024
SEED = 20260102
CODE = "id long, label long, width int, vector array<double>, bits binary, size double, gain double, align double"


@lru_cache(maxsize=4)
def rotations(width: int, count: int, seed: int = SEED) -> np.ndarray:
    """(count * width, width): random orthogonal matrices, one above the other; the same for the same arguments."""
    rng = np.random.Generator(np.random.PCG64(seed))
    turned = [np.linalg.qr(rng.standard_normal((width, width))) for _ in range(count)]
    return np.concatenate([q * np.sign(np.diag(r)) for q, r in turned])


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of bytes, filled up to whole 64-bit words."""
    packed = np.packbits(bits, axis=1)
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))


def codes_of(vectors: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bits as bytes, length, code vector's length, alignment) of each row."""
    turn = rotations(vectors.shape[1], count)
    bits = vectors @ turn.T > 0
    code = np.where(bits, 1.0, -1.0) @ turn / np.sqrt(len(turn))
    size, gain = np.sqrt((vectors * vectors).sum(1)), np.sqrt((code * code).sum(1))
    with np.errstate(invalid="ignore", divide="ignore"):
        align = (code * vectors).sum(1) / (size * gain)
    return _words(bits), size, gain, np.where(size * gain > 0, align, 0.0)


class Block:
    """The rows of one block, with what their codes say about any anchor."""

    def __init__(self, rows: pa.Table, count: int):
        self.ids = rows.column("id").to_numpy()
        self.labels = rows.column("label").to_numpy()
        self.vectors = _matrix(rows.column("vector"))
        self.size, self.gain, self.align = (rows.column(c).to_numpy() for c in ("size", "gain", "align"))
        raw = b"".join(rows.column("bits").to_pylist())
        self.words = np.ascontiguousarray(np.frombuffer(raw, np.uint64).reshape(len(self.ids), -1).T)
        self.turn = rotations(self.vectors.shape[1], count)
        self.set = np.bitwise_count(self.words).sum(0, dtype=np.int64)
        self.off = np.sqrt(np.maximum(0.0, 1 - self.align**2))

    def estimate(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(estimate, low, high) of every row's score."""
        turned = self.turn @ anchor
        n = len(turned)
        low, top = turned.min(), (1 << PLANES) - 1
        step = (turned.max() - low) / top or 1.0
        digits = np.rint((turned - low) / step).astype(np.int64)
        planes = _words((digits[None, :] >> np.arange(PLANES)[:, None] & 1).astype(bool)).view(np.uint64)
        hits = np.zeros(len(self.ids), np.int64)
        for k in range(PLANES):
            count = np.zeros(len(self.ids), np.uint16)
            for word, mask in zip(self.words, planes[k], strict=True):
                count += np.bitwise_count(word & mask)
            hits += count.astype(np.int64) << k
        # Signs are +1 and -1: twice what the set bits hold less the whole.
        product = low * (2 * self.set - n) + step * (2 * hits - digits.sum())
        scale = np.sqrt(n) * np.maximum(self.gain, 1e-300)
        along, slack = product / scale, np.abs(turned - low - step * digits).sum() / scale
        length = float(np.sqrt(anchor @ anchor))
        across = np.sqrt(np.maximum(0.0, length**2 - np.maximum(0.0, np.abs(along) - slack) ** 2))
        middle = self.size * self.align * along
        half = self.size * (np.abs(self.align) * slack + self.off * across)
        half += 1e-9 * (self.size * length + 1)
        return middle, middle - half, middle + half

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Integer inner products; doubles hold them exactly."""
        return (self.vectors[at] @ anchor).astype(np.int64)

    def best(self, at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places in ``at`` of the k best by score, ties by smaller id."""
        if len(at) > k:
            bar = np.partition(scores, len(at) - k)[len(at) - k]
            near = np.flatnonzero(scores >= bar)
        else:
            near = np.arange(len(at))
        return near[np.lexsort((self.ids[at[near]], -scores[near]))[:k]]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    array = column.combine_chunks()
    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)


def top_rows(block: Block, usable: np.ndarray, anchor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k best of the usable rows."""
    at = np.flatnonzero(usable)
    if len(at) > k:
        middle, _, high = block.estimate(anchor)
        first = at[np.argpartition(-middle[at], k)[:k]]
        # The k best have at least the smallest score of any k rows.
        at = at[high[at] >= block.scores(first, anchor).min()]
    scores = block.scores(at, anchor)
    chosen = block.best(at, scores, k)
    return at[chosen], scores[chosen]


def rows_within(
    block: Block, usable: np.ndarray, anchor: np.ndarray, windows: list[tuple[int, int]], k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window [low, high] of scores: (places, scores) of the k best usable rows inside."""
    middle, low, high = block.estimate(anchor)
    alive = np.zeros(len(usable), bool)
    for least, most in windows:
        at = np.flatnonzero(usable & (low <= most) & (high >= least))
        below = at[middle[at] <= most]
        first = below[np.argpartition(-middle[below], 8 * k)[: 8 * k]] if len(below) > 8 * k else below
        seen = block.scores(first, anchor)
        seen = seen[(seen >= least) & (seen <= most)]
        # Once k rows are inside, no worse one can be among the k best.
        bar = np.partition(seen, len(seen) - k)[len(seen) - k] if len(seen) >= k else least
        alive[at[high[at] >= bar]] = True
    at = np.flatnonzero(alive)
    scores = block.scores(at, anchor)
    found = []
    for least, most in windows:
        inside = np.flatnonzero((scores >= least) & (scores <= most))
        chosen = inside[block.best(at[inside], scores[inside], k)]
        found.append((at[chosen], scores[chosen]))
    return found


def coded(rows: DataFrame, count: int) -> DataFrame:
    """The columns of ``CODE`` for rows (id, label, vector) of integers as doubles."""

    def run(batches):
        for batch in batches:
            widths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for width in np.unique(widths):
                part = batch.filter(pa.array(widths == width))
                vectors = _matrix(pa.chunked_array([part.column(2)]))
                if np.abs(vectors).max() ** 2 * width >= 1 << 53:
                    raise ValueError("scaled components are too large for exact scores in doubles")
                bits, size, gain, align = codes_of(vectors, count)
                columns = [
                    part.column(0), part.column(1), pa.array(np.full(len(vectors), width, np.int32)), part.column(2),
                    pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(size), pa.array(gain), pa.array(align),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "width", "vector", "bits", "size", "gain", "align"])

    return rows.mapInArrow(run, CODE)


def _meet(anchors: DataFrame, rows: DataFrame, sizes: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """``fn(anchors, rows)`` of every anchor block with every row block of the same keys.

    ``sizes`` has ``keys``, ``anchor_blocks`` and ``row_blocks``; a side's rows
    are dealt to its blocks by a hash of their id and copied to the other side's.
    """

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        side = side.join(sizes, keys).withColumn(own, F.pmod(F.xxhash64("id"), F.col(f"{own}s")))
        copied = side.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1)))
        return copied.drop("anchor_blocks", "row_blocks").toDF(*[c for c in copied.columns if c not in ("anchor_blocks", "row_blocks")])

    group = [*keys, "anchor_block", "row_block"]
    left = dealt(anchors, "anchor_block", "row_block").groupBy(*group)
    right = dealt(rows, "row_block", "anchor_block").groupBy(*group)
    return left.cogroup(right).applyInArrow(fn, schema)


def _sizes(codes: DataFrame, keys: list[str], is_anchor) -> DataFrame:
    """How many blocks the anchors and rows of each key make; small tables are dealt to the session's tasks."""
    tasks = codes.sparkSession.sparkContext.defaultParallelism
    counted = codes.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), F.count_if(is_anchor).alias("a"))
    spread = F.least(F.lit(2 * tasks), F.ceil(F.col("c") / LEAST_ROWS))
    blocks = F.greatest(F.ceil(F.col("c") / ROWS), spread).cast("long")
    return counted.where("a > 0").select(
        *keys, F.ceil(F.col("a") / ANCHORS).cast("long").alias("anchor_blocks"), blocks.alias("row_blocks")
    )


def _ranked(found: DataFrame, keys: list[str], score: str, id_: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(id_))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def positives_of(codes: DataFrame, is_anchor, k: int = POSITIVES, count: int = ROTATIONS) -> DataFrame:
    """(anchor_id, positive_id, score, rank): the k best other rows of each anchor's label."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"anchor_id": [], "positive_id": [], "score": []}
        if anchors.num_rows and rows.num_rows:
            block = Block(rows, count)
            for id_, vector in zip(anchors.column("id").to_pylist(), _matrix(anchors.column("vector")), strict=True):
                at, scores = top_rows(block, block.ids != id_, vector, k)
                out["anchor_id"] += [id_] * len(at)
                out["positive_id"] += block.ids[at].tolist()
                out["score"] += scores.tolist()
        return pa.table(out, schema=pa.schema([(c, pa.int64()) for c in out]))

    keys = ["width", "label"]
    anchors = codes.where(is_anchor).select("id", "width", "label", "vector")
    found = _meet(anchors, codes, _sizes(codes, keys, is_anchor), keys, run, "anchor_id long, positive_id long, score long")
    return _ranked(found, ["anchor_id"], "score", "positive_id", k)


def negatives_of(
    codes: DataFrame, positives: DataFrame, is_anchor, k: int = NEGATIVES, share: tuple[int, int] = SHARE, count: int = ROTATIONS
) -> DataFrame:
    """(anchor_id, positive_id, positive_score, negative_id, negative_score, rank) for each anchor and positive."""
    least, most = share
    columns = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = {c: [] for c in columns}
        if anchors.num_rows and rows.num_rows:
            block = Block(rows, count)
            vectors = _matrix(anchors.column("vector"))
            for vector, row in zip(vectors, anchors.select(["id", "label", "positives"]).to_pylist(), strict=True):
                windows = {}
                for p in row["positives"]:
                    # least * p <= 100 * n <= most * p in integers; empty below zero.
                    window = -(-least * p["score"] // 100), most * p["score"] // 100
                    if window[0] <= window[1]:
                        windows.setdefault(window, []).append(p)
                found = rows_within(block, block.labels != row["label"], vector, list(windows), k)
                for (at, scores), same in zip(found, windows.values(), strict=True):
                    for p in same:
                        out["anchor_id"] += [row["id"]] * len(at)
                        out["positive_id"] += [p["positive_id"]] * len(at)
                        out["positive_score"] += [p["score"]] * len(at)
                        out["negative_id"] += block.ids[at].tolist()
                        out["negative_score"] += scores.tolist()
        return pa.table(out, schema=pa.schema([(c, pa.int64()) for c in columns]))

    held = positives.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "score")).alias("positives"))
    anchors = codes.where(is_anchor).select("id", "width", "label", "vector")
    anchors = anchors.join(held, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    found = _meet(anchors, codes, _sizes(codes, ["width"], is_anchor), ["width"], run, ", ".join(f"{c} long" for c in columns))
    return _ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", k)


def hard_negatives(
    rows: DataFrame,
    anchors="id % 50 = 0",
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    share: tuple[int, int] = SHARE,
    count: int = ROTATIONS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor's positives.

    ``anchors`` is a condition on the column ``id``.  Rows without id, label or
    vector, with an empty vector or a null or non-finite component take no part.
    An id counts once: of rows that repeat it, the one with the smallest label,
    then vector.  Only vectors of equal length are compared.  Equal scores are
    ordered by id.  Other columns are not read; an empty table gives an empty
    result.  Components too large for exact scores in doubles are an error.
    """
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    named = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    usable = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size(vector) > 0) & finite)
    whole = usable.select("id", F.struct("label", F.transform(vector, lambda x: F.floor(x * scale).cast("double")).alias("vector")).alias("row"))
    once = whole.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.vector")
    codes = stage(coded(once, count), "one-bit-codes")
    is_anchor = F.expr(anchors)
    best = stage(positives_of(codes, is_anchor, positives, count), "positives")
    found = negatives_of(codes, best, is_anchor, negatives, share, count)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


OP13_SQL = """
WITH rows_ AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, s.id AS negative_id, p.positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
