"""Mixing sources to target weights by temperature.

A source's share of tokens is raised to an exponent and normalised.  The
exponent is bisected until the weights reach a target entropy, or until no
source has to be repeated more often than a limit.  A token budget times the
weight says how many tokens a source gives; it is realised by passes over
permutations of the source's blocks: whole passes as far as they fit, then the
first blocks of one more permutation, until the budget is met.

Every document has a place in its source's permutation of a pass: a hash of
(seed, pass, source, document), whose high bits name its block.  The place at
which the last pass ends is found by histograms of token sums over blocks, then
over blocks within the block that holds it, and so on, each at most
``BLOCKS`` sums per source; no source's rows meet in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aqarlens.llm.common import free_names, stage

#: Blocks of a permutation, and of each block within it (a power of two).
BLOCK_BITS = 8
BLOCKS = 1 << BLOCK_BITS
#: Bits of a place; a shift by so many gives 0, the path of the first level.
PLACE_BITS = 63
BROADCAST_ROWS = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def shares(tokens: dict, exponent: float) -> dict:
    """Normalised weights of sources: their token shares to the power of ``exponent``."""
    total = sum(tokens.values())
    raised = {s: (n / total) ** exponent for s, n in tokens.items() if n > 0}
    norm = math.fsum(raised.values())
    return {s: x / norm for s, x in raised.items()}


def entropy(weights: dict) -> float:
    """In nats."""
    return -math.fsum(w * math.log(w) for w in weights.values() if w > 0)


def _budget(tokens: dict, weights: dict, budget: float | None, keep_all: bool) -> float:
    if keep_all:
        return max((tokens[s] / w for s, w in weights.items()), default=0)
    return sum(tokens.values()) if budget is None else budget


def fit_exponent(
    tokens: dict,
    target_entropy: float | None = None,
    max_repeats: float | None = None,
    budget: float | None = None,
    keep_all: bool = False,
    steps: int = 60,
) -> float:
    """The exponent in [0, 1] whose weights meet the target.

    With ``target_entropy``: the largest exponent with at least that entropy
    (1 keeps the shares, 0 makes sources equal; targets out of reach give the
    nearer end).  With ``max_repeats``: the smallest exponent at which a budget
    of ``budget`` tokens (all tokens by default) repeats no source more than so
    many times; 1 if all do.  ``keep_all`` takes the budget of each exponent
    at which every source is passed over once at least.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give either a target entropy or a repetition limit")
    if not any(n > 0 for n in tokens.values()):
        return 1.0

    def flat_enough(exponent):
        weights = shares(tokens, exponent)
        if target_entropy is not None:
            return entropy(weights) >= target_entropy
        give = _budget(tokens, weights, budget, keep_all)
        return any(give * w > max_repeats * tokens[s] for s, w in weights.items())

    low, high = 0.0, 1.0
    if flat_enough(high):
        return high
    if not flat_enough(low):
        return low
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if flat_enough(middle) else (low, middle)
    return low if target_entropy is not None else high


def with_tokens(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, tokens): words of each document; null text has none, null sources form one source."""
    n = F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(WORD)).cast("long")
    return docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), n.alias("tokens"))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    target_entropy: float | None = None,
    max_repeats: float | None = 1.25,
    budget: int | None = None,
    keep_all: bool = False,
    seed: int = 1,
) -> DataFrame:
    """One row per document: id, source, tokens, weight, budget (both the source's) and copies.

    ``copies`` is how often the mixture takes the document: the whole passes
    over its source, and one more if its place in the last permutation comes
    before the budget is met (the document that crosses it is taken).  A
    document without tokens is taken in whole passes only, once at least if
    the source gives anything.  With ``keep_all`` every document is taken once
    at least, also where its source has no token.  Null sources are a source of
    their own.  Rows
    that repeat an id and its token count share a place.  Other columns are not
    read.  An empty table gives an empty result.
    """
    rows = stage(with_tokens(docs, id_col, text_col, source_col), "mix-tokens")
    # One row per source reaches the driver: the catalogue of sources, not the corpus.  All at once, as an
    # iterator would run one job per partition of the shuffle, nearly all of them on nothing.
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    tokens = {r["source"]: r["tokens"] for r in totals.collect()}
    exponent = fit_exponent(tokens, target_entropy, max_repeats, budget, keep_all)
    weights = shares(tokens, exponent) if any(tokens.values()) else {}
    give = _budget(tokens, weights, budget, keep_all)
    plan = []
    for source, n in tokens.items():
        weight = weights.get(source, 0.0)
        want = round(give * weight)
        passes = want // n if n else 0
        plan.append((source, weight, want, passes, want - passes * n if n else 0))
    schema = "source string, weight double, budget long, passes long, rest long"
    plan, known = docs.sparkSession.createDataFrame(plan, schema).withColumnRenamed("source", "__source"), len(plan)
    placed = rows.join(_small(plan, known), rows["source"].eqNullSafe(plan["__source"])).drop("__source")
    order = F.xxhash64(F.lit(seed), F.col("passes"), F.col("source"), F.col("id"), F.col("tokens"))
    # 63 bits: a place is its own unsigned value at every level.
    placed = placed.withColumn("place", F.shiftrightunsigned(order, 1))
    placed = _taken(placed)
    whole = F.when((F.col("tokens") == 0) & (F.col("budget") > 0), F.greatest("passes", F.lit(1))).otherwise(F.col("passes"))
    return placed.select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col),
        "tokens",
        "weight",
        "budget",
        F.greatest(whole + (F.col("taken") & (F.col("tokens") > 0)).cast("long"), F.lit(int(keep_all))).alias("copies"),
    )


def _small(table: DataFrame, rows: int) -> DataFrame:
    """Mark a table for broadcast if its counted rows are few; else the planner joins it by shuffle."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def _taken(placed: DataFrame) -> DataFrame:
    """Adds ``taken``: the tokens of the documents before this one in its source's order are below ``rest``."""
    spark = placed.sparkSession
    rests = placed.groupBy("source").agg(F.first("rest").alias("rest")).where("rest > 0")
    cuts = [(r["source"], 0, r["rest"], 2) for r in rests.collect()]
    schema, bits = "__s string, path long, left long, n long", 0
    cut = spark.createDataFrame(cuts, schema)
    while bits < PLACE_BITS and any(n > 1 for *_, n in cuts):
        # Blocks of this level within the block in which each source's budget ends.
        finer = min(bits + BLOCK_BITS, PLACE_BITS)
        block = F.shiftright("place", PLACE_BITS - finer)
        inside = F.shiftright("place", PLACE_BITS - bits) == F.col("path")
        sums = placed.join(_small(cut, len(cuts)), placed["source"].eqNullSafe(F.col("__s")) & inside)
        sums = sums.groupBy("__s", block.alias("block")).agg(
            F.sum("tokens").alias("t"), F.first("left").alias("left"), F.count("*").alias("n")
        )
        before = Window.partitionBy("__s").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("left", F.col("left") - F.coalesce(F.sum("t").over(before), F.lit(0)))
        # The last block that begins before the budget is met; at most BLOCKS rows per source are compared.
        last = sums.where("left > 0").groupBy("__s").agg(F.max(F.struct("block", "left", "n")).alias("m"))
        cuts = [(r["__s"], r["m"]["block"], r["m"]["left"], r["m"]["n"]) for r in last.collect()]
        cut = spark.createDataFrame(cuts, schema)
        bits = finer
    # Documents that share all bits of their place are taken together.
    joined = placed.join(_small(cut, len(cuts)), placed["source"].eqNullSafe(F.col("__s")), "left")
    place = F.shiftright("place", PLACE_BITS - bits)
    return joined.withColumn("taken", F.coalesce(place <= F.col("path"), F.lit(False)))


def repeat_rows(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as ``mixed`` (of the same documents) takes it, with all their columns.

    Null ids count as one id; rows that share an id are taken as often as the
    one of them that ``mixed`` takes most.
    """
    key, times, number = free_names(docs, "__id", "__copies", "__k")
    copies = mixed.groupBy(F.col(id_col).alias(key)).agg(F.max("copies").alias(times))
    joined = docs.join(copies, F.col(id_col).eqNullSafe(F.col(key))).where(F.col(times) > 0)
    return joined.withColumn(number, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times)))).select(*docs.columns)


def op8_mix_sources(spark, sf_dir):
    """All tokens as budget; no source passed over more than 1.25 times."""
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
