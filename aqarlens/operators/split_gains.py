"""Regression-tree splits as tables: gains of all thresholds, stumps, boosted stumps.

Rows are counted and summed by feature and value once; running sums over each
feature's sorted values give the gain in variance of every threshold between
two neighbouring values.  The sorted table may have as many rows as a feature
has values, so running sums are taken within ranges of it and shifted by the
sums of the ranges before, of which there are as many as partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aqarlens.operators.moments import unfolded
from aqarlens.session import materialize

SUMS = ("n", "s", "q")


def value_sums(df: DataFrame, features: Sequence[str], label: Column) -> DataFrame:
    """``(feature, value, n, s, q)``: rows, label sum and sum of squared labels of each feature's values.

    ``feature`` is the number in ``features``; rows with a null value or label do not count.
    """
    items = [{"value": F.col(name).cast("double"), "y": label} for name in features]
    rows = unfolded(df, items).withColumnRenamed("item", "feature").dropna()
    return rows.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q")
    )


def running_sums(sums: DataFrame, mode: str = "auto") -> DataFrame:
    """``sums`` with ``n_left, s_left, q_left`` up to each value, ``next_value`` and the feature's totals."""
    # Written once: the partition numbers must be the same for the ranges' sums and for their rows.
    ranged = materialize(sums.repartitionByRange("feature", "value").withColumn("range", F.spark_partition_id()), mode)
    totals = [F.sum(c).alias(f"{c}_range") for c in SUMS]
    ranges = ranged.groupBy("feature", "range").agg(F.min("value").alias("first"), *totals)
    order = Window.partitionBy("feature").orderBy("range")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    ranges = ranges.select(
        F.col("feature").alias("f"),
        F.col("range").alias("r"),
        F.lead("first").over(order).alias("first_after"),
        *[F.coalesce(F.sum(f"{c}_range").over(before), F.lit(0)).alias(f"{c}_before") for c in SUMS],
        *[F.sum(f"{c}_range").over(whole).alias(f"{c}_all") for c in SUMS],
    )
    # As many rows as ranges: features times partitions at most.
    joined = ranged.join(F.broadcast(ranges), (F.col("feature") == F.col("f")) & (F.col("range") == F.col("r")))
    inside = Window.partitionBy("feature", "range").orderBy("value")
    return joined.select(
        "feature",
        "value",
        F.coalesce(F.lead("value").over(inside), "first_after").alias("next_value"),
        *[(F.sum(c).over(inside) + F.col(f"{c}_before")).alias(f"{c}_left") for c in SUMS],
        *[f"{c}_all" for c in SUMS],
    )


def _variance(n: Column, s: Column, q: Column) -> Column:
    return q / n - (s / n) * (s / n)


def split_gains(df: DataFrame, features: Sequence[str], label: Column, min_rows: int = 1, mode: str = "auto") -> DataFrame:
    """``(feature, threshold, gain, n, n_left, left_mean, right_mean)`` of every threshold that leaves ``min_rows`` on both sides.

    ``value <= threshold`` goes left; a threshold is the middle between neighbouring
    values; the gain is the label's variance less that within both sides.
    """
    left, whole = [F.col(f"{c}_left") for c in SUMS], [F.col(f"{c}_all") for c in SUMS]
    right = [a - b for a, b in zip(whole, left, strict=True)]
    share = left[0] / whole[0]
    gain = _variance(*whole) - share * _variance(*left) - (F.lit(1.0) - share) * _variance(*right)
    sums = running_sums(value_sums(df, features, label), mode)
    inner = sums.where(F.col("next_value").isNotNull() & (left[0] >= min_rows) & (right[0] >= min_rows))
    return inner.select(
        "feature",
        ((F.col("value") + F.col("next_value")) / 2).alias("threshold"),
        gain.alias("gain"),
        F.col("n_all").alias("n"),
        left[0].alias("n_left"),
        (left[1] / left[0]).alias("left_mean"),
        (right[1] / right[0]).alias("right_mean"),
    )


def best_split(gains: DataFrame):
    """The row of the largest positive gain; ties go to the first feature, then the lowest threshold.  None without one."""
    return gains.where("gain > 0").orderBy(F.desc("gain"), "feature", "threshold").limit(1).first()


def boosted_stumps(
    df: DataFrame, features: Sequence[str], label: str, rounds: int = 2, step: float = 0.1, min_rows: int = 1, mode: str = "auto"
) -> tuple[Column, list]:
    """(prediction, splits) of gradient-boosted trees of depth one on squared loss.

    The first stump predicts the label itself; each further one predicts twice
    what is left of it and counts by ``step``.  The prediction so far is a column
    of the chosen splits, so every round is one aggregate over the rows.
    """
    prediction: Column = F.lit(0.0)
    splits = []
    for k in range(rounds):
        left_over = F.col(label) if k == 0 else 2 * (F.col(label) - prediction)
        found = best_split(split_gains(df, features, left_over.cast("double"), min_rows, mode))
        if found is None:
            break
        below = F.col(features[found["feature"]]).cast("double") <= found["threshold"]
        stump = F.when(below, F.lit(found["left_mean"])).otherwise(F.lit(found["right_mean"]))
        prediction = stump if k == 0 else prediction + F.lit(step) * stump
        splits.append(found)
    return prediction, splits
