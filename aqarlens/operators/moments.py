"""One mergeable aggregate over many columns or pairs of columns, in one scan.

Each row is unfolded into one short row per item (a column or a pair of
columns), so a single grouped aggregate with a handful of fields serves any
number of items: it stays within generated code, where one aggregate with
fields for all items would leave it, and is combined before its shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unfolded(df: DataFrame, items: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One row per row and item: ``item`` (its number) and the item's columns."""
    rows = [F.struct(F.lit(k).alias("item"), *[value.alias(name) for name, value in item.items()]) for k, item in enumerate(items)]
    return df.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def item_stats(df: DataFrame, items: Sequence[Mapping[str, Column]], stats: Sequence[Column], labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """``labels`` (a text per item) and ``stats`` of every item; items without a row have null statistics."""
    found = unfolded(df, items).groupBy("item").agg(*stats)
    number = F.col("id").cast("int")
    texts = [F.element_at(F.array(*map(F.lit, values)), number + 1).alias(name) for name, values in labels.items()]
    named = df.sparkSession.range(0, len(items), 1, 1).select(number.alias("number"), *texts)
    # At most a row per item.
    return named.join(F.broadcast(found), F.col("number") == F.col("item"), "left").drop("number", "item")


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], labels: Mapping[str, Sequence[str]]) -> DataFrame:
    """``labels`` and ``pearson_r`` of each pair of columns; rows with a null in the pair are skipped.

    A pair with a column that never changes has a null.
    """
    items = []
    for x, y in pairs:
        one, other = F.col(x).cast("double"), F.col(y).cast("double")
        items.append({"x": F.when(other.isNotNull(), one), "y": F.when(one.isNotNull(), other)})
    # Not corr(), which fails on a constant column in ANSI mode.
    r = F.try_divide(F.covar_pop("x", "y"), F.stddev_pop("x") * F.stddev_pop("y"))
    return item_stats(df, items, [r.alias("pearson_r")], labels)


def covariances(df: DataFrame, columns: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, means, population covariances) of the rows that have a number in every column.

    One scan and one aggregate; the result has as many values as pairs of columns.
    """
    whole = df.select(*[F.col(name).cast("double").alias(name) for name in columns]).dropna()
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1)]
    items = [{"x": F.col(columns[i]), "y": F.col(columns[j])} for i, j in pairs]
    stats = [F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.covar_pop("x", "y").alias("covar")]
    means, matrix, n = np.zeros(len(columns)), np.zeros((len(columns), len(columns))), 0
    for row in unfolded(whole, items).groupBy("item").agg(*stats).collect():
        i, j = pairs[row["item"]]
        matrix[i, j] = matrix[j, i] = row["covar"]
        means[i], n = row["mean"], row["n"]
    return n, means, matrix


def ridge(df: DataFrame, features: Sequence[str], label: str, penalty: float = 0.0) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) that minimise half the mean squared error plus the penalty on scaled coefficients.

    The penalty is ``penalty / (2 sd(label))`` times the sum of squared
    coefficients of features scaled to deviation one, as Spark's linear
    regression has it for a ridge penalty with standardisation.  Solved from
    the normal equations of one aggregate; features without spread get 0.
    """
    n, means, matrix = covariances(df, [*features, label])
    if not n:
        raise ValueError("no row has a number in every feature and the label")
    spread = np.diag(matrix)[:-1]
    deviation = float(np.sqrt(matrix[-1, -1]))
    weight = penalty / deviation if deviation else 0.0
    used = spread > 0
    solved = np.zeros(len(features))
    gram = matrix[:-1, :-1][np.ix_(used, used)] + weight * np.diag(spread[used])
    solved[used] = np.linalg.lstsq(gram, matrix[:-1, -1][used], rcond=None)[0]
    return solved, float(means[-1] - solved @ means[:-1])
