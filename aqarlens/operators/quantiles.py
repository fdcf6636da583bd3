"""Quantiles: exact (``percentile_disc`` semantics) and approximate.

``percentile_disc`` in Spark keeps a value→count map for the whole column in
one final task, which does not survive billions of distinct prices.  The
exact operator here narrows each requested rank down to a value range that
holds at most ``final_rows`` rows, then ranks only that range:

1. one aggregate per round: row count and ``percentile_approx`` bucket
   boundaries of every open range (bounded-memory sketches);
2. a range still larger than ``final_rows`` is cut at those boundaries by
   ``Bucketizer`` (binary search, JVM); one small aggregate counts rows per
   bucket (≤ ``buckets`` groups per range, combined map-side) and the driver
   keeps the bucket holding the rank — the next round's range;
3. once every range is small, one job groups each range by value and takes
   a running count; a hot value collapses to one row in the map-side partial
   aggregate, so skew never reaches the window.

Each round shrinks a range about ``buckets``-fold, so a window task never
sees more than ``final_rows`` rows whatever the table size.  The result is
the value at 1-based rank ``max(1, ceil(n·q))`` among the non-null, non-NaN
values, i.e. Spark's ``percentile_disc`` and DuckDB's ``quantile_disc``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 1024
DEFAULT_FINAL_ROWS = 1_000_000


def _values(df: DataFrame, column: str) -> DataFrame:
    value = F.col(column).cast("double")
    return df.select(value.alias("v")).where(value.isNotNull() & ~F.isnan(value))


@dataclass
class _Range:
    """Values of column ``col`` in [low, high) (high = +inf is inclusive)."""

    col: int
    low: float
    high: float

    def contains(self, value: Column) -> Column:
        condition = value.isNotNull()
        if self.low != -math.inf:
            condition = condition & (value >= F.lit(self.low))
        if self.high != math.inf:
            condition = condition & (value < F.lit(self.high))
        return condition


def _rank_whole_columns(wide: DataFrame, names: list[str], values: list[str], requests) -> dict[str, list[float | None]]:
    """One job: group each column by value, running count and column total
    from windows (one window partition per column, ≤ ``final_rows`` rows),
    pick the value at rank max(1, ceil(n·q))."""
    pieces = [
        F.when(F.col(v).isNotNull(), F.struct(F.lit(i).alias("r"), F.col(v).alias("v"))) for i, v in enumerate(values)
    ]
    by_column = Window.partitionBy("r")
    ranked = (
        wide.select(F.explode(F.array(*pieces)).alias("e"))
        .where(F.col("e").isNotNull())
        .select("e.r", "e.v")
        .groupBy("r", "v")
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("through", F.sum("rows").over(by_column.orderBy("v").rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("n", F.sum("rows").over(by_column))
    )
    wanted = [(i, k, float(p)) for i, name in enumerate(names) for k, p in enumerate(requests[name])]
    picks = ranked.agg(
        *[
            F.min(
                F.when(
                    (F.col("r") == i) & (F.col("through") >= F.greatest(F.lit(1.0), F.ceil(F.col("n") * F.lit(p)))),
                    F.col("v"),
                )
            ).alias(f"q{j}")
            for j, (i, _, p) in enumerate(wanted)
        ]
    ).first()
    result: dict[str, list[float | None]] = {name: [None] * len(requests[name]) for name in names}
    for j, (i, k, _) in enumerate(wanted):
        value = picks[f"q{j}"]
        result[names[i]][k] = None if value is None else float(value)
    return result


def exact_quantiles_multi(
    df: DataFrame,
    requests: Mapping[str, Sequence[float]],
    buckets: int | None = None,
    final_rows: int = DEFAULT_FINAL_ROWS,
    row_hint: int | None = None,
) -> dict[str, list[float | None]]:
    """Exact discrete quantiles for several columns.

    ``requests`` maps column → probabilities; each column uses its own
    non-null, non-NaN values.  Returns column → values (``None`` when the
    column has no value).  ``row_hint`` is an upper bound on the rows, if
    known: at most ``final_rows`` means one job in all.  Otherwise two jobs
    when every column fits ``final_rows``, two more per refinement round.
    """
    names = list(requests)
    for name in names:
        for p in requests[name]:
            if not 0.0 <= float(p) <= 1.0:
                raise ValueError(f"probability {p} outside [0, 1]")
    if row_hint is not None and row_hint <= final_rows:
        cols = [f"v{i}" for i in range(len(names))]
        small = df.select(
            *[
                F.when(F.isnan(F.col(name).cast("double")), None).otherwise(F.col(name).cast("double")).alias(v)
                for name, v in zip(names, cols)
            ]
        )
        return _rank_whole_columns(small, names, cols, requests)
    bucket_total = max(2, int(buckets or DEFAULT_BUCKETS))
    fractions = [i / bucket_total for i in range(1, bucket_total)]
    accuracy = max(10_000, 10 * bucket_total)
    values = [f"v{i}" for i in range(len(names))]
    wide = df.select(
        *[
            F.when(F.isnan(F.col(name).cast("double")), None).otherwise(F.col(name).cast("double")).alias(v)
            for name, v in zip(names, values)
        ]
    )
    result: dict[str, list[float | None]] = {name: [None] * len(requests[name]) for name in names}

    # targets: (column, probability slot, range, rank within range); rank None until counted.
    targets: list[list] = [[i, k, _Range(i, -math.inf, math.inf), None] for i in range(len(names)) for k in range(len(requests[names[i]]))]
    done: list[list] = []
    while targets:
        ranges: dict[tuple, _Range] = {}
        for target in targets:
            r = target[2]
            ranges.setdefault((r.col, r.low, r.high), r)
        keys = list(ranges)
        # Job: size and sketch of every open range.
        stats = wide.agg(
            *[F.count_if(ranges[key].contains(F.col(values[key[0]]))).alias(f"n{j}") for j, key in enumerate(keys)],
            *[
                F.percentile_approx(
                    F.when(ranges[key].contains(F.col(values[key[0]])), F.col(values[key[0]])), fractions, accuracy
                ).alias(f"s{j}")
                for j, key in enumerate(keys)
            ],
        ).first()
        sizes = {key: int(stats[f"n{j}"]) for j, key in enumerate(keys)}
        sketches = {key: stats[f"s{j}"] or [] for j, key in enumerate(keys)}
        still_open = []
        for target in targets:
            col, slot, r, rank = target
            key = (r.col, r.low, r.high)
            if rank is None:
                if sizes[key] == 0:
                    continue  # empty column: stays None
                rank = max(1, math.ceil(sizes[key] * float(requests[names[col]][slot])))
                target[3] = rank
            if sizes[key] <= final_rows:
                done.append(target)
            else:
                still_open.append(target)
        if not still_open:
            targets = []
            break
        # Cut every large range at its sketch boundaries; count rows per piece.
        open_keys = list({(t[2].col, t[2].low, t[2].high) for t in still_open})
        splits = {}
        for key in open_keys:
            # Cut at each boundary and just above it, so a hot value ends up
            # alone in a one-value piece instead of blocking the split.
            cuts = set()
            for b in sketches[key]:
                if b is not None and math.isfinite(b):
                    cuts.update((float(b), math.nextafter(float(b), math.inf)))
            inner = sorted(c for c in cuts if key[1] < c < key[2])
            if inner:
                splits[key] = [key[1], *inner, key[2]]
        # A range with no interior cut holds a single value: rank it as it is.
        done.extend(t for t in still_open if (t[2].col, t[2].low, t[2].high) not in splits)
        still_open = [t for t in still_open if (t[2].col, t[2].low, t[2].high) in splits]
        open_keys = [key for key in open_keys if key in splits]
        if not open_keys:
            targets = []
            break
        cut_cols = [f"x{j}" for j in range(len(open_keys))]
        piece_cols = [f"p{j}" for j in range(len(open_keys))]
        restricted = wide.select(
            *[
                F.when(ranges[key].contains(F.col(values[key[0]])), F.col(values[key[0]])).alias(cut)
                for key, cut in zip(open_keys, cut_cols)
            ]
        )
        pieces = Bucketizer(
            splitsArray=[_bucketizer_splits(splits[key]) for key in open_keys],
            inputCols=cut_cols,
            outputCols=piece_cols,
            handleInvalid="keep",
        ).transform(restricted)
        counted = (
            pieces.select(
                F.explode(
                    F.array(
                        *[
                            F.struct(F.lit(j).alias("r"), F.col(piece_cols[j]).alias("piece"), F.col(cut_cols[j]).alias("x"))
                            for j in range(len(open_keys))
                        ]
                    )
                ).alias("e")
            )
            .where(F.col("e.x").isNotNull())
            .groupBy("e.r", "e.piece")
            .agg(F.count(F.lit(1)).alias("rows"))
            .collect()
        )
        per_range: dict[int, list[tuple[int, int]]] = {}
        for row in counted:
            per_range.setdefault(int(row["r"]), []).append((int(row["piece"]), int(row["rows"])))
        targets = []
        for target in still_open:
            col, slot, r, rank = target
            key = (r.col, r.low, r.high)
            j = open_keys.index(key)
            edges = splits[key]
            running = 0
            for piece, rows in sorted(per_range.get(j, [])):
                if running + rows >= rank:
                    break
                running += rows
            narrowed = _Range(col, edges[piece], edges[piece + 1])
            if (narrowed.low, narrowed.high) == (r.low, r.high):
                raise RuntimeError(f"no cut of [{r.low}, {r.high}) was found for column {names[col]!r}")
            targets.append([col, slot, narrowed, rank - running])

    if done:
        # Final job: rank each (small) range by value.
        final_ranges: dict[tuple, int] = {}
        for _, _, r, _ in done:
            final_ranges.setdefault((r.col, r.low, r.high), len(final_ranges))
        pieces = []
        for (col, low, high), j in final_ranges.items():
            r = _Range(col, low, high)
            pieces.append(F.when(r.contains(F.col(values[col])), F.struct(F.lit(j).alias("r"), F.col(values[col]).alias("v"))))
        ranked = (
            wide.select(F.explode(F.array(*pieces)).alias("e"))
            .where(F.col("e").isNotNull())
            .select("e.r", "e.v")
            .groupBy("r", "v")
            .agg(F.count(F.lit(1)).alias("rows"))
            .withColumn(
                "through",
                F.sum("rows").over(Window.partitionBy("r").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)),
            )
        )
        picks = ranked.agg(
            *[
                F.min(
                    F.when(
                        (F.col("r") == final_ranges[(t[2].col, t[2].low, t[2].high)]) & (F.col("through") >= t[3]),
                        F.col("v"),
                    )
                ).alias(f"q{k}")
                for k, t in enumerate(done)
            ]
        ).first()
        for k, (col, slot, _, _) in enumerate(done):
            value = picks[f"q{k}"]
            result[names[col]][slot] = None if value is None else float(value)
    return result


def _bucketizer_splits(edges: list[float]) -> list[float]:
    """Bucketizer needs ±inf ends to keep every in-range value."""
    return [-math.inf, *edges[1:-1], math.inf]


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    buckets: int | None = None,
    final_rows: int = DEFAULT_FINAL_ROWS,
    row_hint: int | None = None,
) -> list[float | None]:
    """Exact discrete quantiles of one column; ``None`` for each when empty."""
    return exact_quantiles_multi(df, {column: list(probabilities)}, buckets, final_rows, row_hint)[column]


def approx_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], relative_error: float = 0.01
) -> list[float | None]:
    """Greenwald–Khanna quantiles (``DataFrame.approxQuantile``); nulls and NaN ignored."""
    result = _values(df, column).approxQuantile("v", [float(p) for p in probabilities], relative_error)
    if not result:
        return [None] * len(probabilities)
    return [float(x) for x in result]


def quantiles(
    df: DataFrame,
    column: str,
    probabilities: Sequence[float],
    method: str = "exact",
    relative_error: float = 0.01,
) -> list[float | None]:
    if method == "exact":
        return exact_quantiles(df, column, probabilities)
    if method == "approx":
        return approx_quantiles(df, column, probabilities, relative_error)
    raise ValueError(f"unknown quantile method {method!r}")


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    method: str = "exact",
    relative_error: float = 0.01,
) -> DataFrame:
    """Long table ``(column, probability, value)`` of quantiles per column."""
    if method == "exact":
        found = exact_quantiles_multi(df, {column: list(probabilities) for column in columns})
    else:
        found = {column: quantiles(df, column, probabilities, method, relative_error) for column in columns}
    rows = [
        (column, float(p), value)
        for column in columns
        for p, value in zip(probabilities, found[column])
    ]
    return df.sparkSession.createDataFrame(rows, "column string, probability double, value double")


#: Size parameter of the sketches: ranks are within about 0.4% with it.
SKETCH_SIZE = 800


def sketch_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], group: Sequence[str] = (), size: int = SKETCH_SIZE
) -> DataFrame:
    """``(*group, probability, value)``: approximate quantiles of every group from one mergeable sketch each.

    A sketch is a partial aggregate of bounded size, so a group that holds most
    rows is combined before the shuffle.  Nulls and NaN do not count; a group
    without a number has null values.
    """
    number = F.col(column).cast("double")
    # Groups without numbers keep a row: their sketch is null, and so are their values.
    sketched = df.groupBy(*group).agg(
        F.kll_sketch_agg_double(F.when(~F.isnan(number), number), size).alias("__sketch"), F.count_if(number.isNotNull() & ~F.isnan(number)).alias("__n")
    )
    values = [
        F.struct(
            F.lit(float(p)).alias("probability"),
            F.when(F.col("__n") > 0, F.kll_sketch_get_quantile_double("__sketch", F.lit(float(p)))).alias("value"),
        )
        for p in probabilities
    ]
    return sketched.select(*group, F.explode(F.array(*values)).alias("__r")).select(*group, "__r.*")
