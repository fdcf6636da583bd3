"""File sources and sinks: headered CSV and Parquet.

Pass an explicit schema where it is known; inference costs a full extra
pass over CSV and guesses types from text.  Writes are parallel (one file
per partition) unless ``single_file`` is asked for, which funnels the last
stage through one task and is only meant for small reports.

CSV text is quoted, with quotes doubled, on both sides.  A line break inside a
value can only be read back with ``multi_line``, which makes files
unsplittable; without it the writer refuses such values.  Prefer Parquet.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aqarlens.operators.moments import unfolded


def read_listings(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: StructType | str | None = None,
    infer_schema: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Read raw listings (also scoring input): headered CSV or Parquet."""
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    if fmt != "csv":
        raise ValueError(f"unsupported format {fmt!r}")
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    single_file: bool = False,
    partition_by: list[str] | None = None,
    multi_line: bool = False,
) -> None:
    """Overwrite ``path`` with ``df`` (CSV with header, or Parquet)."""
    if fmt == "csv" and not multi_line:
        df = _without_line_breaks(df)
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        # Keep text exactly as it is (the writer trims by default).  CSV
        # still reads an empty string back as null.
        writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def _without_line_breaks(df: DataFrame) -> DataFrame:
    """The same rows; a text value with a line break fails the write instead of making two records."""
    checked = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, StringType):
            message = F.lit(f"column {field.name} holds a line break; write CSV with multi_line or use Parquet")
            value = F.col(f"`{field.name}`")
            checked[field.name] = F.when(value.rlike("[\r\n]"), F.raise_error(message)).otherwise(value)
    return df.withColumns(checked) if checked else df


#: Types that text may hold, narrowest first.
INFERRED = ("boolean", "bigint", "double", "date", "timestamp")
CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class CheckedRead:
    """Typed rows, rejected records ``(record, reason)`` and the schema that tells them apart."""

    good: DataFrame
    bad: DataFrame
    schema: StructType


def inferred_schema(texts: DataFrame, share: float = 0.95) -> StructType:
    """The narrowest type that at least ``share`` of each text column's values have; else string.

    One scan and one grouped aggregate for all columns.  A column without a
    value is a string.
    """
    items = [{"value": F.trim(F.col(f"`{name}`"))} for name in texts.columns]
    # Narrower than the casts: 1 is no boolean, and a time of day makes no date.
    own = {"boolean": F.lower("value").isin("true", "false"), "date": F.char_length("value") <= 10}
    fits = [F.count_if(F.col("value").try_cast(kind).isNotNull() & own.get(kind, F.lit(True))).alias(kind) for kind in INFERRED]
    counted = unfolded(texts, items).where("value is not null").groupBy("item").agg(F.count("value").alias("n"), *fits)
    found = {row["item"]: row for row in counted.collect()}

    def kind_of(k: int) -> str:
        row = found.get(k)
        return next((kind for kind in INFERRED if row and row[kind] >= share * row["n"]), "string")

    return StructType.fromDDL(", ".join(f"`{name}` {kind_of(k)}" for k, name in enumerate(texts.columns)))


def read_checked(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    columns: Sequence[str] | None = None,
    share: float = 0.95,
    multi_line: bool = False,
) -> CheckedRead:
    """Read CSV into typed good rows and bad records, neither of which is dropped in silence.

    Records with more or fewer fields than the header (or ``columns``, for
    files without one) are bad for the reason ``fields``; others that hold a
    text which is no value of its column's type, for the names of those columns.
    Without ``schema`` the types are inferred from the well-formed records, so a
    few wrong values do not turn a number column into text.  Empty fields are null.
    """
    reader = spark.read.option("escape", '"').option("multiLine", multi_line).option("columnPruning", False)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    names = list(columns or reader.option("header", True).csv(path).columns)
    every = StructType([StructField(name, StringType()) for name in [*names, CORRUPT]])
    texts = reader.option("header", columns is None).schema(every).csv(path)
    formed = texts.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    schema = schema or inferred_schema(formed, share)
    kinds = {field.name: field.dataType.simpleString() for field in schema.fields}

    def typed(name: str):
        text = F.col(f"`{name}`")
        return text if kinds[name] == "string" else F.trim(text).try_cast(kinds[name])

    wrong = [F.when(F.col(f"`{n}`").isNotNull() & typed(n).isNull(), F.lit(n)) for n in names if kinds[n] != "string"]
    reason = F.concat_ws(",", *wrong) if wrong else F.lit("")
    checked = texts.withColumn("__reason", F.when(F.col(CORRUPT).isNotNull(), F.lit("fields")).otherwise(reason))
    good = checked.where(F.col("__reason") == "").select(*[typed(name).alias(name) for name in names])
    record = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[F.col(f"`{n}`") for n in names])))
    bad = checked.where(F.col("__reason") != "").select(record.alias("record"), F.col("__reason").alias("reason"))
    return CheckedRead(good, bad, schema)
