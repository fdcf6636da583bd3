"""Score listings as they land, with Structured Streaming.

Scoring is row-local (parsing, saved medians, features) plus stream-static
left joins against the small encoding mapping, so the batch scorer applies
unchanged to a streaming DataFrame and needs no state store.  The query's
checkpoint belongs to its output: the file sink keeps a log of committed
batches there, so a restart must find the same checkpoint again.  Its place is
therefore derived from the output path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from aqarlens.plans.scoring import ModelBundle, predict_price_per_sqm


def read_listing_stream(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", max_files_per_trigger: int | None = None
) -> DataFrame:
    """New files under ``path`` as a stream (schema is required for streams)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


def score_listing_stream(
    bundle: ModelBundle,
    stream: DataFrame,
    output_path: str,
    keep: tuple[str, ...] = ("listing_id",),
    checkpoint_location: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append scored rows to Parquet at ``output_path``; returns the running query.

    The checkpoint is ``<output_path>-checkpoint`` unless given; a later call
    with the same output goes on after the last committed batch.
    """
    if checkpoint_location is None:
        checkpoint_location = f"{output_path.rstrip('/')}-checkpoint"
    scored = predict_price_per_sqm(bundle, stream, keep=keep)
    writer = (
        scored.writeStream.format("parquet")
        .option("path", output_path)
        .option("checkpointLocation", checkpoint_location)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
