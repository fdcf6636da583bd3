from __future__ import annotations

from pyspark.sql import functions as F

from aqarlens.catalog import queries as q
from aqarlens.plans.scoring import predict_price_per_sqm
from aqarlens.streaming.scoring import read_listing_stream, score_listing_stream


def test_restarted_stream_scores_every_row_once(spark, sf_dir, tmp_path):
    bundle = q.bundle(spark, sf_dir)
    raw = q.raw(spark, sf_dir).coalesce(4)
    source, output = str(tmp_path / "incoming"), str(tmp_path / "scored")

    def drain():
        stream = read_listing_stream(spark, source, raw.schema, max_files_per_trigger=2)
        score_listing_stream(bundle, stream, output).awaitTermination(300)
        return spark.read.parquet(output)

    raw.where("listing_id % 2 = 0").write.parquet(source)
    assert drain().count() == raw.where("listing_id % 2 = 0").count()
    raw.where("listing_id % 2 = 1").write.mode("append").parquet(source)
    streamed = drain()
    batch = predict_price_per_sqm(bundle, raw, keep=("listing_id",))
    cols = ["listing_id", "prediction"]
    assert streamed.count() == raw.count()
    assert streamed.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert streamed.where(F.col("prediction").isNull()).count() == batch.where(F.col("prediction").isNull()).count()
