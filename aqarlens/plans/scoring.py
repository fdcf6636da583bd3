"""Model bundles (save / load) and scoring of new listings.

A bundle folder holds the fitted ``PipelineModel``, the target-encoding
mapping (Parquet), the cleaning values and one JSON metadata line (model
name, features, target, metrics).  Everything is written through Spark, so
the folder can live on the cluster's shared storage.  Each save makes a folder
of its own, and the metadata comes last: a folder without it is no bundle, and
an earlier one is never touched.

Scoring applies the same parsing, imputation (saved medians), payment rules,
features and encodings as training, so raw text never reaches the
assembler.  Optional flag columns that the input lacks count as not set; rows
with any other feature missing get a null prediction instead of failing the job.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aqarlens.functions.features import BOOLEAN_FLAG_COLUMNS
from aqarlens.operators.cleaning import fill_defaults, parse_listing_columns, standardize_payment_method
from aqarlens.operators.encoding import TargetEncodingModel, apply_target_encoding
from aqarlens.operators.features import add_listing_features
from aqarlens.plans.cleaning import CleaningModel
from aqarlens.plans.config import FEATURES, TARGET
from aqarlens.session import cut_code


@dataclass
class ModelBundle:
    model: PipelineModel
    model_name: str
    features: tuple[str, ...] = FEATURES
    target: str = TARGET
    metrics: dict[str, Any] = field(default_factory=dict)
    encoding: TargetEncodingModel | None = None
    cleaning: CleaningModel | None = None

    def save(self, base: str, version: str | None = None) -> str:
        """Write the bundle into a new folder below ``base`` and return the folder."""
        spark = SparkSession.getActiveSession()
        name = version or f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
        path = f"{base.rstrip('/')}/{name}"
        self.model.write().save(f"{path}/model")
        if self.encoding is not None:
            self.encoding.save(f"{path}/encoding")
        meta = {
            "model_name": self.model_name,
            "features": list(self.features),
            "target": self.target,
            "metrics": self.metrics,
            "model_persisted": True,
            "cleaning": asdict(self.cleaning) if self.cleaning is not None else None,
            "has_encoding": self.encoding is not None,
        }
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.text(f"{path}/meta")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ModelBundle":
        meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
        if not meta.get("model_persisted", True):
            raise RuntimeError(f"{path} has the metrics of a model that was not stored")
        return cls(
            model=PipelineModel.load(f"{path}/model"),
            model_name=meta["model_name"],
            features=tuple(meta["features"]),
            target=meta["target"],
            metrics=meta.get("metrics", {}),
            encoding=TargetEncodingModel.load(spark, f"{path}/encoding") if meta.get("has_encoding") else None,
            cleaning=CleaningModel(**meta["cleaning"]) if meta.get("cleaning") else None,
        )


def prepare_for_scoring(raw: DataFrame, bundle: ModelBundle) -> DataFrame:
    """Raw listings → model features, with the bundle's saved values.

    The steps are cut into methods that the JVM compiles (``cut_code``).
    """
    df = cut_code(raw)
    if any(name not in df.columns for name in bundle.features):
        absent = [name for name in BOOLEAN_FLAG_COLUMNS if name not in df.columns]
        df = df.withColumns({name: F.lit(None).cast("string") for name in absent}) if absent else df
        df = parse_listing_columns(df)
        if bundle.cleaning is not None:
            df = fill_defaults(df, bundle.cleaning.bedroom_median, bundle.cleaning.bathroom_median)
        if "payment_method" in df.columns:
            df = standardize_payment_method(df)
        df = cut_code(add_listing_features(df))
        if bundle.encoding is not None:
            df = apply_target_encoding(df, bundle.encoding)
        lacking = [name for name in bundle.features if name not in df.columns]
        df = df.withColumns({name: F.lit(None).cast("double") for name in lacking}) if lacking else df
    return cut_code(df.withColumns({name: F.col(name).try_cast("double") for name in bundle.features}))


def predict_price_per_sqm(bundle: ModelBundle, raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Score every row in one pass: ``prediction`` (log space) and
    ``predicted_price_per_sqm``.

    A row with a missing feature is fed zeros and its prediction masked to
    null, so incomplete rows neither fail the assembler nor need a second
    scan.  The vector column is dropped so any sink can hold the result.
    """
    ready = prepare_for_scoring(raw, bundle)
    complete = F.lit(True)
    for name in bundle.features:
        complete = complete & F.col(name).isNotNull() & ~F.isnan(F.col(name))
    columns = list(keep) or [c for c in ready.columns if c not in bundle.features]
    # Kept columns that are also features are carried aside, so the output
    # shows their real values rather than the zeros fed to the model.
    carried = {name: f"__kept_{i}" for i, name in enumerate(columns) if name in bundle.features}
    guarded = (
        ready.withColumn("__complete", complete)
        .withColumns({alias: F.col(name) for name, alias in carried.items()})
        .withColumns(
            {name: F.when(F.col("__complete"), F.col(name)).otherwise(F.lit(0.0)) for name in bundle.features}
        )
    )
    scored = bundle.model.transform(guarded)
    prediction = F.when(F.col("__complete"), F.col("prediction"))
    return scored.select(
        *[F.col(carried[name]).alias(name) if name in carried else F.col(name) for name in columns],
        prediction.alias("prediction"),
        F.expm1(prediction).alias("predicted_price_per_sqm"),
    )
