"""A trained classifier on disk, and its judgement of documents beside the rules'."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quireline.ml.features import derived
from quireline.ml.search import vectors
from quireline.ml.voting import probability_of
from quireline.tables import opened


@dataclass(frozen=True)
class Bundle:
    """A model, the labels in the order of its numbers, and the features in the order of its vector."""

    model: PipelineModel
    labels: list[str]
    features: list[str]

    def save(self, path: str) -> None:
        """The model first; the bundle is there once its labels and features are."""
        self.model.write().overwrite().save(f"{path}/model")
        fs, at = opened(path)
        with fs.open_output_stream(f"{at}/bundle.json") as f:
            f.write(json.dumps({"labels": self.labels, "features": self.features}).encode())


def load(spark: SparkSession, path: str) -> Bundle:
    fs, at = opened(path)
    try:
        with fs.open_input_stream(f"{at}/bundle.json") as f:
            said = json.loads(f.read())
    except FileNotFoundError as e:
        raise ValueError(f"{path} isn't a model bundle") from e
    return Bundle(PipelineModel.load(f"{path}/model"), said["labels"], said["features"])


def inferred(records: DataFrame, bundle: Bundle, rule: Column, *kept: str) -> DataFrame:
    """``kept``, the model's label and its probabilities by label, and category and reason of the rules, a row a document.

    Features that records lack, or that are null, are 0; derived ones are made here. A record with an error (a column ``error``
    that isn't null) is judged by neither: its label is null and its reason is the error.
    """
    own = derived(records.withColumn("_rule", rule)) if "_rule" not in records.columns else derived(records)
    failed = F.col("error").isNotNull() if "error" in records.columns else F.lit(False)
    own = own.withColumns({"_failed": failed, "_error": F.col("error").cast("string") if "error" in records.columns else F.lit(None).cast("string")})
    own = own.withColumns({f: F.lit(0.0) for f in bundle.features if f not in own.columns})
    out = bundle.model.transform(vectors(own, *kept, "_rule", "_failed", "_error", features=tuple(bundle.features)))
    names = F.array(*map(F.lit, bundle.labels))
    p = F.slice(probability_of(out), 1, len(bundle.labels))
    ok = ~F.col("_failed")
    return out.select(
        *kept, F.when(ok, F.element_at(names, F.col("prediction").cast("int") + 1)).alias("predicted"), F.when(ok, F.map_from_arrays(names, p)).alias("proba"),
        F.when(ok, F.col("_rule.category")).alias("category"), F.when(ok, F.col("_rule.reason")).otherwise(F.col("_error")).alias("reason"),
    )
