"""Queries that SQL can't say: pixel operators over drawn pages, models, services. Imported for its entries in the catalog."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from quireline.config import CATEGORIES
from quireline.functions.text import basename, page_name
from quireline.ml import features, inference, models, search
from quireline.operators import ocr as services
from quireline.operators import orientation, ranks, reports, routing, rules
from quireline.plans.catalog import Tables, classified, documents, query, rounded, training
from quireline.raster import synthetic, udfs
from quireline.sources import pagefiles, sinks
from quireline.tables import shared_folder, written


@query()
def raster_metrics(t: Tables):
    return rounded(udfs.page_metrics(synthetic.frame(t.spark)).drop("image"))


@query()
def raster_brightness(t: Tables):
    return rounded(udfs.page_brightness(synthetic.frame(t.spark)).drop("image"))


@query()
def line_detect(t: Tables):
    return udfs.lines(synthetic.frame(t.spark)).drop("image")


@query()
def line_clean(t: Tables):
    return udfs.lines(udfs.cleaned(synthetic.frame(t.spark))).select("path", "has_line", "orientation", "error")


@query()
def deskew(t: Tables):
    return udfs.deskewed(synthetic.frame(t.spark)).select("path", F.round("angle", 2).alias("angle"), "image.height", "image.width", "error")


@query()
def orientation_turn(t: Tables):
    own = synthetic.frame(t.spark).withColumn("cls", F.pmod(F.crc32(F.col("path").cast("binary")), F.lit(4)).cast("int"))
    own = own.withColumn("angle", orientation.correction(F.col("cls"), F.lit(0.9)))
    return udfs.turned(own.drop("error")).select("path", "cls", "angle", "image.height", "image.width", "error")


@query()
def lighten(t: Tables):
    return rounded(udfs.page_brightness(udfs.lightened(synthetic.frame(t.spark))).drop("image"))


def _folder(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def _stored(t: Tables) -> str:
    """A folder of a PDF for each conversation, a page for each turn: a gray image one pixel high, of which the pixels are the text's bytes and a line feed."""
    own = t("conversations").select(F.concat(F.col("conv_id").cast("string"), F.lit(".pdf")).alias("path"), "turn", F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).cast("binary").alias("data"))
    numbered = ranks.ranked(own, "turn", "data", by=("path",), rank="page_no").withColumn("page_no", (F.col("page_no") + 1).cast("int"))
    image = numbered.select("path", "page_no", F.lit("raw").alias("encoding"), F.length("data").alias("width"), F.lit(1).alias("height"), F.lit(1).alias("channels"), "data", F.lit(None).cast("string").alias("error"))
    folder = _folder(t, "documents")
    sinks.document_files(image, folder)
    return folder


def _in(folder: str, names):
    """The files of these names, without a listing of the folder."""
    return names.select(F.concat(F.lit(f"{folder}/"), "name").alias("path")).distinct()


def _documents(t: Tables):
    return _in(_stored(t), t("conversations").select(F.concat(F.col("conv_id").cast("string"), F.lit(".pdf")).alias("name")))


@query()
def pages_through_files(t: Tables):
    """Documents written as PDFs and read back by ranges of pages."""
    own = pagefiles.pages(_documents(t))
    return own.select(basename(F.col("path")).alias("name"), "page_no", "width", F.md5("data").alias("digest"), "error")


@query()
def pages_split_to_files(t: Tables):
    """Documents' pages written as PDFs of their own and read back."""
    folder = _folder(t, "pages")
    whole = written(pagefiles.pages(_documents(t)))  # read once, for the files and for their names
    sinks.page_files(whole, folder)
    names = whole.select(page_name(basename(F.col("path")), F.col("page_no")).alias("name"))
    return pagefiles.pages(_in(folder, names)).select(basename(F.col("path")).alias("name"), "page_no", "width", F.md5("data").alias("digest"), "error")


@query()
def routed_records(t: Tables):
    """Documents written by category: how many the manifest says, and how many there are."""
    folder = _folder(t, "routed")
    counts = sinks.routed(routing.by_category(classified(t, rules.extended())), folder, CATEGORIES)
    said = t.spark.createDataFrame(list(counts.items()), "category string, n long")
    own = t.spark.createDataFrame([], "category string, n_read long")
    for c in CATEGORIES:
        own = own.unionByName(sinks.target(t.spark, folder, c).agg(F.lit(c).alias("category"), F.count("*").alias("n_read")))
    return said.join(own, "category")


@query()
def ocr_runs(t: Tables):
    pages = t("conversations").select(F.col("conv_id").cast("string").alias("path"), F.col("turn").cast("int").alias("page_no"), F.col("text").cast("binary").alias("content"))
    return services.run_log(services.recognised(pages))


def _rows(t: Tables, docs=None):
    """Documents are made once and written: folds read them twice, to find the ranges and to deal them."""
    own = features.derived(training(t, written(documents(t)) if docs is None else docs)).select("path", "label", *features.FEATURES)
    return reports.folds(own, "label", F.struct(F.xxhash64("path", F.lit(models.SEED)), F.col("path")))


def _searched(t: Tables, *names: str):
    """The candidates of these names over all five folds."""
    results = f"{shared_folder(t.spark)}/search-{uuid.uuid4().hex}"
    return search.summary(search.searched(search.Assembled(_rows(t)), results, {n: search.CANDIDATES[n] for n in names or search.CANDIDATES}))


@query()
def model_search(t: Tables):
    """Every candidate on every fold."""
    return _searched(t).select("name", "cv_mean", "cv_std", "folds", "n", "is_best")


@query()
def train_rf(t: Tables):
    return _searched(t, "rf_50_5").select("cv_mean", "cv_std", "n")


@query()
def train_lr(t: Tables):
    return _searched(t, "lr_1").select("cv_mean", "cv_std", "n")


@query()
def train_gbt_ovr(t: Tables):
    return _searched(t, "gb_50_4").select("cv_mean", "cv_std", "n")


@query()
def train_svm(t: Tables):
    """The radial kernel."""
    return _searched(t, "svm").select("cv_mean", "cv_std", "n")


def _forest(rows):
    return models.fitted(rows, RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=20, maxDepth=5, seed=models.SEED))


@query()
def predict(t: Tables):
    rows = _rows(t)
    return models.predicted(_forest(rows), rows, "path").withColumn("proba", F.map_values("proba"))


@query()
def infer_documents(t: Tables):
    """A model that was saved and read again judges all documents; its label stands beside the rules' category and reason."""
    docs = written(documents(t))
    own, path = search.Assembled(_rows(t, docs)), _folder(t, "model")
    inference.Bundle(Pipeline(stages=[search.forest(20, 5)]).fit(own.table.drop("fold")), own.labels, list(features.FEATURES)).save(path)
    out = inference.inferred(docs, inference.load(t.spark, path), rules.decide(rules.extended()), "path")
    return out.select("path", "predicted", F.transform(F.map_values("proba"), lambda x: F.round(x, 6)).alias("proba"), "category", "reason")


@query()
def vote(t: Tables):
    """All documents judged by the mean probability of four models that were fitted on all."""
    rows = _rows(t)
    own = search.Assembled(rows)
    model = search.CANDIDATES["vote"](sum(own.sizes.values()), len(own.labels)).fit(own.table.drop("fold"))
    names = F.array(*map(F.lit, own.labels))
    return model.transform(search.vectors(rows, "path")).select("path", F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted"))


@query()
def importances(t: Tables):
    return t.spark.createDataFrame(models.importances(_forest(_rows(t))), "feature string, importance double")
