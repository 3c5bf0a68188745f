"""Token counts as delta-maintained rollups.

Totals by source, language and tokenizer version are never counted anew: inserts, deletes and revised counts become signed
deltas, a batch of deltas is committed under its id at most once, and totals are sums over committed batches. Additive
deltas need no order, so batches may come late or twice.

A commit is a marker that only one writer can create; it names the folder that the batch was written to before. Maintained
totals are snapshots: each holds the sums over the batches that it names, and is itself a marker over a folder. Reading adds
to the newest snapshot the batches that came after it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quireline.llm.common import durable, shared_folder
from quireline.llm.tokenizing import counts, encoder, public_vocabulary

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_chars")
VERSIONS = ("byte_bpe_50k", "byte_bpe_multi_50k")


def counted(docs: DataFrame, vocabularies: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """doc_id, source, lang, tokenizer, n_tokens, n_chars: a row for each row of ``docs`` and tokenizer version, over whole texts.

    Null texts have no tokens and no characters. Other columns aren't read.
    """
    known = vocabularies or {v: public_vocabulary(v) for v in VERSIONS}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = [encoder(*files) for files in known.values()]
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column(3).to_pylist()
                n = [counts(t, encoders) for t in texts]
                chars = pa.array([len(t or "") for t in texts], pa.int64())
                for k, version in enumerate(known):
                    yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([version] * len(texts)), pa.array([x[k] for x in n], pa.int64()), chars], ["doc_id", "source", "lang", "tokenizer", "n_tokens", "n_chars"])

    own = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("text").cast("string"))
    return own.mapInArrow(run, "doc_id long, source string, lang string, tokenizer string, n_tokens long, n_chars long")


def inserted(rows: DataFrame) -> DataFrame:
    """Signed deltas of counted rows that come in."""
    return rows.select(*KEYS, F.lit(1).cast("long").alias("n_docs"), "n_tokens", "n_chars")


def deleted(rows: DataFrame) -> DataFrame:
    """Signed deltas of counted rows that go; a row that was never inserted makes totals too low, as in any ledger."""
    return rows.select(*KEYS, F.lit(-1).cast("long").alias("n_docs"), (-F.col("n_tokens")).alias("n_tokens"), (-F.col("n_chars")).alias("n_chars"))


def revised(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed deltas of rows whose counts, source, language or version changed: what was goes, what is comes in."""
    return deleted(before).unionByName(inserted(after))


class Rollups:
    """The ledger in one shared folder: ``data`` of batches and snapshots, ``commits`` and ``snapshots`` of markers."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Adds a batch of deltas, aggregated first; False, and no change, if a batch of that id is there already.

        The deltas are written aside; then the batch's marker is created, which fails if it exists, so of several writers
        one commits, and a batch is there as a whole or not at all.
        """
        if not batch or not all(c.isalnum() or c in "-_" for c in batch):
            raise ValueError(f"{batch!r} isn't a batch id: letters, digits, - and _ only")
        if self._files.exists(self._path(f"{self.folder}/commits/{batch}")):
            return False
        return self._publish(f"commits/{batch}", f"data/{batch}", summed(deltas), [])

    def _publish(self, marker: str, place: str, rows: DataFrame, batches: list[str]) -> bool:
        data = f"{place}/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/{data}")
        try:
            stream = self._files.create(self._path(f"{self.folder}/{marker}"), False)  # exclusive
        except Py4JJavaError as e:
            self._files.delete(self._path(f"{self.folder}/{data}"), True)
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        stream.write(json.dumps({"data": data, "batches": batches}).encode())
        stream.close()
        return True

    def _marked(self, kind: str) -> list[str]:
        there = self._path(f"{self.folder}/{kind}")
        return sorted(s.getPath().getName() for s in self._files.listStatus(there) if not s.getPath().getName().startswith((".", "_"))) if self._files.exists(there) else []

    def _marker(self, kind: str, name: str) -> dict | None:
        """What a marker says. One whose writer was lost before it could say so names the first whole folder of its batch:
        all writers of a batch write the same. None for a snapshot of that kind, which no reader needs."""
        lines = self.spark.read.text(f"{self.folder}/{kind}/{name}", wholetext=True).collect()
        if lines and lines[0][0]:
            return json.loads(lines[0][0])
        if kind != "commits":
            return None
        tries = sorted(s.getPath() for s in self._files.listStatus(self._path(f"{self.folder}/data/{name}")))
        return {"data": next(f"data/{name}/{p.getName()}" for p in tries if self._files.exists(self._path(p, "_SUCCESS"))), "batches": []}

    def batches(self) -> list[str]:
        return self._marked("commits")

    def _newest(self) -> tuple[int, dict]:
        for name in reversed(self._marked("snapshots")):
            if said := self._marker("snapshots", name):
                return int(name), said
        return 0, {"data": None, "batches": []}

    def compact(self) -> bool:
        """Maintains the totals: a snapshot of the newest one and the batches since. False if there are none, or another writer was first."""
        number, newest = self._newest()
        since = [b for b in self.batches() if b not in set(newest["batches"])]
        last = max([number, *(int(n) for n in self._marked("snapshots"))])
        return bool(since) and self._publish(f"snapshots/{last + 1:012d}", "data/-totals", self._sums(newest, since), sorted([*newest["batches"], *since]))

    def _sums(self, newest: dict, since: list[str]) -> DataFrame:
        places = [newest["data"]] * bool(newest["data"]) + [self._marker("commits", b)["data"] for b in since]
        schema = ", ".join([f"{k} string" for k in KEYS] + [f"{s} long" for s in SUMS])
        own = self.spark.read.schema(schema).parquet(*(f"{self.folder}/{p}" for p in places)) if places else self.spark.createDataFrame([], schema)
        return summed(own).where(" or ".join(f"{s} <> 0" for s in SUMS))

    def totals(self) -> DataFrame:
        """Sums over all committed batches: the newest snapshot and what came after it. Keys of which nothing is left aren't there."""
        _, newest = self._newest()
        known = set(newest["batches"])
        return self._sums(newest, [b for b in self.batches() if b not in known])

    def drop(self) -> None:
        self._files.delete(self._path(self.folder), True)


def summed(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(*(F.sum(s).alias(s) for s in SUMS))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Totals after four batches over the whole table: all documents come in; those labelled as of low quality go; the
    counts of one version are revised to include the id that closes a document; the first batch is sent once more. Totals
    are compacted in between. Null sources and languages are keys of their own; rows that repeat count each; labels without
    a document change nothing; of an empty table there are no totals."""
    spark = docs.sparkSession
    rows = durable(counted(docs))
    low = labels.where("quality = 0").select("doc_id").distinct()
    stay = rows.join(low, "doc_id", "left_anti").where(F.col("tokenizer") == VERSIONS[0])
    ledger = Rollups(spark, f"{shared_folder(spark)}/rollups-{uuid.uuid4().hex}")
    ledger.commit("load", inserted(rows))
    ledger.commit("retract", deleted(rows.join(low, "doc_id", "left_semi")))
    ledger.compact()
    ledger.commit("close", revised(stay, stay.withColumn("n_tokens", F.col("n_tokens") + 1)))
    ledger.commit("load", inserted(rows))
    out = durable(ledger.totals())
    ledger.drop()
    return out
