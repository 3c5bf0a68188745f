"""Recognition by a service: a callable a page, retried with growing pauses; each page keeps its own status."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.config import OcrParams
from quireline.functions.text import cer, pages_joined, response_text
from quireline.operators.compare import with_reference


class Failed(Exception):
    """A service's answer that may be asked for again (``again``) or not."""

    def __init__(self, text: str, again: bool):
        super().__init__(text)
        self.again = again


Client = Callable[[bytes], tuple[int, str, str]]  # page -> status, content type, body


def ask(client: Client, page: bytes, p: OcrParams = OcrParams(), sleep: Callable[[float], None] = time.sleep) -> tuple[str, str]:
    """(content type, body); server errors and broken connections are tried again, after one more pause each time."""
    for attempt in range(1, p.retries + 1):
        try:
            status, kind, body = client(page)
            if status >= 400:
                raise Failed(f"HTTP {status}", status >= 500)
            return kind, body
        except Exception as e:
            if attempt == p.retries or isinstance(e, Failed) and not e.again:
                raise
            sleep(p.backoff_s * attempt)
    raise ValueError("retries must be at least 1")


def offline(page: bytes) -> tuple[int, str, str]:
    """Stands in for a service: the page's bytes as text."""
    return 200, "text/plain", page.decode("utf-8", "ignore")


def recognised(pages: DataFrame, client: Client = offline, p: OcrParams = OcrParams()) -> DataFrame:
    """path, page_no, text, error of (path, page_no, content)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, n, content in zip(frame["path"], frame["page_no"], frame["content"], strict=True):
                try:
                    rows.append((path, n, *ask(client, bytes(content), p), None))
                except Exception as e:
                    rows.append((path, n, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "page_no", "kind", "body", "error"])

    own = pages.select("path", "page_no", "content").mapInPandas(run, "path string, page_no int, kind string, body string, error string")
    return own.select("path", "page_no", response_text(F.col("body"), F.col("kind")).alias("text"), "error")


def run_log(pages: DataFrame, refs: DataFrame | None = None, raw: bool = False) -> DataFrame:
    """filename, status, error, text_len, raw, ref_len, cer of ``recognised`` pages joined by form feeds; all failed pages are named."""
    docs = pages.groupBy(F.col("path").alias("filename")).agg(
        pages_joined(F.col("page_no"), F.col("text")).alias("text"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("error").isNotNull(), F.concat(F.lit("page "), F.col("page_no").cast("string"), F.lit(": "), F.col("error"))))), "; ").alias("errors"),
    )
    docs = with_reference(docs, refs) if refs is not None else docs.withColumn("ref", F.lit(None).cast("string"))
    error = F.when(F.col("errors") != "", F.col("errors"))
    return docs.select(
        "filename", F.when(error.isNull(), "ok").otherwise("error").alias("status"), error.alias("error"), F.length("text").alias("text_len"), F.lit(raw).alias("raw"),
        F.length("ref").alias("ref_len"), F.when(F.col("ref").isNotNull(), cer(F.col("text"), F.col("ref"))).alias("cer"),
    )
