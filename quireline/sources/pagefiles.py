"""Pages of scanned documents by ranges: a document of many pages is many tasks' work, and a task reads its pages alone.

Each file's table of offsets says how many pages it has; ranges of pages are rows, dealt over tasks. The bytes of a page's
image are read only if they are asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quireline.sources.pdf import Index, page_images
from quireline.tables import opened

#: Pages of a range; rows and bytes of a batch, about.
TOGETHER = 64
ROWS, BYTES = 256, 1 << 22

_RANGE = pa.schema([("path", pa.string()), ("first", pa.int32()), ("last", pa.int32()), ("error", pa.string())])
_PAGE = pa.schema([("path", pa.string()), ("page_no", pa.int32()), ("encoding", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("channels", pa.int32()), ("data", pa.binary()), ("error", pa.string())])
PAGES = "path string, page_no int, encoding string, width int, height int, channels int, data binary, error string"


def batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches that are bounded by rows and, to one row, by bytes: a batch a row costs more than small rows do."""
    own, held = [], 0
    for row in rows:
        own.append(row)
        held += sum(len(v) for v in row if isinstance(v, bytes))
        if len(own) >= ROWS or held >= BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*own, strict=True), schema, strict=True)], schema=schema)
            own, held = [], 0
    if own:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*own, strict=True), schema, strict=True)], schema=schema)


def ranges(files: DataFrame, together: int = TOGETHER) -> DataFrame:
    """path, first, last, error: the pages of each file (path) in ranges, counted from 0, ``last`` not in it.

    A file without a plain table of offsets is one range without an end; one that can't be read has its error.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    fs, at = opened(path)
                    with fs.open_input_file(at) as f:
                        if f.read(5) != b"%PDF-":
                            raise ValueError("not a PDF")
                        try:
                            n = len(Index(f, f.size()).kids)
                        except (ValueError, TypeError, AttributeError, KeyError, IndexError):
                            n = None
                    if n == 0:
                        raise RuntimeError("PDF has 0 pages")
                    out = [(path, k, min(k + together, n), None) for k in range(0, n, together)] if n else [(path, 0, None, None)]
                except Exception as e:
                    out = [(path, None, None, f"{type(e).__name__}: {e}")]
                yield from out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(found(batches), _RANGE)

    return files.select(F.col("path").cast("string")).mapInArrow(run, "path string, first int, last int, error string")


def pages(files: DataFrame, together: int = TOGETHER, data: bool = True) -> DataFrame:
    """path, page_no (from 1), encoding, width, height, channels, data, error: a row a page of the files (path).

    A file, or a page, that can't be read is a row with its error and no image; of the other pages nothing is lost. Without
    ``data`` its column is null and holds nothing on its way. Rows that name a file twice give its pages twice.
    """
    spark = files.sparkSession
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def of(path: str, first: int, last: int | None) -> Iterator[tuple[int, tuple | None, str | None]]:
        fs, at = opened(path)
        with fs.open_input_file(at) as f:
            if last is None:
                for k, page in enumerate(page_images(f.read()), 1):
                    yield k, page, None
                return
            index = Index(f, f.size())
            for k in range(first, last):
                try:
                    yield k + 1, index.page(k), None
                except Exception as e:
                    yield k + 1, None, f"{type(e).__name__}: {e}"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for path, first, last, error in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    for k, page, wrong in of(path, first, last) if error is None else ((None, None, error),):
                        own = (*page[:4], page[4] if data else None) if page else (None,) * 5
                        yield (path, k, *own, wrong)
                except Exception as e:
                    yield (path, None, *(None,) * 5, f"{type(e).__name__}: {e}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(read(batches), _PAGE)

    dealt = files.repartition(tasks)  # names are few bytes, so a shuffle before would have left them to one task
    return ranges(dealt, together).repartition(tasks).mapInArrow(run, PAGES)
