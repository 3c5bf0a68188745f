"""Named files as a committed sink: a Spark data source that writes one file for each name, as a whole or not at all.

A task streams its rows into files of its own attempt's folder; what it has is its commit message. When all tasks have ended
the driver moves the files to their names; if one fails for good, or the job is stopped, the attempts' folder goes and nothing
of it was to be seen. Files of attempts that were lost or ran twice are in no message and go with that folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from quireline.sources.pdf import Stream
from quireline.tables import opened


@dataclass
class Written(WriterCommitMessage):
    """(name, place in the attempt's folder, bytes) of each file."""

    files: list[tuple[str, str, int]]


class _Bytes:
    """Pieces of a file one behind another."""

    def __init__(self, out):
        self.out = out

    def add(self, content: bytes) -> None:
        self.out.write(content)

    def close(self) -> None:
        pass


KINDS = {"bytes": ("content",), "pdf": ("encoding", "width", "height", "channels", "data")}


class _Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, kind: str, overwrite: bool):
        self.folder, self.kind, self.overwrite = folder, kind, overwrite
        self.attempts = f"_attempts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, at = opened(self.folder)
        place, done, now, out, own = f"{self.attempts}/{uuid.uuid4().hex}", [], None, None, None

        def close() -> None:
            if out is not None:
                own.close()
                size = out.tell()
                out.close()
                done.append((now, f"{place}/{len(done)}", size))

        for batch in iterator:
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in ("name", *KINDS[self.kind])}
            for k in range(batch.num_rows):
                name, *piece = (c[k].as_py() for c in columns.values())
                if name != now or out is None:
                    close()
                    if not name or "/" in name or name in (".", "..") or name.startswith("_"):
                        raise ValueError(f"{name!r} isn't the name of a file")
                    fs.create_dir(f"{at}/{place}", recursive=True)
                    now, out = name, fs.open_output_stream(f"{at}/{place}/{len(done)}")
                    own = Stream(out) if self.kind == "pdf" else _Bytes(out)
                own.add(*piece)
        close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, at = opened(self.folder)
        files = [f for m in messages if m for f in m.files]
        if len({name for name, _, _ in files}) < len(files):
            self.abort(messages)
            raise ValueError("several tasks wrote files of one name")
        fs.create_dir(at, recursive=True)
        if self.overwrite:
            stay = {name for name, _, _ in files}
            for there in fs.get_file_info(_files(at)):
                if there.is_file and there.base_name not in stay:
                    fs.delete_file(there.path)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: fs.move(f"{at}/{f[1]}", f"{at}/{f[0]}"), files))
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow.fs import FileType

        fs, at = opened(self.folder)
        if fs.get_file_info(f"{at}/{self.attempts}").type == FileType.Directory:
            fs.delete_dir(f"{at}/{self.attempts}")


def _files(at: str):
    from pyarrow.fs import FileSelector

    return FileSelector(at)


class NamedFiles(DataSource):
    """``df.write.format("named_files").option("kind", "pdf").save(folder)``; use ``named_files``, which brings a file's rows together."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema, overwrite: bool) -> _Writer:
        kind = self.options.get("kind", "bytes")
        missing = {"name", *KINDS[kind]} - {f.name for f in schema.fields}
        if missing:
            raise ValueError(f"columns are missing: {', '.join(sorted(missing))}")
        return _Writer(self.options["path"], kind, overwrite)


def named_files(rows: DataFrame, folder: str, *order: str, kind: str = "bytes", overwrite: bool = False) -> None:
    """Writes a file for each ``name`` into one folder, from its rows in the order of ``order``.

    ``kind`` bytes: ``content`` one behind another; pdf: each row a page (encoding, width, height, channels, data). A file's rows
    are one task's, which streams them. Null content adds nothing; a null name, or one that isn't a file's, is an error. What
    the folder has under other names stays, unless ``overwrite``.
    """
    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    own = rows.withColumn("content", F.coalesce("content", F.lit(b""))) if kind == "bytes" else rows
    dealt = own.repartition("name").sortWithinPartitions("name", *order).select("name", *KINDS[kind])
    dealt.write.format("named_files").option("kind", kind).mode("overwrite" if overwrite else "append").save(folder)
