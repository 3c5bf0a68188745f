"""Token ids as files of separately compressed documents under one shared dictionary.

A folder holds a zstandard dictionary, trained on serialized id arrays, files of documents in ascending order of ids, and a
manifest that names the files in order. A file is: magic, bytes an id, the dictionary's SHA-256; a zstandard frame for each
document; an index with each document's id, the place of its frame and its number of ids; the index' place, its rows and
the magic again. So a single document takes the manifest, one index and one frame.

Files get a new name at every attempt of a task and count from when the manifest, written at the end, names them: a lost
executor leaves at most a file that nobody reads, and those are deleted once the manifest stands.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quireline.llm.common import opened, shared_folder
from quireline.llm.wordids import public_vocabulary, word_ids

#: Id that closes a document.
END = 1
#: Documents in a file, on average.
PER_FILE = 20_000
#: The dictionary's sample: texts of the least hashes, at most so many, none of more characters than a short document has.
#: It decides how small files are, never what they hold.
SAMPLED, SAMPLED_CHARS = 2_000, 20_000
DICTIONARY_BYTES = 1 << 16
LEVEL = 1

_MAGIC, _HEAD, _FOOT = b"QLT1", "<4sB32s", "<QQ4s"
_INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("place", "<u8"), ("n_ids", "<u8")])
_DECODERS: dict[str, object] = {}

MANIFEST = "file_no int, file string, n_docs long, n_ids long, first long, last long, nulls boolean"


def trained(docs: DataFrame, vocabulary: str) -> bytes:
    """A dictionary over the serialized ids of a bounded sample, made in one task; empty if the sample is too small for one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder = word_ids(vocabulary)
        samples = [i for b in batches for texts in _chunks(b.column(0)) for i in encoder.packed(texts)]
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, [s for s in samples if s]).as_bytes()
        except zstandard.ZstdError:
            made = b""
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["dictionary"])

    short = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.length("text").between(1, SAMPLED_CHARS))
    sample = short.orderBy(F.xxhash64("doc_id", "text"), "text").limit(SAMPLED).select("text")
    return bytes((sample.mapInArrow(run, "dictionary binary").first() or [b""])[0])


def _chunks(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in their order, about sixteen million bytes at a time, a longer one by itself."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // 16_000_000
    cuts = [0, *(1 + np.flatnonzero(np.diff(ends))).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield texts.slice(a, b - a)


def _compressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdCompressor(level=LEVEL)


def _decompressor(folder: str, said: bytes):
    """The folder's decompressor; an error unless its dictionary is the one that a file says it was written with."""
    import zstandard

    if folder not in _DECODERS:
        fs, at = opened(folder)
        with fs.open_input_stream(f"{at}/dictionary") as f:
            dictionary = f.read()
        made = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)) if dictionary else zstandard.ZstdDecompressor()
        _DECODERS.clear()
        _DECODERS[folder] = hashlib.sha256(dictionary).digest(), made
    known, made = _DECODERS[folder]
    if known != said:
        raise ValueError(f"a file in {folder} was written with another dictionary")
    return made


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, end: int = END) -> DataFrame:
    """Writes the ids of whole texts, and ``end`` behind each, in ascending order of ``doc_id`` to a new folder; gives its manifest.

    Null ids come first, rows of one id by the texts' hashes, then by their texts; a null text is as an empty one, of which
    ``end`` alone is written; rows that repeat are written each. Other columns aren't read. An empty table makes an empty
    manifest. Ranges are by id and hash, so one id, or none, may hold any share of the rows.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or public_vocabulary()
    dictionary = trained(docs, vocabulary)
    fs, at = opened(folder)
    fs.create_dir(f"{at}/files", recursive=True)
    with fs.open_output_stream(f"{at}/dictionary") as f:
        f.write(dictionary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, frames = word_ids(vocabulary), _compressor(dictionary)
        fs, at = opened(folder)
        number, name, index, place = TaskContext.get().partitionId(), f"{uuid.uuid4().hex}.ids", [], struct.calcsize(_HEAD)
        out = None
        for whole in batches:
            at_row = 0
            for texts in _chunks(whole.column(1)):
                batch, at_row = whole.slice(at_row, len(texts)), at_row + len(texts)
                if out is None:
                    out = fs.open_output_stream(f"{at}/files/{name}")
                    out.write(struct.pack(_HEAD, _MAGIC, 2, hashlib.sha256(dictionary).digest()))
                ids = [i + struct.pack("<H", end) for i in encoder.packed(texts)]
                packed = [frames.compress(i) for i in ids]
                out.write(b"".join(packed))
                own = np.zeros(len(ids), _INDEX)
                own["doc_id"] = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                own["known"] = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
                ends = place + np.cumsum([len(p) for p in packed])
                own["place"], place = ends - [len(p) for p in packed], int(ends[-1])
                own["n_ids"] = [len(i) // 2 for i in ids]
                index.append(own)
        if out is None:
            return
        index = np.concatenate(index)
        out.write(index.tobytes())
        out.write(struct.pack(_FOOT, place, len(index), _MAGIC))
        out.close()
        known = index["doc_id"][index["known"] == 1]
        first, last = (int(known[0]), int(known[-1])) if len(known) else (None, None)
        yield pa.RecordBatch.from_pylist([{"file_no": number, "file": name, "n_docs": len(index), "n_ids": int(index["n_ids"].sum()), "first": first, "last": last, "nulls": len(known) < len(index)}], pa.schema([("file_no", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("nulls", pa.bool_())]))

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n_files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-docs.count() // PER_FILE))
    by = (F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc())
    dealt = own.repartitionByRange(n_files, *by).sortWithinPartitions(*by, "text")
    dealt.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    files = manifest(spark, folder)
    named = {r["file"] for r in files.select("file").collect()}  # a row a file
    for there in fs.get_file_info(_listing(f"{at}/files")):
        if there.base_name not in named:
            fs.delete_file(there.path)
    return files


def _listing(at: str):
    from pyarrow.fs import FileSelector

    return FileSelector(at)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _index(f, size: int) -> tuple[np.ndarray, bytes]:
    """(index, the dictionary's hash) of an open file; an error if it isn't whole."""
    f.seek(0)
    magic, width, said = struct.unpack(_HEAD, f.read(struct.calcsize(_HEAD)))
    f.seek(size - struct.calcsize(_FOOT))
    place, rows, last = struct.unpack(_FOOT, f.read(struct.calcsize(_FOOT)))
    if (magic, width, last) != (_MAGIC, 2, _MAGIC):
        raise ValueError("not a whole file of token ids")
    f.seek(place)
    return np.frombuffer(f.read(rows * _INDEX.itemsize), _INDEX), said


def _frames(f, index: np.ndarray, size: int) -> Iterator[bytes]:
    """Each document's frame, read one after another."""
    ends = [*index["place"][1:].tolist(), size - struct.calcsize(_FOOT) - len(index) * _INDEX.itemsize]
    f.seek(struct.calcsize(_HEAD))
    for begin, end in zip(index["place"].tolist(), ends, strict=True):
        yield f.read(end - begin)


def _scanned(spark: SparkSession, folder: str, emit, schema: str) -> DataFrame:
    """``emit(ids of documents, starts, arrays of ids)``, a batch, over all documents of all files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = opened(folder)
        for batch in batches:
            for name, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with fs.open_input_file(f"{at}/files/{name}") as f:
                    index, said = _index(f, f.size())
                    decompress = _decompressor(folder, said).decompress
                    starts = before + np.cumsum(index["n_ids"]).astype("i8") - index["n_ids"].astype("i8")
                    frames = _frames(f, index, f.size())
                    for k in range(0, len(index), 512):
                        own = index[k : k + 512]
                        ids = [np.frombuffer(decompress(next(frames)), "<u2") for _ in range(len(own))]
                        if [len(i) for i in ids] != own["n_ids"].tolist():
                            raise ValueError(f"{name} holds other ids than its index says")
                        yield emit(pa.array(own["doc_id"], mask=own["known"] == 0), pa.array(starts[k : k + 512]), ids)

    files = manifest(spark, folder)
    before = F.sum("n_ids").over(Window.orderBy("file_no")) - F.col("n_ids")  # a row a file
    numbered = files.select("file", before.alias("before")).repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return numbered.mapInArrow(run, schema)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, ids: every document of a folder, from its files; ``start`` is the number of ids of all documents before it."""

    def emit(doc_ids: pa.Array, starts: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
        ends = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]), pa.int32())
        return pa.RecordBatch.from_arrays([doc_ids, starts, pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids).astype("i4")))], ["doc_id", "start", "ids"])

    return _scanned(spark, folder, emit, "doc_id long, start long, ids array<int>")


def lookup(wanted: DataFrame, folder: str) -> DataFrame:
    """doc_id, ids: the documents of the ids in ``wanted.doc_id`` alone, by the index: of a file that may hold one its index
    is read, of a document its frame. An id that several documents share gives each; one that none has, and null, gives none.
    """
    spark = wanted.sparkSession
    files = [(r["file"], r["first"], r["last"]) for r in manifest(spark, folder).where("first is not null").orderBy("file_no").collect()]  # a row a file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = opened(folder)
        first, last = (np.array([f[k] for f in files], "i8") for k in (1, 2))
        for batch in batches:
            asked = np.unique(batch.column(0).drop_null().to_numpy(zero_copy_only=False))
            for j in np.unique(np.concatenate([np.flatnonzero((first <= i) & (i <= last)) for i in asked.tolist()] or [np.array([], int)])):
                with fs.open_input_file(f"{at}/files/{files[j][0]}") as f:
                    index, said = _index(f, f.size())
                    decompress, found = _decompressor(folder, said).decompress, []
                    ends = np.append(index["place"][1:], f.size() - struct.calcsize(_FOOT) - len(index) * _INDEX.itemsize)
                    for k in np.flatnonzero(np.isin(index["doc_id"], asked) & (index["known"] == 1)).tolist():
                        f.seek(int(index["place"][k]))
                        found.append((int(index["doc_id"][k]), np.frombuffer(decompress(f.read(int(ends[k] - index["place"][k]))), "<u2").astype("i4")))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int32()))], ["doc_id", "ids"])

    asked = wanted.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    return asked.repartitionByRange("doc_id").mapInArrow(run, "doc_id long, ids array<int>")


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids as little-endian unsigned 32-bit integers, from a folder's files."""

    def emit(doc_ids: pa.Array, starts: pa.Array, ids: list[np.ndarray]) -> pa.RecordBatch:
        sums = [zlib.crc32(i.astype("<u4").tobytes()) for i in ids]
        return pa.RecordBatch.from_arrays([doc_ids, starts, pa.array([len(i) for i in ids], pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _scanned(spark, folder, emit, "doc_id long, start long, n_tokens long, ids_crc32 long")


def query(docs: DataFrame) -> DataFrame:
    """The whole table written to a new folder under the shared one, which stays, and read back."""
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-ids-{uuid.uuid4().hex}"
    write(docs, folder)
    return digest(spark, folder)
