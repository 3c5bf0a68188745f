"""Cascading erasure by rewriting files: a person's rows go from every table that leads back to them, and from no file else.

Tables lie as Parquet files of consecutive rows in one order. A task that writes a file also makes a Bloom filter of its link
keys (xxhash, 64 bits), cut into buckets by hash, so that it grows with the file and its pieces don't. Victims' keys meet the
filters bucket by bucket: of the files, those in which no key may be are left alone, and a filter never misses one. The link
columns of the others are read and joined exactly with the keys; that confirms the files, and in them the keys of the next
table. Confirmed files stream through pyarrow, batch by batch, into a new file that takes the old one's place in one move.

What is to go is known, and written down, before the first file changes, and taking it from a file twice is as taking it
once: a lost executor's tasks can simply run again. Counts of what went are the rows of the order less those that are left,
so they don't depend on which attempt did it.

Hot keys: rows are dealt by range over the whole order, so one client's are cut like any others; filters and joins see a key
once a file.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quireline.llm.common import durable, opened, shared_folder

#: Bits that a filter has for each key at least, and how many of them a key sets: about one false hit in a million.
BITS_A_KEY, PROBES = 32, 11
#: Keys in a bucket of one file's filter, about; files and keys that meet in one task.
BUCKET_KEYS, FILES_TOGETHER, KEYS_TOGETHER = 8_192, 512, 1 << 18
#: Rows that are sorted in one task, about; rows of a batch, and of a row group.
SORTED_TOGETHER, BATCH, GROUP = 500_000, 1 << 16, 1 << 17


@dataclass(frozen=True)
class Linked:
    """A table of the cascade: rows whose ``link`` is a victim's key go; their ``passes`` are keys of the tables ``after`` it."""

    name: str
    link: str
    passes: str | None = None
    after: str | None = None
    cents: str | None = None
    passes_kind: str = "long"


# --- order, files, filters


def sorted_parts(rows: DataFrame, place: str, by: Column, columns: list[str], n: int) -> None:
    """``columns`` of about n rows ordered by ``by``, then by these columns from left to right, ascending and nulls first, as parts in that order."""
    names = [f"`{c}`" for c in columns]
    every = [by.asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in names)]
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // SORTED_TOGETHER)
    rows.repartitionByRange(tasks, *every).sortWithinPartitions(*every).select(*names).write.option("parquet.block.size", 4 << 20).parquet(place)


def planned_files(spark: SparkSession, place: str, files: int) -> DataFrame:
    """file_no, rows, buckets, spans: which rows of which parts make up each file of ``1 + n // files`` consecutive rows."""
    parts = spark.read.parquet(place).select(F.col("_metadata.file_path").alias("part")).groupBy("part").agg(F.count("*").alias("n"))
    parts = parts.withColumn("k", F.regexp_extract("part", r"part-(\d+)-[^/]*$", 1).cast("int"))
    ends = F.sum("n").over(Window.orderBy("k"))  # a row a part
    total = F.sum("n").over(Window.partitionBy())
    parts = parts.select("part", "k", (ends - F.col("n")).alias("start"), ends.alias("end"), (1 + F.floor(total / files)).cast("long").alias("per"))
    own = parts.select("*", F.explode(F.sequence(F.expr("start div per"), F.expr("(end - 1) div per"))).alias("file_no"))
    span = F.struct("k", "part", (F.greatest(F.col("file_no") * F.col("per"), "start") - F.col("start")).alias("begin"), (F.least((F.col("file_no") + 1) * F.col("per"), "end") - F.col("start")).alias("end"))
    buckets = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.max("per") / BUCKET_KEYS, F.lit(1))))).cast("int")
    return own.groupBy("file_no").agg(F.sum(span["end"] - span["begin"]).alias("rows"), buckets.alias("buckets"), F.sort_array(F.collect_list(span)).alias("spans"))


def _batches(path: str, columns: list[str] | None = None, begin: int = 0, end: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows ``begin`` to ``end`` of a Parquet file in its order; row groups outside aren't read."""
    fs, at = opened(path)
    with fs.open_input_file(at) as f:
        file, seen = pq.ParquetFile(f), 0
        for g in range(file.num_row_groups):
            n = file.metadata.row_group(g).num_rows
            if seen < (seen + n if end is None else end) and seen + n > begin:
                for batch in file.iter_batches(BATCH, [g], columns):
                    low, high = max(begin - seen, 0), batch.num_rows if end is None else min(end - seen, batch.num_rows)
                    if low < high:
                        yield batch.slice(low, high - low)
                    seen += batch.num_rows
            else:
                seen += n


def _written(batches: Iterator[pa.RecordBatch], schema: pa.Schema, folder: str, path: str) -> int:
    """Streams rows into a file that is moved to ``path`` when it is whole; how many. Without rows there is no file."""
    fs, work = opened(f"{folder}-work")
    aside, writer, held, n = f"{work}/{uuid.uuid4().hex}", None, [], 0
    for batch in batches:
        writer = writer or pq.ParquetWriter(aside, schema, filesystem=fs)
        held.append(batch)
        n += batch.num_rows
        if sum(b.num_rows for b in held) >= GROUP:
            writer.write_table(pa.Table.from_batches(held, schema))
            held = []
    if writer:
        if held:
            writer.write_table(pa.Table.from_batches(held, schema))
        writer.close()
        fs.move(aside, opened(path)[1])
    return n


def _hashes(keys: pa.Array) -> np.ndarray:
    """The xxhash of each key as Spark's ``xxhash64`` has it: whole numbers by their eight bytes, texts by their UTF-8."""
    import xxhash

    if pa.types.is_integer(keys.type):
        raw = keys.cast(pa.int64()).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
        return np.fromiter((xxhash.xxh64_intdigest(raw[i : i + 8], 42) for i in range(0, len(raw), 8)), np.uint64, len(keys))
    return np.fromiter((xxhash.xxh64_intdigest(k.encode(), 42) for k in keys.to_pylist()), np.uint64, len(keys))


def _buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(48)) & np.uint64(buckets - 1)


def _spots(hashes: np.ndarray, k: int, size: int) -> np.ndarray:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return ((hashes & np.uint64(0xFFFFFFFF)) + np.uint64(k) * step) & np.uint64(size - 1)


def bloom(hashes: np.ndarray) -> bytes:
    """A filter of hashes; its size is a power of two, 4,096 bits at least, as in fewer too many hashes set the same ones."""
    size = 1 << max(12, int(len(hashes) * BITS_A_KEY - 1).bit_length())
    bits = np.zeros(size, bool)
    for k in range(PROBES):
        bits[_spots(hashes, k, size)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(filter_: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in a filter: all that are, and about one of a million others."""
    bits = np.frombuffer(filter_, np.uint8)
    left = np.arange(len(hashes))
    for k in range(PROBES):
        spot = _spots(hashes[left], k, len(bits) * 8)
        left = left[(bits[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    out = np.zeros(len(hashes), bool)
    out[left] = True
    return out


def _tasks(spark: SparkSession, files: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), files // 4)


def path_of(folder: str, table: str, file_no: int) -> str:
    return f"{folder}/{table}/{file_no:06d}.parquet"


def store(tables: dict[str, tuple[DataFrame, Column, list[str]]], cascade: list[Linked], folder: str, files: int = 250) -> DataFrame:
    """Writes each table (rows, first order, columns to keep) as files of consecutive rows; (table_name, file_no, rows, buckets, bucket, bits) is
    what is in them, a row for each bucket of a file's filter that has keys, one of null bits where none has."""
    plans = []
    spark = next(iter(tables.values()))[0].sparkSession
    fs, at = opened(folder)
    fs.create_dir(f"{at}-work")
    for t in cascade:
        rows, by, columns = tables[t.name]
        fs.create_dir(f"{at}/{t.name}")
        sorted_parts(rows, f"{folder}-work/parts/{t.name}", by, columns, rows.select(columns[0]).count())
        plans.append(planned_files(spark, f"{folder}-work/parts/{t.name}", files).select(F.lit(t.name).alias("table_name"), F.lit(t.link).alias("link"), "*"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                spans, seen = f["spans"], []

                def streamed():
                    for s in spans:
                        for b in _batches(s["part"], None, s["begin"], s["end"]):
                            seen.append(_hashes(pc.drop_null(b.column(b.schema.get_field_index(f["link"]))).unique()))
                            yield b

                there, at = opened(spans[0]["part"])
                schema = pq.read_schema(at, filesystem=there)
                if _written(streamed(), schema, folder, path_of(folder, f["table_name"], f["file_no"])) != f["rows"]:
                    raise ValueError(f"file {f['file_no']} of {f['table_name']} isn't whole")
                hashes = np.unique(np.concatenate(seen))
                bucket = _buckets(hashes, f["buckets"])
                out = [{**{c: f[c] for c in ("table_name", "file_no", "rows", "buckets")}, "bucket": int(b), "bits": bloom(hashes[bucket == b])} for b in np.unique(bucket)]
                out = out or [{**{c: f[c] for c in ("table_name", "file_no", "rows", "buckets")}, "bucket": 0, "bits": None}]
                yield pa.RecordBatch.from_pylist(out, pa.schema([("table_name", pa.string()), ("file_no", pa.int64()), ("rows", pa.int64()), ("buckets", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())]))

    every = plans[0]
    for p in plans[1:]:
        every = every.unionByName(p)
    every = durable(every)
    return durable(every.repartition(_tasks(spark, every.count())).mapInArrow(run, "table_name string, file_no long, rows long, buckets int, bucket int, bits binary"))


# --- what is to go


def shortlist(filters: DataFrame, keys: DataFrame, tables: list[str]) -> DataFrame:
    """(table_name, file_no) of files of which a filter says that a key may be in them.

    Keys and filters meet by table and bucket; of many files or keys in one bucket, so many at a time: blocks of files are
    met by every block of keys, and each task holds one of either.
    """
    own = filters.where(F.col("table_name").isin(tables) & F.col("bits").isNotNull())
    sizes = own.groupBy("table_name").agg(F.max("buckets").alias("buckets"), F.max("file_no").alias("last")).collect()  # a row a table
    hashed, n, by = keys.select(F.xxhash64("key").alias("hash")), keys.count(), ("table_name", "bucket", "block", "key_block")
    met = []
    for table, buckets, last in sizes:
        blocks, key_blocks = 1 + last // FILES_TOGETHER, max(1, -(-n // (buckets * KEYS_TOGETHER)))
        numbers = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
        bucket = F.shiftrightunsigned("hash", 48).bitwiseAND(F.lit(buckets - 1).cast("long")).cast("int")
        filters_ = own.where(F.col("table_name") == table).select("table_name", "bucket", F.expr(f"cast(file_no div {FILES_TOGETHER} as int)").alias("block"), numbers(key_blocks).alias("key_block"), "file_no", "bits")
        met.append((filters_, hashed.select(F.lit(table).alias("table_name"), bucket.alias("bucket"), numbers(blocks).alias("block"), F.pmod("hash", F.lit(key_blocks)).cast("int").alias("key_block"), "hash")))
    if not met:
        return own.select("table_name", "file_no")
    own, asked = met[0]
    for a, b in met[1:]:
        own, asked = own.unionByName(a), asked.unionByName(b)

    def run(left, right):
        hashes = right["hash"].to_numpy().astype(np.int64).view(np.uint64)
        hit = [bool(may_hold(b, hashes).any()) for b in left["bits"]]
        return left.loc[hit, ["table_name", "file_no"]]

    return own.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(run, "table_name string, file_no long").distinct()


def _over_files(files: DataFrame, folder: str, columns: tuple[str, ...], emit, schema: str) -> DataFrame:
    """``emit(row, batches of the columns)`` over the files that ``files`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.to_pylist():
                yield from emit(f, _batches(path_of(folder, f["table_name"], f["file_no"]), [f[c] for c in columns]))

    return files.repartition(_tasks(files.sparkSession, files.count())).mapInArrow(run, schema)


def _whole(keys: pa.Array) -> pa.Array:
    return keys.cast(pa.int64()) if pa.types.is_integer(keys.type) else keys


def confirmed(short: DataFrame, keys: DataFrame, cascade: list[Linked], folder: str, kind: str) -> DataFrame:
    """(table_name, file_no, link, passes, keys) of files that do hold keys, with these: the files' different link keys, joined exactly."""

    def emit(f: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = pa.chunked_array([pc.drop_null(b.column(0)).unique() for b in batches])
        own = _whole(pc.unique(seen))
        for k in range(0, len(own), BATCH):
            part = own.slice(k, BATCH)
            yield pa.RecordBatch.from_arrays([pa.array([f["table_name"]] * len(part), pa.string()), pa.array([f["file_no"]] * len(part), pa.int64()), part], ["table_name", "file_no", "key"])

    said = F.create_map(*(F.lit(x) for t in cascade for x in (t.name, t.link)))
    then = F.create_map(*(F.lit(x) for t in cascade for x in (t.name, t.passes or "")))
    there = _over_files(short.withColumn("link", said[F.col("table_name")]), folder, ("link",), emit, f"table_name string, file_no long, key {kind}")
    held = there.join(keys, "key").groupBy("table_name", "file_no").agg(F.collect_set("key").alias("keys"))
    return durable(held.select("table_name", "file_no", said[F.col("table_name")].alias("link"), then[F.col("table_name")].alias("passes"), "keys"))


def passed_on(files: DataFrame, folder: str, kind: str) -> DataFrame:
    """(key): what the victims in confirmed files pass on to the tables after theirs, each once."""

    def emit(f: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            victims = pc.is_in(b.column(0), value_set=pa.array(f["keys"], b.column(0).type))
            own = pc.drop_null(b.column(1).filter(victims)).unique()
            if len(own):
                yield pa.RecordBatch.from_arrays([_whole(own)], ["key"])

    return durable(_over_files(files, folder, ("link", "passes"), emit, f"key {kind}").distinct())


def victims(filters: DataFrame, keys: DataFrame, cascade: list[Linked], folder: str) -> DataFrame:
    """The confirmed files of all tables of a cascade, table after table; ``keys`` (key) are those of the first one."""
    spark, levels, out = filters.sparkSession, {None: durable(keys)}, []
    for after in dict.fromkeys(t.after for t in cascade):
        own = [t for t in cascade if t.after == after]
        asked, kind = levels[after], levels[after].schema["key"].dataType.simpleString()
        found = confirmed(shortlist(filters, asked, [t.name for t in own]), asked, cascade, folder, kind)
        out.append(found)
        for t in own:
            if any(x.after == t.name for x in cascade):
                levels[t.name] = passed_on(found.where(F.col("table_name") == t.name), folder, t.passes_kind)
    every = out[0]
    for f in out[1:]:
        every = every.unionByName(f)
    return every


# --- rewriting


def rewrite(files: DataFrame, folder: str) -> DataFrame:
    """Takes the victims out of confirmed files; (table_name, file_no, rows) that are left. A file of which nothing is left goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileType

        for batch in batches:
            for f in batch.to_pylist():
                path = path_of(folder, f["table_name"], f["file_no"])
                fs, at = opened(path)
                left = 0
                if fs.get_file_info(at).type != FileType.NotFound:  # another attempt may have emptied it
                    schema = pq.read_schema(at, filesystem=fs)
                    gone = pa.array(f["keys"], schema.field(f["link"]).type)
                    link = schema.get_field_index(f["link"])
                    stay = (b.filter(pc.invert(pc.is_in(b.column(link), value_set=gone))) for b in _batches(path))
                    left = _written((b for b in stay if b.num_rows), schema, folder, path)
                    if not left:
                        fs.delete_file(at)
                yield pa.RecordBatch.from_pylist([{"table_name": f["table_name"], "file_no": f["file_no"], "rows": left}], pa.schema([("table_name", pa.string()), ("file_no", pa.int64()), ("rows", pa.int64())]))

    return durable(files.repartition(_tasks(files.sparkSession, files.count())).mapInArrow(run, "table_name string, file_no long, rows long"))


def audit(filters: DataFrame, cascade: list[Linked], folder: str) -> DataFrame:
    """A row for each file that is there in the end, read back from it."""
    schema = "file_no long, n_rows long, n_erased long, cents long, rewritten boolean, table_name string, ids_sha256 string, columns string, path string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileType

        for batch in batches:
            for f in batch.to_pylist():
                path = path_of(folder, f["table_name"], f["file_no"])
                fs, at = opened(path)
                if fs.get_file_info(at).type == FileType.NotFound:
                    continue
                names = pq.read_schema(at, filesystem=fs).names
                sha, n, cents = hashlib.sha256(), 0, 0
                for b in _batches(path, list(dict.fromkeys([names[0], f["cents"]]))):
                    ids = b.column(b.schema.get_field_index(names[0])).cast(pa.string()).fill_null("")
                    sha.update(("," * bool(n) + ",".join(ids.to_pylist())).encode())
                    x = b.column(b.schema.get_field_index(f["cents"])).cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
                    cents += int(np.floor(100 * np.where(np.isfinite(x), x, 0) + 0.5).astype(np.int64).sum())
                    n += b.num_rows
                erased = f["rows"] - n
                yield pa.RecordBatch.from_pydict({"file_no": [f["file_no"]], "n_rows": [n], "n_erased": [erased], "cents": [cents], "rewritten": [erased > 0], "table_name": [f["table_name"]], "ids_sha256": [sha.hexdigest()], "columns": [",".join(names)], "path": [path]})

    files = filters.select("table_name", "file_no", "rows").distinct()
    money = F.create_map(*(F.lit(x) for t in cascade for x in (t.name, t.cents)))
    return files.withColumn("cents", money[F.col("table_name")]).repartition(_tasks(filters.sparkSession, files.count())).mapInArrow(run, schema)


def erase(tables: dict[str, tuple[DataFrame, Column, list[str]]], cascade: list[Linked], keys: DataFrame, folder: str, files: int = 250) -> DataFrame:
    """Stores the tables in ``folder``, takes the victims out of their files, and says what is there: ``audit``'s rows."""
    filters = store(tables, cascade, folder, files)
    rewrite(victims(filters, keys, cascade, folder), folder)
    fs, at = opened(f"{folder}-work")
    fs.delete_dir(at)
    return audit(filters, cascade, folder)


# --- the shop's tables

SHOP = [
    Linked("clients", "master_id", "client_id", None, "balance"),
    Linked("clicks", "client_id", None, "clients", "value"),
    Linked("sales", "client_id", "sale_id", "clients", "total"),
    Linked("sale_lines", "sale_id", None, "sales", "amount"),
]


def victim_masters(clients: DataFrame, clicks: DataFrame, share: int = 200) -> DataFrame:
    """(key): masters whose digest is drawn, and the one whose clients have most clicks; of several the least."""
    own = clients.where("master_id is not null").select(F.col("master_id").alias("key"), "client_id").distinct()
    n = clicks.where("client_id is not null").groupBy("client_id").agg(F.count("*").alias("n"))
    most = own.join(n, "client_id", "left").groupBy("key").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n")).orderBy(F.desc("n"), "key").limit(1).select("key")
    drawn = own.where(F.crc32(F.col("key").cast("string").cast("binary")) % share == 0).select("key")
    return drawn.unionByName(most).distinct()


def query(clients: DataFrame, clicks: DataFrame, sales: DataFrame, sale_lines: DataFrame) -> DataFrame:
    """The four tables stored in a new folder under the shared one, which stays, and the drawn masters' rows erased.

    Tables are ordered by the crc32 of their client, those of lines by their sale's; a null client, and a line without a sale,
    is an empty text. A sale number that several sales share leads to the least of their clients in the order, and to all in the
    cascade. Repeated rows are kept, and go, each. A null link key is nobody's. Amounts that aren't finite count as 0. Further
    columns are stored and sorted by as they stand. An empty table has no files; without a master nothing goes.
    """
    spark = clients.sparkSession
    folder = f"{shared_folder(spark)}/erasure-{uuid.uuid4().hex}"
    folder = f"file:///{folder.removeprefix('file:').lstrip('/')}" if folder.startswith(("/", "file:/")) else folder
    order = lambda c: F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary"))
    own = "_quireline_owner"  # sorts the lines; not stored
    owners = durable(sales.where("sale_id is not null").groupBy("sale_id").agg(F.min("client_id").alias(own)))  # so that a hot sale's lines can be split
    lines = sale_lines.join(owners, "sale_id", "left")
    by_client = {name: (rows, order(F.col("client_id")), rows.columns) for name, rows in (("clients", clients), ("clicks", clicks), ("sales", sales))}
    return erase({**by_client, "sale_lines": (lines, order(F.col(own)), sale_lines.columns)}, SHOP, victim_masters(clients, clicks), folder)
