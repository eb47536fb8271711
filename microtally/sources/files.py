"""Source files: lookup, checksum, encoding, line counts, manifest and change detection."""

import hashlib
import re
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from microtally.errors import SourceError
from microtally.session import checkpointed, path_exists, send_package
from microtally.sources.text_tables import read_text_table

# Files are hashed in pieces of this size, cut at line ends. It is part of what a checksum means.
PIECE_BYTES = 64 << 20

# The mark some UTF-8 files begin with; a line scan leaves it out.
BYTE_ORDER_MARK = b"\xef\xbb\xbf"

# Scans see the content of files with these endings, so they are hashed as they are, whole (up to 2 GB).
COMPRESSED = r"\.(gz|bz2|deflate|lz4|snappy|zst|xz)$"

# Local files are reported with one slash or with three.
LOCAL_PREFIX = "^file:/+"


FILE_SCHEMA = "path string, uri string, file string, size_bytes long, file_modified_at timestamp"


def list_status(spark: SparkSession, path: str):
    """Entries of a folder, or the one entry of a file, from the file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)


def file_statuses(spark: SparkSession, path: str) -> list[tuple]:
    """Path, URI, name, size and modification time of a file, or of the files in a folder.

    The URI is the escaped form in which scans report where a row came from. Spark's file
    sources leave out empty files, which have to be noticed here.
    """
    found = []
    for status in list_status(spark, path):
        name = status.getPath().getName()
        if status.isFile() and not name.startswith(("_", ".")):
            uri = re.sub(LOCAL_PREFIX, "file:///", status.getPath().toUri().toString())
            modified = datetime.fromtimestamp(status.getModificationTime() / 1000, timezone.utc)
            found.append((status.getPath().toString(), uri, name, status.getLen(), modified))
    return found


def list_files(spark: SparkSession, paths) -> DataFrame:
    """Where files are, how large and how old; the content is not read."""
    paths = [paths] if isinstance(paths, str) else paths
    return spark.createDataFrame([row for path in paths for row in file_statuses(spark, path)], FILE_SCHEMA)


def find_source(spark: SparkSession, folder: str, pattern: str) -> str:
    """Path of the one entry of ``folder`` matching a glob, in any case of letters.

    An entry is a file, or a folder of part files that all have the same header. The file system
    does the matching: letters become classes of both cases.
    """
    either = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in pattern)
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    filesystem = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not filesystem.exists(place):
        raise SourceError(f"{folder} does not exist, so {pattern} cannot be looked for")
    entries = [str(entry.getPath()) for entry in filesystem.globStatus(spark._jvm.org.apache.hadoop.fs.Path(place, either)) or []]
    if len(entries) != 1:
        names = ", ".join(sorted(entry.rsplit("/", 1)[-1] for entry in entries))
        raise SourceError(f"{pattern} must name one entry of {folder}, not {f'{len(entries)} entries: {names}' if entries else 'nothing'}")
    return entries[0]


def checksums(spark: SparkSession, files: DataFrame, paths) -> DataFrame:
    """``path, sha256`` of each file with content, read from whatever store the paths name.

    The checksum is a tree of SHA-256 digests that keeps the order of the bytes: the file is cut at every multiple
    of ``PIECE_BYTES``, a line belongs to the piece in which it starts (one that starts right on a cut to the piece
    before), each piece is hashed by a task, and the checksum is the SHA-256 of the pieces' digests in their
    order. A file with one piece, so every file up to ``PIECE_BYTES``, has the digest of that piece, which is
    the plain SHA-256 of its bytes. No byte passes the driver and none is shuffled. A file whose size is not
    that of its lines was changed while it was read, which fails the job.
    """
    scanned = files.where(~F.col("file").rlike(COMPRESSED)).where("size_bytes > 0").select("path", "uri", "size_bytes")
    in_order = F.array_sort(F.collect_list(F.struct("start", "bytes", "closed", "open", "marked_closed", "marked_open")))
    found = scanned.join(pieces(spark, paths).groupBy("uri").agg(in_order.alias("pieces")), "uri", "left")
    # The lines with a line end each make the size of the file; a mark adds three bytes, a last line without end lacks one.
    beyond = F.col("size_bytes") - F.aggregate(F.coalesce("pieces", F.array()), F.lit(0).cast("long"), lambda total, piece: total + piece.bytes)
    ends = F.when(beyond.isin(0, 3), False).when(beyond.isin(-1, 2), True).otherwise(
        F.raise_error(F.concat(F.lit("changed while it was read: "), F.col("path"))).cast("boolean"))

    def digest(piece, place):
        last = ends & (place == F.size("pieces") - 1)
        marked = (beyond >= 2) & (place == 0)
        return F.when(marked, F.when(last, piece.marked_open).otherwise(piece.marked_closed)).when(last, piece.open).otherwise(piece.closed)

    digests = F.transform("pieces", digest)
    only_mark = F.col("pieces").isNull() & (beyond == len(BYTE_ORDER_MARK))
    tree = F.when(only_mark, hashlib.sha256(BYTE_ORDER_MARK).hexdigest()).when(F.size(digests) == 1, digests[0]).otherwise(
        F.sha2(F.array_join(digests, ""), 256))
    content = spark.read.format("binaryFile").load(paths).where(F.col("path").rlike(COMPRESSED))
    return found.select("path", tree.alias("sha256")).unionByName(content.select("path", F.sha2("content", 256).alias("sha256")))


def pieces(spark: SparkSession, paths) -> DataFrame:
    """Digests of the pieces of files, as the scan of a task makes them.

    Where a piece may end or begin with bytes that a line scan does not show, there is a digest for either case.
    The scan belongs to a session of its own, in which files are cut at the multiples of ``PIECE_BYTES`` and
    nowhere else, whatever the size of the cluster.
    """
    send_package(spark)
    own = spark.newSession()
    for name, value in {"spark.sql.files.maxPartitionBytes": PIECE_BYTES, "spark.sql.files.minPartitionNum": 1}.items():
        own.conf.set(name, str(value))
    lines = own.read.option("lineSep", "\n").text(paths)
    scanned = lines.select(scanned_uri().alias("uri"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("line"))
    digests = "closed string, open string, marked_closed string, marked_open string"
    return checkpointed(scanned.mapInArrow(_hashed, f"uri string, start long, bytes long, {digests}"))


class _Piece:
    """The running digests of one piece."""

    def __init__(self, uri, start):
        self.uri, self.start, self.bytes = uri, start, 0
        self.digests = [hashlib.sha256(), *[hashlib.sha256(BYTE_ORDER_MARK)] * (start == 0)]

    def add(self, lines):
        content = b"\n".join(lines) if not self.bytes else b"\n" + b"\n".join(lines)
        self.bytes += len(content) + (not self.bytes)
        for digest in self.digests:
            digest.update(content)

    def row(self):
        found = []
        for digest in self.digests:
            unended = digest.hexdigest()
            digest.update(b"\n")
            found += [digest.hexdigest(), unended]
        return (self.uri, self.start, self.bytes, *found, *[None] * (4 - len(found)))


_PIECES = pa.schema([("uri", pa.string()), ("start", pa.int64()), ("bytes", pa.int64()),
                     *[(name, pa.string()) for name in ("closed", "open", "marked_closed", "marked_open")]])


def _hashed(batches):
    """One row per piece; the lines of a piece follow each other in their order."""
    piece = None
    for batch in batches:
        if not batch.num_rows:
            continue
        uris, starts = batch.column("uri"), batch.column("start")
        other = [pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False) for column in (uris, starts)]
        cuts = [0, *(np.flatnonzero(other[0] | other[1]) + 1), batch.num_rows]
        done = []
        for low, high in zip(cuts, cuts[1:]):
            name, start = uris[low].as_py(), starts[low].as_py()
            if piece is None or (piece.uri, piece.start) != (name, start):
                done += [piece.row()] if piece else []
                piece = _Piece(name, start)
            piece.add(batch.column("line").slice(low, high - low).to_pylist())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*done), _PIECES)], schema=_PIECES)
    if piece:
        yield pa.RecordBatch.from_arrays([pa.array([value], f.type) for value, f in zip(piece.row(), _PIECES)], schema=_PIECES)


def scanned_uri():
    """URI of the file a scanned row came from, spelt as in the listing."""
    return F.regexp_replace("_metadata.file_path", LOCAL_PREFIX, "file:///")


def text_facts(spark: SparkSession, paths) -> DataFrame:
    """Encoding and number of data lines of each file, from a split scan of its lines.

    No byte of a multi-byte UTF-8 character is a line feed, so a file is valid UTF-8
    exactly if each of its lines is.
    """
    lines = spark.read.option("lineSep", "\n").text(paths)
    blank = F.col("value").rlike(r"^[ \t\r\f\x0B]*$")
    return (
        lines.groupBy(scanned_uri().alias("uri"))
        .agg(F.bool_and(F.is_valid_utf8("value")).alias("_valid"), F.count_if(~blank).alias("_lines"))
        .select(
            "uri",
            F.when(F.col("_valid"), "utf-8-sig").otherwise("latin-1").alias("encoding"),
            F.greatest(F.col("_lines") - 1, F.lit(0)).alias("data_lines"),
        )
    )


def detect_encoding(spark: SparkSession, path: str) -> str:
    """``utf-8-sig`` if the whole file is valid UTF-8, else ``latin-1``."""
    row = text_facts(spark, path).agg(F.min("encoding").alias("encoding")).first()
    return row.encoding or "utf-8-sig"


def common_encoding():
    """Encoding of a table: latin-1 as soon as one of its files is not UTF-8."""
    return F.min("encoding").alias("encoding")


def describe_files(spark: SparkSession, paths) -> DataFrame:
    """Listing, checksum, encoding and data lines of some files."""
    files = list_files(spark, paths)
    return (
        files.join(checksums(spark, files, paths), "path", "left")
        .join(text_facts(spark, paths), "uri", "left")
        .fillna({"encoding": "utf-8-sig", "data_lines": 0})
    )


def file_manifest(spark: SparkSession, files: dict, source: str, previous: DataFrame | None = None) -> DataFrame:
    """One row per registered file: ``files`` maps table names to files or folders of parts."""
    facts = checkpointed(describe_files(spark, list(files.values())))
    located = spark.createDataFrame(
        [(table, path, status[1]) for table, path in files.items() for status in file_statuses(spark, path)],
        "`table` string, location string, uri string",
    )
    filled = facts.where("size_bytes > 0").join(located, "uri")
    charsets = {row.table: row.encoding for row in filled.groupBy("table").agg(common_encoding()).collect()}
    headers = spark.createDataFrame(
        [(table, read_text_table(spark, path, charsets[table]).columns if table in charsets else [])
         for table, path in files.items()],
        "`table` string, column_names array<string>",
    )
    manifest = facts.join(located, "uri").join(headers, "table").select(
        "table", F.lit(source).alias("source"), "location", "file", "path", "sha256", "size_bytes", "encoding",
        "data_lines", F.size("column_names").alias("columns"), "column_names", "file_modified_at",
    )
    return flag_changes(manifest, previous, ("table", "file"))


def flag_changes(manifest: DataFrame, previous: DataFrame | None, key=("table",)) -> DataFrame:
    """Add ``changed_since_last_run``: registered before under this key with another checksum."""
    if previous is None:
        return manifest.withColumn("changed_since_last_run", F.lit(False))
    before = previous.select(*key, F.col("sha256").alias("_before"))
    changed = F.coalesce(F.col("_before") != F.col("sha256"), F.lit(False))
    return manifest.join(before, list(key), "left").withColumn("changed_since_last_run", changed).drop("_before")


def reject_empty(manifest: DataFrame) -> DataFrame:
    """Fail on a registered table without content."""
    sizes = manifest.groupBy("location").agg(F.sum("size_bytes").alias("bytes")).where("bytes = 0")
    empty = [row.location for row in sizes.limit(10).collect()]
    if empty:
        raise SourceError(f"source files are empty: {empty}")
    return manifest
