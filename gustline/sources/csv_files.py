"""Directories of CSV files whose headers may list the columns in different orders."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from typing import TYPE_CHECKING, Any
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gustline.sources.shared_folder import shared_folder

if TYPE_CHECKING:
    import pyarrow as pa


# Options that decide which files belong to a source.
_LISTING_OPTIONS = ("pathGlobFilter", "recursiveFileLookup", "modifiedAfter", "modifiedBefore")


# Schemes of file systems whose files the tasks can open to look at a header.
HEADER_SCHEMES = frozenset({"", "file", "s3", "s3a", "gs", "hdfs", "abfs", "abfss"})
MAX_HEADERS = 200

Paths = str | Sequence[str]


def _listing(spark: SparkSession, paths: Paths, options: Mapping[str, Any], pattern: str | None = "*.csv") -> DataFrame:
    chosen = {**({"pathGlobFilter": pattern} if pattern else {}), **options}
    try:
        return (
            spark.read.format("binaryFile")
            .options(**{key: chosen[key] for key in _LISTING_OPTIONS if chosen.get(key) is not None})
            .load(paths if isinstance(paths, str) else list(paths))
            .select("path", "length", F.col("_metadata.file_path").alias("file"))
        )
    except AnalysisException as error:
        raise FileNotFoundError(f"No directory {paths}") from error


def get_all_csv_files(
    spark: SparkSession, directory: str, options: Mapping[str, Any] | None = None
) -> DataFrame:
    """The ``*.csv`` files directly inside a directory, as one row each (``path``, ``length``).

    Spark lists them, leaves out empty ones and opens none. ``FileNotFoundError`` if none is left.
    ``options`` may narrow or widen the choice (``modifiedAfter``, ``recursiveFileLookup``, ...).
    """
    files = _listing(spark, directory, options or {}).select("path", "length")
    if files.isEmpty():
        raise FileNotFoundError(f"No CSV file in {directory}")
    return files


def _header_reader(options: Mapping[str, Any]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    # Everything the tasks need lives inside, so the executors need not have this package.
    import csv
    import io

    import pyarrow as pa
    from pyarrow import fs

    chunk_size = 64 * 1024
    encoding = options.get("encoding") or options.get("charset") or "utf-8"
    separator = options.get("sep") or options.get("delimiter") or ","
    quote = options.get("quote") or '"'

    def first_line(path: str) -> str:
        if path.startswith("file:"):
            filesystem, name = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
        else:
            filesystem, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        start = b""
        with filesystem.open_input_stream(name) as stream:
            while chunk := stream.read(chunk_size):
                start += chunk
                if b"\n" in chunk or b"\r" in chunk:
                    break
        lines = start.decode(encoding, errors="replace").removeprefix("\ufeff").splitlines()
        return lines[0] if lines else ""

    def parsed(path: str) -> list[str]:
        return next(csv.reader(io.StringIO(first_line(path)), delimiter=separator, quotechar=quote), [])

    def read_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("columns", pa.list_(pa.string()))])
        for batch in batches:
            headers = [parsed(path) for path in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(headers, schema[1].type)], schema=schema)

    return read_headers


def header_catalogue(
    spark: SparkSession, paths: Paths, options: Mapping[str, Any] | None = None, pattern: str | None = "*.csv"
) -> DataFrame:
    """``file`` and ``columns`` of every CSV file: its header line, parsed.

    The tasks open each file once and read its beginning; the result is a written table in the
    shared folder, so looking at it again opens nothing. ``FileNotFoundError`` without any file,
    ``ValueError`` for a file system whose files the tasks can't open.
    """
    options = options or {}
    files = _listing(spark, paths, options, pattern)
    some = files.select("path").first()
    if some is None:
        raise FileNotFoundError(f"No CSV file in {paths}")
    scheme = urlsplit(some.path).scheme
    if scheme not in HEADER_SCHEMES:
        raise ValueError(f"Headers of {scheme}:// files can't be looked at: name the columns of the files")
    folder = shared_folder(spark, "csv-headers")
    files.select("file", "path").mapInArrow(
        _header_reader(options), "file string, columns array<string>"
    ).write.parquet(folder)
    return spark.read.schema("file string, columns array<string>").parquet(folder)


def _scan(
    spark: SparkSession,
    paths: Paths,
    columns: Sequence[str],
    options: Mapping[str, Any],
    pattern: str | None,
    by_position: bool = False,
) -> DataFrame:
    """One scan as text; unless bound by position, a file with another header fails the query."""
    chosen = {"mode": "PERMISSIVE", **({"pathGlobFilter": pattern} if pattern else {}), **options}
    return (
        spark.read.schema(T.StructType([T.StructField(name, T.StringType()) for name in columns]))
        .options(**{key: value for key, value in chosen.items() if value is not None})
        .options(header=True, enforceSchema=by_position)
        .csv(paths if isinstance(paths, str) else list(paths))
    )


def read_csv_directory(
    spark: SparkSession,
    directory: Paths,
    required: Iterable[str] = (),
    columns: Sequence[str] | None = None,
    file_column: str | None = None,
    options: Mapping[str, Any] | None = None,
    only_common: bool = False,
    pattern: str | None = "*.csv",
) -> DataFrame:
    """All CSV files of a directory (or of a file, a glob, several paths) as text columns, bound by header name.

    Spark binds the columns of a scan by position, so files with another column order would be
    swapped silently. The files' headers are looked at first, see ``header_catalogue``. If all
    have the same columns, Spark scans by these names. Otherwise one scan reads all files by
    position, and each row takes its columns from where its file's header has them; files with
    the most common header need no entry for that. The driver receives the different headers
    (``MAX_HEADERS`` at most), never a list of files. A file without a ``required`` column raises
    ``ValueError``. Short rows end in NULLs, surplus fields are dropped.

    ``columns`` states the one header all files have and skips the look at the headers; Spark
    then refuses any file that differs while it reads. ``file_column`` names a column to hold
    each row's file name. ``options`` are Spark's CSV options (separator, encoding,
    ``modifiedAfter`` to skip files without new rows, ...). Columns that some files lack are NULL
    there; with ``only_common`` they are left out. ``pattern`` is which files of a folder count.
    """
    options = {key: value for key, value in (options or {}).items() if key != "path"}
    if str(options.get("header", "true")).lower() != "true":
        raise ValueError("Files without a header line cannot be bound by name")

    def complete(names: Sequence[str]) -> Sequence[str]:
        absent = [name for name in required if name not in names]
        if absent:
            raise ValueError(f"Columns missing from a CSV header in {directory}: {absent}")
        return names

    name_of_file = [F.col("_metadata.file_name").alias(file_column)] if file_column else []
    if columns is not None:
        if _listing(spark, directory, options, pattern).isEmpty():
            raise FileNotFoundError(f"No CSV file in {directory}")
        return _scan(spark, directory, complete(columns), options, pattern).select("*", *name_of_file)

    catalogue = header_catalogue(spark, directory, options, pattern)
    counted = catalogue.groupBy("columns").agg(F.count("*").alias("files"))
    headers = [row["columns"] for row in counted.orderBy(F.desc("files"), "columns").limit(MAX_HEADERS + 1).collect()]
    if len(headers) > MAX_HEADERS:
        raise ValueError(f"More than {MAX_HEADERS} different CSV headers in {directory}")
    for names in headers:
        complete(names)
    if len(headers) == 1:
        return _scan(spark, directory, headers[0], options, pattern).select("*", *name_of_file)

    if str(options.get("mode", "PERMISSIVE")).upper() != "PERMISSIVE" and len(set(map(len, headers))) > 1:
        raise ValueError(f"Files in {directory} differ in their number of columns, which takes mode PERMISSIVE")

    def literal(names: Sequence[str]) -> Column:
        return F.array(*map(F.lit, names)).cast("array<string>")

    places = [f"place_{i}" for i in range(max(map(len, headers)))]
    scanned = _scan(spark, directory, places, options, pattern, by_position=True)
    metadata = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name")]
    rows = scanned.select(*places, *metadata)
    number = F.array_position(F.array(*map(literal, headers)), F.col("columns")) - 1
    uncommon = catalogue.select("file", number.cast("int").alias("header")).where("header > 0")
    rows = rows.join(uncommon, "file", "left")
    header = F.coalesce("header", F.lit(0))

    def named(name: str) -> Column:
        held = [(i, names.index(name)) for i, names in enumerate(headers) if name in names]
        value = F.when(header == held[0][0], F.col(places[held[0][1]]))
        for i, place in held[1:]:
            value = value.when(header == i, F.col(places[place]))
        return value.alias(name)

    everywhere = set.intersection(*map(set, headers))
    wanted = dict.fromkeys(name for names in headers for name in names if not only_common or name in everywhere)
    own = [F.col("name").alias(file_column)] if file_column else []
    return rows.select(*map(named, wanted), *own)
