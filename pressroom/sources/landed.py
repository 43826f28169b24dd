"""Landed files: RSS feeds, JSON lists, image manifests."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from pressroom.functions import dates, text as tx


def rss_items(spark: SparkSession, path: str, as_of, branch: str, query: str, days: int) -> DataFrame:
    """Entries of landed RSS files as feed rows; empty titles and entries past the window are dropped."""
    items = (
        spark.read.format("xml").option("rowTag", "item").option("attributePrefix", "_").option("valueTag", "text")
        .schema("title string, link string, pubDate string, updated string, source struct<text:string,_url:string>")
        .load(path)
    )
    published = dates.feed_date(tx.first_text(F.col("pubDate"), F.col("updated")))
    rows = items.withColumn("found", tx.source_of(F.col("source.text"), F.col("title"))).select(
        tx.strip_source(F.col("title"), F.col("found")).alias("title"), F.col("found").alias("source"),
        published.alias("published"), tx.blank_if_null(F.col("link")).alias("link"),
        F.lit(branch).alias("category_internal"), F.array(F.lit(branch)).alias("categories_seen"),
        F.lit(query).alias("search_query"), F.lit(days).alias("discovery_window_days"),
    )
    return rows.filter((F.col("title") != "") & dates.in_window(F.col("published"), as_of, days))


def json_list(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of JSON list files; nothing when the path is missing.

    A mistyped field is null and its record stays; records without any readable field and broken files give no rows.
    """
    reader = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
    try:
        return reader.json(path).dropna(how="all")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def json_records(spark: SparkSession, path: str, schema: StructType | str, indent: int = 2) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of JSON list files written with an indent, each file read by as many tasks as its size asks for.

    With an indent a record ends at the only line that holds a closing brace at its depth (inside strings a line end is escaped), so Spark's
    text reader splits the files there. `rejected` has file and text of each record that is no JSON object, and of each with a mistyped
    field; the latter stays among the rows with that field null. Empty lists and a missing path give no rows.
    """
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if "_record" in fields.names:
        raise ValueError("_record is the name of the rejected text")
    try:
        pieces = spark.read.option("lineSep", "\n" + " " * indent + "}").text(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], fields), spark.createDataFrame([], "file string, record string")
    body = F.regexp_replace("value", r"^[\s,]*\[?\s*", "")  # the list's bracket, the comma after the record before
    found = pieces.select(F.col("_metadata.file_path").alias("file"), body.alias("body")).filter(~F.col("body").rlike(r"^\s*\]?\s*$"))
    found = found.withColumn("record", F.concat("body", F.lit("\n" + " " * indent + "}")))
    read = StructType(list(fields.fields)).add("_record", StringType())
    parsed = found.withColumn("row", F.from_json("record", read, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_record"}))
    bad = F.col("row").isNull() | F.col("row._record").isNotNull()
    empty = F.lit(True)
    for name in fields.names:
        empty = empty & F.col(f"row.`{name}`").isNull()
    rows = parsed.filter(~empty).select(*[F.col(f"row.`{name}`").alias(name) for name in fields.names])
    return rows, parsed.filter(bad).select("file", "record")


def json_list_strict(spark: SparkSession, path: str, schema: StructType | str, label: str) -> DataFrame:
    """Rows of JSON list files; a missing path, a broken record or an empty list is an error."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    if rows.isEmpty():
        raise ValueError(f"{label} must hold a non-empty JSON list: {path}")
    return rows


# How image files begin, and the JPEG markers that carry the size or stand without a length.
PNG_START, JPEG_START = b"\x89PNG\r\n\x1a\n", b"\xff\xd8\xff"
JPEG_SIZES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
JPEG_BARE = frozenset({0x01, *range(0xD0, 0xD8)})
MOST_SEGMENTS = 1_000


def image_size(file) -> tuple[str | None, int | None, int | None]:
    """(format, width, height) from the headers of a seekable file: at most 24 bytes, and 9 per JPEG segment, are read."""
    head = file.read(24)
    if head.startswith(PNG_START):
        return ("PNG", *struct.unpack(">II", head[16:24])) if len(head) == 24 else ("PNG", None, None)
    if not head.startswith(JPEG_START):
        return None, None, None
    at = 2
    for _ in range(MOST_SEGMENTS):
        file.seek(at)
        mark = file.read(9)
        if len(mark) < 2 or mark[0] != 0xFF:
            break
        if mark[1] == 0xFF:  # a fill byte
            at += 1
        elif mark[1] in JPEG_BARE:
            at += 2
        elif mark[1] in JPEG_SIZES and len(mark) == 9:
            height, width = struct.unpack(">HH", mark[5:9])
            return "JPEG", width, height
        elif len(mark) < 4 or mark[1] in (0xD9, 0xDA):  # the end, or picture data without a size before them
            break
        else:
            at += 2 + struct.unpack(">H", mark[2:4])[0]
    return "JPEG", None, None


def arrow_file(path: str):
    """(file system, path) of a path as Spark names it."""
    from pyarrow import fs

    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _sizes(batches):
    for batch in batches:
        out = []
        for path in batch.column("path").to_pylist():
            place, inner = arrow_file(path)
            with place.open_input_file(inner) as file:
                out.append(image_size(file))
        columns = [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))]
        yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["path", "n_bytes", "format", "width", "height"])


def image_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(path, n_bytes, format, width, height) of image files; sizes are null where the headers name none.

    Spark lists the files, and tasks open each for a few header bytes, whatever its size; the contents are not loaded. The files must be in a
    store that Arrow's file systems reach.
    """
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("n_bytes"))
    return files.mapInArrow(_sizes, "path string, n_bytes bigint, format string, width int, height int")
