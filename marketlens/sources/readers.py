"""Scans: raw CSV sources, stored tables, published files, parameterised SQL."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketlens.functions.dates import parse_timestamp
from marketlens.functions.money import nan_to_null
from marketlens.sources.store import Store

# Position of a row in its source files (name, block, running number within the scan); added on request and
# used by "keep first" operators.
FILE_ORDER = "_file_order"

# A quote within quotes is doubled. (Spark's default is a backslash before it.)
CSV = {"header": True, "escape": '"'}


# A row whose number of fields is not that of the header of its file: the line as it stands, and what is wrong.
BAD_ROW = "_bad_row"
TOO_FEW, TOO_MANY = "too few fields", "too many fields"
_LINE = "_line"

# One file per task: no file is split, none shares a task with another one.
_WHOLE_FILES = {"spark.sql.files.maxPartitionBytes": str(1 << 60), "spark.sql.files.openCostInBytes": str(1 << 60)}


def as_path(name: str) -> str:
    """A file name as a path without wildcards."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", name)


def first_lines(spark: SparkSession, paths: list[str]) -> list[tuple[str, list[str]]]:
    """Each distinct first line (blank ones are skipped) and the files that have it, by one job over all files.

    Every file is a task that stops reading after that line.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, line in enumerate(batch.column("value").to_pylist()):
                if line.strip():
                    yield batch.slice(k, 1)
                    return

    saved = {key: spark.conf.get(key) for key in _WHOLE_FILES}
    try:
        for key, value in _WHOLE_FILES.items():
            spark.conf.set(key, value)
        lines = spark.read.text(paths).select("_metadata.file_path", "value").mapInArrow(first, "file string, value string")
        found = lines.groupBy("value").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("value").collect()
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)
    return [(row.value, [unquote(file) for file in row.files]) for row in found]


def files_by_header(spark: SparkSession, paths: list[str], options: dict) -> list[tuple[list[str], list[str]]]:
    """Each distinct header of the files of ``paths``, and files that have it. A header is one line. Empty files have none."""
    groups = []
    for _, files in first_lines(spark, paths):
        header = spark.read.options(**options | {"multiLine": False}).csv(as_path(files[0])).columns
        groups.append((list(header), [as_path(file) for file in files]))
    return groups


def scan_text(
    spark: SparkSession, paths: list[str], file_order: bool = False, multi_line: bool = False
) -> DataFrame | None:
    """CSV files with a header each, all values as text. None if there is no file with a header.

    Columns are matched by the names in the header of each file, so their order is free; where only some files have a
    column, it is NULL for the others. Only the headers are looked at before the scan. ``_bad_row`` is set where a row has
    not as many fields as its header. ``multi_line``: quoted values may hold line breaks; a file is then read by one task.
    """
    options = CSV | {"multiLine": multi_line}
    scans = [_scan(spark, header, files, options, file_order) for header, files in files_by_header(spark, paths, options)]
    if not scans:
        return None
    rows = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    last = [BAD_ROW, *[FILE_ORDER] * file_order]
    return rows.select(*(c for c in rows.columns if c not in last), *last)


def _scan(spark: SparkSession, header: list[str], paths: list[str], options: dict, file_order: bool) -> DataFrame:
    layout = StructType([StructField(name, StringType()) for name in [*header, _LINE]])
    # All columns are parsed, whichever are asked for, as a row with missing fields is not seen otherwise.
    whole = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _LINE, "columnPruning": False}
    rows = spark.read.schema(layout).options(**options, **whole).csv(paths)
    # Separators outside quotes; an open quote reaches to the end of the line.
    bare = F.regexp_replace(_LINE, '"(?:[^"]|"")*(?:"|$)', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1
    problem = F.when(fields > len(header), TOO_MANY).otherwise(TOO_FEW)
    # Spark refuses a query for the faulty line alone; the condition on a first column, always true, makes it ask for two.
    asked = F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))) >= 0
    bad = F.when(F.col(_LINE).isNotNull() & asked, F.struct(F.col(_LINE).alias("line"), problem.alias("problem")))
    columns = [*[F.col(f"`{name}`") for name in header], bad.alias(BAD_ROW)]
    if file_order:
        position = F.struct(
            F.col("_metadata.file_name"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id().alias("row"),
        )
        columns.append(position.alias(FILE_ORDER))
    return rows.select(*columns)


def typed(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows of text with the types of ``schema``; columns that it does not name stay text, absent ones stay absent.

    Unreadable numbers become NULL, NaN too. Rows with too many fields are left out, as it is not known which value
    belongs to which column; of rows with too few, the last columns are NULL. ``clean.bad_values`` reports all of these.
    """
    known = {field.name: field.dataType for field in schema.fields}

    def column(name: str) -> Column:
        kind = known.get(name)
        if kind is None or rows.schema[name].dataType != StringType():
            return F.col(f"`{name}`")
        value = F.col(f"`{name}`").try_cast(kind)
        return (nan_to_null(value) if kind.typeName() == "double" else value).alias(name)

    if BAD_ROW in rows.columns:
        rows = rows.filter(F.coalesce(F.col(f"{BAD_ROW}.problem") != TOO_MANY, F.lit(True)))
    return rows.select(*[column(name) for name in rows.columns if name != BAD_ROW])


def read_csv_source(
    spark: SparkSession, path: str, schema: StructType, file_order: bool = False, multi_line: bool = False
) -> DataFrame:
    """CSV with a header line: a file, or a folder of files with a header each (``scan_text``), with the types of
    ``schema`` (``typed``). A missing path raises."""
    rows = scan_text(spark, [path], file_order, multi_line)
    if rows is None:
        return spark.createDataFrame([], StructType([]))
    return typed(rows, schema)


def read_optional_source(spark: SparkSession, path: str, schema: StructType, **options) -> DataFrame | None:
    """As ``read_csv_source``, but None when the path does not exist."""
    try:
        return read_csv_source(spark, path, schema, **options)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_stored(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A table of a store, as last published."""
    return Store(spark, base).read(name)


def with_parsed_dates(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: parse_timestamp(name) for name in names})


def query_tables(
    spark: SparkSession, query: str, tables: dict[str, DataFrame], params: dict | None = None
) -> DataFrame:
    """SQL over named DataFrames (written ``{name}``) with bound parameters (written ``:name``)."""
    return spark.sql(query, args=params or {}, **tables)


def read_published(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A published CSV; an empty frame of the same schema when it is not there yet."""
    try:
        return spark.read.schema(schema).options(**CSV, multiLine=True).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def has_columns(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def fetch_scalar(df: DataFrame):
    """The single value of a one-row, one-column result."""
    row = df.first()
    return None if row is None else row[0]
