"""Landing of raw files: each is read once, as text, and stored with the position of every row.

The manifest (table ``bronze_files``) names every landed file with its size, time and header. A later landing reads only
files that are not in it. If a landed file has changed or is gone, its source is landed anew, so the stored rows are
always those of the files that are there. All later steps read the landed rows; the raw files are not opened again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources import schemas
from marketlens.sources.readers import BAD_ROW, as_path, scan_text, typed
from marketlens.sources.store import Change, Store

MANIFEST = "bronze_files"
MANIFEST_COLUMNS = "source string, path string, size bigint, modified timestamp"
OPTIONAL = {"sellers"}


def table_name(source: str) -> str:
    return f"bronze_{source}"


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int, object]]:
    """Path, size and time of the files of a path. Their contents are not read."""
    found = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    return sorted(tuple(row) for row in found.collect())


def land_source(change: Change, source: str, path: str, multi_line: bool = False) -> list[tuple]:
    """Land the new files of a source; returns its lines of the manifest."""
    spark = change.store.spark
    try:
        now = files_of(spark, path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND" and source in OPTIONAL:
            change.tables.pop(table_name(source), None)
            return []
        raise
    landed = set()
    if MANIFEST in change.tables and table_name(source) in change.tables:
        landed = {tuple(row)[1:] for row in change.read(MANIFEST).filter(F.col("source") == source).collect()}
    anew = not landed <= set(now) or not landed
    wanted = now if anew else [file for file in now if file not in landed]
    rows = scan_text(spark, [as_path(name) for name, _, _ in wanted], file_order=True, multi_line=multi_line) if wanted else None
    if rows is not None:
        bad = F.count(BAD_ROW)
        if anew:
            change.replace(table_name(source), rows, bad_rows=bad)
        else:
            change.append(table_name(source), rows, bad_rows=bad)
    elif anew:
        change.replace(table_name(source), spark.createDataFrame([], schemas.RAW_SOURCES[source]))
    return [(source, *file) for file in now]


def land(spark: SparkSession, folder: str, base: str, multi_line: bool = False) -> None:
    """Land the raw sources of a folder: ``<source>.csv``, each a file or a folder of files. Sellers may be missing.

    The list of files passes through the driver, as it does in every scan of Spark. It is taken before the scans, so a
    file that arrives meanwhile waits for the next landing.
    """
    with Store(spark, base).change() as change:
        lines = []
        for source in schemas.RAW_SOURCES:
            lines += land_source(change, source, f"{folder.rstrip('/')}/{source}.csv", multi_line)
        change.replace(MANIFEST, spark.createDataFrame(lines, MANIFEST_COLUMNS))


def land_frames(frames: dict[str, DataFrame], base: str) -> None:
    """Land rows that are no files: sources that another job provides."""
    spark = next(iter(frames.values())).sparkSession
    with Store(spark, base).change() as change:
        for source, df in frames.items():
            change.replace(table_name(source), df)


def raw_rows(change: Change) -> dict[str, DataFrame]:
    """The landed rows of all sources, with types."""
    return {
        source: typed(change.read(table_name(source)), schema)
        for source, schema in schemas.RAW_SOURCES.items()
        if table_name(source) in change.tables
    }
