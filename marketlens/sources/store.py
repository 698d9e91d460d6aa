"""Stored tables that are replaced together or not at all.

A change writes its files into folders that no reader looks at yet, ``<table>/version=<n>-<id>``, and ends by moving one
small file into place, ``_pointers/<n>.json``. That file names, for every table of the store, the folders that make it
up. Readers follow the pointer with the highest number. So they see all tables of a change or none, a job that is killed
leaves the tables as they were, and a partition that a change does not touch keeps its files.

There is one writer at a time: a second change that started from the same pointer fails when it ends. Folders of older
versions stay for readers that still use them, until ``clean`` removes them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

POINTERS = "_pointers"
# The folder of a partition whose value is missing.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
# Of the stored files.
COMPRESSION = "zstd"
# Bytes that Spark reckons for a row besides its values.
ROW_HEADER = 8


class ConcurrentChange(Exception):
    """Another change was published since this one started."""


class Folder:
    """Few small files and folder listings, through the file system that Spark itself uses."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "", folders: bool = False) -> list[str]:
        path = self._path(name)
        if not self.fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path) if s.isDirectory() == folders)

    def size(self, name: str) -> int:
        """Bytes of a file or folder, 0 without one."""
        path = self._path(name)
        return self.fs.getContentSummary(path).getLength() if self.fs.exists(path) else 0

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Write a new file that appears whole. False if there is one of that name."""
        parent, own = name.rsplit("/", 1)
        draft = self._path(f"{parent}/.{own}-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.exists(self._path(name)) and self.fs.rename(draft, self._path(name)):
            return True
        self.fs.delete(draft, False)
        return False

    def remove(self, name: str) -> None:
        self.fs.delete(self._path(name), True)

    def leaves(self, name: str, depth: int) -> list[str]:
        """The folders ``depth`` levels below."""
        found = [name]
        for _ in range(depth):
            found = [f"{top}/{sub}" for top in found for sub in self.names(top, folders=True) if "=" in sub]
        return found


class Written:
    """What a change has written in one go: folders by partition, and the figures counted while writing."""

    def __init__(self, root: str, schema: StructType, by: list[str], folders: list[str], figures: dict):
        self.root, self.schema, self.by, self.folders, self.figures = root, schema, by, folders, figures

    def where(self, column: str, wanted: Callable[[str], bool]) -> list[str]:
        """The folders of the partitions whose value (as in the folder name) is wanted."""
        return [f for f in self.folders if wanted(partition_values(f)[column])]


def partition_values(folder: str) -> dict[str, str]:
    return dict(part.split("=", 1) for part in folder.split("/") if "=" in part)


class Store:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.folder = Folder(spark, self.base)

    def pointers(self) -> list[int]:
        return sorted(int(name.split(".")[0]) for name in self.folder.names(POINTERS) if name.endswith(".json") and name[0] != ".")

    def tables(self, number: int | None = None) -> dict[str, dict]:
        """name -> root, schema, hidden (further partition columns), by, folders, rows, figures; of the published state."""
        numbers = self.pointers()
        if not numbers:
            return {}
        return json.loads(self.folder.read(f"{POINTERS}/{numbers[-1] if number is None else number:012d}.json"))["tables"]

    def has(self, name: str) -> bool:
        return name in self.tables()

    def read(self, name: str, only: Callable[[dict[str, str]], bool] | None = None) -> DataFrame:
        """A published table; ``only`` chooses partitions by their values."""
        tables = self.tables()
        if name not in tables:
            raise AnalysisException(f"no table {name} in {self.base}", errorClass="PATH_NOT_FOUND", messageParameters={"path": f"{self.base}/{name}"})
        return self.open(tables[name], only)

    def lookup(self, name: str, only: Callable[[dict[str, str]], bool] | None = None) -> DataFrame:
        """A published table to look rows up in, see ``open_lookup``."""
        return self.open_lookup(self.tables()[name], only)

    def open_lookup(self, table: dict, only: Callable[[dict[str, str]], bool] | None = None) -> DataFrame:
        """A table for the side of a join in which rows are looked up.

        Spark takes the length of the files for the size of a table, but these are packed many times denser than rows in
        memory: millions of ids lie in fewer bytes than its threshold for a broadcast and would all pass through the
        driver. The rows were counted as they were written. Where they, at Spark's width of a row, are beyond the
        threshold, the join is one of shuffles; below it Spark is free.
        """
        rows = self.open(table, only)
        most = self.spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        if most.startswith("-"):
            return rows
        size = table["rows"] * (rows._jdf.schema().defaultSize() + ROW_HEADER)
        in_bytes = self.spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
        return rows.hint("merge") if size > in_bytes(most) else rows

    def open(self, table: dict, only: Callable[[dict[str, str]], bool] | None = None) -> DataFrame:
        schema = StructType.fromJson(table["schema"])
        folders = [f for f in table["folders"] if only is None or only(partition_values(f))]
        if not folders:
            return self.spark.createDataFrame([], schema)
        root = f"{self.base}/{table['root']}"
        # The partition columns of the folders that are not columns of the table are left out by the schema below.
        layout = StructType([*schema.fields, *[f for f in StructType.fromJson(table["hidden"]).fields]])
        rows = self.spark.read.schema(layout).option("basePath", root).parquet(*[f"{root}/{f}" for f in folders])
        return rows.select(*schema.names)

    def change(self) -> Change:
        return Change(self)

    def clean(self, keep: int = 2) -> list[str]:
        """Remove pointers but the last ``keep``, and the folders that none of those names. Returns the folders."""
        numbers = self.pointers()
        kept = numbers[-keep:]
        named = {f"{t['root']}/{f}".split("/")[1] for n in kept for t in self.tables(n).values() for f in t["folders"]}
        gone = []
        for root in self.folder.names(folders=True):
            for version in self.folder.names(root, folders=True):
                # A folder of a higher number may belong to a change that is under way.
                if version.startswith("version=") and int(version[8:].split("-")[0]) <= numbers[-1] and version not in named:
                    gone.append(f"{root}/{version}")
        for number in numbers[:-keep]:
            self.folder.remove(f"{POINTERS}/{number:012d}.json")
        for name in gone:
            self.folder.remove(name)
        return gone


class Change:
    """Tables written and then published together. Use as a context; an exception publishes nothing."""

    def __init__(self, store: Store):
        self.store = store
        numbers = store.pointers()
        self.number = numbers[-1] + 1 if numbers else 1
        self.tables = store.tables()

    def __enter__(self) -> Change:
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self.commit()

    def write(self, df: DataFrame, root: str, by: Iterable[str] = (), rebalance: bool = True, **figures: Column) -> Written:
        """Write rows in one pass, split by columns. Figures are counted by that pass, exactly: they are counted in the
        tasks that write the files, of which each counts once however often it is tried."""
        by = list(by)
        version = f"version={self.number}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        # Rebalanced, every partition gets few files of good size, and a large one is split.
        rows = df.hint("rebalance", *[F.col(c) for c in by]) if by and rebalance else df
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), *[c.alias(name) for name, c in figures.items()])
        rows.write.option("compression", COMPRESSION).partitionBy(*by).parquet(f"{self.store.base}/{root}/{version}")
        folders = self.store.folder.leaves(f"{root}/{version}", len(by))
        return Written(root, df.schema, by, [f.split("/", 1)[1] for f in folders], seen.get)

    def publish(
        self, name: str, written: Written, folders: list[str] | None = None, columns: list[str] | None = None, rows: int | None = None
    ) -> None:
        """Make (some of) the folders the table of that name, as this change sees it and, once it ends, everybody.
        ``rows``: how many rows these folders hold, if not all."""
        chosen = written.folders if folders is None else folders
        schema = StructType([f for f in written.schema.fields if columns is None or f.name in columns])
        hidden = [StructField("version", _parse_datatype_string("string")), *[f for f in written.schema.fields if f.name in written.by and f.name not in schema.names]]
        figures = dict(written.figures)
        self.tables[name] = {
            "root": written.root,
            "schema": schema.jsonValue(),
            "hidden": StructType(hidden).jsonValue(),
            "by": written.by,
            "folders": chosen,
            "rows": figures.pop("n_rows", 0) if rows is None else rows,
            "figures": figures,
        }

    def replace(self, name: str, df: DataFrame, by: Iterable[str] = (), **figures: Column) -> Written:
        written = self.write(df, name, by, **figures)
        self.publish(name, written)
        return written

    def append(self, name: str, df: DataFrame, **figures: Column) -> Written:
        """Add rows to an unpartitioned table. Its columns become those of old and new rows together."""
        written = self.write(df, name, **figures)
        if name not in self.tables:
            self.publish(name, written)
            return written
        table = self.tables[name]
        schema = StructType.fromJson(table["schema"])
        added = [f for f in written.schema.fields if f.name not in schema.names]
        figures = {key: table["figures"].get(key, 0) + n for key, n in written.figures.items()}
        self.tables[name] = {
            **table,
            "schema": StructType([*schema.fields, *added]).jsonValue(),
            "folders": table["folders"] + written.folders,
            "rows": table["rows"] + figures.pop("n_rows", 0),
            "figures": figures,
        }
        return written

    def replace_partitions(self, name: str, df: DataFrame, touched: Callable[[dict[str, str]], bool]) -> Written:
        """Put new rows in place of the partitions that are touched. All other partitions keep their files."""
        table = self.tables[name]
        written = self.write(df, table["root"], table["by"])
        kept = [f for f in table["folders"] if not touched(partition_values(f))]
        stray = [f for f in written.folders if not touched(partition_values(f))]
        if stray:
            raise ValueError(f"rows of partitions that are not replaced: {stray[:3]}")
        gone = self.read(name, touched).count()
        rows = table["rows"] - gone + written.figures.get("n_rows", 0)
        self.tables[name] = {**table, "folders": kept + written.folders, "rows": rows}
        return written

    def read(self, name: str, only: Callable[[dict[str, str]], bool] | None = None) -> DataFrame:
        """A table as this change sees it."""
        return self.store.open(self.tables[name], only)

    def lookup(self, name: str, only: Callable[[dict[str, str]], bool] | None = None) -> DataFrame:
        """The same, to look rows up in (``Store.open_lookup``)."""
        return self.store.open_lookup(self.tables[name], only)

    def commit(self) -> None:
        text = json.dumps({"tables": self.tables}, indent=1)
        if not self.store.folder.publish(f"{POINTERS}/{self.number:012d}.json", text):
            raise ConcurrentChange(f"{self.store.base} was changed meanwhile")
