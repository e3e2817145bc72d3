"""Zipped CSV: a data source that reads every entry of every archive as a partition of its own."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

# Python workers get this module's code with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of an entry that the parser takes at once.
BLOCK = 4 << 20


def _opened(path: str):
    """A seekable file of a local, HDFS or object store."""
    from pyarrow import fs

    system, inside = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    return system.open_input_file(inside)


def _archives(path: str) -> list[str]:
    """The archive itself, or those of a folder."""
    from pyarrow import fs

    system, inside = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    info = system.get_file_info(inside)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [path]
    found = system.get_file_info(fs.FileSelector(inside, recursive=True))
    root = path[: len(path) - len(inside)] if path.endswith(inside) else path.split("://")[0] + "://"
    return sorted(f"{root}{f.path}" for f in found if f.is_file and f.path.lower().endswith(".zip"))


class Entry(InputPartition):
    def __init__(self, archive: str, name: str):
        super().__init__((archive, name))
        self.archive, self.name = archive, name


class ZippedCsv(DataSource):
    """``spark.read.format("zipped_csv")``: text columns by position, header lines skipped."""

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ZippedCsvReader(self.options, [f.name for f in schema.fields])


class ZippedCsvReader(DataSourceReader):
    def __init__(self, options, names: list[str]):
        self.paths = options["paths"].split("\n") if options.get("paths") else []
        self.header, self.names = options.get("header", "true").lower() == "true", names

    def partitions(self) -> list[Entry]:
        """One for each entry; a directory of an archive is read, not its data."""
        import zipfile

        out = []
        for path in self.paths:
            for archive in _archives(path):
                with zipfile.ZipFile(_opened(archive)) as z:
                    out += [Entry(archive, i.filename) for i in z.infolist()
                            if i.file_size and i.filename.lower().endswith((".csv", ".txt"))]
        return out or [Entry("", "")]

    def read(self, partition: Entry) -> Iterator[pa.RecordBatch]:
        """An entry's rows in batches; no more than a block of it is held."""
        import zipfile

        from pyarrow import csv

        if not partition.archive:
            return
        with zipfile.ZipFile(_opened(partition.archive)) as z, z.open(partition.name) as entry:
            names = [str(i) for i in range(len(self.names))]
            lines = csv.open_csv(
                entry, read_options=csv.ReadOptions(block_size=BLOCK, column_names=names, skip_rows=int(self.header)),
                parse_options=csv.ParseOptions(newlines_in_values=True, double_quote=True),
                convert_options=csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=True,
                                                   null_values=[""], quoted_strings_can_be_null=False))
            for batch in lines:
                yield batch.rename_columns(self.names)


def read_zipped_csv(spark: SparkSession, *paths: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """The CSV entries of zip archives (or folders of them), with a declared schema.

    Columns are bound by position: a header line is skipped, not trusted, so a byte-order mark and
    duplicate names do no harm. An empty cell is null, a quoted empty one is an empty text, and a cell
    that does not fit its type is null. Every entry is a partition; a row of another width is an error.
    """
    spark.dataSource.register(ZippedCsv)
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = ", ".join(f"`{f.name}` string" for f in declared)
    rows = spark.read.format("zipped_csv").schema(text).option("header", str(header)).option("paths", "\n".join(paths)).load()
    return rows.select(*(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in declared))


def write_zipped_csv(df: DataFrame, folder: str) -> list[str]:
    """One archive for each partition that has rows, each with one entry and a header; returns the archives' paths.

    Archives are named by task attempt and only those of finished tasks are returned, so what a lost executor
    left behind is not read.
    """
    run = uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zipfile

        from pyarrow import csv, fs

        system, inside = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))
        rows = (b for b in batches if b.num_rows)
        first = next(rows, None)
        if first is None:
            return
        name = f"{run}-{uuid.uuid4().hex}.zip"
        system.create_dir(inside, recursive=True)
        with system.open_output_stream(f"{inside}/{name}") as sink, zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED) as out:
            with out.open("rows.csv", "w", force_zip64=True) as entry:
                # Every text is quoted, so that an empty one is not taken for null.
                with csv.CSVWriter(entry, first.schema, write_options=csv.WriteOptions(quoting_style="all_valid")) as lines:
                    lines.write_batch(first)
                    for batch in rows:
                        lines.write_batch(batch)
        yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"]})

    cells = df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in df.columns))
    return sorted(r["path"] for r in cells.mapInArrow(write, "path string").collect())
