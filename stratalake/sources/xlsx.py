"""Workbooks as a Spark data source: ``spark.read.format("xlsx")`` and ``df.write.format("xlsx")``."""

from __future__ import annotations

import datetime
import fnmatch
import posixpath
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from stratalake.sources import spreadsheet

#: Rows of an Arrow batch.
BATCH_ROWS = 10_000
#: Rows of the first sheet that column types are inferred from.
INFER_ROWS = 1_000
#: Rows of a written workbook; a task holds as many.
ROWS_PER_FILE = 50_000
#: Columns that a schema may ask for besides those of the sheets.
SHEET, FILE = "_sheet", "_file"
#: Workbooks whose sheets are listed at a time.
_LISTED_AT_ONCE = 16


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def _workbooks(options: dict[str, str]) -> list[str]:
    """The file named by ``path``, or the workbooks below the folder of that name."""
    store, path = _file_system(options["path"])
    info = store.get_file_info(path)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(options["path"])
    if info.is_file:
        return [path]
    glob = options.get("pathglobfilter", "*.xlsx")
    files = [f.path for f in store.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file]
    hidden = lambda f: any(part[:1] in "._" for part in f[len(path) :].strip("/").split("/"))
    return sorted(f for f in files if fnmatch.fnmatch(posixpath.basename(f), glob) and not hidden(f))


def _kind(values: list) -> T.DataType:
    """The narrowest type that holds all values; text if they are of different kinds, or all missing."""
    kinds = {type(v) for v in values if v is not None}
    if kinds == {bool}:
        return T.BooleanType()
    if kinds == {int}:
        return T.LongType()
    if kinds and kinds <= {int, float}:
        return T.DoubleType()
    if kinds == {datetime.date}:
        return T.DateType()
    if kinds and kinds <= {datetime.date, datetime.datetime}:
        return T.TimestampNTZType()
    return T.StringType()


def cell_value(value, kind: T.DataType):
    """A cell's value as one of the Spark type; ValueError if it is none."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return str(value).lower() if isinstance(value, bool) else str(value)
    if isinstance(kind, T.BooleanType):
        if isinstance(value, bool):
            return value
    elif isinstance(kind, T.IntegralType):
        if not isinstance(value, (bool, str)) and isinstance(value, (int, float)) and value == int(value):
            return int(value)
        if isinstance(value, str):
            return int(value)
    elif isinstance(kind, T.FractionalType):
        if isinstance(kind, T.DecimalType):
            try:
                return round(Decimal(str(value)), kind.scale)
            except InvalidOperation:
                raise ValueError(f"{value!r} is no number") from None
        if not isinstance(value, bool) and isinstance(value, (int, float, str)):
            return float(value)
    elif isinstance(kind, T.DateType):
        if isinstance(value, datetime.datetime):
            return value.date()
        if isinstance(value, datetime.date):
            return value
        if isinstance(value, str):
            return datetime.date.fromisoformat(value)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(value, str):
            value = datetime.datetime.fromisoformat(value)
        if isinstance(value, datetime.datetime):
            return value
        if isinstance(value, datetime.date):
            return datetime.datetime.combine(value, datetime.time())
    raise ValueError(f"{value!r} is no {kind.simpleString()}")


@dataclass
class Sheet(InputPartition):
    path: str
    sheet: str | None


class XlsxReader(DataSourceReader):
    """One task per file and sheet; rows leave it in Arrow batches of ``BATCH_ROWS``."""

    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.fields, self.options = schema, options
        self.strict = options.get("mode", "FAILFAST").upper() != "PERMISSIVE"

    def partitions(self) -> Sequence[Sheet]:
        files = _workbooks(self.options)
        wanted = self.options.get("sheets")
        if wanted is None:
            return [Sheet(f, None) for f in files]
        if wanted != "*":
            return [Sheet(f, s.strip()) for f in files for s in wanted.split(",")]
        store, _ = _file_system(self.options["path"])

        def names(path: str) -> list[Sheet]:
            with store.open_input_file(path) as file:
                return [Sheet(path, s) for s in spreadsheet.sheet_names(file)]

        with ThreadPoolExecutor(_LISTED_AT_ONCE) as pool:
            return [sheet for sheets in pool.map(names, files) for sheet in sheets]

    def read(self, partition: Sheet) -> Iterator[pa.RecordBatch]:
        store, _ = _file_system(self.options["path"])
        kinds = to_arrow_schema(self.fields)
        with store.open_input_file(partition.path) as file:
            sheet = spreadsheet.sheet_names(file)[0] if partition.sheet is None else partition.sheet
            file.seek(0)
            rows = enumerate(spreadsheet.cell_rows(file, sheet), start=2)
            while some := list(islice(rows, BATCH_ROWS)):
                places = {name: i for i, name in reversed(some[0][1][0].items())}
                columns = []
                for field, kind in zip(self.fields, kinds, strict=True):
                    if field.name in (SHEET, FILE) and field.name not in places:
                        values = [sheet if field.name == SHEET else partition.path] * len(some)
                    else:
                        values = [self._value(cells.get(places.get(field.name)), field, partition, sheet, n) for n, (_, cells) in some]
                    columns.append(pa.array(values, kind.type))
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    def _value(self, value, field: T.StructField, partition: Sheet, sheet: str, row: int):
        try:
            return cell_value(value, field.dataType)
        except ValueError as error:
            if self.strict:
                raise ValueError(f"{partition.path}, sheet {sheet}, row {row}, column {field.name}: {error}") from None
            return None


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class XlsxWriter(DataSourceWriter):
    """Every task writes workbooks into a folder of its attempt; the driver moves those of successful tasks to their place."""

    def __init__(self, schema: T.StructType, options: dict[str, str], overwrite: bool):
        self.names, self.options, self.overwrite = schema.names, options, overwrite
        self.job = uuid.uuid4().hex
        self.rows_per_file = int(options.get("rowsperfile", ROWS_PER_FILE))
        if not 0 < self.rows_per_file <= spreadsheet.MOST_ROWS:
            raise ValueError(f"rowsPerFile must be from 1 to {spreadsheet.MOST_ROWS}")
        self.sheet_by = options.get("sheetby")
        if self.sheet_by is not None and self.sheet_by not in self.names:
            raise ValueError(f"no column {self.sheet_by} to name sheets by")

    def _folder(self) -> tuple[fs.FileSystem, str, str]:
        store, path = _file_system(self.options["path"].rstrip("/"))
        return store, path, f"{path}/_temporary-{self.job}"

    def write(self, iterator: Iterator) -> Written:
        store, _, temporary = self._folder()
        task = TaskContext.get()
        number, attempt = (task.partitionId(), task.taskAttemptId()) if task else (0, 0)
        own = f"{temporary}/{attempt}"
        store.create_dir(own, recursive=True)
        names = [n for n in self.names if n != self.sheet_by]
        files = []
        while some := list(islice(iterator, self.rows_per_file)):
            sheets: dict[str, list] = {}
            for row in some:
                name = "Sheet1" if self.sheet_by is None else str(row[self.sheet_by])
                sheets.setdefault(name, []).append([row[n] for n in names])
            files.append(f"{own}/part-{number:05d}-{self.job}-{len(files):04d}.xlsx")
            with store.open_output_stream(files[-1]) as out:
                spreadsheet.write_workbook(out, names, dict(sorted(sheets.items())))
        return Written(files)

    def commit(self, messages: list) -> None:
        store, path, temporary = self._folder()
        if self.overwrite:
            for old in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
                if old.is_file and old.path.endswith(".xlsx"):
                    store.delete_file(old.path)
        for message in messages:
            for file in message.files if message else ():
                store.move(file, f"{path}/{posixpath.basename(file)}")
        self._clear(store, temporary)

    def abort(self, messages: list) -> None:
        store, _, temporary = self._folder()
        self._clear(store, temporary)

    @staticmethod
    def _clear(store: fs.FileSystem, folder: str) -> None:
        if store.get_file_info(folder).type != fs.FileType.NotFound:
            store.delete_dir(folder)


class XlsxSource(DataSource):
    """Workbooks with a header in the first row of each sheet.

    Reading: ``path`` names a workbook or a folder of them (``pathGlobFilter``, default ``*.xlsx``); ``sheets`` the sheets by name, separated by commas, or ``*``
    for all (default: the first of each workbook). Without a schema, names and types come from the first ``INFER_ROWS`` rows of the first
    workbook's first wanted sheet. Columns are bound by name: one that a sheet lacks is NULL, and ``_sheet`` and ``_file`` say where a row is from if the schema has them. A cell that is
    no value of its column's type fails the read, or is NULL with ``mode`` PERMISSIVE.

    Writing: workbooks of ``rowsPerFile`` rows at most; with ``sheetBy`` the rows go to sheets named by that column. Files appear when the job has succeeded, so retried
    and speculative tasks leave no rows twice.

    Paths may be of any file system that pyarrow opens.
    """

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _options(self) -> dict[str, str]:
        return {k.lower(): v for k, v in dict(self.options).items()}

    def schema(self) -> T.StructType:
        options = self._options()
        files = _workbooks(options)
        if not files:
            raise ValueError(f"no workbook below {options['path']}")
        store, _ = _file_system(options["path"])
        wanted = options.get("sheets")
        sheet = None if wanted in (None, "*") else wanted.split(",")[0].strip()
        with store.open_input_file(files[0]) as file:
            names = list(dict.fromkeys(spreadsheet.header_of(file, sheet)))
            file.seek(0)
            rows = list(islice(spreadsheet.cell_rows(file, sheet), INFER_ROWS))
        places = {name: i for i, name in reversed(rows[0][0].items())} if rows else {}
        fields = [T.StructField(n, _kind([cells.get(places.get(n)) for _, cells in rows])) for n in names]
        return T.StructType(fields + ([T.StructField(SHEET, T.StringType())] if wanted is not None and SHEET not in names else []))

    def reader(self, schema: T.StructType) -> XlsxReader:
        return XlsxReader(schema, self._options())

    def writer(self, schema: T.StructType, overwrite: bool) -> XlsxWriter:
        return XlsxWriter(schema, self._options(), overwrite)


def read_xlsx(spark: SparkSession, path: str, schema: str | T.StructType | None = None, **options: str) -> DataFrame:
    """Rows of workbooks, see :class:`XlsxSource`."""
    spark.dataSource.register(XlsxSource)
    reader = spark.read.format("xlsx").options(**options)
    return (reader if schema is None else reader.schema(schema)).load(path)


def write_xlsx(df: DataFrame, path: str, mode: str = "append", **options) -> None:
    """Write a frame to workbooks below ``path``, see :class:`XlsxSource`."""
    df.sparkSession.dataSource.register(XlsxSource)
    df.write.format("xlsx").mode(mode).options(**options).save(path)
