"""Readers for stored tables, delimited text, JSON envelopes, logs and binary files."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.text import locale_decimal
from stratalake.operators.reshape import union_all
from stratalake.sources.scratch import _files


RECORDS_AT_ONCE = 10_000


def read_table(spark: SparkSession, name: str, db: str | None = None) -> DataFrame:
    """A catalog table."""
    return spark.table(f"{db}.{name}" if db else name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


#: First lines read at a time.
_OPENED_AT_ONCE = 32


def _first_line(spark: SparkSession, path: str, encoding: str) -> str | None:
    """The first line of a file, from as many of its bytes as a reader buffers."""
    jvm, (fs, at) = spark._jvm, _files(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(at)
    stream = fs.open(at)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, encoding))
    try:
        return reader.readLine()
    finally:
        reader.close()


def _layouts(spark: SparkSession, paths: str | list[str], sep: str, encoding: str) -> dict[tuple[str, ...], list[str]]:
    """Files by the column names in their first line. Files are listed by Spark and only their beginnings are read."""
    files = [row["path"] for row in spark.read.format("binaryFile").load(paths).select("path").orderBy("path").collect()]  # as Spark's own file list
    with ThreadPoolExecutor(_OPENED_AT_ONCE) as pool:
        lines = list(pool.map(lambda path: _first_line(spark, path, encoding), files))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(files, lines, strict=True):
        if line:
            names = tuple(n.strip().strip('"') for n in line.lstrip("\ufeff").split(sep))
            layouts.setdefault(names, []).append(path)
    return layouts


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    schema: str | T.StructType,
    decimal_comma_columns: Sequence[str] = (),
    sep: str = ";",
    encoding: str = "ISO-8859-1",
    mode: str = "FAILFAST",
) -> DataFrame:
    """Semicolon-separated latin-1 text with a header, whose names say which column is which.

    Files may have their columns in any order; a column that a file lacks is NULL and one that ``schema`` does not
    know is an error. Decimal-comma columns are declared STRING in ``schema`` and turned into doubles here
    (``1.234,5`` is 1234.5). Malformed lines, and under FAILFAST text that is no number, fail the read.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    known = {f.name: f for f in schema.fields}
    parts = []
    for names, files in _layouts(spark, paths, sep, encoding).items():
        if unknown := [n for n in names if n not in known]:
            raise ValueError(f"{files[0]}: columns {unknown} are not in the schema")
        own = T.StructType([known[n] for n in names])
        parts.append(spark.read.csv(files, schema=own, header=True, sep=sep, encoding=encoding, mode=mode))
    df = union_all(parts, allow_missing=True) if parts else spark.createDataFrame([], schema)
    missing = {n: F.lit(None).cast(f.dataType) for n, f in known.items() if n not in df.columns}
    df = df.withColumns(missing).select(list(known))
    return df.withColumns({c: locale_decimal(F.col(c), strict=mode == "FAILFAST") for c in decimal_comma_columns})


def read_envelope(
    spark: SparkSession, paths: str | list[str], row_schema: T.StructType, field: str = "data", multi_line: bool = True
) -> DataFrame:
    """Rows of ``{"metadata": ..., "data": [row, ...]}`` documents, one file or one line each; a broken document fails the read."""
    envelope = T.StructType([T.StructField(field, T.ArrayType(row_schema))])
    docs = spark.read.schema(envelope).json(paths, multiLine=multi_line, mode="FAILFAST")
    return docs.select(F.explode(field).alias("_row")).select("_row.*")


def read_envelope_rejects(
    spark: SparkSession, paths: str | list[str], row_schema: T.StructType, field: str = "data", multi_line: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(rows of whole documents, ``file_path, text`` of broken ones): nothing is lost and nothing fails."""
    envelope = T.StructType([T.StructField(field, T.ArrayType(row_schema)), T.StructField("_broken", T.StringType())])
    docs = spark.read.schema(envelope).json(paths, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord="_broken")
    docs = docs.select(field, "_broken", "_metadata.file_path")
    whole = docs.filter("_broken IS NULL").select(F.explode(field).alias("_row")).select("_row.*")
    # Spark wants a data column to be read along with the broken text.
    read = F.coalesce(F.size(field), F.lit(-1)) >= -1
    return whole, docs.filter(F.col("_broken").isNotNull() & read).select("file_path", F.col("_broken").alias("text"))


def read_log(spark: SparkSession, paths: str | list[str], schema: str | T.StructType, header: bool = True) -> DataFrame:
    """A comma-separated log with one record per line; malformed lines are skipped.

    Lines are parsed whole. A CSV scan would not convert the fields a query leaves
    out, so the same line could be kept or dropped depending on the query.
    A header is the first line of each file, not any line that looks like one.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    wide = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields], "_bad_line string"])
    lines = spark.read.csv(paths, schema="value string", sep="\u0001", quote="", header=header).filter(F.length("value") > 0)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad_line"}
    records = lines.select(F.from_csv("value", wide, options).alias("_record"))
    return records.filter("_record._bad_line IS NULL").select(*[F.col("_record").getField(n).alias(n) for n in schema.fieldNames()])


def read_rejects(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """What ``log_rejects`` wrote, value for value."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def union_tagged(
    frames: Mapping[str, DataFrame] | Iterable[tuple[str, DataFrame]], tag: str, skip_empty: bool = False
) -> DataFrame:
    """Union several loads, each tagged with a constant; columns one load lacks become NULL.

    Several loads may share one tag value, so an iterable of pairs is accepted
    too. With ``skip_empty`` a load without rows is left out, columns included,
    and having no load left is an error; one job finds out for all loads, reading one row of each.
    """
    pairs = list(frames.items() if isinstance(frames, Mapping) else frames)
    if skip_empty and pairs:
        seen = reduce(DataFrame.union, [df.limit(1).select(F.lit(i).alias("i")) for i, (_, df) in enumerate(pairs)])
        filled = {row["i"] for row in seen.collect()}  # one row per load at most
        pairs = [pair for i, pair in enumerate(pairs) if i in filled]
    tagged = [df.withColumn(tag, F.lit(value)) for value, df in pairs]
    if not tagged:
        raise ValueError("no load has data")
    return union_all(tagged, allow_missing=True)


def tag_by_file(df: DataFrame, pattern: str, out: str, group: int = 1) -> DataFrame:
    """Tag rows of a multi-file read from their file path."""
    return df.withColumn(out, F.regexp_extract(F.col("_metadata.file_path"), pattern, group))


def read_binary_records(
    spark: SparkSession,
    path: str,
    parser: Callable[[bytes], Iterable[dict]],
    schema: str | T.StructType,
    glob: str = "*",
) -> DataFrame:
    """Rows parsed out of whole files, such as spreadsheets, one file at a time inside the tasks.

    ``parser`` gets the bytes of one file and yields its rows. Files are spread
    over tasks by the binary file source; rows leave the task ``RECORDS_AT_ONCE`` at a time.
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    names = schema.fieldNames()
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                records = iter(parser(bytes(content)))
                while some := list(islice(records, RECORDS_AT_ONCE)):
                    rows = pd.DataFrame(some, columns=names, dtype=object)
                    for name in texts:
                        rows[name] = [None if value is None else str(value) for value in rows[name]]
                    yield rows

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("content")
    return files.mapInPandas(parse, schema)


def json_line_records(content: bytes) -> Iterator[dict]:
    """A parser for ``read_binary_records``: one JSON object per line."""
    for line in content.splitlines():
        if line.strip():
            yield json.loads(line)
