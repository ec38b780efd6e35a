"""CSV with a header row into declared columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .csv_blocks import read_quoted_csv
from .schemas import TableSpec


class MissingColumns(ValueError):
    """The header lacks columns the table needs."""


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as strings, under the names of the header.

    A doubled quote inside a quoted field stands for a quote. A record with more
    or fewer fields than the header fails the read, which is why every column
    is parsed even if few are used. Only tables with free text need ``multi_line``:
    it keeps newlines inside fields, and reads blocks of a file in parallel.
    """
    df = _read_csv(spark, path, multi_line)
    # The byte order mark is not part of the first column's name.
    names = [name.removeprefix("\ufeff") for name in df.columns]
    return read_quoted_csv(spark, path, names) if multi_line else df.toDF(*names)


def _read_csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """Spark's reader; with ``multi_line`` it reads a file in one task, which is enough for a header."""
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("encoding", "UTF-8")
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .csv(path)
    )


def missing_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    return sorted({spec.header_of(name) for name, _, _ in spec.columns} - set(df.columns))


def require_header(df: DataFrame, spec: TableSpec) -> None:
    missing = missing_columns(df, spec)
    if missing:
        raise MissingColumns(f"{spec.name}: missing column(s) {missing}; found {df.columns}")


def _cast(text, dtype: T.DataType, where: str):
    """``text`` as ``dtype``; a value that does not fit fails, whatever the session's ANSI setting."""
    value = F.nullif(text, F.lit(""))
    if isinstance(dtype, T.StringType):
        return value
    message = F.concat(F.lit(f"{where}: does not fit {dtype.simpleString()}: "), value)
    return F.coalesce(value.try_cast(dtype), F.when(value.isNotNull(), F.raise_error(message).cast(dtype)))


def typed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Pick, reorder, rename and cast the columns; empty fields become NULL.

    A value that does not fit its type fails the load.
    """
    return df.select(*[
        _cast(F.col(spec.header_of(name)), dtype, f"{spec.name}.{name}").alias(name)
        for name, dtype, _ in spec.columns
    ])


def read_table_csv(spark: SparkSession, spec: TableSpec, path: str, multi_line: bool = False) -> DataFrame:
    df = read_text_csv(spark, path, multi_line)
    require_header(df, spec)
    return typed(df, spec)
