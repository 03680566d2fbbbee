"""Scans of headerless delimited text, strict by default.

Strict means that a bad row fails the job whichever columns are read, a bare
count included. The checks sit in the scan itself, so there is no second pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType

from ..functions.text import (
    SEP,
    after_sep,
    before_sep,
    finite_number,
    has_one_sep,
    is_blank,
    is_finite,
    number_of,
    number_text,
)
from ..functions.numeric import scaled_integer
from ..schema import MEASUREMENT_NAMES, MEASUREMENT_TYPES, STATION, TEMP, build_schema


def _csv(spark: SparkSession, path, schema, sep: str) -> DataFrame:
    # An explicit schema saves the pass that inference needs. With no quote
    # character a stray quote is ordinary text.
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("quote", "")
        .option("mode", "FAILFAST")
        .csv(path)
    )


def _fail(*message) -> Column:
    return F.raise_error(F.concat_ws(" ", F.lit("bad row:"), *message))


def _number_or_fail(text: Column, well_formed: Column, row: Column) -> Column:
    """The number in ``text``, or a failure that names the file and the row.

    The file name makes the expression non-deterministic for the optimizer. It
    then keeps ``_only_finite`` above the projection, so that a row is parsed
    once and is parsed even if nothing else reads the number.
    """
    return F.coalesce(F.when(well_formed, number_of(text)), _fail(row, F.lit("in"), F.input_file_name()).cast("double"))


def _only_finite(df: DataFrame) -> DataFrame:
    failure = _fail(F.lit("number is not finite for"), F.col(STATION)).cast("boolean")
    return df.filter(F.when(is_finite(F.col(TEMP)), F.lit(True)).otherwise(failure))


def scan_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str] = MEASUREMENT_NAMES,
    types=MEASUREMENT_TYPES,
    sep: str = SEP,
    strict: bool = True,
) -> DataFrame:
    """Typed scan through the CSV reader, for any number of columns.

    Strict, every column is read as text, which makes the reader reject rows with
    too few or too many fields, and is turned into its type after that. A filter on
    the result does not get below that step, so it hides no bad row.
    """
    schema = build_schema(names, types)
    if strict:
        return _typed(_csv(spark, path, build_schema(names), sep), schema, sep)
    df = _csv(spark, path, schema, sep)
    # The reader has no empty text, only NULL.
    texts = [f.name for f in schema if isinstance(f.dataType, StringType)]
    for name in texts:
        df = df.withColumn(name, F.coalesce(F.col(name), F.lit("")))
    return df


def _typed(raw: DataFrame, schema: StructType, sep: str) -> DataFrame:
    """The text columns in their types; fails on what is not of its type.

    A row is one struct, made in one expression that also says which file it came
    from. The optimizer keeps filters above such an expression and cannot leave
    parts of it out, so each row is checked whole.
    """
    names = schema.names
    texts = {n: F.coalesce(F.col(f"`{n}`"), F.lit("")) for n in names}
    good, values = F.lit(True), []
    for field in schema:
        text, kind = texts[field.name], field.dataType
        if isinstance(kind, StringType):
            value = text
        elif isinstance(kind, (DoubleType, FloatType)):
            value = number_of(text).cast(kind)
            good = good & F.coalesce(is_finite(value), F.lit(False))
        else:
            value = text.try_cast(kind)
            good = good & value.isNotNull()
        values.append(value.alias(field.name))
    row = F.concat_ws(sep, *texts.values())
    failure = _fail(row, F.lit("in"), F.input_file_name()).cast("boolean")
    checked = F.when(good, F.lit(True)).otherwise(failure)
    whole = raw.select(F.struct(checked.alias("ok"), F.struct(*values).alias("row")).alias("_checked"))
    return whole.filter("_checked.ok").select("_checked.row.*")


def scan_late_cast(
    spark: SparkSession, path: str | Sequence[str], sep: str = SEP
) -> DataFrame:
    """Every column read as text first, the number parsed afterwards."""
    raw = _csv(spark, path, build_schema(MEASUREMENT_NAMES), sep)
    station = F.coalesce(F.col(STATION), F.lit(""))
    row = F.concat_ws(sep, station, F.col(TEMP))
    # Reads the station too, so that a row with too many fields is seen.
    temp = _number_or_fail(F.col(TEMP), F.octet_length(station) >= 0, row)
    return _only_finite(raw.select(station.alias(STATION), temp.alias(TEMP)))


def parse_lines(lines: DataFrame, sep: str = SEP, strict: bool = True) -> DataFrame:
    """``station, temp`` from a text column ``value``; other columns are kept.

    Works on a batch or a streaming DataFrame.
    Not strict, a bad row keeps its station and has no number.
    """
    line, raw = F.col("value"), F.col("_raw")
    rest = [c for c in lines.columns if c != "value"]
    fields = lines.filter(~is_blank(line, sep)).select(
        "*", before_sep(line, sep).alias(STATION), after_sep(line, sep).alias("_raw")
    )
    well_formed = has_one_sep(line, F.col(STATION), raw, sep)
    if strict:
        temp = _number_or_fail(raw, well_formed, line)
        return _only_finite(fields.select(*rest, STATION, temp.alias(TEMP)))
    temp = F.when(well_formed, finite_number(raw))
    return fields.select(*rest, STATION, temp.alias(TEMP))


def scan_lines(
    spark: SparkSession, path: str | Sequence[str], sep: str = SEP, strict: bool = True
) -> DataFrame:
    """Scan one text line per row. The fastest text scan here: all of it is generated code."""
    return parse_lines(spark.read.text(path), sep, strict)


def reject_reason(line: Column, sep: str = SEP) -> Column:
    """Why a strict scan fails on a line that is not blank; NULL if it does not."""
    raw = after_sep(line, sep)
    return (
        F.when(~line.contains(sep), "no delimiter")
        .when(~has_one_sep(line, before_sep(line, sep), raw, sep), "extra field")
        .when(raw == "", "no value")
        .when(finite_number(raw).isNull(), "not a finite number")
    )


def rejected_lines(lines: DataFrame, sep: str = SEP) -> DataFrame:
    """The rows of a text column ``value`` that a strict scan fails on, and why."""
    line = F.col("value")
    return (
        lines.filter(~is_blank(line, sep))
        .select(line.alias("line"), reject_reason(line, sep).alias("reason"))
        .filter(F.col("reason").isNotNull())
    )


def preview(df: DataFrame, n: int, order_by: str | Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows. Only an order makes the choice repeatable."""
    return (df if order_by is None else df.orderBy(order_by)).limit(n)


def input_bytes(spark: SparkSession, path: str | Sequence[str]) -> int:
    """Size of the input from the file listing; no job runs and no content is read."""
    return int(spark.read.text(path)._jdf.queryExecution().analyzed().stats().sizeInBytes())


_OPEN_BYTES = "spark.sql.files.openCostInBytes"


def _bytes_of(spark: SparkSession, setting: str) -> int:
    """A setting in bytes; it may be written with a unit."""
    text = spark.conf.get(setting).strip().lower().removesuffix("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    shift = units.get(text[-1], 0)
    return int(text.rstrip("kmgt")) << shift


def like_session(spark: SparkSession) -> SparkSession:
    """Another session with the settings of ``spark``, to be changed without changing those."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


def session_for_chunks(spark: SparkSession, path: str | Sequence[str], num_chunks: int) -> SparkSession:
    """A session like ``spark`` whose scans of ``path`` have at least about ``num_chunks`` splits.

    Splits never get larger than they are in ``spark``: of a very large input
    there are more of them than asked for. Small files are packed together.
    """
    if num_chunks < 1:
        raise ValueError("num_chunks must be at least 1")
    session = like_session(spark)
    size = max(1, math.ceil(input_bytes(spark, path) / num_chunks))
    # Spark aims at so many splits, and packs small files together into one.
    session.conf.set("spark.sql.files.minPartitionNum", str(num_chunks))
    # What opening a file counts for keeps splits from getting smaller than that.
    session.conf.set(_OPEN_BYTES, f"{min(size, _bytes_of(spark, _OPEN_BYTES))}b")
    return session


def scan_chunks(
    spark: SparkSession, path: str | Sequence[str], num_chunks: int | None = None, sep: str = SEP
) -> DataFrame:
    """``scan_lines`` with ``chunk``, the part of the input that each row came from.

    A chunk is a struct of ``file`` and ``start``, the byte of the file at which it
    begins. Without ``num_chunks`` a chunk is a whole file, however many tasks read
    it. With it, files are cut to give at least about so many chunks, and every file
    starts a new one. Neither depends on which task reads what, so a chunk is the
    same when a task is run again, when small files are packed together, and for
    any number of executors.
    """
    session = spark if num_chunks is None else session_for_chunks(spark, path, num_chunks)
    start = F.lit(0).cast("bigint") if num_chunks is None else F.col("_metadata.file_block_start")
    chunk = F.struct(F.col("_metadata.file_path").alias("file"), start.alias("start"))
    return parse_lines(session.read.text(path).select(chunk.alias("chunk"), "value"), sep)


def _line(scale: int, sep: str) -> Column:
    """A measurement as a line of text; fails on what would not come back."""
    name, temp = F.col(STATION), F.col(TEMP)
    broken = name.contains(sep) | name.contains("\n") | name.contains("\r")
    good = F.coalesce(~broken & is_finite(temp), F.lit(False))
    text = F.concat(name, F.lit(sep), number_text(temp, scale))
    line = F.when(good & scaled_integer(temp, scale).isNotNull(), text)
    return F.coalesce(line, _fail(F.lit("cannot be written:"), name, temp.cast("string")))


def write_lines(
    df: DataFrame, path: str, scale: int, sep: str = SEP, rows_per_file: int = 0
) -> None:
    """Write ``station;temp`` text, the form the scans read. 0 is no limit to a file.

    Fails on what would not come back: no station, one with a separator or line
    end in it, no number, one that is not finite or has more than ``scale`` decimals.
    """
    df.select(_line(scale, sep).alias("value")).write.option("maxRecordsPerFile", rows_per_file).text(path)


def write_chunk_files(df: DataFrame, path: str, scale: int, chunk: str = "chunk", sep: str = SEP) -> None:
    """``write_lines`` with one file for each value of ``chunk``, in a folder of its own."""
    lines = df.select(F.col(chunk).alias("chunk"), _line(scale, sep).alias("value"))
    lines.repartition("chunk").write.partitionBy("chunk").text(path)
