"""CSV scans."""

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import presets, schemas
from ..functions import null_if_token, text_or_empty, timestamp_or_null
from ..functions.casts import JAVA_ONLY_NUMBER


def read_text_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None
) -> DataFrame:
    """All fields of a CSV as text, nothing converted yet.

    With ``schema`` its names replace the header by position; without, every file's own
    header names are used, and files with other names than the first are rejected. A quote inside a quoted field is doubled. Records do not span lines, so
    large files split across tasks. Ragged rows raise: column pruning is off because the
    parser could not count the fields of a row it only reads in part.
    """
    reader = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
    )
    if schema is not None:
        return reader.schema(schemas.as_text(schema)).csv(path)
    return _by_header(spark, reader, path)


def _by_header(spark: SparkSession, reader: DataFrameReader, path: str | list[str]) -> DataFrame:
    """Files by the names in their own headers, in the order of the first file. Files with the same
    header are one scan. One job takes the census of all headers, whatever the number of files; after
    it each different header line is read once."""
    by_header: dict[tuple[str, ...], list[str]] = {}
    names_of: dict[str, tuple[str, ...]] = {}
    for file, line in _header_lines(spark, path):
        if line not in names_of:
            names_of[line] = tuple(reader.csv(file).columns)
        by_header.setdefault(names_of[line], []).append(file)
    if not by_header:
        return reader.csv(path)
    first = next(iter(by_header))
    for names, files in by_header.items():
        if sorted(names) != sorted(first):
            raise ValueError(f"{files[0]} has the columns {list(names)}, not {list(first)}")
    frames = [reader.schema(_text_fields(names)).csv(files) for names, files in by_header.items()]
    return reduce(DataFrame.unionByName, frames)


def _header_lines(spark: SparkSession, path: str | list[str]) -> list[tuple[str, str]]:
    """Each file that has one with its first line that is not blank, by path.

    Lines are numbered as a task reads them, and tasks by where in the file they begin. Per file one
    row comes back, as long as a header. Only the first lines of a split can be the first of a file, and
    the minimum combines in the task, so nothing but one row per file and split is shuffled.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
        ).alias("place"),
        F.col("value"),
    )
    first = (
        lines.filter(F.length(F.trim("value")) > 0)
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"))
    )
    # The path as Hadoop spells it; in metadata it is a URL.
    return sorted((_unquoted(row["file"]), row["header"]) for row in first.collect())


def _unquoted(url: str) -> str:
    return unquote(url) if "%" in url else url


def _text_fields(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def typed(df: DataFrame, schema: T.StructType, timestamp_patterns: Sequence[str] = ()) -> DataFrame:
    """Convert text columns to the declared types.

    Text columns keep every value as it is, an empty field being ``''``. In the others the
    null tokens are missing and anything else has to convert, or the job fails and names the
    row's texts.

    Conversion and check are two steps over the whole row. Checking column by column made
    the generated code so long that the JVM ran it uncompiled, at half the speed. The row
    number keeps the optimizer from moving the check below the conversions, which would then
    run twice; and as a filter the check also holds when only some columns are read.
    """
    others = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    if not others:
        return df.select(*(text_or_empty(F.col(name)).alias(name) for name in schema.names))
    numbers = [f for f in others if isinstance(f.dataType, (T.DoubleType, T.FloatType))]

    def raw(field: T.StructField) -> Column:
        return F.col(f"raw {field.name}")

    def convert(field: T.StructField) -> Column:
        text = F.col(field.name)
        if field not in others:
            return text_or_empty(text)
        if isinstance(field.dataType, T.TimestampNTZType):
            return timestamp_or_null(null_if_token(text), timestamp_patterns)
        # A cast that fails costs as much as a hundred that do not, so tokens are not tried.
        value = null_if_token(text).try_cast(field.dataType)
        return F.nullif(value, F.lit(float("nan"))) if field in numbers else value

    converted = df.select(
        *(F.col(f.name).alias(f"raw {f.name}") for f in others),
        *(convert(f).alias(f.name) for f in schema.fields),
        F.monotonically_increasing_id().alias("row number"),
    )
    failed = reduce(
        lambda left, right: left | right,
        (F.col(f.name).isNull() & ~raw(f).isin(*presets.NULL_TOKENS) for f in others),
    )
    if numbers:
        failed = failed | F.rlike(F.concat_ws(" ", *map(raw, numbers)), F.lit(JAVA_ONLY_NUMBER))
    row = F.to_json(F.struct(*(raw(f).alias(f.name) for f in others)))
    report = F.raise_error(F.concat(F.lit("a field does not convert to its declared type: "), row))
    converts = F.when(failed, report).otherwise(F.col("row number") >= 0)
    return converted.filter(converts).select(*schema.names)


def land_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = schemas.SALES,
    timestamp_patterns: Sequence[str] = presets.SALES_DATE_PATTERNS,
) -> DataFrame:
    """A CSV under a fixed positional schema, strictly typed."""
    return typed(read_text_csv(spark, path, schema), schema, timestamp_patterns)
