"""What several operators share: words, stored intermediate tables, ranks without one big task."""

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sinks import stored
from ..storage import scratch_path

# A word: a run of characters other than space and the ASCII controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, as ``--py-files`` does, once per application."""
    context = spark.sparkContext
    if getattr(context, "_martwright_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for path in sorted(package.rglob("*.py")):
            archive.write(path, path.relative_to(package.parent))
    folder = tempfile.mkdtemp(prefix="martwright-code-")
    name = os.path.join(folder, "martwright.zip")
    Path(name).write_bytes(data.getvalue())
    context.addPyFile(name)
    context._martwright_shipped = True


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: it is computed once, and a lost executor
    costs no more than reading a file again."""
    return stored(df, scratch_path(df.sparkSession, label))


def fresh(label: str = "c") -> str:
    """A column name that no caller's table has."""
    return f"__{label}_{uuid.uuid4().hex[:12]}"


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, order: Sequence[Column], label: str, name: str) -> DataFrame:
    """Add the row's place (long, from 0) in the order over all rows.

    No task sees more than its range: rows are range-partitioned and stored, numbered inside each
    part, and each part's start is the sum of the sizes of the parts before it, one row per part.
    """
    part, start = fresh("part"), fresh("start")
    ranges = keep(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), label)
    sizes = ranges.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    # One row per part, so it is broadcast.
    starts = sizes.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return (
        ranges.withColumn(name, place.cast("long"))
        .join(F.broadcast(starts), part)
        .withColumn(name, F.col(name) + F.col(start))
        .drop(part, start)
    )
