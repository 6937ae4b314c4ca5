"""Writers. Each replaces its target as a whole."""

import json
import math
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import month_of
from .presets import CLUSTER_COLUMNS, MONTH_COLUMN
from .sources import read_parquet, read_table

# Sales rows of about 100 bytes, compressed: files of 100 MB.
ROWS_PER_FILE = 1_000_000
# Files of full size that months which share a task have together, in expectation.
FILES_PER_TASK = 4
# And their rows: a task sorts what it writes, and a million wide rows (half a GB) fit its memory, while
# several million are spilled.
ROWS_PER_TASK = 1_000_000
# Keys that decide where large months are cut.
SKETCH_KEYS = 100_000
# Rows that a task holds, in bytes, before it sends them on in packs.
PACKED_BYTES = 64_000_000
# Columns that a pack returns as they were. Tables with others are shuffled row by row.
PACKED_TYPES = (
    T.BooleanType(), T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(),
    T.StringType(), T.BinaryType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(),
)
# The setting by which a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# The view that says which of two sets of files a database shows.
POINTER = "published_tables"


def fresh_name(label: str) -> str:
    """A column name that no caller's table has."""
    return f"{label}_{uuid.uuid4().hex}"


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files. They would stay on the executors' disks until the driver
    happens to collect its garbage, though nothing reads them again: later steps read the written files."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def write_parquet(df: DataFrame, path: str) -> None:
    with without_leftovers(df.sparkSession):
        df.write.mode("overwrite").parquet(path)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and return the written files as a frame. This cuts the lineage: later
    steps and retries read the files instead of computing the frame again."""
    write_parquet(df, path)
    return read_parquet(df.sparkSession, path, df.schema)


def write_by_month(
    df: DataFrame,
    path: str,
    time_column: str = "sale_date",
    cluster_columns: Sequence[str] = CLUSTER_COLUMNS,
    month_column: str = MONTH_COLUMN,
    last_keys: Sequence[str] = ("invoice_item_number",),
    rows_per_file: int = ROWS_PER_FILE,
    tasks: int | None = None,
) -> None:
    """Parquet partitioned by month and clustered by ``cluster_columns`` across a month's files.

    A month of up to ``rows_per_file`` rows is one file. A larger one is cut into ranges of its cluster
    columns and ``last_keys`` of about that size, so a value of the first cluster column lies in few
    neighbouring files of its month, and the others' statistics skip them; each file is sorted alike.
    ``last_keys`` should be nearly unique: they let a range end inside a frequent county and category.

    A range is written by a task of its own. Neighbouring months that are one file each share tasks: ``tasks`` of
    them, by default as many as the cluster runs at once, and as many more as keep a task at a few files
    and at about ``ROWS_PER_TASK`` rows. The
    layout is decided from the number of rows of each month and, for months that are cut, from a sample of
    at most about ``SKETCH_KEYS`` of their keys: two passes that read no other columns. Rows that are
    equal in all keys stay together, and more of them than two files should hold are several files.

    Every row travels once, to its task. A task sends what it has for another one column by column, in packs of
    compressed Parquet, which are about a quarter of the same rows one by one.
    """
    layout = df.withColumn(month_column, month_of(F.col(time_column)))
    keys = [*cluster_columns, *last_keys]
    target = fresh_name("task")
    with without_leftovers(df.sparkSession):
        pieces = _pieces(layout, month_column, keys, rows_per_file)
        dealt, count = _dealt(pieces, rows_per_file, tasks or df.sparkSession.sparkContext.defaultParallelism)
        (
            _gathered(_placed(layout, month_column, keys, dealt, target), target, count)
            .sortWithinPartitions(month_column, *keys)
            .write.mode("overwrite")
            .option("maxRecordsPerFile", 2 * rows_per_file)
            .partitionBy(month_column)
            .parquet(path)
        )


# A month, the keys that its pieces but the first begin with, and the pieces' rows.
Piece = tuple[object, list[tuple], list[float]]


def _pieces(layout: DataFrame, month: str, keys: Sequence[str], rows_per_file: int) -> list[Piece]:
    """The files every month should have, in order."""
    # One row per month.
    found = layout.groupBy(month).agg(F.count(F.lit(1)).alias("n")).orderBy(month).collect()
    counts = [(row[0], row[1]) for row in found]
    large = {value: n for value, n in counts if n > rows_per_file}
    samples: dict[object, list[tuple]] = {value: [] for value in large}
    if large and keys:
        is_large = F.col(month).isin([v for v in large if v is not None])
        if None in large:
            is_large = is_large | F.col(month).isNull()
        share = min(1.0, SKETCH_KEYS / sum(large.values()))
        sketch = layout.filter(is_large).select(month, *keys)
        if share < 1:
            sketch = sketch.sample(share, seed=1)
        for row in sketch.orderBy(month, *keys).collect():
            samples[row[0]].append(tuple(row[1:]))
    result = []
    for value, n in counts:
        own = samples.get(value, [])
        first_at: dict[tuple, int] = {}
        for i, key in enumerate(own):
            first_at.setdefault(key, i)
        # A range that a handful of samples bounds would be of any size.
        wanted = min(math.ceil(n / rows_per_file), max(1, len(own) if len(own) == n else len(own) // 16))
        starts = []
        for i in range(1, wanted):
            start = own[i * len(own) // wanted]
            if start != own[0] and (not starts or start != starts[-1]):
                starts.append(start)
        at = [0, *(first_at[start] for start in starts), len(own)] if starts else [0, 1]
        result.append((value, starts, [n * (b - a) / at[-1] for a, b in zip(at, at[1:])]))
    return result


def _dealt(pieces: list[Piece], rows_per_file: int, parallel: int) -> tuple[list[tuple], int]:
    """Each month with its pieces' first keys and tasks, which have the numbers from 0 without gaps."""
    whole = sum(sizes[0] for _, _, sizes in pieces if len(sizes) == 1)
    turns = max(parallel, math.ceil(whole / min(FILES_PER_TASK * rows_per_file, ROWS_PER_TASK)))
    before, last, number, dealt = 0.0, None, -1, []
    for value, starts, sizes in pieces:
        if len(sizes) > 1:
            own = list(range(number + 1, number + 1 + len(sizes)))
            number, last = own[-1], None
        else:
            # The middle of a month decides, so that a large one does not drag others along.
            turn = int((before + sizes[0] / 2) * turns / whole)
            if turn != last:
                last, number = turn, number + 1
            own = [number]
            before += sizes[0]
        dealt.append((value, starts, own))
    return dealt, max(1, number + 1)


def _placed(
    layout: DataFrame, month: str, keys: Sequence[str], dealt: list[tuple], target: str
) -> DataFrame:
    """Add the number of the task that writes a row. The table of months that is broadcast has one row
    each and no more keys than the sketch."""
    if not dealt:
        return layout.withColumn(target, F.lit(0))
    value, starts, tasks = (fresh_name(n) for n in ("month", "starts", "tasks"))
    kinds = {f.name: f.dataType for f in layout.schema.fields}
    key = T.StructType([T.StructField(f"k{i}", kinds[name]) for i, name in enumerate(keys)])
    schema = T.StructType(
        [
            T.StructField(value, kinds[month]),
            T.StructField(starts, T.ArrayType(key)),
            T.StructField(tasks, T.ArrayType(T.IntegerType())),
        ]
    )
    months = F.broadcast(layout.sparkSession.createDataFrame(dealt, schema))
    joined = layout.join(months, F.col(month).eqNullSafe(F.col(value)))
    if any(firsts for _, firsts, _ in dealt):
        own = F.struct(*(F.col(name).alias(f"k{i}") for i, name in enumerate(keys)))
        piece = _number_at_most(F.col(starts), own, max(len(firsts) for _, firsts, _ in dealt))
    else:
        piece = F.lit(0)
    task = F.element_at(F.col(tasks), piece + 1)
    return joined.withColumn(target, task).drop(value, starts, tasks)


def _gathered(placed: DataFrame, target: str, count: int) -> DataFrame:
    """The rows of each target in the partition of that number, without the target."""
    rows = placed.drop(target)
    kinds = [f.dataType for f in rows.schema.fields]
    if not all(kind in PACKED_TYPES or isinstance(kind, T.DecimalType) for kind in kinds):
        return placed.repartitionById(count, F.col(target)).drop(target)
    # A function over batches takes plain column names only.
    plain = [target if name == target else f"column {i}" for i, name in enumerate(placed.columns)]
    packs = placed.toDF(*plain).mapInArrow(_packing(target, PACKED_BYTES), f"`{target}` int, pack binary")
    return (
        packs.repartitionById(count, F.col(target)).select("pack").mapInArrow(_unpacking(rows.columns), rows.schema)
    )


# Functions within functions travel to the workers whole, whatever is installed there besides Spark and Arrow.
def _packing(target: str, most_bytes: int):
    def packs_of(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        table = table.take(pc.sort_indices(table[target])).combine_chunks()
        runs = pc.run_end_encode(table[target].combine_chunks())
        rows, begin, packs = table.drop_columns([target]), 0, []
        for end in runs.run_ends.to_pylist():
            sink = pa.BufferOutputStream()
            pq.write_table(rows.slice(begin, end - begin), sink, compression="zstd", write_statistics=False)
            packs.append(sink.getvalue().to_pybytes())
            begin = end
        return pa.record_batch([runs.values, pa.array(packs, pa.binary())], ["target", "pack"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= most_bytes:
                yield packs_of(held)
                held, size = [], 0
        if size:
            yield packs_of(held)

    return pack


def _unpacking(names: list[str]):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.column(0):
                file = pq.ParquetFile(pa.BufferReader(pack.as_buffer()))
                for rows in file.iter_batches(10_000, use_threads=False):
                    yield rows.rename_columns(names)

    return unpack


def _number_at_most(ascending: Column, own: Column, most: int) -> Column:
    """How many elements of an ascending array are at most ``own``, by bisection."""
    steps = F.sequence(F.lit(1), F.lit(most.bit_length()))

    def halve(bounds: Column, _: Column) -> Column:
        middle = F.floor((bounds["low"] + bounds["high"]) / 2).cast("int")
        at_most = F.get(ascending, middle) <= own
        return F.when(bounds["low"] >= bounds["high"], bounds).otherwise(
            F.struct(
                F.when(at_most, middle + 1).otherwise(bounds["low"]).alias("low"),
                F.when(at_most, bounds["high"]).otherwise(middle).alias("high"),
            )
        )

    bounds = F.struct(F.lit(0).alias("low"), F.size(ascending).alias("high"))
    return F.aggregate(steps, bounds, halve, lambda found: found["low"])


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create or replace a Parquet table in the session catalog.

    ``path`` keeps the files outside the warehouse folder. Spark refuses to replace a
    table that the same query reads.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def publish_view(spark: SparkSession, name: str, path: str) -> None:
    """Point a catalog name at finished Parquet files. The switch is one catalog change: a
    reader sees the old files or the new ones, and nothing is copied."""
    spark.sql(
        f"CREATE OR REPLACE VIEW IDENTIFIER(:name) AS SELECT * FROM {_files(path)}",
        args={"name": name},
    )


def publish_views(spark: SparkSession, database: str, paths: dict[str, str], pointer: str = POINTER) -> None:
    """Point several names of a database at finished Parquet files, all of them in one step.

    The names are views over two sets of files, the published and the next one, and show the set that
    a further view, ``pointer``, names. First all of them get the next set beside the one they show,
    which changes nothing for readers; then the pointer is replaced, which is one catalog change. Dying
    anywhere leaves all names on the old files or all on the new ones, and it can be repeated. The
    choice is a constant when a query is planned: a reader scans one set. Old files have to stay until
    the names are published again or ``settle_views`` is called.

    A table keeps its columns from one set to the next; other columns are refused before any change.
    Names that were single views before become empty until the step, once. One publisher at a time.
    """
    now = published(spark, database, pointer)
    turn = 0
    if now:
        turn = now["turn"] + 1
        for name, path in paths.items():
            if name in now["paths"]:
                new, old = (read_parquet(spark, p).schema.names for p in (path, now["paths"][name]))
                if new != old:
                    raise ValueError(f"{name} has the columns {new}; the published ones are {old}")
    else:
        _point(spark, database, pointer, {"turn": -1, "paths": {}})
        turn = 0
    for name, path in paths.items():
        sets = [(turn, path)]
        if now and name in now["paths"]:
            sets.append((now["turn"], now["paths"][name]))
        _show(spark, database, pointer, name, sets)
    # Names that this set does not have keep their files.
    kept = {**(now["paths"] if now else {}), **paths}
    for name in kept.keys() - paths.keys():
        _show(spark, database, pointer, name, [(turn, kept[name]), (now["turn"], kept[name])])
    _point(spark, database, pointer, {"turn": turn, "paths": kept})


def settle_views(spark: SparkSession, database: str, pointer: str = POINTER) -> None:
    """Let the published names forget the set before, so that its files may go."""
    now = published(spark, database, pointer)
    for name, path in (now["paths"] if now else {}).items():
        _show(spark, database, pointer, name, [(now["turn"], path)])


def published(spark: SparkSession, database: str, pointer: str = POINTER) -> dict | None:
    """``turn`` and ``paths`` of what a database shows; None if nothing was published yet."""
    if not spark.catalog.tableExists(f"{_quoted(database)}.{_quoted(pointer)}"):
        return None
    found = json.loads(read_table(spark, f"{_quoted(database)}.{_quoted(pointer)}").first()["paths"])
    return found if found["turn"] >= 0 else None


def _point(spark: SparkSession, database: str, pointer: str, to: dict) -> None:
    spark.sql(
        "CREATE OR REPLACE VIEW IDENTIFIER(:name) AS "
        f"SELECT {to['turn']} AS turn, {_literal(json.dumps(to))} AS paths",
        args={"name": f"{_quoted(database)}.{_quoted(pointer)}"},
    )


def _show(
    spark: SparkSession, database: str, pointer: str, name: str, sets: list[tuple[int, str]]
) -> None:
    chosen = f"(SELECT turn FROM {_quoted(database)}.{_quoted(pointer)})"
    body = " UNION ALL ".join(
        f"SELECT * FROM {_files(path)} WHERE {chosen} = {turn}" for turn, path in sets
    )
    spark.sql(
        f"CREATE OR REPLACE VIEW IDENTIFIER(:name) AS {body}",
        args={"name": f"{_quoted(database)}.{_quoted(name)}"},
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _files(path: str) -> str:
    return f"parquet.{_quoted(path)}"
