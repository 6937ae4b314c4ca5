"""Harmonic packing of documents into sequences of a fixed capacity.

A piece belongs to the reciprocal class k when k pieces like it fill a sequence: its length is at
most capacity / k. Every sequence of class k takes exactly k pieces, so a worker fills its sequences
without knowing of any other: it keeps one open sequence per class and emits it when it is full. What
long pieces would leave empty is avoided by cutting: a document gives full sequences first, and the
rest is cut to exact reciprocals of the capacity while it is at least capacity / 16; only the last,
small piece keeps its own length.

Sequences that stay open when a worker's input ends are filled with those of other workers, 64
workers at a time, then 64 such groups at a time, until one group is left. At most one open sequence
per class then remains in the whole corpus; those few pieces are packed first fit.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep
from .tokens import batches, default_path

CAPACITY = 2048
END_ID = 1
# Rests of at least capacity / CUT_BELOW are cut to reciprocals, smaller ones stay whole.
CUT_BELOW = 16
# Up to here every class is used, above only some, each a sixteenth larger than the one before.
FINE_CLASSES = 64
FAN_IN_BITS = 6

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "per int, worker int, sequence_id long, offset long"
)


def class_sizes(capacity: int) -> list[int]:
    """The numbers of pieces per sequence that are used, ascending."""
    sizes = list(range(1, min(FINE_CLASSES, capacity) + 1))
    while sizes[-1] < capacity:
        sizes.append(min(capacity, sizes[-1] + max(1, sizes[-1] // 16)))
    return sizes


def cuts(tokens: int, capacity: int, classes: np.ndarray) -> list[tuple[int, int]]:
    """(length, class) of a document's pieces, in order."""
    pieces = [(capacity, 1)] * (tokens // capacity)
    rest = tokens % capacity
    while rest:
        k = capacity // rest
        if k >= CUT_BELOW:
            pieces.append((rest, int(classes[np.searchsorted(classes, k, side="right") - 1])))
            break
        if rest != capacity // k:
            k += 1
        pieces.append((capacity // k, k))
        rest -= capacity // k
    return pieces


def sequence_base(level: int, group: int) -> int:
    """Ids of sequences: four bits of level, 24 of worker or group, 34 of the sequence's number."""
    return (level << 58) | (group << 34)


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document's ids are those of its whole text, then an end id. A null text is empty and gives the
    end id alone. Repeated rows are packed once each; a null id is carried along. An empty table
    gives an empty result.
    """
    path = tokenizer or default_path()

    def fill(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = TaskContext.get().partitionId()
        classes = np.array(class_sizes(capacity))
        known: dict[int, list[tuple[int, int]]] = {}
        open_rows: dict[int, list[tuple]] = {}
        open_used: dict[int, int] = {}
        number = sequence_base(0, worker)
        for batch, (offsets, ids) in batches(path, source, "text"):
            names = batch.column("doc_id").to_pylist()
            out: list[tuple] = []
            for i, doc_id in enumerate(names):
                own = np.append(ids[offsets[i] : offsets[i + 1]], np.uint32(END_ID)).astype("<u4")
                n = len(own)
                if n % capacity not in known:
                    known[n % capacity] = cuts(n % capacity, capacity, classes)
                data, start = own.data.cast("B"), 0
                for length, per in [(capacity, 1)] * (n // capacity) + known[n % capacity]:
                    crc = zlib.crc32(data[4 * start : 4 * (start + length)])
                    used = open_used.get(per, 0)
                    rows = open_rows.setdefault(per, [])
                    rows.append((doc_id, start, length, crc, n, per, worker, None, used))
                    open_used[per] = used + length
                    start += length
                    if len(rows) == per:
                        out += [(*row[:7], number, row[8]) for row in rows]
                        number += 1
                        open_rows[per], open_used[per] = [], 0
            if out:
                yield _batch(out)
        left = [(*row[:7], None, None) for rows in open_rows.values() for row in rows]
        if left:
            yield _batch(left)

    pieces = keep(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
        ).mapInArrow(fill, PIECES),
        "pieces",
    )
    done = [pieces.filter(F.col("sequence_id").isNotNull())]
    left = pieces.filter(F.col("sequence_id").isNull())
    workers = left.agg(F.max("worker")).first()[0] or 0
    level = 0
    while True:
        level += 1
        filled = keep(_fill_level(left, level), "pieces")
        done.append(filled.filter(F.col("sequence_id").isNotNull()))
        left = filled.filter(F.col("sequence_id").isNull())
        if workers >> (FAN_IN_BITS * level) == 0:
            break
    done.append(_first_fit(left, capacity, level + 1))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()] * 2
    names = [part.split()[0] for part in PIECES.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names
    )


def _fill_level(left: DataFrame, level: int) -> DataFrame:
    """Fill sequences with the open pieces of 64 workers, or groups of workers. A group holds fewer
    than 64 open sequences of a class, so the windows are small."""
    group = F.expr(f"worker >> {FAN_IN_BITS * level}")
    rows = left.withColumn("group", group)
    window = Window.partitionBy("group", "per")
    place = F.row_number().over(window.orderBy("doc_id", "start", "ids_crc32", "worker")) - 1
    rows = rows.withColumn("place", place).withColumn("rows", F.count(F.lit(1)).over(window))
    rows = rows.withColumn("bin", F.expr("place div per"))
    full = F.col("bin") < F.expr("rows div per")
    inside = (
        Window.partitionBy("group", "per", "bin")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn("upto", F.sum("length").over(inside))
    # A level's sequences are numbered by class and place, which is unique inside their group.
    number = F.col("per").cast("long") * (1 << 22) + F.col("bin")
    base = F.expr(f"shiftleft(cast({level} as bigint), 58)") + F.expr(
        "shiftleft(cast(group as bigint), 34)"
    )
    return rows.select(
        *(c for c in left.columns if c not in ("sequence_id", "offset")),
        F.when(full, base + number).alias("sequence_id"),
        F.when(full, F.col("upto") - F.col("length")).alias("offset"),
    )


def _first_fit(left: DataFrame, capacity: int, level: int) -> DataFrame:
    """The landing: fewer than k pieces of each class k, whatever the corpus, longest first."""
    base = sequence_base(level, 0)

    def place(table: pa.Table) -> pa.Table:
        keys = [(c, "descending" if c == "length" else "ascending") for c in ("length", "doc_id", "start", "ids_crc32")]
        table = table.drop_columns("all").sort_by(keys)
        used: list[int] = []
        sequence, offset = [], []
        for length in table.column("length").to_pylist():
            at = next((i for i, u in enumerate(used) if u + length <= capacity), len(used))
            if at == len(used):
                used.append(0)
            sequence.append(base + at)
            offset.append(used[at])
            used[at] += length
        for name, values in (("sequence_id", sequence), ("offset", offset)):
            at = table.schema.get_field_index(name)
            table = table.set_column(at, name, pa.array(values, pa.int64()))
        return table

    return left.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(place, PIECES)
