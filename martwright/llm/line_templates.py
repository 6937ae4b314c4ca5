"""Line deduplication with a log-template tree of fixed depth.

Every line is parsed down the tree by its number of tokens and its first ``DEPTH`` tokens, tokens with
a digit counting as a variable field. In each leaf that enough documents reach, fields are
generalised: a token stays in the template if enough documents have it at that place of that leaf,
otherwise the place is variable. A line belongs to a template if enough of its places stay constant,
where leading fields with a digit do not count, and enough of all its places are constant words: rows of
different numbers have no template in common.
Templates that recur across enough documents are dropped, all but the first line that shows them.

Only hashes of lines are shuffled at first. Tokens are looked at once per different line, and only
for lines of leaves that recur; a line that a third of all documents hold is one row by then.
"""

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, keep

DEPTH = 3
MIN_DOCUMENTS = 10
SIMILARITY = 0.7
# The share of a line's places that have to be constant and without a digit.
WORDS = 0.5
VARIABLE = "<*>"
# Space and the ASCII controls from tab to carriage return separate tokens; a line ends at "\n".
TOKEN_BLANKS = str.maketrans("\t\x0b\x0c\r", "    ")

LINES = (
    "doc_id long, text_key long, line_no int, leaf long, line long, new_leaf boolean, new_line boolean, "
    "new_text boolean"
)
PLACES = (
    "leaf long, line long, documents long, leading int, length int, place int, token long, word boolean"
)


def tokens_of(line: str) -> list[str]:
    """The tokens of a line, fields with a digit generalised."""
    tokens = [t for t in line.translate(TOKEN_BLANKS).split(" ") if t]
    if any(c in line for c in "0123456789"):
        tokens = [VARIABLE if any(c in t for c in "0123456789") else t for t in tokens]
    return tokens


def signed_hash(text: str) -> int:
    value = xxhash.xxh3_64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


def leaf_of(tokens: list[str]) -> int:
    """The leaf of the tree: the number of tokens, then the leading ones."""
    return signed_hash(" ".join((str(len(tokens)), *tokens[:DEPTH])))


def text_key(id_column: str, text_column: str) -> Column:
    """Tells rows with the same id apart."""
    return F.xxhash64(F.col(text_column))


def _parse(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaf and hash of every line that has a token. ``new_leaf`` and ``new_line`` mark the first of
    a document, so that their sums count documents, and ``new_text`` its first line."""
    for batch in source:
        ids, keys, numbers, leaves, lines, new_leaves, new_lines, new_texts = [], [], [], [], [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))
        for doc_id, key, text in zip(*columns):
            seen_leaves, seen_lines = set(), set()
            for number, line in enumerate((text or "").split("\n")):
                tokens = tokens_of(line)
                if not tokens:
                    continue
                leaf, whole = leaf_of(tokens), signed_hash(" ".join(tokens))
                ids.append(doc_id)
                keys.append(key)
                numbers.append(number)
                leaves.append(leaf)
                lines.append(whole)
                new_leaves.append(leaf not in seen_leaves)
                new_lines.append(whole not in seen_lines)
                new_texts.append(not seen_lines)
                seen_leaves.add(leaf)
                seen_lines.add(whole)
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
        values = (ids, keys, numbers, leaves, lines, new_leaves, new_lines, new_texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(values, kinds)],
            [part.split()[0] for part in LINES.split(", ")],
        )


def _places(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of the wanted lines, one row per place behind the leading ones; a line without
    such a place gives one row with place -1."""
    for batch in source:
        columns = leaves, lines, documents, leading, lengths, places, tokens, words = tuple([] for _ in range(8))
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            split = (text or "").split("\n")
            for want in wanted:
                parts = tokens_of(split[want["line_no"]])
                named = sum(token != VARIABLE for token in parts[:DEPTH])
                for place, token in list(enumerate(parts))[DEPTH:] or [(-1, "")]:
                    leaves.append(want["leaf"])
                    lines.append(want["line"])
                    documents.append(want["documents"])
                    leading.append(named)
                    lengths.append(len(parts))
                    places.append(place)
                    tokens.append(signed_hash(token))
                    words.append(place >= 0 and token != VARIABLE)
                if len(places) > 200_000:
                    yield _place_batch(columns)
                    for column in columns:
                        column.clear()
        yield _place_batch(columns)


def _place_batch(columns: tuple[list, ...]) -> pa.RecordBatch:
    long, short = pa.int64(), pa.int32()
    kinds = [long, long, long, short, short, short, long, pa.bool_()]
    return pa.RecordBatch.from_arrays(
        [pa.array(v, k) for v, k in zip(columns, kinds)],
        [part.split()[0] for part in PLACES.split(", ")],
    )


def recurring_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id, text_key, dropped``: for each document that loses lines their numbers, from 0."""
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        text_key(id_column, text_column).alias("text_key"),
        F.col(text_column).alias("text"),
    )
    lines = _once(keep(rows.mapInArrow(_parse, LINES), "lines"))
    # Aggregates are stored before they are joined with what they come from: only then can the engine
    # split a frequent key of that join.
    leaves = keep(
        lines.groupBy("leaf")
        .agg(F.sum(F.col("new_leaf").cast("long")).alias("documents"))
        .filter(F.col("documents") >= min_documents)
        .select(F.col("leaf").alias("of")),
        "leaves",
    )
    candidates = keep(lines.join(leaves, F.col("leaf") == F.col("of")).drop("of"), "candidates")

    # One document per different line shows its tokens.
    wanted = (
        candidates.filter("new_line")
        .groupBy("leaf", "line")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.min_by(F.struct("doc_id", "text_key", "line_no"), F.struct("doc_id", "text_key")).alias("at"),
        )
        .groupBy("at.doc_id", "at.text_key")
        .agg(F.collect_list(F.struct("at.line_no", "leaf", "line", "documents")).alias("wanted"))
        .select(F.col("doc_id").alias("at_id"), F.col("text_key").alias("at_key"), "wanted")
    )
    shown = rows.join(
        wanted, F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("text_key") == F.col("at_key"))
    )
    places = keep(
        shown.select("text", "wanted").mapInArrow(_places, PLACES)
        # Rows that repeat an id and text show their lines twice.
        .dropDuplicates(["leaf", "line", "place"]),
        "places",
    )
    constant = keep(
        places.groupBy("leaf", "place", "token")
        .agg(F.sum("documents").alias("n"))
        .filter(F.col("n") >= min_documents)
        .select(
            F.col("leaf").alias("c_leaf"), F.col("place").alias("c_place"), F.col("token").alias("c_token")
        ),
        "constants",
    )
    stays = F.col("c_leaf").isNotNull() & (F.col("place") >= 0)
    constants = F.first("leading") + F.sum(F.when(stays, 1).otherwise(0))
    words = F.first("leading") + F.sum(F.when(stays & F.col("word"), 1).otherwise(0))
    template = keep(
        places.join(
            constant,
            (F.col("leaf") == F.col("c_leaf"))
            & (F.col("place") == F.col("c_place"))
            & (F.col("token") == F.col("c_token")),
            "left",
        )
        .groupBy("leaf", "line")
        .agg(
            # The same set of constant places gives the same number, in any order.
            F.bit_xor(F.when(stays, F.xxhash64("place", "token")).otherwise(0)).alias("template"),
            constants.alias("constants"),
            words.alias("words"),
            F.first("length").alias("length"),
        )
        .filter(F.col("constants") >= similarity * F.col("length"))
        .filter(F.col("words") >= WORDS * F.col("length"))
        .select(F.col("leaf").alias("t_leaf"), F.col("line").alias("t_line"), "template"),
        "templates",
    )
    matched = keep(
        candidates.join(
            template, (F.col("leaf") == F.col("t_leaf")) & (F.col("line") == F.col("t_line"))
        ).select("doc_id", "text_key", "line_no", "leaf", "template"),
        "matched",
    )
    in_documents = matched.groupBy("leaf", "template", "doc_id", "text_key").agg(
        F.min("line_no").alias("line_no")
    )
    recurring = keep(
        in_documents.groupBy("leaf", "template")
        .agg(
            F.count(F.lit(1)).alias("documents"),
            F.min(F.struct("doc_id", "text_key", "line_no")).alias("first"),
        )
        .filter(F.col("documents") >= min_documents)
        .select(F.col("leaf").alias("r_leaf"), F.col("template").alias("r_template"), "first"),
        "recurring",
    )
    return (
        matched.join(
            recurring,
            (F.col("leaf") == F.col("r_leaf")) & (F.col("template") == F.col("r_template")),
        )
        .filter(~F.struct("doc_id", "text_key", "line_no").eqNullSafe(F.col("first")))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("line_no").alias("dropped"))
    )


def _once(lines: DataFrame) -> DataFrame:
    """The lines of rows that repeat an id and text, once. Only those rows' lines are compared."""
    own = lines.filter("new_text").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    repeated = keep(
        own.filter("rows > 1").select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key")), "repeated"
    )
    if repeated.isEmpty():
        return lines
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_key") == F.col("of_key"))
    once = lines.join(repeated, same, "left_semi").distinct()
    return keep(lines.join(repeated, same, "left_anti").unionByName(once), "lines")


def _without(texts: pa.Array, dropped: pa.Array) -> pa.Array:
    """Texts without the lines of these numbers; null where there are none."""
    result = []
    for text, numbers in zip(texts.to_pylist(), dropped.to_pylist()):
        if text is None or numbers is None:
            result.append(None)
            continue
        gone = set(numbers)
        result.append("\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone))
    return pa.array(result, pa.string())


def drop_recurring_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    similarity: float = SIMILARITY,
    dropped_column: str | None = None,
) -> DataFrame:
    """All documents with all their columns, their texts without the lines of recurring templates.

    A template recurs if at least ``min_documents`` documents have a line of it; the first such line
    (smallest id, then first in the text) stays. Lines without a token, null texts and documents that
    lose nothing stay as they are. Rows that repeat an id and text lose the same lines and count as
    one document. A document of recurring lines only becomes an empty text. With ``dropped_column``
    the numbers of the dropped lines, from 0, are added.
    """
    lost_id, lost_key, lost = fresh("id"), fresh("key"), fresh("lost")
    found = recurring_lines(docs, id_column, text_column, min_documents, similarity).select(
        F.col("doc_id").alias(lost_id), F.col("text_key").alias(lost_key), F.col("dropped").alias(lost)
    )
    joined = docs.join(
        keep(found, "lost"),
        F.col(id_column).cast("long").eqNullSafe(F.col(lost_id))
        & (text_key(id_column, text_column) == F.col(lost_key)),
        "left",
    )
    # Only texts that lose lines go to Python, and once: a caller's filter on the text would otherwise be
    # moved below and call the function again, with a Python worker of its own in every task.
    without = F.arrow_udf(_without, "string").asNondeterministic()
    left_over = without(F.when(F.col(lost).isNotNull(), F.col(text_column)), F.col(lost))
    text = F.when(F.col(lost).isNull(), F.col(text_column)).otherwise(left_over)
    result = joined.withColumn(text_column, text)
    own = list(docs.columns)
    if dropped_column:
        empty = F.array().cast("array<int>")
        result = result.withColumn(dropped_column, F.coalesce(F.array_sort(F.col(lost)), empty))
        own = [c for c in own if c != dropped_column] + [dropped_column]
    return result.select(*own)
