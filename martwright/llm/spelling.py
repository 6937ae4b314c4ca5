"""Spelling variants of words by permuterm rotations.

A word is closed by a terminator and rotated so that an edited character would stand last: what comes
before it is then a prefix, and one edit never touches that prefix. Words that differ by a replaced
character share the prefix in front of it; the shorter of two words that differ by an inserted one is
the whole rotation that the longer one has as prefix. So all rotations are dealt and sorted by that
prefix, each range of equal prefixes is scanned once, and every word in it gets its neighbours there
as a number and the most frequent one. A range holds at most one word per character and one shorter
word; no pair of words is written down, and none is met twice.

From a word's most frequent neighbour follows its form, and from the forms, by doubling, its root.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

LETTER = "A-Za-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
# A form is at least so many times as frequent as its variant.
FACTOR = 5
# Closes a word; no word holds it.
TERMINATOR = "\x00"
# Different words that a task counts before it hands them on, and code points looked at once.
COUNTED_WORDS = 500_000
SLICE = 1 << 20


def _pieces(text: str, outside: re.Pattern[str]) -> Iterator[tuple[int, int]]:
    """Bounds of pieces of a text that cut no word."""
    start = 0
    while start < len(text):
        end = min(len(text), start + SLICE)
        if end < len(text):
            gap = outside.search(text, end)
            end = gap.start() if gap else len(text)
        yield start, end
        start = end


def slipped(word: str, doc_id: str, every: int) -> str:
    """The word as a hurried hand would write it: in one of ``every`` documents, by the checksum of id
    and word, one letter is missing."""
    return _slipped(word, zlib.crc32(f"{doc_id}:".encode()), every)


def _slipped(word: str, begun: int, every: int) -> str:
    mark = zlib.crc32(word.encode(), begun)
    if mark % every:
        return word
    at = mark % len(word)
    return word[:at] + word[at + 1 :]


def _counted(min_length: int, slip_every: int | None):
    run = re.compile(f"[{LETTER}]{{{min_length},}}")
    outside = re.compile(f"[^{LETTER}]")

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in source:
            for doc_id, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text"))):
                # Lower case for A-Z only: of bytes, no others change.
                text = (data or b"").lower().decode(errors="replace")
                begun = None if doc_id is None or not slip_every else zlib.crc32(f"{doc_id}:".encode())
                for start, end in _pieces(text, outside):
                    for word, n in Counter(run.findall(text, start, end)).items():
                        if begun is not None:
                            word = _slipped(word, begun, slip_every)
                            if len(word) < min_length:
                                continue
                        counts[word] += n
                    if len(counts) > COUNTED_WORDS:
                        yield batch_of(counts)
                        counts.clear()
        yield batch_of(counts)

    return count


def word_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_length: int = MIN_LENGTH,
    slip_every: int | None = None,
) -> DataFrame:
    """``word, n`` of all words of at least ``min_length`` code points in whole texts.

    A word is a maximal run of letters A-Z, a-z and U+00C0 to U+00FF, of which only A-Z become lower
    case. A null text has none; rows that repeat an id count each. With ``slip_every`` a word loses a
    letter in one of so many documents (``slipped``), which gives variants of known origin; rows
    without an id have no slips.
    """
    texts = docs.select(
        F.col(id_column).cast("string").alias("doc_id"), F.col(text_column).cast("binary").alias("text")
    )
    found = texts.mapInArrow(_counted(min_length, slip_every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """``prefix, word, n, whole, first`` of a table ``word, n``.

    The prefix is a rotation up to a skipped last character or, with ``whole``, all of it. ``first``
    tells whether the skipped character is the first of its run: deleting any other of the run gives
    the same shorter word, which should be met once.
    """
    at = F.col("at")
    length = F.length("word")
    skipped = F.substring("word", at, F.lit(1))
    before = F.substring("word", F.lit(1), at - 1)
    mark = F.lit(TERMINATOR)
    placed = words.withColumn("at", F.explode(F.sequence(F.lit(1), length + 1)))
    whole = placed.select(
        F.concat(F.substring("word", at, length), mark, before).alias("prefix"),
        "word", "n", F.lit(True).alias("whole"), F.lit(False).alias("first"),
    )
    part = placed.filter(at <= length).select(
        F.concat(F.substring("word", at + 1, length), mark, before).alias("prefix"),
        "word", "n", F.lit(False).alias("whole"),
        ((at == 1) | (skipped != F.substring("word", at - 1, F.lit(1)))).alias("first"),
    )
    return whole.unionByName(part)


def _better(a: Column, b: Column) -> Column:
    """Of two ``(-n, word)`` the one that comes first; null counts as none."""
    return F.when(a.isNull() | (b < a), b).otherwise(a)


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best``: for each word that has any, the number of words one inserted,
    deleted or replaced code point away, and the most frequent of them (ties: smallest in code point
    order). ``words`` has each word once."""
    scan = (
        Window.partitionBy("prefix")
        .orderBy(F.desc("n"), "word")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    own = F.struct((-F.col("n")).alias("less"), F.col("word").alias("near"))
    part = F.when(~F.col("whole"), own)
    leading = F.when(~F.col("whole") & F.col("first"), own)
    met = (
        rotations(words)
        .select(
            "*",
            F.count(F.lit(1)).over(scan).alias("met"),
            F.count(part).over(scan).alias("parts"),
            F.count(leading).over(scan).alias("leading"),
            F.first(part, True).over(scan).alias("best_part"),
            F.nth_value(part, 2, True).over(scan).alias("next_part"),
            F.first(leading, True).over(scan).alias("best_leading"),
            F.first(F.when(F.col("whole"), own), True).over(scan).alias("shorter"),
        )
        .filter("met > 1")
    )
    shorter = F.when(F.col("first"), F.col("shorter"))
    other = F.when(F.col("best_part.near") == F.col("word"), F.col("next_part")).otherwise(F.col("best_part"))
    return (
        met.select(
            "word",
            F.when(F.col("whole"), F.col("leading"))
            .otherwise(F.col("parts") - 1 + shorter.isNotNull().cast("long"))
            .alias("n_near"),
            F.when(F.col("whole"), F.col("best_leading")).otherwise(_better(other, shorter)).alias("best"),
        )
        .filter("n_near > 0")
        .groupBy("word")
        .agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
        .select("word", "n_near", (-F.col("best.less")).alias("best_n"), F.col("best.near").alias("best"))
    )


def _roots(forms: DataFrame) -> DataFrame:
    """``of, root`` of a table ``word, form``: forms followed to the last. Every form is more frequent
    than its word, so chains are short, end, and halve in every round."""
    links = forms.select(F.col("word").alias("of"), F.col("form").alias("root"))
    while True:
        ahead = links.select(F.col("of").alias("next"), F.col("root").alias("beyond"))
        stepped = keep(links.join(ahead, F.col("root") == F.col("next"), "left"), "roots")
        links = stepped.select("of", F.coalesce("beyond", "root").alias("root"))
        if stepped.filter("next is not null").isEmpty():
            return links


def spelling_variants(
    counts: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    factor: int = FACTOR,
    word_column: str = "word",
    count_column: str = "n",
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of counted words.

    Words of fewer than ``min_length`` code points or less than ``min_count`` occurrences take no
    part; counts of a repeated word are added, a null word or one with a U+0000 is left out. A word's
    form is its most frequent neighbour (``neighbours``) if that is at least ``factor`` times (2 or more)
    as frequent, else null; its root is the last form that can be reached, or the word itself. An empty
    table gives an empty result.
    """
    if factor < 2:
        raise ValueError("a form has to be more frequent than its word")
    word, n = F.col(word_column).cast("string"), F.col(count_column).cast("long")
    words = keep(
        counts.select(word.alias("word"), n.alias("n"))
        .filter((F.length("word") >= max(1, min_length)) & ~F.contains("word", F.lit(TERMINATOR)))
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= max(1, min_count)),
        "words",
    )
    near = neighbours(words).withColumnRenamed("word", "of")
    is_form = F.col("best_n") >= F.lit(factor) * F.col("n")
    forms = keep(
        words.join(near, F.col("word") == F.col("of"), "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(forms.filter(F.col("form").isNotNull()))
    return forms.join(roots, F.col("word") == F.col("of"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )
