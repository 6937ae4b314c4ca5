"""Quality rules as a learned decision list over statistics of the text.

Sequential covering learns one rule at a time: a conjunction of thresholds grows, by the gain of
information, on two thirds of the labelled rows that no earlier rule covers, until it covers no good
one; on the other third its last conditions are dropped again as long as that does not make it worse.
What the rule covers is put aside, and the next one is learnt from the rest, until none is precise
enough. Rules that the finished list can do without go at the end. The list is small enough to read,
and is applied as one ordered conditional expression of Spark.
"""

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, fresh, keep
from .quality import held_out

SYMBOLS = b"#*$%&|<>"
# A text fails before any rule with fewer words, or a larger percentage of words in repeated windows.
MIN_WORDS = 50
MOST_REPEATED = 50
WINDOW = 3
# The bound of the training sample, in documents per label.
SAMPLE_DOCUMENTS = 4000
# A rule has to be right on this share of the rows it was not grown on, and on so many bad ones.
MIN_PRECISION = 0.95
MIN_COVERED = 5

STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_upper", "n_digits", "n_shouts", "n_stops",
)

# Bytes looked at once, and different words that a task remembers between texts.
SLICE = 1 << 20
KNOWN_WORDS = 1 << 20
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_BLANKS = BLANKS.encode()


class Condition(NamedTuple):
    """``feature`` is at least the threshold or, without ``at_least``, below it."""

    feature: str
    at_least: bool
    threshold: float


Rule = tuple[Condition, ...]


def features(statistics: str) -> dict[str, Column]:
    """What conditions look at, as columns over a struct of statistics. Nothing is divided by 0."""

    def of(name: str) -> Column:
        return F.col(f"{statistics}.{name}").cast("double")

    def each(name: str, base: str) -> Column:
        return of(name) / F.greatest(of(base), F.lit(1.0))

    return {
        "words": of("n_words"),
        "characters_per_word": each("word_chars", "n_words"),
        "symbols_per_word": each("n_symbols", "n_words"),
        "repeated_line_share": each("n_dup_lines", "n_lines"),
        "repeated_word_share": each("n_repeat_words", "n_words"),
        "distinct_word_share": each("n_distinct_words", "n_words"),
        "words_per_line": each("n_words", "n_lines"),
        "capital_share": each("n_upper", "word_chars"),
        "digit_share": each("n_digits", "word_chars"),
        "shouts_per_word": each("n_shouts", "n_words"),
        "stops_per_word": each("n_stops", "n_words"),
    }


def _byte_counts(data: bytes) -> np.ndarray:
    every, total = np.frombuffer(data, np.uint8), np.zeros(256, np.int64)
    for k in range(0, len(every), SLICE):
        total += np.bincount(every[k : k + SLICE], minlength=256)
    return total


def _word_numbers(data: bytes, known: dict[bytes, int]) -> np.ndarray:
    """The words of a text as numbers, the same for equal words; long texts piece by piece."""
    parts, start = [], 0
    while start < len(data):
        blank = _BLANK.search(data, start + SLICE)
        end = blank.start() if blank else len(data)
        words = _WORD.findall(data, start, end)
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        start = end
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _repeated_words(numbers: np.ndarray) -> int:
    """Words in windows of three that occur twice or more."""
    if len(numbers) <= WINDOW:
        return 0
    windows = numbers[: len(numbers) - WINDOW + 1]
    base = int(numbers.max()) + 1
    for j in range(1, WINDOW):
        if (int(windows.max()) + 1) * base >= 1 << 62:
            # As ranks, pairs are as few as the text has words.
            windows = np.unique(windows, return_inverse=True)[1]
        windows = windows * base + numbers[j : len(numbers) - WINDOW + 1 + j]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    found = np.zeros(len(windows), bool)
    found[order[1:][same]] = found[order[:-1][same]] = True
    covered = np.zeros(len(numbers), bool)
    for j in range(WINDOW):
        covered[j : j + len(found)] |= found
    return int(covered.sum())


def statistics_of(data: bytes, known: dict[bytes, int]) -> tuple[int, ...]:
    """The ``STATISTICS`` of one text in UTF-8."""
    at = _byte_counts(data)
    numbers = _word_numbers(data, known)
    lines = [line for line in data.split(b"\n") if line.strip(_BLANKS)]
    points = len(data) - at[128:192].sum()
    return (
        len(numbers),
        int(points - at[32] - at[9:14].sum()),
        int(at[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        _repeated_words(numbers),
        len(lines),
        len(np.unique(numbers)),
        int(at[ord("A") : ord("Z") + 1].sum()),
        int(at[ord("0") : ord("9") + 1].sum()),
        int(at[list(b"!?")].sum()),
        int(at[list(b".,;:")].sum()),
    )


def with_statistics(docs: DataFrame, name: str, text_column: str = "text") -> DataFrame:
    """Add a struct of the ``STATISTICS`` (long) of the whole text; a null text is empty."""
    kind = ", ".join(f"{n}: bigint" for n in STATISTICS)

    @F.arrow_udf(f"struct<{kind}>")
    def measured(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known: dict[bytes, int] = _numbering()
        for part in texts:
            rows = []
            for data in pc.fill_null(part.cast(pa.large_binary()), b""):
                rows.append(statistics_of(data.as_py(), known))
                if len(known) > KNOWN_WORDS:
                    known = _numbering()
            table = np.array(rows, np.int64).reshape(len(rows), len(STATISTICS))
            columns = [pa.array(np.ascontiguousarray(c)) for c in table.T]
            yield pa.StructArray.from_arrays(columns, list(STATISTICS))

    return docs.withColumn(name, measured(F.col(text_column)))


def _numbering() -> dict[bytes, int]:
    return defaultdict(count().__next__)


def base_failed(statistics: str) -> Column:
    """Too few words, or too many of them in repeated windows."""
    words, repeated = F.col(f"{statistics}.n_words"), F.col(f"{statistics}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MOST_REPEATED * words)


def rule_number(rules: Sequence[Rule], statistics: str) -> Column:
    """The number, from 1, of the first rule that covers a row, else 0: one ordered conditional
    expression."""
    known = features(statistics)
    chosen = None
    for number, rule in enumerate(rules, 1):
        covers = F.lit(True)
        for feature, at_least, threshold in rule:
            value = known[feature]
            covers = covers & (value >= F.lit(threshold) if at_least else value < F.lit(threshold))
        chosen = F.when(covers, number) if chosen is None else chosen.when(covers, number)
    return F.lit(0) if chosen is None else chosen.otherwise(0)


def describe(rules: Sequence[Rule]) -> list[str]:
    """The list in words, one line per rule."""
    return [
        "drop if " + (" and ".join(f"{f} {'>=' if up else '<'} {t:g}" for f, up, t in rule) or "labelled at all")
        for rule in rules
    ] + ["else keep"]


def _threshold(low: float, high: float) -> float:
    """The shortest decimal number above ``low`` and up to ``high``."""
    for digits in range(17):
        value = round((low + high) / 2, digits)
        if low < value <= high:
            return value
    return high


def _covered(rule: Sequence[Condition], table: dict[str, np.ndarray], n: int) -> np.ndarray:
    mask = np.ones(n, bool)
    for feature, at_least, threshold in rule:
        mask &= table[feature] >= threshold if at_least else table[feature] < threshold
    return mask


def _grow(table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """Conditions by the largest gain of information until no good row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while (~bad[inside]).any():
        rows, best = np.flatnonzero(inside), (0.0, None)
        positive, total = int(bad[rows].sum()), len(rows)
        for feature, values in table.items():
            order = rows[np.argsort(values[rows], kind="stable")]
            own = values[order]
            cuts = np.flatnonzero(own[1:] > own[:-1]) + 1
            if not len(cuts):
                continue
            below = np.cumsum(bad[order])[cuts - 1]
            for at_least, hits, size in ((True, positive - below, total - cuts), (False, below, cuts)):
                share = np.log2(np.maximum(hits, 1e-9) / size) - np.log2(positive / total)
                gain = np.where(hits > 0, hits * share, 0.0)
                k = int(gain.argmax())
                if gain[k] > best[0] + 1e-9:
                    cut = cuts[k]
                    best = gain[k], Condition(feature, at_least, _threshold(own[cut - 1], own[cut]))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= _covered(rule[-1:], table, len(bad))
    return tuple(rule)


def _pruned(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The shortest beginning of the rule that separates best."""

    def worth(length: int) -> float:
        inside = _covered(rule[:length], table, len(bad))
        return (2 * bad[inside].mean() - 1) if inside.any() else -1.0

    return rule[: max(range(1, len(rule) + 1), key=lambda n: (round(worth(n), 9), -n))]


def _of(table: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return {name: values[rows] for name, values in table.items()}


def learn(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    min_precision: float = MIN_PRECISION,
    min_covered: int = MIN_COVERED,
    seed: int = 3,
) -> list[Rule]:
    """Rules for bad rows, in order. Without bad rows there are none; without good ones there is one
    rule without a condition, that covers everything."""
    if not bad.any():
        return []
    if bad.all():
        return [()]
    rng = np.random.default_rng(seed)
    rules: list[Rule] = []
    left = np.arange(len(bad))
    while bad[left].sum() >= min_covered:
        # Two thirds of either label to grow on, the rest to prune and judge on.
        third = np.zeros(len(left), bool)
        for label in (True, False):
            own = rng.permutation(np.flatnonzero(bad[left] == label))
            third[own[: len(own) // 3]] = True
        rule = _grow(_of(table, left[~third]), bad[left[~third]])
        if not rule:
            break
        rule = _pruned(rule, _of(table, left[third]), bad[left[third]])
        judged = bad[left[third]][_covered(rule, _of(table, left[third]), int(third.sum()))]
        inside = _covered(rule, _of(table, left), len(left))
        if not len(judged) or judged.mean() < min_precision or bad[left[inside]].sum() < min_covered:
            break
        rules.append(rule)
        left = left[~inside]

    def errors(some: Sequence[Rule]) -> int:
        dropped = np.zeros(len(bad), bool)
        for rule in some:
            dropped |= _covered(rule, table, len(bad))
        return int((dropped != bad).sum())

    for rule in reversed(list(rules)):
        others = [r for r in rules if r is not rule]
        if errors(others) <= errors(rules):
            rules = others
    return rules


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_documents: int = SAMPLE_DOCUMENTS,
) -> list[Rule]:
    """Learn rules from the labelled documents (1 good, 0 bad) that are not held out.

    At most ``sample_documents`` of each label are taken, the first by a hash of their ids, so that
    ids and statistics of the sample, which come to the driver, are bounded. Documents with
    contradicting labels, without an id, or that fail the base rules teach nothing; of texts that
    share an id one counts, the same one each time.
    """
    known = (
        labels.select(
            F.col(id_column).cast("long").alias("doc_id"), F.col(label_column).cast("int").alias("label")
        )
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .select("doc_id", "label")
    )
    order = F.xxhash64("doc_id"), F.col("doc_id")
    drawn = [known.filter(F.col("label") == v).orderBy(*order).limit(sample_documents) for v in (0, 1)]
    sample = keep(drawn[0].unionByName(drawn[1]), "sample").withColumnRenamed("doc_id", "of")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    found = with_statistics(texts.join(F.broadcast(sample), F.col("doc_id") == F.col("of")), "s").select(
        "doc_id", "label", "s"
    )
    one = found.groupBy("doc_id", "label").agg(F.min("s").alias("s")).filter(~base_failed("s"))
    values = features("s")
    rows = sorted(tuple(r) for r in one.select("doc_id", "label", *values.values()).collect())
    table = {name: np.array([r[2 + i] for r in rows], float) for i, name in enumerate(values)}
    return learn(table, np.array([r[1] == 0 for r in rows], bool))


def judge(
    docs: DataFrame, rules: Sequence[Rule], text_column: str = "text", prefix: str = ""
) -> DataFrame:
    """All documents with all their columns, then the ``STATISTICS``, ``base_failed``, ``rule`` and
    ``kept``, each name led by ``prefix``; columns of these names are replaced.

    A document that fails the base rules is not kept; of the others those are that no rule covers.
    ``rule`` is the number of the first that does, from 1, 0 for none, null where the base rules
    decide. A null text is an empty one, which fails.
    """
    added = [f"{prefix}{n}" for n in (*STATISTICS, "base_failed", "rule", "kept")]
    own = [c for c in docs.columns if c not in added or c == text_column]
    name = fresh("statistics")
    measured = with_statistics(docs.select(*own), name, text_column)
    failed = base_failed(name)
    number = F.when(~failed, rule_number(rules, name))
    return measured.select(
        *(c for c in own if c not in added),
        *(F.col(f"{name}.{n}").alias(f"{prefix}{n}") for n in STATISTICS),
        failed.alias(f"{prefix}base_failed"),
        number.alias(f"{prefix}rule"),
        (~failed & (number == 0)).alias(f"{prefix}kept"),
    )
