"""URL filter: host and path rules, and gradient-boosted trees for the URLs no rule fits.

Built-in functions and Spark's own tree learner only. The trees are trained from the labels the rules
give: lexical features of the URL (length, depth, digits, entropy, parameters) and statistics of its
host suffix. Suffix statistics come from one half of the labelled sample and the trees from the other,
so that the trees do not see a statistic their own label went into.
"""

import string
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep

# (verdict, host and path). Fixed values.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# The bound of the training sample: different URLs of each verdict, in expectation.
SAMPLE_URLS = 10_000
TREES = 12
DEPTH = 4
BINS = 32
SUFFIX_LABELS = (1, 2)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z in lower case, and the path. Both are empty for a null or without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(
        F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase
    )
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits the host or a domain above it, and the beginning of the path; null
    if none does. Of equally long ones the first in text order counts."""
    fitting = None
    for _, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(
            path, F.lit(slash + rest)
        )
        fitting = F.when(fits, rule) if fitting is None else fitting.when(fits, rule)
    return F.lit(None).cast("string") if fitting is None else fitting.otherwise(None)


def entropy(text: Column) -> Column:
    """Bits per character, from the runs of the sorted characters; 0 for an empty text."""
    chars = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    zero = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def closed(state: Column) -> Column:
        return state["sum"] + F.when(state["run"] > 1, state["run"] * F.log2(state["run"])).otherwise(0.0)

    def step(state: Column, c: Column) -> Column:
        same = state["last"] == c
        return F.struct(
            c.alias("last"),
            F.when(same, state["run"] + 1.0).otherwise(1.0).alias("run"),
            F.when(same, state["sum"]).otherwise(closed(state)).alias("sum"),
        )

    n = F.length(text)
    runs = F.aggregate(chars, zero, step, closed)
    return F.when(n > 0, F.log2(n) - runs / n).otherwise(0.0)


def _occurrences(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.translate(text, char, ""))


def _suffix(host: Column, labels: int) -> Column:
    return F.xxhash64(F.lit(labels), F.substring_index(host, ".", -labels))


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    length = F.length(text)
    digits = length - F.length(F.translate(text, string.digits, ""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    return {
        "f_length": length.cast("double"),
        "f_host_length": F.length(host).cast("double"),
        "f_host_labels": (_occurrences(host, ".") + 1).cast("double"),
        "f_depth": _occurrences(path, "/").cast("double"),
        "f_digit_ratio": F.when(length > 0, digits / length).otherwise(0.0),
        "f_entropy": entropy(text),
        "f_parameters": F.when(query != "", _occurrences(query, "&") + 1).otherwise(0).cast("double"),
        "f_fragment": F.contains(text, F.lit("#")).cast("double"),
    }


def judge(
    pages: DataFrame,
    id_column: str = "page_id",
    url_column: str = "url",
    rules: Sequence[tuple[str, str]] = RULES,
    sample_urls: int = SAMPLE_URLS,
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``rule`` is null where no rule fits; the trees then decide. A null or malformed URL has an empty
    host and path, fits no rule and is decided by the trees. Where the rules give one verdict only,
    that is the verdict of all other URLs, and ``allow`` where they give none. Rows may repeat.
    """
    url = F.col("url")
    host, path = host_and_path(url)
    rows = pages.select(
        F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url")
    ).select("page_id", "url", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    blocked = [rule for verdict, rule in rules if verdict == "block"]
    is_blocked = F.col("rule").isin(blocked)
    labelled = rows.filter(F.col("rule").isNotNull()).select(
        "url", "host", "path", is_blocked.cast("double").alias("label"), F.xxhash64("url").alias("draw")
    )
    counts = {
        row["label"]: row["urls"]
        for row in labelled.groupBy("label")
        .agg(F.approx_count_distinct("draw").alias("urls"))
        .collect()
    }
    if len(counts) < 2:
        other = "block" if 1.0 in counts else "allow"
        decided = rows.withColumn("guess", F.lit(other))
    else:
        decided = _by_trees(rows, labelled, counts, sample_urls)
    verdict = F.when(F.col("rule").isNull(), F.col("guess")).otherwise(
        F.when(is_blocked, "block").otherwise("allow")
    )
    return decided.select("page_id", "host", "path", "rule", verdict.alias("verdict"))


def _by_trees(
    rows: DataFrame, labelled: DataFrame, counts: dict[float, int], sample_urls: int
) -> DataFrame:
    """Add ``guess``. URLs are sampled by their hash before repeated ones are dropped, so a URL that
    a third of all rows share is one row per task at most."""
    space = 1 << 30
    wanted = reduce(
        lambda a, b: a | b,
        (
            (F.col("label") == label)
            & (F.pmod("draw", F.lit(space)) < int(space * min(1.0, sample_urls / n)))
            for label, n in counts.items()
        ),
    )
    features = lexical_features(F.col("url"), F.col("host"), F.col("path"))
    suffixes = {f"s_{k}": _suffix(F.col("host"), k) for k in SUFFIX_LABELS}
    sample = keep(
        labelled.filter(wanted)
        .groupBy("draw")
        .agg(*(F.first(c).alias(c) for c in ("url", "host", "path", "label")))
        .select("label", (F.shiftright("draw", 40) % 2 == 0).alias("half"), *(
            c.alias(name) for name, c in {**features, **suffixes}.items()
        )),
        "urls",
    )
    prior = sample.agg(F.avg("label")).first()[0]
    statistics = {}
    for name in suffixes:
        # At most one row of two numbers and a hash per sampled URL: bounded, so it is broadcast.
        statistics[name] = keep(
            sample.filter("half")
            .groupBy(F.col(name).alias(f"{name}_of"))
            .agg(
                F.log1p(F.count(F.lit(1))).alias(f"{name}_count"),
                ((F.sum("label") + 2 * prior) / (F.count(F.lit(1)) + 2)).alias(f"{name}_blocked"),
            ),
            "suffixes",
        )

    def with_statistics(df: DataFrame) -> DataFrame:
        for name, table in statistics.items():
            df = df.join(F.broadcast(table), F.col(name) == F.col(f"{name}_of"), "left").drop(
                f"{name}_of"
            )
        return df.fillna(0.0, [f"{n}_count" for n in statistics]).fillna(
            prior, [f"{n}_blocked" for n in statistics]
        )

    inputs = [*features, *(f"{n}_{x}" for n in suffixes for x in ("count", "blocked"))]
    assembler = VectorAssembler(inputCols=inputs, outputCol="f_vector")
    learner = GBTClassifier(
        featuresCol="f_vector",
        labelCol="label",
        predictionCol="f_blocked",
        maxIter=TREES,
        maxDepth=DEPTH,
        maxBins=BINS,
        seed=11,
    )
    learner.setRawPredictionCol("").setProbabilityCol("")
    training = sample.filter("NOT half")
    if training.select("label").distinct().count() < 2:
        training = sample
    model = learner.fit(
        assembler.transform(with_statistics(training)).select("label", "f_vector")
    )
    scored = rows.select(
        "*", *(c.alias(name) for name, c in {**features, **suffixes}.items())
    )
    scored = model.transform(assembler.transform(with_statistics(scored)))
    return scored.withColumn("guess", F.when(F.col("f_blocked") > 0.5, "block").otherwise("allow"))
