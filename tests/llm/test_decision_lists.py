"""Statistics and rules against plain Python."""

from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import decision_lists
from martwright.llm.decision_lists import Condition, describe, fit, judge, learn, statistics_of
from martwright.llm.queries import QUERIES

from .conftest import DOCUMENTS, SF_DIR, WORD, as_rows, table

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def base_by_brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated), failed


ODD = [
    None, "", " \n\t", "a", "a a a", "a a a a", "a b c a b c", "x\x0by \x1c z w \x85 é", "a\r\na\r\nb\na \na",
    "#*$%&|<> €", "日本語 テキスト " * 30, "one two three\n" * 20, "w " * 49, "w" + " w" * 49, "a  b\n\n\na  b\n \na b",
    " ".join(f"n{i}" for i in range(60)), " ".join(f"n{i % 30}" for i in range(60)), "A B. C! 1 2? " * 12,
    "lead " * 25 + " ".join(f"n{i}" for i in range(25)), "lead " * 26 + " ".join(f"n{i}" for i in range(25)),
]


def test_base_statistics(spark, documents, monkeypatch):
    rows = as_rows(documents, "doc_id", "text") + [(-i, t) for i, t in enumerate(ODD, 1)] + [(None, "a b")] * 2
    frame = table(spark, [(*r, True, 1) for r in rows], "doc_id long, text string, kept boolean, n_words int")
    found = judge(frame.repartition(6), [])
    assert Counter(as_rows(found, "doc_id", *BASE)) == Counter((i, *base_by_brute_force(t)) for i, t in rows)
    assert found.columns[:2] == ["doc_id", "text"] and found.columns.count("kept") == 1
    assert all(kept != failed for kept, failed in as_rows(found, "kept", "base_failed"))
    led = judge(frame, [], prefix="q_")
    assert led.columns[:4] == frame.columns and "q_kept" in led.columns
    assert judge(frame.limit(0), []).count() == 0


def test_long_texts_go_piece_by_piece(monkeypatch):
    rng = np.random.default_rng(4)
    texts = [" ".join(f"é{n}" for n in rng.integers(0, 60, size).tolist()) for size in (10, 500, 4000)]
    texts += ["x" * 5000, "\n".join(["ab cd ef"] * 700), " " * 3000]
    monkeypatch.setattr(decision_lists, "SLICE", 64)
    for text in texts:
        found = statistics_of(text.encode(), defaultdict(count().__next__))
        assert found[:5] == base_by_brute_force(text)[:5]
        assert found[6] == len(set(WORD.findall(text)))


def test_windows_of_many_words_stay_exact():
    """Numbers so large that three of them do not fit one long."""
    rng = np.random.default_rng(8)
    own = rng.integers(0, 1 << 40, 300)
    numbers = np.concatenate([own, own[50:90], rng.integers(0, 1 << 40, 100), own[:2]])
    assert decision_lists._repeated_words(numbers) == 80


def plain_rule(rules, values):
    for number, rule in enumerate(rules, 1):
        if all(values[f] >= t if up else values[f] < t for f, up, t in rule):
            return number
    return 0


@pytest.fixture(scope="module")
def large(spark):
    folder = SF_DIR.replace("sf0.001", "sf0.1")
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_rules_on_held_out_documents(spark, large):
    docs, labels = large
    rules = fit(docs, labels)
    assert 1 <= len(rules) <= 12 and describe(rules)[-1] == "else keep"
    judged = judge(docs, rules).join(labels, "doc_id")
    held = judged.filter(decision_lists.held_out(F.col("doc_id")) & ~F.col("base_failed"))
    rows = as_rows(held, "quality", "kept")
    assert len(rows) > 700
    assert np.mean([bool(q) == k for q, k in rows]) > 0.97
    assert np.mean([k for q, k in rows if q]) > 0.99
    # The same list again, and the same verdicts as read by a person.
    assert fit(docs.repartition(7), labels.repartition(3)) == rules
    known = decision_lists.features("s")
    some = decision_lists.with_statistics(docs.limit(300), "s").select("doc_id", *(c.alias(n) for n, c in known.items()))
    numbers = dict(as_rows(judge(docs, rules), "doc_id", "rule"))
    for row in some.collect():
        if numbers[row.doc_id] is not None:
            assert numbers[row.doc_id] == plain_rule(rules, row.asDict())


def test_the_query_keeps_what_no_rule_covers(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rules = fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    found = {r.doc_id: r for r in QUERIES["op12_rules"](spark, SF_DIR).collect()}
    assert found.keys() == {i for (i,) in as_rows(docs, "doc_id")}
    numbers = dict(as_rows(judge(docs, rules), "doc_id", "rule"))
    for doc_id, text in as_rows(docs, "doc_id", "text"):
        row = found[doc_id]
        assert tuple(row[c] for c in BASE) == base_by_brute_force(text)
        assert row.kept == (not row.base_failed and numbers[doc_id] == 0)


def test_learning_a_known_list():
    rng = np.random.default_rng(1)
    table_ = {name: rng.random(3000) for name in "abc"}
    bad = ((table_["a"] >= 0.8) & (table_["b"] < 0.3)) | (table_["c"] >= 0.95)
    rules = learn(table_, bad)
    found = np.zeros(3000, bool)
    for rule in rules:
        found |= decision_lists._covered(rule, table_, 3000)
    assert (found == bad).mean() > 0.99 and 2 <= len(rules) <= 4
    assert all(len(rule) <= 3 for rule in rules)
    noise = learn({"a": rng.random(1000)}, rng.random(1000) < 0.1)
    assert len(noise) <= 1


def test_one_label_or_none(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(60)), "en", "s", 0) for i in range(30)]
    frame = table(spark, rows, DOCUMENTS)
    schema = "doc_id long, quality int"
    assert fit(frame, table(spark, [], schema)) == []
    assert fit(frame, table(spark, [(i, 1) for i in range(30)], schema)) == []
    assert fit(frame.limit(0), table(spark, [(i, i % 2) for i in range(30)], schema)) == []
    odd = table(spark, [(None, 0), (1, None), (2, 7), (3, 0), (3, 1), (900, 0)], schema)
    assert fit(frame, odd) == []
    every = fit(frame, table(spark, [(i, 0) for i in range(30)], schema))
    assert every == [()] and {k for (k,) in as_rows(judge(frame, every), "kept")} == {False}
    assert describe(every) == ["drop if labelled at all", "else keep"]
    assert describe([(Condition("words", False, 3.0),)])[0] == "drop if words < 3"


def test_the_sample_is_bounded_with_repeated_ids(spark, monkeypatch):
    """A third of all rows share one labelled id; each id teaches once."""
    rows = [(i, " ".join(f"{'#' * (i % 2)}w{i * k}" for k in range(60))) for i in range(200)]
    rows += [(1, f"{'#x ' * 70}{n}") for n in range(100)]
    frame = table(spark, rows, "doc_id long, text string").repartition(4)
    labels = table(spark, [(i, 1 - i % 2) for i in range(200)] * 2, "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(decision_lists, "learn", lambda t, bad: seen.append(len(bad)) or [])
    fit(frame, labels, sample_documents=40)
    fit(frame, labels)
    assert seen[0] <= 80 and 130 <= seen[1] <= 160
