"""URL filter, neighbours, quotation linking, mixing, pipeline."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martwright.llm import quality
from martwright.llm.common import numbered
from martwright.llm.mixing import mix, mixed_documents, source_targets
from martwright.llm.neighbours import chi_square_quantile, nearest
from martwright.llm.packing import pack
from martwright.llm.queries import QUERIES
from martwright.llm.quotes import link_conversations
from martwright.llm.url_filter import RULES, entropy, judge

from ..conftest import plan_text
from .conftest import DOCUMENTS, SF_DIR, WORD, as_rows, components_by_brute_force, table
from .test_texts import PIECE, check_packing, encoder, lines_by_brute_force  # noqa: F401


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


# URL filter


def host_path_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        at = min([len(rest), *(rest.index(c) for c in "/?#" if c in rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at])
        tail = rest[at:]
        path = tail[: min([len(tail), *(tail.index(c) for c in "?#" if c in tail)])]
    fitting = []
    for verdict, rule in RULES:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fitting.append((-len(rule), rule, verdict))
    return host, path, min(fitting)[1] if fitting else None


URLS = [
    None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/x", "http://example.com", "http://com/",
    "http://xexample.com/en/", "http://a.b.net/es/1?x=/fr/", "http://net/fr/", "http://net?/fr/", "ftp://x.org#/a",
    "http://ÄÖ.com/é", "http://www.example.com/de/", "http://example.com/EN/", "a://b://c.com/x", "http://x.com/\n/y",
    "http://h.net/" + "q" * 100_000,
]


def test_hosts_paths_and_rules(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url")
    odd = table(spark, [(-i, u) for i, u in enumerate(URLS, 1)] + [(-1, None)], "page_id long, url string")
    every = pages.unionByName(odd).withColumn("host", F.lit("clash"))
    found = as_rows(judge(every), "page_id", "host", "path", "rule", "verdict")
    urls = dict(as_rows(every, "page_id", "url"))
    verdicts = {rule: verdict for verdict, rule in RULES}
    assert len(found) == every.count()
    for page_id, host, path, rule, verdict in found:
        assert (host, path, rule) == host_path_rule(urls[page_id])
        assert verdict == verdicts.get(rule, verdict) and verdict in ("allow", "block")


def test_trees_learn_what_urls_look_like(spark):
    rng = random.Random(2)

    def url(bad, host):
        path = "/".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(2))
        if bad:
            path = "".join(rng.choice("0123456789") for _ in range(30)) + "?a=1&b=2&c=3"
        return f"http://{host}/{path}"

    rules = [("allow", "good.org/"), ("block", "bad.org/")]
    rows = [(i, url(i % 2, f"w{i % 7}.{'bad' if i % 2 else 'good'}.org")) for i in range(1200)]
    rows += [(i, url(i % 2, f"w{i % 7}.unseen.info")) for i in range(1200, 1600)]
    found = as_rows(judge(table(spark, rows, "page_id long, url string"), rules=rules), "page_id", "rule", "verdict")
    right = [(v == "block") == (i % 2 == 1) for i, rule, v in found if rule is None]
    assert len(right) == 400 and np.mean(right) > 0.95


def test_one_verdict_or_none_and_no_pages(spark):
    schema = "page_id long, url string"
    rows = table(spark, [(1, "http://a.org/"), (2, "http://b.net/fr/")], schema)
    assert dict(as_rows(judge(rows), "page_id", "verdict")) == {1: "block", 2: "block"}
    assert dict(as_rows(judge(rows, rules=[]), "page_id", "verdict")) == {1: "allow", 2: "allow"}
    assert judge(rows.limit(0)).count() == 0


def test_entropy(spark):
    texts = ["", "a", "aaaa", "abab", "http://x.y/z?q=1", "ééa"]
    for text, found in as_rows(
        table(spark, [(t,) for t in texts], "t string").withColumn("e", entropy(F.col("t"))), "t", "e"
    ):
        n = Counter(text)
        assert found == pytest.approx(-sum(c / len(text) * math.log2(c / len(text)) for c in n.values()), abs=1e-9)


# Neighbours


def neighbours_by_brute_force(rows, is_query, k):
    own = {i: np.array(v, float) for i, v in rows}
    result = {}
    for q in filter(is_query, own):
        scores = [
            (-(own[q] * v).sum() / (math.sqrt((own[q] ** 2).sum()) * math.sqrt((v**2).sum())), i)
            for i, v in own.items() if i != q
        ]
        result[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return result


def test_recall_and_scores_on_the_table(spark):
    vectors = spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    rows = as_rows(vectors, "vec_id", "embedding")
    expected = neighbours_by_brute_force(rows, lambda i: i % 50 == 0, 5)
    found = defaultdict(list)
    for q, rank, i, score in sorted(
        as_rows(nearest(vectors, F.col("vec_id") % 50 == 0), "query_id", "rank", "vec_id", "score")
    ):
        found[q].append((i, score))
        assert rank == len(found[q])
    assert found.keys() == expected.keys()
    hits = [i in dict(expected[q]) for q in expected for i, _ in found[q]]
    assert np.mean(hits) >= 0.9
    for q, own in found.items():
        exact = dict(expected[q])
        assert all(score == pytest.approx(exact[i], abs=1e-12) for i, score in own if i in exact)
        assert own == sorted(own, key=lambda r: (-r[1], r[0]))


def test_neighbours_of_odd_vectors(spark, monkeypatch):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(1, 40)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)]  # one common vector
    rows += [(50, [2.0, 4.0, 6.0, 8.0]), (0, [1e-30, 2e-30, 3e-30, 4e-30]), (150, [1e30, 0.0, 0.0, 0.0])]
    odd = [(200, None), (201, []), (250, [0.0] * 4), (300, [nan, 1.0, 1.0, 1.0]), (301, [inf, 0.0, 0.0, 0.0]),
           (302, [None, 1.0, 1.0, 1.0]), (350, [1.0, 2.0]), (None, [1.0] * 4), rows[0], rows[0]]
    frame = table(spark, [(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, cell string")
    expected = neighbours_by_brute_force(rows, lambda i: i % 50 == 0, 5)
    found = defaultdict(list)
    query = as_rows(nearest(frame.repartition(3), F.col("vec_id") % 50 == 0), "query_id", "rank", "vec_id")
    for q, _, i in sorted(query):
        found[q].append(i)
    assert found.keys() == expected.keys() == {0, 50, 100, 150}
    assert found[50] == [0, 100, 101, 102, 103] and found[100][:2] == [0, 50]
    few = frame.filter("vec_id in (1, 50)")
    assert as_rows(nearest(few, F.col("vec_id") % 50 == 0), "query_id", "rank", "vec_id") == [(50, 1, 1)]
    assert nearest(frame.limit(0), F.lit(True)).count() == 0
    assert nearest(frame.filter("vec_id = 250"), F.lit(True)).count() == 0


def test_chi_square_quantile():
    draws = (np.random.default_rng(3).standard_normal((200_000, 8)) ** 2).sum(axis=1)
    for p in (0.5, 0.9, 0.98):
        assert (draws <= chi_square_quantile(p, 8)).mean() == pytest.approx(p, abs=0.005)


# Quotation linking

MESSAGES = [
    (1, 0, "u", "Hello there\nhow are you\n\nsecond   par"),
    (1, 1, "a", "> hello there\n> how are you\n\nfine"),
    (1, 2, "u", "new thread"),
    (1, 3, "u", "On Mon Bob wrote:\n> fine\n>> hello there\n\nok"),
    (1, 4, "a", "> NEW thread\nyes"),
    (1, 4, "a", "> NEW thread\nyes"),
    (1, 5, "u", "> never said\nhm > x"),
    (None, 1, "a", "> new thread"),
    (2, None, "b", None),
    (2, 0, None, ">> deep\n> second par"),
    (2, 1, "u", "> new thread\n"),
]


def test_quotes_are_linked_and_removed(spark):
    frame = table(spark, [(*r, 9) for r in MESSAGES], "conv_id long, turn long, role string, text string, depth int")
    columns = ("conv_id", "position", "turn", "parent_turn", "root_turn", "depth", "quotes", "linked", "text")
    found = sorted(as_rows(link_conversations(frame.repartition(3)), *columns), key=str)
    assert found == sorted(
        [
            (None, 0, 1, None, 1, 0, 1, 0, ""),
            (1, 0, 0, None, 0, 0, 0, 0, "Hello there\nhow are you\n\nsecond   par"),
            (1, 1, 1, 0, 0, 1, 1, 1, "fine"),
            (1, 2, 3, 1, 0, 2, 2, 2, "ok"),
            (1, 3, 2, None, 2, 0, 0, 0, "new thread"),
            (1, 4, 4, 2, 2, 1, 1, 1, "yes"),
            (1, 5, 4, 2, 2, 1, 1, 1, "yes"),
            (1, 6, 5, None, 5, 0, 1, 0, "hm > x"),
            (2, 0, None, None, None, 0, 0, 0, None),
            (2, 1, 0, None, 0, 0, 2, 0, ""),
            (2, 2, 1, None, 1, 0, 1, 0, ""),
        ],
        key=str,
    )


def test_a_long_thread_and_a_common_passage(spark):
    """Every message quotes its predecessor, and a greeting that the first one wrote."""
    rows = [(7, 0, "u", "hi all\nline 0")]
    rows += [(7, i, "u", f"> line {i - 1}\n\n> hi all\n\nhi all\nline {i}") for i in range(1, 70)]
    found = as_rows(
        link_conversations(table(spark, rows, "conv_id long, turn long, role string, text string")),
        *("turn", "position", "root_turn", "linked"),
    )
    assert sorted(found) == [(i, i, 0, 0 if i == 0 else 1 if i == 1 else 2) for i in range(70)]


def test_conversations_without_quotes_keep_their_order(spark):
    table_ = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    found = link_conversations(table_)
    assert sorted(as_rows(found, "conv_id", "position", "role", "text")) == sorted(
        as_rows(table_, "conv_id", "turn", "role", "text")
    )
    assert link_conversations(table_.limit(0)).count() == 0


def test_numbered(spark):
    values = [random.Random(4).randrange(50) for _ in range(500)]
    frame = table(spark, list(enumerate(values)), "i long, v long").repartition(7)
    found = as_rows(numbered(frame, [F.col("v"), F.col("i")], "test", "place"), "v", "i", "place")
    assert [r[:2] for r in sorted(found, key=lambda r: r[2])] == sorted((v, i) for i, v in enumerate(values))
    assert sorted(r[2] for r in found) == list(range(500))


# Mixing


def targets_by_resharing(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, capped, left = {}, set(), share * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        total = sum(weight[s] for s in free)
        target |= {s: left * weight[s] / total for s in free}
        above = [s for s in free if target[s] > most * sizes[s] + 1e-9]
        if not above:
            return target
        for s in above:
            target[s] = most * sizes[s]
            capped.add(s)
            left -= target[s]
        if len(capped) == len(order):
            return target


def test_targets(spark):
    sizes = {"b": 100, "a": 5, "é": 70, "Z": 1000, None: 30, "": 400, "zero": 0}
    rows = [(s, n) for s, n in sizes.items()] + [("b", 0)]
    found = {r[0]: r[1:] for r in as_rows(source_targets(table(spark, rows, "source string, size long")), "source", "source_size", "target")}
    expected = targets_by_resharing(sizes)
    assert found.keys() == sizes.keys()
    for source, (size, target) in found.items():
        assert size == sizes[source] and target == pytest.approx(expected[source])


def test_the_mix_meets_its_targets(spark, documents):
    frame = documents.unionByName(
        table(spark, [(-1, None, "x", None, 0), (2**62 + 1, "a b", "x", None, 0), (-3, "", "x", "src1", 0)], DOCUMENTS)
    )
    first = mix(frame)
    rows = as_rows(first, "doc_id", "source", "size", "source_size", "target", "copies", "taken")
    texts = dict(as_rows(frame, "doc_id", "text"))
    sizes = Counter()
    for doc_id, source, size, *_ in rows:
        assert size == len(WORD.findall(texts[doc_id] or ""))
        sizes[source] += size
    assert len(rows) == frame.count() and None in sizes
    expected = targets_by_resharing(sizes)
    taken, copies, number = Counter(), Counter(), Counter()
    for _, source, size, source_size, target, times, words in rows:
        assert source_size == sizes[source] and target == pytest.approx(expected[source])
        assert times in (0, 1, 2) and words == times * size
        taken[source] += words
        copies[source] += times
        number[source] += 1
    for source, target in expected.items():
        longest = max(r[2] for r in rows if r[1] == source)
        assert abs(taken[source] - target) <= max(longest, 0.02 * target)
        ratio = target / sizes[source] if sizes[source] else 0
        assert abs(copies[source] - ratio * number[source]) <= 3
    again = as_rows(mix(frame.repartition(9)), "doc_id", "copies")
    assert sorted(again) == sorted((r[0], r[5]) for r in rows)


def test_the_flight_over_many_buckets(spark, monkeypatch):
    from martwright.llm import mixing

    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    rng = random.Random(8)
    rows = [(i, "w " * rng.randrange(1, 200), "x", f"s{i % 3}", 0) for i in range(1500)]
    found = as_rows(mix(table(spark, rows, DOCUMENTS)), "source", "size", "source_size", "target", "copies", "taken")
    for source in ("s0", "s1", "s2"):
        own = [r for r in found if r[0] == source]
        assert sum(r[5] for r in own) == pytest.approx(own[0][3], abs=100)
        assert sum(r[4] for r in own) == pytest.approx(own[0][3] / own[0][2] * len(own), abs=3)


def test_identical_rows_spread_over_buckets(spark, monkeypatch):
    from martwright.llm import mixing

    monkeypatch.setattr(mixing, "BUCKET_ROWS", 200)
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 16)
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(1, 9), "x", f"s{i % 3}", 0) for i in range(4000)]
    rows += [(7, "same words", "x", "s1", 0)] * 1500 + [(None, None, "x", None, 0)] * 500
    frame = table(spark, rows, DOCUMENTS).repartition(7)
    groups = []
    keep_ = mixing.keep
    monkeypatch.setattr(mixing, "keep", lambda df, label: groups.append((label, keep_(df, label))) or groups[-1][1])
    first = mix(frame, seed=5)
    sizes = [n for _, n in as_rows(next(df for label, df in groups if label == "flight").groupBy("bucket").count(), "bucket", "count")]
    assert sum(sizes) == 6000 and max(sizes) <= 400
    found = Counter(as_rows(first, "doc_id", "text_key", "copies"))
    assert found == Counter(as_rows(mix(frame.repartition(3), seed=5), "doc_id", "text_key", "copies"))
    taken = Counter()
    for source, words, target in as_rows(first, "source", "taken", "target"):
        taken[source, target] += words
    assert all(abs(words - target) <= max(20, 0.02 * target) for (_, target), words in taken.items())


def test_mixed_documents_keep_their_columns(spark):
    big = 2**62 + 1
    rows = [(1, "a b c", "en", "s", 5)] * 2 + [(big, None, "en", None, 0), (None, "x", "en", "t", 1)]
    frame = table(spark, rows, DOCUMENTS)
    copies = Counter(dict.fromkeys([(1, "s"), (big, None), (None, "t")], 0))
    for doc_id, source, times in as_rows(mix(frame), "doc_id", "source", "copies"):
        copies[doc_id, source] += times
    out = mixed_documents(frame)
    assert out.columns == frame.columns
    found = Counter(as_rows(out, "doc_id", "source"))
    assert all(found[key] <= n for key, n in copies.items()) and found.keys() <= copies.keys()
    assert mix(frame.limit(0)).count() == 0 and mixed_documents(frame.limit(0)).count() == 0


def test_mixed_documents_are_the_mix_of_repeated_rows(spark):
    """Sources above and below their size, every row present two or three times, in several parts."""
    rows = [(i, f"{'w ' * (i % 7 + 1)}{i}", "en", f"s{i % 2}", 1) for i in range(120)]
    rows = rows * 2 + rows[::3] + [(5, rows[5][1], "en", "s0", 1), (None, None, "en", None, 0), (None, "x", "en", None, 0)] * 3
    frame = table(spark, rows, DOCUMENTS).repartition(5)
    ratios = set()
    for share in (0.4, 1.5):
        copies = Counter()
        for doc_id, source, key, times, ratio in as_rows(
            mix(frame, total_share=share).withColumn("ratio", F.col("target") / F.col("source_size")),
            *("doc_id", "source", "text_key", "copies", "ratio"),
        ):
            copies[doc_id, source, key] += times
            ratios.add(ratio)
        out = mixed_documents(frame, total_share=share).withColumn("key", F.xxhash64("text"))
        assert Counter(as_rows(out, "doc_id", "source", "key")) == +copies
    assert min(ratios) < 1 < max(ratios)


# Pipeline


def test_every_stage_against_its_definition(spark, documents, encoder):  # noqa: F811
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == documents.columns
        before = {r.doc_id: r for r in docs.collect()}
        after = out.collect()
        found = Counter(r.doc_id for r in after)
        if name == "quality_classifier":
            model = quality.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            scores = dict(as_rows(quality.score(docs, model), "doc_id", "score"))
            assert set(found) == {i for i, s in scores.items() if s >= quality.THRESHOLD}
        elif name == "line_dedup":
            expected = lines_by_brute_force({i: r.text for i, r in before.items()}, 10, 0.7)
            kept = {i: text for i, (dropped, text) in expected.items() if not dropped or WORD.search(text)}
            assert {r.doc_id: r.text for r in after} == kept
            assert all(r.n_chars == len(r.text) for r in after if expected[r.doc_id][0])
        elif name == "near_dedup":
            groups = components_by_brute_force({i: r.text for i, r in before.items()}, 5, 80)
            assert set(found) == {i for i, (_, component) in groups.items() if component == i}
        else:
            copies = dict(as_rows(mix(docs), "doc_id", "copies"))
            assert found == Counter({i: n for i, n in copies.items() if n})
        if name != "mixing":
            assert set(found.values()) <= {1}
        docs = corpus_pipeline.keep(out, name)
    pieces = as_rows(corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR), *PIECE)
    assert check_packing(encoder, as_rows(docs, "doc_id", "text"), pieces) < 0.05


def test_near_dedup_leaves_one_of_repeated_rows(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(1, a)] * 3 + [(1, b), (2, a + " x"), (3, "c d"), (4, None), (4, None), (None, "n"), (None, "n")]
    frame = table(spark, [(i, t, "en", "s", 0) for i, t in rows], DOCUMENTS).repartition(3)
    out = corpus_pipeline.near_dedup(spark, frame, SF_DIR)
    assert out.columns == frame.columns
    expected = Counter([(1, a), (1, b), (3, "c d"), (4, None), (None, "n"), (None, "n")])
    assert Counter(as_rows(out, "doc_id", "text")) == expected


def test_the_pipeline_runs(spark):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert found.columns == pack(spark.read.parquet(f"{SF_DIR}/documents.parquet")).columns
    assert found.count() > 100
    assert corpus_pipeline.ORACLE_SQL is None


def test_no_stage_fails_on_an_empty_table(spark, tmp_path):
    docs = table(spark, [], DOCUMENTS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).count() == 0


def test_lines_are_dropped_by_one_function_call(spark):
    # Without the mark the filter on what is left of a text called the function a second time, in a Python
    # worker of its own: four workers for two tasks, and an executor above its memory.
    frame = spark.createDataFrame([(1, "a b c d", "en", "s", 7)], DOCUMENTS)
    plan = plan_text(corpus_pipeline.line_dedup(spark, frame, ""))
    assert plan.count("ArrowEvalPython") == 1
