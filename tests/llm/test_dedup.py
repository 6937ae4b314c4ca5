"""Exact and near duplicates, against brute force."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from martwright.llm import minhash
from martwright.llm.components import connected_components
from martwright.llm.exact_dedup import exact_duplicates
from martwright.llm.minhash import near_duplicates, shingle_hashes, signature
from martwright.llm.oracle import ORACLES

from .conftest import DOCUMENTS, SF_DIR, as_rows, components_by_brute_force, shingles, table

BLANKS = re.compile(r"[\x20\x09-\x0D]")
HARD = "A" * 300_000


def exact_by_brute_force(rows):
    plain = [BLANKS.sub("", t or "") for _, t in rows]
    result = []
    for (doc_id, text), own in zip(rows, plain):
        group = [(i, t) for (i, t), p in zip(rows, plain) if p == own]
        best = min(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        kept = doc_id == best[0] and len(text or "") == len(best[1] or "")
        result.append((doc_id, best[0], len(group), kept, hashlib.sha256(own.encode()).hexdigest()))
    return result


def test_exact_duplicates_of_odd_rows(spark):
    rows = [
        (5, "a b"), (3, "ab"), (4, "a\tb"), (9, None), (8, ""), (7, " \n"), (None, "a  b"),
        (-(2**63), "z"), (2**63 - 1, "z"), (6, "é x"), (2, "é x"), (1, "éx"),
        (20, HARD), (21, HARD + " "), (30, "same"), (30, "same"), (31, "same"), (40, "𝒳 y"), (41, "𝒳y "),
    ]
    found = as_rows(
        exact_duplicates(table(spark, rows, "doc_id long, text string")),
        *("doc_id", "keep_id", "group_size", "kept", "text_sha256"),
    )
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(found, key=key) == sorted(exact_by_brute_force(rows), key=key)


def test_exact_duplicates_of_the_table_match_sql(spark, documents):
    sql = duckdb.sql(
        ORACLES["op2_exact_dedup"].replace("FROM documents", f"FROM '{SF_DIR}/documents.parquet'")
    ).order("doc_id")
    found = exact_duplicates(documents).orderBy("doc_id")
    assert as_rows(found, *sql.columns) == sql.fetchall()


def test_exact_duplicates_of_an_empty_table_and_clashing_columns(spark):
    empty = table(spark, [], DOCUMENTS)
    assert exact_duplicates(empty).count() == 0
    clash = table(spark, [(1, "a", "x", 1)], "doc_id long, text string, hash string, plain int")
    assert exact_duplicates(clash).count() == 1


def variations(base, count, changes, rng):
    for _ in range(count):
        words = base.split()
        for _ in range(rng.choice(changes)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(50)}"
        yield " ".join(words)


@pytest.mark.parametrize("words,percent", [(3, 85), (5, 80)])
def test_near_duplicates_against_all_pairs(spark, words, percent):
    rng = random.Random(words)
    vocabulary = [f"v{i}" for i in range(300)]
    texts = {}
    for size, count, changes in ((120, 60, (0, 1, 2, 3, 4)), (140, 40, (2, 3)), (30, 20, (1,)), (400, 8, (3, 9))):
        base = " ".join(rng.choice(vocabulary) for _ in range(size))
        for text in variations(base, count, changes, rng):
            texts[len(texts)] = text
    for odd in ("", "one", "ONE", "one two", "\x0b\x0c", "a b c", *[texts[0]] * 5, texts[3].upper()):
        texts[len(texts)] = odd
    rows = [(i, t, "x") for i, t in texts.items()]
    rng.shuffle(rows)
    expected = components_by_brute_force(texts, words, percent)
    frame = table(spark, rows, "doc_id long, text string, bands string").repartition(5)
    found = as_rows(
        near_duplicates(frame, shingle_words=words, percent=percent),
        *("doc_id", "n_shingles", "component_id", "kept"),
    )
    assert {r[0]: (r[1], r[2]) for r in found} == expected
    assert all(kept == (i == component) for i, _, component, kept in found)
    assert len({c for _, c in expected.values()}) > 20


def test_near_duplicates_of_nulls_repeats_and_nothing(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(table(spark, [], schema)).count() == 0
    rows = [(None, "a b c"), (1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "A B C"), (5, HARD)]
    found = as_rows(
        near_duplicates(table(spark, rows, schema)), "doc_id", "n_shingles", "component_id", "kept"
    )
    assert sorted(found, key=str) == sorted(
        [(None, 1, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (3, 1, 3, True),
         (4, 1, 3, False), (5, 1, 5, True)],
        key=str,
    )


def variants_of_repeated_rows():
    """Groups without a common original, whose members repeat their rows; 90 of 100 words are common
    to two, so that exact buckets decide what the bands leave open."""
    rng, texts = random.Random(12), {}
    for group in range(25):
        common = [f"g{group}c{i}" for i in range(90)]
        for member in range(2):
            own = [f"g{group}m{member}o{i}" for i in range(10)]
            words = common + own
            rng.shuffle(words)
            texts[10 * group + member] = " ".join(words)
    return texts


@pytest.mark.parametrize("times", [(3, 1), (2, 2), (1, 1)])
def test_prefix_buckets_keep_pairs_of_repeated_rows(spark, times, monkeypatch):
    """What the first round leaves open: with its links ignored, exact buckets have to find all."""
    whole = minhash._round
    calls = []

    def blind_first_round(state, sets, pivots, small, percent):
        calls.append(1)
        if len(calls) > 1:
            return whole(state, sets, pivots, small, percent)
        return whole(state.limit(0), sets, pivots, small, percent)[0], state

    monkeypatch.setattr(minhash, "_round", blind_first_round)
    texts = variants_of_repeated_rows()
    rows = [(i, t) for i, t in texts.items() for _ in range(times[i % 10])]
    found = dict(as_rows(
        near_duplicates(table(spark, rows, "doc_id long, text string"), shingle_words=1, percent=80),
        *("doc_id", "component_id"),
    ))
    assert found == {i: c for i, (_, c) in components_by_brute_force(texts, 1, 80).items()}


def test_an_id_that_leads_several_classes(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (1, a.upper()), (2, a + " x"), (3, b + " y"), (3, b + " y"), (4, "c d e f")]
    found = as_rows(near_duplicates(table(spark, rows, "doc_id long, text string")), "doc_id", "component_id")
    assert sorted(found) == [(1, 1)] * 3 + [(2, 1), (3, 1), (3, 1), (4, 4)]


def test_signatures_estimate_the_similarity():
    rng = random.Random(1)
    a = " ".join(f"x{rng.randrange(10**6)}" for _ in range(600))
    words = a.split()
    words[::12] = [f"y{i}" for i in range(len(words[::12]))]
    b = " ".join(words)
    exact = len(shingles(a, 3) & shingles(b, 3)) / len(shingles(a, 3) | shingles(b, 3))
    same = signature(shingle_hashes(a, 3), 1024) == signature(shingle_hashes(b, 3), 1024)
    assert abs(same.mean() - exact) < 0.06
    assert len(np.unique(signature(shingle_hashes(a, 3), 1024))) > 1000


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 180)] + [(7, 7), (200, 199)]
    rng.shuffle(links)
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in links]
    found = dict(as_rows(connected_components(table(spark, links, "a long, b long")), "node", "component"))
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 180)} | {199: 199, 200: 199}
    assert found == expected
    assert connected_components(table(spark, [], "a long, b long")).count() == 0


def test_words_of_a_polynomials_weak_kind_differ():
    """The Thue-Morse word and its complement have one polynomial for every base modulo 2^64."""
    for n in (65, 1024, 2048, 4096):
        word = "".join("ab"[i.bit_count() & 1] for i in range(n))
        other = word.translate(str.maketrans("ab", "ba"))
        assert minhash.shingle_hashes(word, 3) != minhash.shingle_hashes(other, 3)
        assert minhash.shingle_hashes(word.upper(), 3) == minhash.shingle_hashes(word, 3)


def test_long_texts_are_hashed_piece_by_piece(monkeypatch):
    rng = random.Random(1)
    texts = [
        " ".join("".join(rng.choice("abÄ \n") for _ in range(rng.randrange(9))) for _ in range(rng.randrange(400)))
        for _ in range(60)
    ] + ["x" * 5000 + " y z", "", None, " ", "A b C d", "q" * 64, "q" * 65 + " " + "Q" * 65]
    whole = list(minhash.shingle_sets(pa.array(texts, pa.large_string()), 3))
    monkeypatch.setattr(minhash, "SLICE_BYTES", 100)
    cut = list(minhash.shingle_sets(pa.array(texts, pa.large_string()), 3))
    assert [a.tolist() for a in whole] == [b.tolist() for b in cut]
    assert [len(a) for a in cut] == [len(shingles(t, 3)) for t in texts]
