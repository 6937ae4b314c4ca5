import os
import re
from pathlib import Path

import pytest

from martwright.llm.common import ship

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def shingles(text, words):
    own = WORD.findall((text or "").translate(UPPER))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1)))


def components_by_brute_force(texts, words, percent):
    """``{id: (set size, component)}`` from all pairs that share a shingle."""
    sets = {i: shingles(t, words) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def as_rows(df, *columns):
    return [tuple(row) for row in df.select(*columns).collect()]
