import random
import re

import pytest
from pyspark.sql import functions as F

from martwright.functions import title_case, title_case_columns

from .conftest import plan_text


def model(value):
    """The rules over lists of words and hyphen pieces."""
    text = " ".join(word.capitalize() for word in (value or "").split())
    pieces = text.split("-")
    if len(pieces) > 1:
        text = "-".join(piece.capitalize() for piece in pieces)
    prefixed = re.fullmatch("(.'|Mc)(.)(.*)", text, re.DOTALL)
    if prefixed:
        start, third, rest = prefixed.groups()
        text = f"{start}{third.upper()}{rest}"
    return None if value is None else text


EDGES = {
    None: None,
    "": "",
    " ": "",
    "x": "X",
    "O'": "O'",
    "MC": "Mc",
    "O'BRIEN": "O'Brien",
    "MCGREGOR": "McGregor",
    "BLACK HAWK": "Black Hawk",
    "  two   blanks ": "Two Blanks",
    "tab\there": "Tab Here",
    "no break": "No Break",
    "file\x1cseparator": "File Separator",
    "HY-VEE FOOD STORE / CEDAR": "Hy-Vee food store / cedar",
    "4-NOT SPECIFIED": "4-Not specified",
    "a-": "A-",
    "-": "-",
    "ǆx": "ǅx",
    "straße": "Straße",
    "ß-ß": "Ss-Ss",
    "ΟΔΟΣ ΑΣ": "Οδος Ας",
    "MC'X": "Mc'x",
    "O'-BRIEN": "O'-Brien",
    "say MCGREGOR": "Say Mcgregor",
}


def titled(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v string").repartition(8)
    found = dict(df.select("id", title_case(F.col("v"))).collect())
    return [found[i] for i in range(len(values))]


def test_edges(spark):
    assert titled(spark, list(EDGES)) == list(EDGES.values())


def test_edges_agree_with_model():
    assert {value: model(value) for value in EDGES} == EDGES


@pytest.mark.parametrize(
    "alphabet",
    [
        "abXY  --''McMC.",
        "aB c-'\t\n\x0b\x1c\x1d\x1e\x1f\x85\xa0     　​",
        "éÉßǆǅǄŉİıσςΣﬁA b-'😀ʼնք",
    ],
)
def test_random_text_agrees_with_model(spark, alphabet):
    random.seed(7)
    values = ["".join(random.choices(alphabet, k=random.randint(0, 14))) for _ in range(20000)]
    wrong = [(v, model(v), t) for v, t in zip(values, titled(spark, values)) if model(v) != t]
    assert wrong == []


def test_columns_stay_in_the_jvm(spark):
    df = spark.createDataFrame([("A B", "c-d", 1)], "x string, y string, z int")
    result = title_case_columns(df, ["x", "y"])
    assert result.columns == ["x", "y", "z"]
    assert result.first() == ("A B", "C-D", 1)
    assert "Python" not in plan_text(result)
