"""Title-casing of names, as plain Column expressions (no Python worker).

Rules, in order:
1. runs of white space become one blank, outer blanks vanish, each word is capitalised;
2. if a hyphen remains, the value is capitalised again with the hyphen as the only word
   separator, so ``HY-VEE FOOD STORE`` becomes ``Hy-Vee food store``;
3. after a leading ``X'`` or ``Mc`` the third character is upper-cased.
NULL stays NULL and empty text stays empty. Values too short for rule 3 are left as they are.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode white space and the separators \x1c-\x1f. Without (?U), \s is ASCII only.
_BLANKS = r"(?U)[\s\x1c-\x1f]+"


def _capitalise_words(value: Column) -> Column:
    return F.initcap(F.trim(F.regexp_replace(value, _BLANKS, " ")))


def _capitalise_hyphen_pieces(value: Column) -> Column:
    # initcap starts a word after each blank. Swapping blanks and hyphens makes the
    # hyphen that separator, without splitting into an array.
    def swap(text: Column) -> Column:
        return F.translate(text, " -", "- ")

    pieces = swap(F.initcap(swap(value)))
    return F.when(F.contains(value, F.lit("-")), pieces).otherwise(value)


def _raise_third_letter(value: Column) -> Column:
    raised = F.concat(
        F.substring(value, 1, 2), F.upper(F.substring(value, 3, 1)), F.substr(value, F.lit(4))
    )
    prefixed = (F.substring(value, 2, 1) == "'") | F.startswith(value, F.lit("Mc"))
    return F.when(prefixed, raised).otherwise(value)


def title_case(value: Column) -> Column:
    """Title-case one value."""
    return _raise_third_letter(_capitalise_hyphen_pieces(_capitalise_words(value)))


def title_case_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Title-case several columns of a frame.

    All columns go into one projection. Spark moves their repeated parts into functions of
    their own, which keeps the generated code below the size the JVM refuses to compile;
    one projection per rule was twice as slow for seven columns.
    """
    return df.withColumns({name: title_case(F.col(name)) for name in columns})
