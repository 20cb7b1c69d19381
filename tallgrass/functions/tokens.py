"""Token expressions over a line of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the word statistics.
MAX_WORDS_PER_LINE = 40
DEFAULT_THRESHOLD = 1
MARGINAL_MARK = "*"


def tokenize(text: str | Column, letters: str = "a-z") -> Column:
    """Lower-cased words between white space, cut at their first and last letter.

    ``letters`` is the inside of a regular-expression character class. One
    pattern finds a word from its first letter to its last one, so the whole
    function is a single compiled expression.
    """
    word = rf"[{letters}](?:[^ \t\n\x0B\f\r]*[{letters}])?"
    return F.regexp_extract_all(F.lower(text), F.lit(word), F.lit(0))


def explode_once(table: DataFrame, items: Column, *names: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per item, as ``names`` = item or position and item; ``keep`` stays.

    Below a plain ``explode`` the optimizer adds a filter on the array's size
    and evaluates the array a second time for it. The outer form has no such
    filter; its null rows are dropped here.
    """
    explode = F.explode_outer if len(names) == 1 else F.posexplode_outer
    return table.select(*keep, explode(items).alias(*names)).filter(F.col(names[-1]).isNotNull())


def stretch_count(tokens: str | Column, max_words: int = MAX_WORDS_PER_LINE) -> Column:
    """How many stretches of ``max_words`` tokens a line has; a blank line is one."""
    return F.greatest(F.ceil(F.size(tokens) / F.lit(max_words)), F.lit(1)).cast("int")


def stretches(tokens: str, max_words: int = MAX_WORDS_PER_LINE) -> Column:
    """The different words of each consecutive stretch of ``max_words`` tokens."""
    numbers = F.sequence(F.lit(0), stretch_count(tokens, max_words) - 1)
    return F.transform(numbers, lambda i: F.array_distinct(F.slice(tokens, i * max_words + 1, F.lit(max_words))))
