"""Keyword tokenisers, as array columns and as a table function."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F
from pyspark.sql.functions import udtf

WORD = r"[\p{L}\p{N}]+"
CJK = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]"


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def cjk_bigrams(text: Column) -> Column:
    """Letter and digit runs, with each run of Chinese or Japanese script replaced
    by its overlapping two-character pieces (a single character stays as it is)."""
    runs = F.regexp_extract_all(
        F.lower(text), F.lit(rf"{CJK}+|(?:(?!{CJK})[\p{{L}}\p{{N}}])+"), F.lit(0))

    def pieces(run: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(1), F.length(run) - 1),
                            lambda i: F.substring(run, i, F.lit(2)))
        return F.when(run.rlike(CJK) & (F.length(run) > 1), pairs).otherwise(F.array(run))

    return F.flatten(F.transform(runs, pieces))


@udtf(returnType="word string", useArrow=True)
class SplitWords:
    """Table function form for ``lateralJoin`` and SQL ``LATERAL``.

    The column form above stays inside the JVM and is what the jobs use; this one
    is the hook for a tokeniser that exists only in Python.
    """

    def eval(self, keyword: str):
        for word in re.findall(r"[^\W_]+", (keyword or "").lower()):
            yield (word,)
