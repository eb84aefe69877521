"""Search keyword counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.fixed import KEYWORD_ITEM_TYPE, SEARCH_PAGE
from tidemart.functions.times import window_seconds
from tidemart.functions.tokens import words
from tidemart.operators.windows import bounds


def searches(pages: DataFrame) -> DataFrame:
    """``source, keyword, event_time`` of the pages reached by a keyword search."""
    hit = ((F.col("page.item_type") == KEYWORD_ITEM_TYPE)
           & (F.col("page.last_page_id") == SEARCH_PAGE))
    return pages.where(hit).select(F.col("page.last_page_id").alias("source"),
                                   F.col("page.item").alias("keyword"), "event_time")


def split_words(texts: DataFrame, text: str = "keyword",
                tokens: Callable[[Column], Column] = words) -> DataFrame:
    """One row per word of a text column; ``tokens`` gives an array of words."""
    kept = [c for c in texts.columns if c != text]
    return texts.select(*kept, F.explode(tokens(F.col(text))).alias("word"))


def keyword_totals(words_: DataFrame, size: str = "5 seconds") -> DataFrame:
    """Word count per window and source, with the window start in epoch seconds.

    Equal words are added up within each task before the shuffle, so a word that
    makes up a third of all text costs one row per task."""
    counted = (words_.groupBy(F.window("event_time", size).alias("_span"), "source", "word")
                     .agg(F.count("*").alias("keyword_count"))
                     .withColumn("ts", window_seconds(F.col("_span").start)))
    return bounds(counted, "_span").select(
        "stt", "edt", "source", F.col("word").alias("keyword"), "keyword_count", "ts")


def keyword_window(pages: DataFrame, size: str = "5 seconds",
                   tokens: Callable[[Column], Column] = words) -> DataFrame:
    return keyword_totals(split_words(searches(pages), tokens=tokens), size)
