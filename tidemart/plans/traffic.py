"""Log splitting and the traffic jobs.

A page log has the columns ``common`` (mid, uid, vc, ch, ar, is_new), ``page``
(page_id, last_page_id, item, item_type, during_time), ``ts`` (epoch ms) and
``event_time``; further columns pass through.  ``ties`` names columns that order
rows of one visitor with equal times.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.fixed import DETAIL_PAGE, HOME_PAGE
from tidemart.operators import parse
from tidemart.operators.bounce import bounces
from tidemart.operators.keyed import daily_first, first_times, fix_is_new
from tidemart.operators.windows import windowed

_IS_ENTRY = "page.last_page_id is null"
VISIT_KEYS = ("vc", "ch", "ar", "is_new")
MEASURES = ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")


def split_log(lines: DataFrame, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Log lines (``value``) to ``route, value``: ``start``, ``page``, ``display``,
    ``action``, ``error`` and ``dirty``.

    The new-visitor flag is corrected on the way.  Besides lines that are no JSON
    object, a record without a device id, or with neither a start nor a page part,
    is a dead letter.  The correction reads the keys of the log several times, so
    ``store`` may write them out beside the lines (see ``session.stored``) and spare
    parsing the lines again.
    """
    keyed = log_records(lines)
    keyed = store(keyed) if store else keyed
    usable = keyed.where("usable").drop("usable")
    fixed = fix_is_new(usable, "mid", "is_new", "event_time", ["value"])
    dirty = keyed.where("not usable").select(F.lit("dirty").alias("route"), "value")
    return corrected_routes(fixed).unionByName(dirty)


def log_records(lines: DataFrame) -> DataFrame:
    """``value, mid, is_new, event_time`` and whether the line is a usable record."""
    frame = parse.parsed(lines.select("value"))
    return frame.select("value", *parse.log_keys(), parse.is_usable().alias("usable"))


def corrected_routes(fixed: DataFrame) -> DataFrame:
    """Write the corrected flag into the records that it changed, and route them."""
    records = parse.parsed(fixed)
    stale = ~F.col("is_new").eqNullSafe(parse.field("common.is_new"))
    return parse.routes(records.withColumn("_doc", F.when(
        stale, parse.with_flag(F.col("is_new"))).otherwise(F.col("_doc"))))


def entries(pages: DataFrame) -> DataFrame:
    """Pages that no other page led to."""
    return pages.where(_IS_ENTRY)


def uv_detail(pages: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """First entry page of each device per day."""
    with_mid = entries(pages).withColumn("_mid", F.col("common.mid"))
    return daily_first(with_mid, ["_mid"], "event_time", ties, day="_day").drop("_mid", "_day")


def bounce_detail(pages: DataFrame, within: str = "10 seconds",
                  ties: Sequence[str] = ()) -> DataFrame:
    """Entry pages after which the visitor left."""
    with_mid = pages.withColumn("_mid", F.col("common.mid"))
    return bounces(with_mid, "_mid", "event_time", F.expr(_IS_ENTRY), within, ties).drop("_mid")


def _measures(frame: DataFrame, **values: Column) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return frame.select("event_time", *[F.col(f"common.{k}").alias(k) for k in VISIT_KEYS],
                        *[values.get(m, zero).cast("bigint").alias(m) for m in MEASURES])


def page_view_measures(pages: DataFrame, uv: DataFrame, uj: DataFrame) -> DataFrame:
    """One measure row per page, unique visitor and bounce, in one frame."""
    return (page_measures(pages).unionByName(_measures(uv, uv_ct=F.lit(1)))
                                .unionByName(_measures(uj, uj_ct=F.lit(1))))


def page_measures(pages: DataFrame) -> DataFrame:
    """The measures that follow from the pages alone."""
    is_entry = F.when(F.expr(_IS_ENTRY), 1).otherwise(0)
    return _measures(pages, sv_ct=is_entry, pv_ct=F.lit(1), dur_sum=F.col("page.during_time"))


def page_view_window(pages: DataFrame, uv: DataFrame, uj: DataFrame,
                     size: str = "10 seconds") -> DataFrame:
    """Visitors, sessions, page views, time spent and bounces by version, channel,
    area and new-visitor flag."""
    return page_view_totals(page_view_measures(pages, uv, uj), size)


def page_view_totals(measures: DataFrame, size: str = "10 seconds") -> DataFrame:
    return windowed(measures, "event_time", size,
                    [F.sum(m).alias(m) for m in MEASURES], VISIT_KEYS)


def home_detail_window(pages: DataFrame, size: str = "3 seconds") -> DataFrame:
    """Daily unique visitors of the home page and of the product page."""
    return home_detail_totals(first_times(home_and_detail(pages), ["mid", "page_id"], "event_time"), size)


def home_and_detail(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("page.page_id").isin(HOME_PAGE, DETAIL_PAGE)).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "event_time")


def home_detail_totals(firsts: DataFrame, size: str) -> DataFrame:
    return windowed(firsts, "event_time", size, [
        F.count_if(F.col("page_id") == HOME_PAGE).alias("home_uv_ct"),
        F.count_if(F.col("page_id") == DETAIL_PAGE).alias("good_detail_uv_ct")])
