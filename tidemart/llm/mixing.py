"""Mix sources to target weights by whole and one more, drawn, copies of their documents.

The tokens of each source are added up; a source's target is its share of all tokens by
weight, at most ``cap`` times what it has, and what a source cannot take goes to the others
by weight.  A document of a source with rate r is emitted floor(r) times and once more with
probability r - floor(r), decided by a hash of its id.

Defined results: a null source is a source of its own; a null text has no words; a document
without words is emitted at its source's rate, and not at all where the source has no words;
rows of one id are drawn alike; a null id is drawn as the text ``null``; an empty table gives
none.  Other columns pass through ``mix`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemart.llm.common import word_count
from tidemart.session import stored

SEED = 42
CAP = 3


def draw(key: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) that depends on the key and the seed only: 52 bits of an MD5."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))


def cycled(sources: DataFrame, weights: tuple[float, ...] = (1, 2, 3)) -> DataFrame:
    """Give sources weights in turn, by code point, null last.

    The rank comes from a sort over all tasks, not from one window.
    """
    schema = T.StructType([*sources.schema.fields, T.StructField("weight", T.DoubleType())])
    ranked = sources.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex()
    return sources.sparkSession.createDataFrame(
        ranked.map(lambda x: (*x[0], float(weights[x[1] % len(weights)]))), schema)


def targets(sources: DataFrame, cap: int = CAP) -> DataFrame:
    """Add ``target`` and ``rate`` to a stored table of source, source_size, weight.

    A level L gives each source min(cap * size, L * weight).  L starts at all tokens by all
    weights and rises as capped sources leave their excess to the rest; each step is one
    aggregate of two numbers, and a source once capped stays so.
    """
    most = F.lit(cap) * F.col("source_size")
    total, level = sources.agg(F.sum("source_size")).first()[0] or 0, 0.0
    before = None
    while True:
        capped = most <= F.lit(level) * F.col("weight") if before is not None else F.lit(False)
        n, full, weight = sources.agg(F.count_if(capped), F.sum(F.when(capped, most)),
                                      F.sum(F.when(~capped, F.col("weight")))).first()
        if n == before or not weight:
            break
        before, level = n, (total - (full or 0)) / weight
    target = F.least(most.cast("double"), F.lit(level) * F.col("weight"))
    if before is not None and n != before:  # every source is capped
        target = most.cast("double")
    rate = F.when(F.col("source_size") > 0, F.least(target / F.col("source_size"), F.lit(float(cap))))
    return sources.withColumns({"target": target, "rate": F.coalesce(rate, F.lit(0.0))})


def source_table(sized: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: int = CAP) -> DataFrame:
    """Rates by source from rows of ``source`` and ``size``."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return targets(stored(cycled(sums, weights), "mix-sources"), cap)


def with_copies(sized: DataFrame, rates: DataFrame, key: str, seed: int = SEED) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows that have ``source``."""
    rates = rates.select(F.col("source").alias("mix_source"), "source_size", "target", "rate")
    whole = F.floor("rate")
    more = (draw(F.col(key), seed) < F.col("rate") - whole).cast("long")
    return (sized.join(rates, F.col("source").eqNullSafe(F.col("mix_source")))
            .withColumn("copies", whole + more).drop("mix_source", "rate"))


def decisions(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: int = CAP,
              seed: int = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies`` for every document."""
    sized = stored(docs.select("doc_id", "source", word_count(docs["text"]).alias("size")), "mix-sizes")
    return with_copies(sized, source_table(sized, weights, cap), "doc_id", seed).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"),
        (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), cap: int = CAP,
        seed: int = SEED) -> DataFrame:
    """The mixed documents: each row as often as the mix takes it, columns unchanged."""
    rates = source_table(docs.select("source", word_count(docs["text"]).alias("size")), weights, cap)
    row = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source")
    copies = with_copies(row, rates, "doc_id", seed).where("copies > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source COLLATE "BINARY" NULLS LAST) - 1) % 3 AS weight FROM sums),
ranked AS (
  SELECT *, 3 * source_size / weight AS need,
         sum(3 * source_size) OVER w AS full_below, sum(weight) OVER w AS weight_below
  FROM weighed
  WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
totals AS (SELECT sum(source_size) AS total, sum(weight) AS weights FROM weighed),
levels AS (
  SELECT need, (total - full_below)::DOUBLE / nullif(weights - weight_below, 0) AS level, full_below
  FROM ranked, totals
  UNION ALL SELECT 0, total::DOUBLE / weights, 0 FROM totals),
level AS (
  SELECT level FROM levels WHERE need <= level
    AND NOT EXISTS (SELECT 1 FROM ranked r WHERE r.need > levels.need AND r.need <= levels.level)
  ORDER BY need LIMIT 1),
rates AS (
  SELECT source, source_size, least(3 * source_size::DOUBLE, level * weight) AS target FROM weighed, level)
SELECT doc_id, size, source_size, round(target, 6) AS target,
       copies * size AS taken, copies
FROM (
  SELECT doc_id, size, source_size, target, CAST(floor(rate) AS BIGINT) + CASE WHEN
           ('0x' || left(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 13))::BIGINT::DOUBLE / 16::DOUBLE ** 13
           < rate - floor(rate) THEN 1 ELSE 0 END AS copies
  FROM (SELECT s.doc_id, s.size, r.source_size, r.target,
               CASE WHEN r.source_size > 0 THEN least(r.target / r.source_size, 3.0::DOUBLE) ELSE 0 END AS rate
        FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source))
"""
