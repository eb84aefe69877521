"""Pack documents into batches of like length under a token budget.

Lengths go into one global histogram; dynamic programming over it picks the bucket bounds
that waste the fewest tokens when every document is padded to its bucket's bound.  Inside a
bucket, documents in hash order fill batches of ``budget // bound`` rows.

The histogram has one bin for each length up to 256 and 32 bins for each doubling beyond,
about 2,000 at most, so it fits the driver at any input.  Bounds are optimal among the ends of
bins, each the longest length found in its bin.

Defined results: null and empty texts have length 0 and are packed like any other; a text
longer than the budget is a batch of its own; equal rows are packed one by one; an empty
table gives none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.llm.common import numbered, word_count
from tidemart.session import stored

EXACT = 256
PER_DOUBLING = 32


def bin_of(length: Column) -> Column:
    """Number of a length's bin; longer texts have a higher bin or the same."""
    return F.when(length <= EXACT, length).otherwise(
        EXACT + F.ceil(F.log2(length / EXACT) * PER_DOUBLING)).cast("int")


def best_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` bounds out of ascending lengths with the least padded total.

    ``best[j]`` is the least padded total of the first j bins; a bucket of bins i..j-1 costs
    its longest length times its documents.
    """
    tops, below = np.array(lengths, dtype=float), np.concatenate([[0.0], np.cumsum(counts, dtype=float)])
    m = len(tops)
    cost = tops[None, :] * (below[None, 1:] - below[:-1, None])  # [first bin, last bin]
    cost[np.tril_indices(m, -1)] = np.inf
    best, cuts = cost[0].copy(), [np.zeros(m, dtype=int)]
    for _ in range(min(buckets, m) - 1):
        total = np.concatenate([[0.0], best[:-1]])[:, None] + cost
        cuts.append(total.argmin(axis=0))
        best = total.min(axis=0)
    bounds, last = [], m - 1
    for cut in reversed(cuts):
        bounds.append(int(tops[last]))
        if cut[last] == 0:
            break
        last = cut[last] - 1
    return bounds[::-1]


def pack(docs: DataFrame, buckets: int = 16, budget: int = 16_384, group_rows: int = 4_096) -> DataFrame:
    """``doc_id, n_tokens, bucket, batch, slot, padding`` for every document.

    ``bucket`` is the padded length, ``batch`` counts inside the bucket.  A bucket is dealt by
    hash into groups of about ``group_rows`` rows; ranks inside a group plus the sizes of the
    groups before it give ranks in the bucket, so no task holds a whole bucket.
    """
    spark = docs.sparkSession
    sized = stored(numbered(docs, docs["doc_id"], word_count(docs["text"]).alias("n_tokens")), "pack-sizes")
    histogram = (sized.groupBy(bin_of(F.col("n_tokens")).alias("bin"))
                 .agg(F.max("n_tokens").alias("top"), F.count("*").alias("n")).orderBy("bin").collect())
    if not histogram:
        return spark.createDataFrame([], "doc_id long, n_tokens long, bucket long, batch long, slot long, padding long")
    bounds = best_bounds([r.top for r in histogram], [r.n for r in histogram], buckets)
    held = [sum(r.n for r in histogram if low < r.top <= high)
            for low, high in zip([-1, *bounds], bounds)]
    bucket = F.coalesce(*[F.when(F.col("n_tokens") <= b, F.lit(b).cast("long")) for b in bounds])
    groups = F.coalesce(*[F.when(F.col("bucket") == b, F.lit(-(-n // group_rows))) for b, n in zip(bounds, held)])
    spread = F.xxhash64("doc_id", "n_tokens", "rid")
    dealt = (sized.withColumn("bucket", bucket).withColumn("mark", spread)
             .withColumn("dealt", F.pmod("mark", groups)))
    inside = Window.partitionBy("bucket", "dealt").orderBy("mark", "doc_id", "rid")
    before = Window.partitionBy("bucket").orderBy("dealt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (dealt.groupBy("bucket", "dealt").count()
              .select("bucket", "dealt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")))
    ranked = dealt.withColumn("place", F.row_number().over(inside) - 1).join(starts, ["bucket", "dealt"])
    rows = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.col("bucket"), F.lit(1))))
    place = F.col("start") + F.col("place")
    return ranked.select("doc_id", "n_tokens", "bucket", F.floor(place / rows).alias("batch"),
                         (place % rows).alias("slot"), (F.col("bucket") - F.col("n_tokens")).alias("padding"))
