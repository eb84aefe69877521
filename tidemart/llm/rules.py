"""Quality rules: base counts of a text, and how much more it looks like trusted text than
like the raw corpus.

Words and pairs of neighbouring words are hashed into buckets.  Two multinomials over the
buckets are counted, one over all documents and one over the trusted ones; a document's score
is the mean log ratio of their probabilities over its n-grams.  It is kept if the score is no
less than the score under which a share ``reject`` of the trusted documents lies.

Only DataFrame functions are used.  The bucket tables have ``buckets`` rows at any input, which
is the bound of what is broadcast.  Log ratios are whole multiples of 1e-6 and scores are
counted in steps of 1e-4, so that neither sums nor the threshold depend on the order of rows.

Defined results: a null text has no words; a text without words has score null and fails the
base rules; with no trusted document every document that passes the base rules is kept; equal
rows are judged alike; a trusted id that is listed twice counts once, and all rows of it are
trusted; a very long text is one row, whose arrays must fit in a task; an empty table gives
none.  Windows of three words are compared by 64-bit hashes.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import SPACES, let, numbered, text_mark, words
from tidemart.session import stored

BUCKETS = 1 << 16
REJECT = 0.01
SYMBOLS = "#*$%&|<>"
UNIT = 1_000_000
STEPS = 10_000
ID_BITS = 1 << 24


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeated_words(tokens: Column) -> Column:
    """Words that lie in a three-word window found twice or more, the first one included."""
    n = F.size(tokens)

    def of_windows(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), covered))

    def covered(pairs: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            def same(j):
                return F.coalesce(F.get(pairs, j)["h"] == x["h"], F.lit(False))
            return same(i - 1) | same(i + 1)
        places = F.sort_array(F.transform(F.filter(pairs, twice), lambda x: x["i"]))
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, b: a + b))

    def hashed(w: Column) -> Column:
        two = F.zip_with(w, F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
        three = F.zip_with(two, F.slice(w, F.lit(3), F.greatest(F.size(w) - 2, F.lit(0))), lambda a, b: F.xxhash64(a, b))
        return F.slice(three, F.lit(1), F.size(w) - 2)

    return F.when(n < 4, F.lit(0)).otherwise(let(let(tokens, hashed), of_windows)).cast("long")


def base_counts(text: Column) -> dict[str, Column]:
    """``word_chars, n_symbols, n_dup_lines`` of a text without nulls."""
    bare = without(text, SPACES)
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(without(x, SPACES)) > 0)
    return {"word_chars": F.length(bare).cast("long"),
            "n_symbols": (F.length(bare) - F.length(without(bare, SYMBOLS))).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")}


def ngram_buckets(tokens: Column, buckets: int) -> Column:
    """Buckets of all words and of all pairs of a word and the next; the last word's next
    is the end of the text."""
    def pairs(w: Column) -> Column:
        after = F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0)))
        return F.concat(F.transform(w, lambda a: F.pmod(F.xxhash64(a), F.lit(buckets)).cast("int")),
                        F.zip_with(w, after, lambda a, b: F.pmod(F.xxhash64(F.lit(2), a, b), F.lit(buckets)).cast("int")))
    return let(tokens, pairs)


def bitmap(ids: DataFrame, name: str) -> DataFrame:
    """``part, bits``: a bit for the hash of each id, in as many rows and bytes for any input."""
    bit = id_bit(F.col(name))
    return ids.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))


def id_bit(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(ID_BITS)) + 1


def may_be_in(docs: DataFrame, name: str, ids: DataFrame, inside: bool = True) -> DataFrame:
    """Rows of ``docs`` whose ``name`` has its bit set in :func:`bitmap`: all that are in ``ids`` and
    few others, as long as these are few against the bits; or else all other rows."""
    bits = F.broadcast(bitmap(ids, ids.columns[0]))  # at most ID_BITS bits
    bit = id_bit(docs[name])
    place = F.bitmap_bit_position(bit)
    found = docs.join(bits, F.bitmap_bucket_number(bit) == bits["part"], "left")
    byte = F.conv(F.hex(F.substring(bits["bits"], (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return found.where(hit if inside else ~hit).select(*[docs[c] for c in docs.columns])


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, ratio``: log of trusted over raw probability, each bucket counted once more
    than found, as a whole number of 1e-6.  Buckets that are not listed were never found.

    Only the texts that may be trusted, by a bitmap of fixed size, are shuffled to be joined with
    the ids; all others are counted where they are read.  One plan at any size.
    """
    ids = trusted.select(F.col("doc_id").alias("trusted_id")).where("trusted_id IS NOT NULL").distinct()
    texts = docs.select(docs["doc_id"].alias("of_id"), docs["text"].alias("words_of"))
    rest = may_be_in(texts, "of_id", ids, False).select("words_of", F.lit(0).cast("long").alias("target"))
    likely = may_be_in(texts, "of_id", ids).join(ids.hint("merge"), F.col("of_id") == F.col("trusted_id"), "left")
    flagged = likely.select("words_of", F.col("trusted_id").isNotNull().cast("long").alias("target"))

    def counted(rows: DataFrame) -> DataFrame:
        grams = rows.select("target", F.explode(ngram_buckets(words(F.col("words_of")), buckets)).alias("bucket"))
        return grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("target").alias("target"))
    counts = stored(counted(rest).unionByName(counted(flagged)).groupBy("bucket")
                    .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")), "rule-counts")
    raw, target = counts.agg(F.sum("raw"), F.sum("target")).first()
    if not target:
        return counts.select("bucket", F.lit(0).cast("long").alias("ratio"))
    ratio = (F.log((F.col("target") + 1) / F.lit(float(target + buckets)))
             - F.log((F.col("raw") + 1) / F.lit(float(raw + buckets))))
    return counts.select("bucket", F.round(ratio * UNIT).cast("long").alias("ratio"))


def threshold(scores: DataFrame, trusted: DataFrame, reject: float = REJECT) -> int | None:
    """The least step of score that leaves no more than a share of trusted documents below it.

    Scores lie between -log and +log of the number of n-grams, so their steps are few.
    """
    ids = trusted.select("doc_id").where("doc_id IS NOT NULL").distinct()
    steps = (scores.where("score IS NOT NULL AND NOT base_failed").join(ids, "doc_id", "left_semi")
             .groupBy(F.floor(F.col("score") * STEPS).alias("step")).count().orderBy("step").collect())
    below, total = 0, sum(r["count"] for r in steps)
    for r in steps:
        below += r["count"]
        if below > reject * total:
            return r["step"]
    return None


def judge(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS,
          reject: float = REJECT) -> DataFrame:
    """``doc_id, mark``, the base counts, ``base_failed, score, kept`` for every document."""
    ratios = F.broadcast(log_ratios(docs, trusted, buckets))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = numbered(docs, docs["doc_id"], docs["text"]).withColumn("tokens", words(text))
    measured = rows.select(
        "rid", "doc_id", text_mark(text).alias("mark"), F.size("tokens").cast("long").alias("n_words"),
        *[c.alias(n) for n, c in base_counts(text).items()],
        repeated_words(F.col("tokens")).alias("n_repeat_words"),
        ngram_buckets(F.col("tokens"), buckets).alias("grams"))
    base = ["mark", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    grams = measured.select("rid", "doc_id", *base, F.explode_outer("grams").alias("bucket"))
    scored = (grams.join(ratios, "bucket", "left").groupBy("rid")
              .agg(F.any_value("doc_id").alias("doc_id"), *[F.any_value(c).alias(c) for c in base],
                   F.sum("ratio").alias("total"), F.count("bucket").alias("grams")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scores = stored(scored.select("doc_id", *base, failed.alias("base_failed"),
                                  (F.col("total") / (F.col("grams") * UNIT)).alias("score")), "rule-scores")
    least = threshold(scores, trusted, reject)
    good = F.lit(True) if least is None else F.floor(F.col("score") * STEPS) >= least
    return scores.select("doc_id", *base, "base_failed",
                         (~F.col("base_failed") & F.coalesce(good, F.lit(False))).alias("kept"), "score")


def trusted_labels(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled good and not toxic."""
    return labels.where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id")
