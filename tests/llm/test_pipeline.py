"""The pipeline as a whole: each stage on what its predecessor kept, against plain versions."""

import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tidemart.llm import packing, quality, rules
from tidemart.session import stored


@pytest.fixture(scope="module")
def frames(spark, small):
    """The documents, with columns that could clash, and what each stage makes of them."""
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumns(
        {"row_name": F.lit("a"), "simhash_name": F.lit("b"), "name": F.lit("c"), "mark": F.lit(1), "kept": F.lit("d")})
    docs = docs.unionByName(docs.where("doc_id % 7 = 0"))   # repeated rows
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], small), "test-stage"))
    return out


def ids(df):
    return collections.Counter(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay_but_in_the_last_stage(frames):
    assert all(f.columns == frames[0].columns for f in frames[1:-1])
    assert {(r.row_name, r.simhash_name, r.name, r.mark, r.kept) for r in frames[4].collect()} == {("a", "b", "c", 1, "d")}


def test_quality_classifier_keeps_its_verdicts(spark, small, frames):
    trusted = rules.trusted_labels(spark.read.parquet(f"{small}/labels.parquet"))
    verdicts = {r.doc_id: r.kept for r in quality.judge(frames[0], trusted).collect()}
    assert ids(frames[1]) == collections.Counter({i: n for i, n in ids(frames[0]).items() if verdicts[i]})


def test_quality_rules_keep_what_the_plain_ratio_keeps(spark, small, frames):
    docs = frames[1].collect()
    trusted = {r.doc_id for r in rules.trusted_labels(spark.read.parquet(f"{small}/labels.parquet")).collect()}
    wanted = brute.kept_by_ratio([(r.doc_id, r.text) for r in docs], trusted, rules.BUCKETS, rules.REJECT)
    assert ids(frames[2]) == collections.Counter(r.doc_id for r, kept in zip(docs, wanted) if kept)


def test_one_document_of_each_group_stays(frames):
    texts = {r.doc_id: r.text for r in frames[2].collect()}
    prints = {i: brute.fingerprint(t) for i, t in texts.items()}
    linked = [(a, b) for a in texts for b in texts if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    roots = brute.components(sorted(texts), linked)
    assert ids(frames[3]) == collections.Counter({i: 1 for i in set(roots.values())})


def test_mixing_repeats_within_bounds(frames):
    before, after = ids(frames[3]), ids(frames[4])
    assert set(after) <= set(before) and max(after.values()) <= 3
    sizes = collections.Counter()
    mixed = collections.Counter()
    for df, into in ((frames[3], sizes), (frames[4], mixed)):
        for r in df.collect():
            into[r.source] += len(brute.words(r.text))
    sources = sorted(sizes)
    wanted = brute.targets([sizes[s] for s in sources], [1 + n % 3 for n in range(len(sources))])
    longest = max(len(brute.words(r.text)) for r in frames[3].collect())
    assert all(abs(mixed[s] - w) <= 0.35 * w + 2 * longest for s, w in zip(sources, wanted))


def test_every_copy_is_packed_once(frames):
    assert ids(frames[5]) == ids(frames[4])
    assert {c for c in packing.pack(frames[4].limit(0)).columns} == set(frames[5].columns)


def test_run_is_its_stages(spark, small):
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    assert corpus_pipeline.run(spark, small).count() > 0


def test_empty_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, small), "test-empty")
        assert docs.count() == 0
