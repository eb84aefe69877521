"""Mixing, packing, rules and SimHash against plain versions, on edge rows and test tables."""

import itertools

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemart.llm import mixing, packing, queries, rules, simhash
from tidemart.llm.graph import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept int"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
TEXTS = [None, "", " \t\n", "one", "One  two\nthree\x0bfour\x0cfive\r\nsix", "a | b # c\n\na | b # c\n a",
         "be it as it was be it as it was " * 12, "zwölf Öfen 日本 😀 " * 30, LONG, LONG + " end",
         "same text here " * 3, "same text here " * 3, "x\x00y z w"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, 0, "clash", 1) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None, "no id", None, None, None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def table(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, j) for j in range(60, 99)] + [(7, 7), (50, 3), (3, 50)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges for n in e}
    assert found == brute.components(nodes, edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_triples_cover_every_four_positions():
    triples = simhash.triples()
    assert len(triples) == 20
    assert all(any(set(t) <= set(four) for t in triples) for four in itertools.combinations(range(8), 4))


@pytest.mark.parametrize("tile", [3, 8_192])
def test_links_equal_all_pairs(spark, tile):
    import random
    rng = random.Random(5)
    prints = {0}
    for _ in range(40):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(rng.choice([1, 2, 40])):
            prints.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))))
    prints |= {1, 7, 15, 31}
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    pairs = [(a, b) for a, b in itertools.combinations(signed, 2) if (signed[a] ^ signed[b]).bit_count() <= 4]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    found = {r.node: r.root for r in components(simhash.links(frame, tile)).collect()}
    whole = brute.components(signed, pairs)
    assert {n: found.get(n, n) for n in signed} == whole


def test_simhash_matches_all_pairs(docs, table):
    for frame in (docs, table):
        rows = frame.select("doc_id", "text").collect()
        prints = {}
        for r in rows:
            prints[(r.doc_id, r.text)] = brute.fingerprint(r.text)
        keys = list(prints)
        root = brute.components(range(len(keys)), [
            (i, j) for i, j in itertools.combinations(range(len(keys)), 2)
            if (prints[keys[i]] ^ prints[keys[j]]).bit_count() <= 4])
        least = {}
        for i, (doc, _) in enumerate(keys):
            if doc is not None:
                least[root[i]] = min(doc, least.get(root[i], doc))
        expected = sorted((str(k[0]), f"{prints[k]:016x}", str(least.get(root[keys.index(k)])))
                          for k in [(r.doc_id, r.text) for r in rows])
        found = sorted((str(r.doc_id), r.fingerprint, str(r.component_id))
                       for r in simhash.near_duplicates(frame).collect())
        assert found == expected


def test_one_of_each(docs):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    classes = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, classes))
    assert simhash.one_of_each(docs.limit(0)).count() == 0


def test_rules_base_counts(docs, table):
    trusted = table.select("doc_id").where("doc_id % 2 = 0")
    for frame in (docs, table):
        texts = sorted((str(r.doc_id), str(brute.base_counts(r.text))) for r in frame.collect())
        names = list(brute.base_counts(""))
        judged = rules.judge(frame, trusted, buckets=512).collect()
        assert sorted((str(r.doc_id), str({n: r[n] for n in names})) for r in judged) == texts
        assert not any(r.kept for r in judged if r.base_failed)


def test_rules_scores(spark, docs, table):
    """Scores and threshold by plain counting with the same buckets."""
    import math
    from collections import Counter
    buckets = 512
    good = {r.doc_id for r in rules.trusted_labels(spark.read.parquet(
        table.inputFiles()[0].replace("documents", "labels"))).collect()}
    trusted = spark.createDataFrame([(i,) for i in [*good, min(good), None]], "doc_id long")
    grams = {r.doc_id: r.g for r in table.select(
        "doc_id", rules.ngram_buckets(rules.words(F.col("text")), buckets).alias("g")).collect()}
    raw, target = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in good:
            target.update(g)
    ratio = {b: round(1e6 * (math.log((target[b] + 1) / (target.total() + buckets))
                             - math.log((raw[b] + 1) / (raw.total() + buckets)))) for b in raw}
    judged = {r.doc_id: r for r in rules.judge(table, trusted, buckets).collect()}
    for i, g in grams.items():
        if g:
            assert judged[i].score == pytest.approx(sum(ratio[b] for b in g) / len(g) / 1e6, abs=1e-6)
    steps = sorted(math.floor(judged[i].score * rules.STEPS) for i in good
                   if i in judged and not judged[i].base_failed)
    least = next(s for s in steps if sum(x <= s for x in steps) > rules.REJECT * len(steps))
    assert {i for i, r in judged.items() if r.kept} == {
        i for i, r in judged.items() if not r.base_failed and math.floor(r.score * rules.STEPS) >= least}


def test_rules_without_trusted_or_documents(docs):
    nobody = docs.select("doc_id").limit(0)
    assert all(r.kept != r.base_failed for r in rules.judge(docs, nobody).collect())
    assert rules.judge(docs.limit(0), nobody).count() == 0


def test_rules_plan_is_native(docs):
    plan = rules.judge(docs, docs.select("doc_id"), 64)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_mixing_targets(docs, table):
    for frame in (docs, table):
        rows = mixing.decisions(frame).collect()
        source = {(r.doc_id, r.text): r.source for r in frame.collect()}
        sizes = {}
        for r in frame.collect():
            sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
        order = sorted(sizes, key=lambda s: (s is None, s or ""))
        goal = dict(zip(order, brute.targets([sizes[s] for s in order], [i % 3 + 1 for i in range(len(order))])))
        by_id = {i: s for (i, _), s in source.items()}
        for r in rows:
            s = by_id[r.doc_id]
            assert r.source_size == sizes[s] and r.target == pytest.approx(goal[s], abs=1e-3)
            assert r.taken == r.copies * r.size and r.copies <= 3
            rate = r.target / r.source_size if r.source_size else 0
            assert rate - 1 - 1e-9 < r.copies < rate + 1 + 1e-9
        assert sorted(map(str, rows)) == sorted(map(str, mixing.decisions(frame).collect()))


def test_mixing_caps_and_reshares(spark):
    rows = [(i, "w " * (2 if i % 9 == 0 else 40), "a" if i % 9 == 0 else f"b{i % 4}") for i in range(180)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.source_size: r.target for r in mixing.decisions(frame).collect()}
    assert found[40] == 40 or found[40] <= 120
    assert max(t / s for s, t in found.items()) <= 3
    by = {}
    for r, (_, _, s) in zip(sorted(mixing.decisions(frame).collect()), sorted(rows)):
        by[s] = r.target
    assert sum(by.values()) == pytest.approx(sum(len(t.split()) for _, t, _ in rows), abs=1e-3)


def test_mix_emits_copies(docs):
    taken = {}
    for r in mixing.decisions(docs).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.copies
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    found = {}
    for r in mixed.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + 1
    assert found == {i: n for i, n in taken.items() if n}
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.decisions(docs.limit(0)).count() == 0


def test_best_bounds_are_optimal():
    lengths, counts = [1, 3, 4, 9, 10, 30, 31, 80], [5, 1, 9, 2, 7, 1, 3, 2]

    def padded(bounds):
        return sum(n * min(b for b in bounds if b >= x) for x, n in zip(lengths, counts))
    for k in range(1, 10):
        best = min(padded([*some, lengths[-1]]) for m in range(k) for some in itertools.combinations(lengths[:-1], m))
        bounds = packing.best_bounds(lengths, counts, k)
        assert len(bounds) <= k and padded(bounds) == best


@pytest.mark.parametrize("group_rows", [7, 4_096])
def test_pack_fills_batches(docs, table, group_rows):
    for frame in (docs, table):
        rows = packing.pack(frame, buckets=6, budget=2_048, group_rows=group_rows).collect()
        assert sorted(str((r.doc_id, r.n_tokens)) for r in rows) == sorted(
            str((r.doc_id, len(brute.words(r.text)))) for r in frame.collect())
        batches = {}
        for r in rows:
            assert r.padding == r.bucket - r.n_tokens >= 0
            batches.setdefault((r.bucket, r.batch), []).append(r.slot)
        last = {}
        for (bucket, batch), slots in batches.items():
            assert sorted(slots) == list(range(len(slots)))
            room = max(1, 2_048 // max(1, bucket))
            assert len(slots) <= room
            last.setdefault(bucket, []).append((batch, len(slots) == room))
        for filled in last.values():
            assert [b for b, _ in sorted(filled)] == list(range(len(filled)))
            assert all(full for _, full in sorted(filled)[:-1])
    assert packing.pack(docs.limit(0)).count() == 0


def test_words_agree_with_split(spark, docs):
    found = [r.n for r in docs.select(mixing.word_count(docs["text"]).alias("n"), "doc_id").orderBy("doc_id").collect()]
    assert sorted(found) == sorted(len(brute.words(r.text)) for r in docs.collect())


def test_queries_read_whole_tables(spark, small):
    n = spark.read.parquet(f"{small}/documents.parquet").count()
    for name in ("op4_length_buckets", "op6_quality_rules", "op9_mixing", "op10_simhash"):
        assert queries.QUERIES[name](spark, small).count() == n
