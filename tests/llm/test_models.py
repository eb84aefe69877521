"""Toxicity, class bigrams, token counts, vectors and chat turns against plain versions."""

import hashlib
import json
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.llm import brute
from tidemart.llm import chat, classes, queries, toxicity, trie, vectors

TEXTS = [None, "", " \t\n", "One two TWO three", "😀 Öfen 日本", "x" * 3_000, "same text", "same text", "a\x00b c"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "clash", 1, 2) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None, "no id", None, None, None, None)],
                                 "doc_id long, text string, lang string, word string, n int, rid int")


@pytest.fixture(scope="module")
def table(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


# Token counts


def plain_tokens(token, scores):
    """Best (score, fewest tokens) segmentation of one pre-token."""
    raw = token.encode()
    best = [(0, 0)] + [None] * len(raw)
    for end in range(1, len(raw) + 1):
        best[end] = max((best[begin][0] + scores[raw[begin:end]], best[begin][1] - 1)
                        for begin in range(max(0, end - 140), end) if raw[begin:end] in scores)
    return -best[-1][1], best[-1][0]


@pytest.mark.parametrize("nodes, terminals", [(400_000, 1_000_000), (50, 3)])
def test_trie_matches_plain_segmentation(monkeypatch, table, nodes, terminals):
    monkeypatch.setattr(trie, "MOST_NODES", nodes)
    monkeypatch.setattr(trie, "MOST_TERMINALS", terminals)
    scores = trie.read_vocabulary()
    find = trie.regex.compile(trie.PRE_TOKEN).findall
    shared = trie.Trie(trie.piece_trie(scores))
    for text in [*(t or "" for t in TEXTS), *(r.text or "" for r in table.limit(15).collect())]:
        tokens = find(text)
        counted = [plain_tokens(t, scores) for t in tokens]
        assert "".join(tokens) == text
        assert shared.count(Counter(tokens)) == (sum(n for n, _ in counted), sum(s for _, s in counted))


def test_token_counts_of_odd_rows(docs):
    rows = trie.token_counts(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.n_tokens == 0 and r.log_prob == 0 for r in rows if r.doc_id in (0, 1))
    assert trie.token_counts(docs.limit(0)).count() == 0


# Class bigrams


def test_class_scores_match_plain_counts(docs, table):
    for frame in (docs, table):
        texts = [(r.doc_id, (r.text or "").encode().lower().split() + [b""]) for r in frame.select("doc_id", "text").collect()]
        out = {i: zlib.crc32(("null" if i is None else str(i)).encode()) % 10 == 0 for i, _ in texts}
        counts = Counter(w for i, words in texts if not out[i] for w in words)
        n, v = counts.total(), len(counts)
        expected = sorted((str(i), out[i], len(w), sum(x in counts for x in w), n,
                           round(sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 6)) for i, w in texts)
        rows = classes.judge(frame, frequent=500, classes=8, rounds=2).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                      for r in rows) == expected
        assert all(math.isfinite(r.score) and r.perplexity > 0 for r in rows)


def test_class_model_adds_up_and_beats_words(table):
    rows = classes.numbered(table, table["doc_id"], table["text"])
    model = classes.train(rows, frequent=500, classes=8, rounds=2)
    sent, square_size = model["sent"], classes.SPELLED + 1 + 8
    # Words by class: known words and one unknown word in each spelled class.
    mass = np.zeros(square_size)
    for word, i in sent["frequent"].items():
        mass[sent["class_of"][i]] += 10 ** sent["log_counts"][i]
    mass[classes.SPELLED] += 10 ** sent["log_counts"][classes.SPELLED]
    mass[:classes.SPELLED] += classes.ADD
    for r in model["counts"].collect():
        mass[classes.spelled(bytes(r.word))] += r.n + classes.ADD
    used = mass > 0
    assert (10 ** sent["ratio"][:, used] * mass[used] / model["whole"]).sum(axis=1) == pytest.approx(1, abs=1e-9)
    scored = classes.judge(table, frequent=500, classes=8).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert scored[0] > scored[1]


def test_exchange_takes_words_by_count_not_by_share(spark):
    """A word of 12 occurrences among 336,000 tokens is clustered; one of 9 is not."""
    rows = [(i, "the " * 1_000 + " ".join(f"w{i * 10 + k % 10}" for k in range(120))) for i in range(300)]
    docs = spark.createDataFrame([*rows, (300, "seldom " * 9)], "doc_id long, text string").withColumn("lang", F.lit("en"))
    model = classes.train(docs, classes=4, rounds=1)
    assert len(model["sent"]["frequent"]) == 3_001
    assert [bytes(r.word) for r in model["counts"].collect()] == [b"seldom"]


def test_best_class_is_the_most_likely_one():
    """Moving one word, by counting everything anew."""
    rng = random.Random(3)
    words, first = 12, classes.SPELLED + 1
    text = [rng.randrange(words) for _ in range(400)]
    pairs = Counter(zip(text, text[1:]))
    size = first + 3
    class_of = {w: first + w % 3 for w in range(words)}

    def likelihood(of):
        square, out, into = Counter(), Counter(), Counter()
        for (x, y), n in pairs.items():
            square[of[x], of[y]] += n
            out[of[x]] += n
            into[of[y]] += n
        return sum(sum(n * math.log(n) for n in c.values()) * k for c, k in ((square, 1), (out, -1), (into, -1)))
    square = np.zeros((size, size))
    for (x, y), n in pairs.items():
        square[class_of[x], class_of[y]] += n
    for w in range(words):
        after, before = np.zeros(size), np.zeros(size)
        for (x, y), n in pairs.items():
            if x == w and y != w:
                after[class_of[y]] += n
            if y == w and x != w:
                before[class_of[x]] += n
        best = classes.best_class(square, class_of[w], after, before, pairs[w, w], first)
        values = {c: likelihood(class_of | {w: c}) for c in range(first, size)}
        assert values[best] == pytest.approx(max(values.values()), abs=1e-6)


def test_tokens_of_texts_are_those_of_bytes():
    alphabet = [*map(chr, range(128)), *"éÀ\x85\xa0日😀 \t\n\r\x0b\x0c   AB"]
    rng = random.Random(5)
    texts = [None, "", " \n", *("".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(500))]
    expected = [(t or "").encode().lower().split() for t in texts]
    words, lengths = classes.tokens_of(pa.chunked_array([texts[:100], texts[100:]]))
    assert words.to_pylist() == [w for of_text in expected for w in of_text]
    assert lengths.tolist() == list(map(len, expected))
    last = [sum(w[-4:].decode(errors="ignore")[-1:].encode()) % classes.SPELLED for w in words.to_pylist()]
    assert classes.spelled_all(words).tolist() == [classes.spelled(w) for w in words.to_pylist()] == last


def test_moves_are_those_of_plain_counts(spark):
    """Packed and spread contexts give the moves of words one by one."""
    rng, first, kinds, tokens = random.Random(4), classes.FIRST, 5, 6_000
    size, top = first + kinds, 60
    texts = [np.array([rng.choice([rng.randrange(16), first + min(int(rng.expovariate(0.05)), top - 1)]) for _ in range(60)], dtype=np.int32)
             for _ in range(100)]
    ids = spark.createDataFrame([(t.tobytes(),) for t in texts], "ids binary")
    start = {first + i: first + i % kinds for i in range(top)}
    class_of = spark.createDataFrame([*start.items()], "number long, class int")
    parts = classes.by_place(classes.pair_parts(ids, tokens))
    asked = classes.asked_by(parts.select(F.col("part").alias("key"), "numbers"))
    pairs = Counter(p for t in texts for p in zip([classes.SPELLED, *t.tolist()], [*t.tolist(), classes.SPELLED]))
    of = start | {i: i for i in range(first)}
    square = np.zeros((size, size))
    for (x, y), n in pairs.items():
        square[of[x], of[y]] += n
    expected = {}
    for w in start:
        if classes.half(np.array([w]), 0)[0] and any(w in p for p in pairs):
            after, before = np.zeros(size), np.zeros(size)
            for (x, y), n in pairs.items():
                if x == w != y:
                    after[of[y]] += n
                if y == w != x:
                    before[of[x]] += n
            expected[w] = classes.best_class(square, of[w], after, before, pairs[w, w], first)
    assert any(expected[w] != of[w] for w in expected)
    for spread in (first, first + 20, first + top):
        around = classes.contexts(parts, asked, class_of, size, 0, tokens, spread)
        counted = {(r.side, r.other): r.n for r in classes.summed(around.where("word IS NULL")).collect()}
        assert counted == {(int(x), int(y)): square[x, y] for x, y in zip(*np.nonzero(square))}
        assert {r.word: r.best for r in classes.moves(around, square, class_of).collect()} == expected


def test_parts_are_told_the_classes_they_ask_for(spark):
    """What is sent is a class for each number of a part, not slices of all classes for every part."""
    far = 3 * classes.SLICE
    class_of = spark.range(classes.FIRST, far).select(F.col("id").alias("number"), (F.col("id") % 64 + classes.FIRST).cast("int").alias("class"))
    numbers = {1: [3, classes.FIRST, far - 1], 2: [far - 2], 3: []}
    rows = spark.createDataFrame([(k, np.array(v, dtype=np.int32).tobytes()) for k, v in numbers.items()], "key long, numbers binary")
    told = classes.told_to(classes.asked_by(rows), class_of, 500 * classes.PART).toArrow()
    assert sum(map(len, told["classes"].to_pylist())) == 2 * 4
    for key, of_key in numbers.items():
        mine = told.filter(pc.equal(told["key"], key))
        found, kinds = classes.classes_told(mine)
        assert found.tolist() == of_key
        assert kinds.tolist() == [n if n < classes.FIRST else n % 64 + classes.FIRST for n in of_key]


def test_words_of_blocks_are_read_by_one_python_worker(spark, table):
    rows = classes.numbered(table, table["doc_id"], table["text"])
    plan = classes.words_of_blocks(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_classes_without_rows(docs):
    assert classes.judge(docs.limit(0)).count() == 0
    only = classes.judge(docs.where("doc_id IS NULL")).collect()
    assert len(only) == 1 and math.isfinite(only[0].score)


# Toxicity


def test_toxicity_on_held_out_labels(spark):
    """Half of about 400 labels train, the other half judge."""
    table, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    chain = {"poor": F.col("quality") == 0, "toxic": F.col("toxic") == 1}
    found = toxicity.judge(table, labels.where("doc_id % 2 = 0"), chain, folds=3)
    judged = found.join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "truth"), "doc_id").collect()
    assert found.count() == table.count()
    assert sum(r.toxic == (r.truth == 1) for r in judged) / len(judged) > 0.9
    assert sum(r.toxic and r.truth == 1 for r in judged) / sum(r.truth for r in judged) > 0.5


def test_toxicity_fit_is_a_minimum():
    """The slope of the loss vanishes at the weights."""
    rng = np.random.default_rng(1)
    words = [sorted(set(rng.integers(0, 6, 3).tolist())) for _ in range(300)]
    y = np.array([float(0 in w and rng.random() < 0.9 or rng.random() < 0.1) for w in words])
    extra = rng.normal(size=(300, 1))
    w = toxicity.fit(words, extra, y, 6)
    p = np.array([1 / (1 + np.exp(-(w[ws].sum() + e @ w[6:-1] + w[-1]))) for ws, e in zip(words, extra)])
    x = np.array([[float(k in ws) for k in range(6)] for ws in words])
    slope = np.concatenate([x.T @ (p - y), extra.T @ (p - y)]) / 300 + toxicity.RIDGE * w[:-1]
    assert np.abs(slope).max() < 5e-3


def test_toxicity_of_odd_rows(spark, docs):
    chain = {"a": F.col("toxic") == 1, "b": F.col("toxic") == 0}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.judge(docs, none, chain).collect()
    assert len(rows) == docs.count() and all(r.p_a == r.p_b == 0.5 and not r.a for r in rows)
    some = spark.createDataFrame([(3, 1), (3, 0), (6, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    assert toxicity.judge(docs, some, chain).count() == docs.count()
    assert toxicity.judge(docs.limit(0), some, chain).count() == 0


# Vectors


def plain_links(rows, threshold):
    fine = [(k, i, np.array(v, dtype=float)) for k, (i, v) in enumerate(rows)
            if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    linked = [(a, b) for n, (a, _, v) in enumerate(fine) for b, _, w in fine[n + 1:]
              if len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold]
    root = brute.components(range(len(rows)), linked)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root[k]] = min(i, least.get(root[k], i))
    n = Counter(x for pair in linked for x in pair)
    return sorted((str(i), n[k], str(least.get(root[k])), i is not None and least[root[k]] == i) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("tile", [7, 8_192])
def test_vectors_match_all_pairs(spark, tile):
    rng = np.random.default_rng(4)
    rows = []
    for size, dim, spread in ((60, 20, 0.25), (1, 20, 0), (30, 20, 0.05), (15, 3, 0.3), (9, 1, 0.3)):
        centre = rng.normal(size=dim)
        rows += [(len(rows) + k, (centre + spread * rng.normal(size=dim) * np.linalg.norm(centre) / dim ** 0.5).tolist())
                 for k in range(size)]
    rows += [(500 + k, rows[3][1]) for k in range(5)] + [(3, rows[3][1]), (None, rows[70][1]), (None, [1e300, 1e300])]
    rows += [(600, None), (601, []), (602, [0.0] * 20), (603, [1.0, None]), (604, [float("nan")] * 3),
             (605, [float("inf"), 1.0, 0.0]), (606, [2e-300, 2e-300])]
    frame = spark.createDataFrame([(i, v, 7, 8) for i, v in rows], "vec_id long, embedding array<double>, n int, node int")
    found = vectors.near_duplicates(frame, 0.95, tile).collect()
    rows = [(i, [x / 1e300 for x in v] if v == [1e300] * 2 else [x * 1e300 for x in v] if v == [2e-300] * 2 else v)
            for i, v in rows]
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in found) == plain_links(rows, 0.95)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_near_gives_up_no_link():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 50)) * np.linspace(2, 0.1, 50)
    unit = np.concatenate([base, base + 0.2 * rng.normal(size=base.shape)])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    axes = np.linalg.eigh(unit.T @ unit)[1][:, ::-1]
    i, j = vectors.near(unit, unit, unit @ axes, unit @ axes, 0.9)
    assert sorted(zip(i, j)) == sorted(zip(*np.nonzero(unit @ unit.T >= 0.9)))


# Chat


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="<>/\\s|[]INSTY \nim_endu", max_size=40) | st.sampled_from(chat.CONTROLS),
       st.text(alphabet="<s>/\\\nuser", max_size=10))
def test_turns_read_back(text, role):
    segment, begin, end = chat.write_turn(role, text)
    assert chat.read_turn(segment) == (role, text)
    assert not any(c in chat.escape(text) for c in chat.CONTROLS)
    segment, begin, end = chat.write_turn("assistant", text)
    assert chat.unescape(segment[begin:end]) == text


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 4}, "messages"),
    ({"messages": [{"role": "user", "content": [{"type": "text", "text": "q"}]},
                   {"role": "assistant", "content": [{"type": "text", "text": "a"}]}]}, "parts"),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "from-value"),
    ({"instruction": "q", "input": "", "output": "a"}, "instruction"),
    ({"prompt": "q", "completion": "a"}, "completion"), ({"prompt": "q", "response": "a"}, "response"),
    ({"question": "q", "answer": "a", "meta": {"x": [1]}}, "question")]


def test_layouts_give_the_same_turns(spark):
    rows = [(i, None, json.dumps(r), 1) for i, (r, _) in enumerate(LAYOUTS)]
    rows += [(90, 0, "no json", 1), (91, 0, None, 1), (92, 0, "[1]", 1), (93, 0, '{"other": 1}', 1)]
    turns = chat.canonical(spark.createDataFrame(rows, "conv_id long, turn long, record string, part int"))
    found = {}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.part)):
        found.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    for i, (_, name) in enumerate(LAYOUTS):
        assert found[i] == [(name, "user", "q"), (name, "assistant", "a")]
    assert all(found[i] == [(None, None, None)] for i in (90, 91, 92, 93))
    whole = {r.conv_id: r for r in chat.texts(chat.formatted(turns)).collect()}
    assert set(whole) == set(range(len(LAYOUTS)))
    assert whole[0].formatted == "<s>user\nq</s><s>assistant\na</s>"
    assert [whole[0].formatted[s.start:s.end] for s in whole[0].spans] == ["a"]


def test_fingerprints_tell_layouts_apart():
    prints = {chat.fingerprint(chat.field_paths(r)) for r, _ in LAYOUTS}
    assert len(prints) == len(LAYOUTS)
    assert chat.field_paths({"a": [{"b": 1}, {"c": []}]}) == {"a", "a[]", "a[].b", "a[].c"}


def test_chat_digests(spark, small):
    rows = [(r.conv_id, r.turn, r.role or "", r.text or "") for r in
            spark.read.parquet(f"{small}/conversations.parquet").collect()]
    rows += [(-7, n, role, "</s>[INST] ok [/INST]") for n, role in enumerate(("user", "assistant"))]
    expected = {}
    for conv in {r[0] for r in rows}:
        turns = [(role, text) for c, _, role, text in sorted(rows) if c == conv]
        learned = "".join(t for r, t in turns if r == "assistant")
        expected[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                          len(learned), hashlib.sha256(learned.encode()).hexdigest())
    found = queries.op8_chat(spark, small).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == expected


def test_chat_of_odd_rows(spark):
    rows = [(1, None, "user", None), (1, 0, None, "b"), (1, 0, None, "b"), (None, 1, "assistant", "x" * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    segments = chat.formatted(chat.canonical(frame.select("conv_id", "turn", record.alias("record"))))
    found = {r.conv_id: r for r in chat.digests(segments).collect()}
    assert found[1].n_turns == 3 and found[1].loss_chars == 0 and found[None].loss_chars == 200_000
    assert found[1].turns_sha256 == hashlib.sha256(b"user\n\n\nb\n\nb\n").hexdigest()
    assert chat.digests(segments.limit(0)).count() == 0
