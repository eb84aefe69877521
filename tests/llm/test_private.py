"""Spans of personal data: base spans against plain patterns, what is added, and the estimates."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tidemart.llm import private

PATTERNS = (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))


def checksum(digits):
    doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def plain(text):
    """``start, kind, end`` of the base spans, from the patterns as they are stated."""
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == 1 and any(int(p) > 255 for p in m[0].split(".")) or kind == 2 and not (12 <= len(digits) <= 19 and checksum(digits))
                    or kind == 3 and not 9 <= len(digits) <= 15):
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def base(text):
    return sorted((c.start, c.kind, c.end) for c in private.candidates(text) if c.base)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "@", "a", "%x", ".", "1", "4111111111111111", "5500 0000 0000 0004", "255", "256", ".1.2.3", "-", " ",
                                 "+", "+1 (843) 555-7672", "(at)", "é😀", "\n", "0", "00012", "(", ")"]), max_size=14).map("".join))
def test_base_spans_are_those_of_the_patterns(text):
    assert base(text) == plain(text)


def test_base_spans_of_given_documents(spark, small):
    for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect():
        assert base(r.text or "") == plain(r.text or "")


def test_long_runs_take_time_in_proportion():
    for text in ("x" * 300_000, "1" * 300_000, "+" * 300_000, " @a.b" * 60_000, "a@" * 150_000, "1." * 100_000, "0" * 10_000 + "1.2.3.4",
                 "+1" + " " * 300_000, "(at)a" * 60_000):
        began = time.process_time()
        private.candidates(text)
        assert time.process_time() - began < 8


def documents(rng, n):
    out = []
    for i in range(n):
        words = [rng.choice(("sea", "ship", "harbour", "sails", "über", "home")) for _ in range(30)]
        card = next(c for c in (f"4{rng.randrange(10 ** 15):015}" for _ in range(200)) if checksum(c))
        other = next(c for c in (f"{rng.randrange(10 ** 15, 10 ** 16)}" for _ in range(200)) if not checksum(c))
        words[5:5] = [f"+1 ({rng.randrange(1000):03}) 555-{rng.randrange(10_000):04}", "and", card, "and", other, "and",
                      ".".join(str(rng.randrange(1, 224)) for _ in range(4)), "and", f"p{i}@mail.example.com", "end"]
        out.append((i, " ".join(words)))
    return out


def said(text, spans):
    return [(s["kind"], text[s["start"]:s["end"]]) for s in spans if not s["base"]]


def test_what_base_patterns_miss_is_added(spark):
    missed = [(500, "call +1 (843) 555-7672 170.106.47.218 now"), (501, "4111111111111111 5500000000000004"),
              (502, "write to jo.doe (at) example (dot) com please"), (503, "order 4111111111111112 4111111111111113"),
              (504, None), (505, ""), (505, ""), (None, "p@q.example.com")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in documents(random.Random(2), 60) + missed],
                                 "doc_id long, text string, spans string, candidates int")
    texts = dict(missed)
    rows = private.spans(docs).collect()
    assert len(rows) == 68
    more = {r.doc_id: said(texts[r.doc_id] or "", r.spans) for r in rows if r.doc_id in texts}
    assert more[500] == [("phone", "+1 (843) 555-7672")]
    assert more[501] == [("card", "4111111111111111"), ("card", "5500000000000004")]
    assert more[502] == [("email", "jo.doe (at) example (dot) com")]
    assert more[503] == more[504] == more[505] == more[None] == []
    assert all(not said(t, r.spans) for r in rows for i, t in documents(random.Random(2), 60) if r.doc_id == i)
    for r in private.digests(private.spans(docs)).collect():
        text = texts.get(r.doc_id) if r.doc_id in texts else dict(documents(random.Random(2), 60))[r.doc_id]
        own = plain(text or "")
        digest = ",".join(f"{private.KINDS[k]}:{s}:{e}" for s, k, e in own)
        assert r.base_sha256 == hashlib.sha256(digest.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in own) for kind in range(4)]
        assert set(filter(None, digest.split(","))) <= set(r.spans.split(","))


def test_empty_table_and_nothing_to_train_on(spark):
    docs = spark.createDataFrame([(1, "nothing here")], "doc_id long, text string")
    assert [tuple(r.spans) for r in private.spans(docs).collect()] == [()]
    assert private.digests(private.spans(docs.limit(0))).collect() == []


def test_reliabilities_are_found_from_votes():
    """Votes drawn from known reliabilities: truth and error rates come back."""
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.4
    right, silent = [0.95, 0.8, 0.7, 0.9, 0.75], [0.0, 0.3, 0.5, 0.8, 0.1]
    said = np.empty((len(truth), 5), dtype=int)
    for j in range(5):
        correct = rng.random(len(truth)) < right[j]
        said[:, j] = np.where(rng.random(len(truth)) < silent[j], private.SILENT, (truth == correct).astype(int))
    patterns, at, n = np.unique(said, axis=0, return_inverse=True, return_counts=True)
    p, chance, share = private.reliabilities(patterns, n.astype(float))
    assert share == pytest.approx(0.4, abs=0.03)
    assert ((p[at.ravel()] > 0.5) == truth).mean() > 0.95
    for j in range(5):
        heard = chance[1, j, private.FOR] / (chance[1, j, private.FOR] + chance[1, j, private.AGAINST])
        assert heard == pytest.approx(right[j], abs=0.05)


def test_classifier_follows_its_labels():
    looks = np.array([[d, r, 1, 1, 2, 1, 1] for d in (9, 10, 16) for r in (0, 1, 2)])
    p = np.array([0.02, 0.98, 0.6] * 3)
    w = private.span_classifier(looks, p, np.full(9, 400.0))
    fitted = 1 / (1 + np.exp(-np.take(w, private.places(looks)).sum(axis=1)))
    assert fitted == pytest.approx(p, abs=0.02)


def test_base_spans_stay_and_others_do_not_overlap():
    c = private.Candidate
    fine = (10, private.FOR, 1, 1, 2, 1, 1)
    each = [c(1, 0, 10, True, fine), c(2, 5, 12, True, fine), c(3, 11, 20, False, fine), c(3, 12, 25, False, fine), c(3, 12, 22, False, fine),
            c(2, 30, 40, False, (10, private.AGAINST, 1, 1, 2, 1, 1)), c(0, 50, 60, False, fine)]
    kept = private.settled(each, [0.1, 0.1, 0.9, 0.9, 0.9, 0.9, 0.4])
    assert [(s, k, e) for s, k, e, _, _ in kept] == [(0, 1, 10), (5, 2, 12), (12, 3, 22)]


def test_redacted_text():
    assert private.redacted("a b@c.d e 1.2.3.4", [("ip", 10, 17), ("email", 2, 7)]) == "a [email] e [ip]"
