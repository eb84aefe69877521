"""Plain versions of the operators, row by row, to compare with."""

import math
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def fingerprint(text):
    tokens = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i:i + 4]) for i in range(max(1, len(tokens) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Smallest node reachable, by node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n
    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def base_counts(text):
    tokens, text = words(text), text or ""
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(tokens[i:i + 3]) for i in range(len(tokens) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 3)}
    n = len(tokens)
    return {"n_words": n, "word_chars": sum(map(len, tokens)),
            "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
            "base_failed": n < 50 or 100 * len(covered) > 50 * n}


def targets(sizes, weights, cap=3):
    """Water level by bisection."""
    low, high = 0.0, float(cap * sum(sizes) + 1)
    for _ in range(200):
        level = (low + high) / 2
        if sum(min(cap * s, level * w) for s, w in zip(sizes, weights)) < sum(sizes):
            low = level
        else:
            high = level
    return [min(cap * s, high * w) for s, w in zip(sizes, weights)]


def ngram_buckets(tokens, buckets):
    """Hash buckets of words and of pairs of neighbours; the last word's neighbour is the end."""
    def signed(h):
        return h - (1 << 64) if h >> 63 else h
    raw = [w.encode() for w in tokens]
    two = xxhash.xxh64_intdigest((2).to_bytes(4, "little"), 42)
    firsts = [xxhash.xxh64_intdigest(w, two) for w in raw]
    pairs = [xxhash.xxh64_intdigest(b, a) for a, b in zip(firsts, raw[1:])] + firsts[-1:]
    return [signed(h) % buckets for h in [*(xxhash.xxh64_intdigest(w, 42) for w in raw), *pairs]]


def kept_by_ratio(docs, trusted, buckets, reject):
    """For each ``(id, text)``: passes the base rules, and the mean log ratio of its n-grams is no
    less than that under which a share ``reject`` of the trusted ones lies."""
    grams = [ngram_buckets(words(t), buckets) for _, t in docs]
    raw = Counter(b for g in grams for b in g)
    target = Counter(b for (i, _), g in zip(docs, grams) if i in trusted for b in g)
    if not target:
        return [not base_counts(t)["base_failed"] for _, t in docs]
    all_raw, all_target = raw.total() + buckets, target.total() + buckets
    ratio = {b: round((math.log((target[b] + 1) / all_target) - math.log((n + 1) / all_raw)) * 1e6) for b, n in raw.items()}
    good = [not base_counts(t)["base_failed"] for _, t in docs]
    steps = [math.floor(sum(ratio[b] for b in g) / (len(g) * 1e6) * 10_000) if g else None for g in grams]
    seen = sorted(s for (i, _), s, ok in zip(docs, steps, good) if ok and i in trusted)
    least = next((s for n, s in enumerate(seen, 1) if seen[n:n + 1] != [s] and n > reject * len(seen)), None)
    return [ok and (least is None or s >= least) for ok, s in zip(good, steps)]
