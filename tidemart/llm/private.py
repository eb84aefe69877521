"""Personal data by weak supervision.

A pass over the texts gives candidate spans of four kinds: whatever the base patterns match, and
what they miss, such as a phone number run together with the number after it, two card numbers
with a space between, or an address with its signs spelled out.  Five labelers vote on each
candidate, for, against or not at all: a rule (digits, checksum, ranges) and a layout, both by
pattern; a gazetteer of domain endings, card issuers, calling codes and reserved networks; the
words before it; and the characters around it.

Candidates are described by a few small classes, so the number of distinct descriptions is bounded
by a constant whatever the input; their counts over all documents are what training sees.  From
the votes expectation-maximisation estimates, for each kind, how reliable each labeler is and how
likely each description is personal; on these soft labels a logistic regression of the
description is trained, the final span classifier.  The second pass adds, where no base span and
no more likely span is, the candidates that it finds likely and that keep the rule of their kind.

Offsets are code points, ends exclusive.  Every row is judged alone, and a document's candidates
stay in its row, so nothing but the counts is shuffled.

Defined results: null and empty texts have no spans; a failing base match is dropped and not
tried again as a base span; equal rows are judged alike, and a null id is kept; without any
candidate there is nothing to train and nothing is added; an empty table gives none.  Very long
texts and very long runs of one character take time in proportion to their length.  Other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.session import stored

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
AGAINST, FOR, SILENT = range(3)
THRESHOLD = 0.5
BEFORE = 48
ROWS = 500
RIDGE = 0.1
TRUST = 4.0
RULE_TRUST = 20.0

# Characters of a mail address ahead of its sign.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# Endings of domains.
ENDINGS = set("com org net edu gov mil int info biz io co ai app dev eu de at ch fr be es pt it nl uk ie us ca mx br ar "
              "cl au nz in cn jp kr ru ua pl cz se no dk fi gr tr za".split())
# First digits of card numbers by issuer.
ISSUERS = re.compile(r"4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|3[47]|3(?:0[0-5]|[689])|6(?:011|5|4[4-9])|35(?:2[89]|[3-8])|62")
# International calling codes of one, two and three digits.
CALLING = re.compile(r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|2[1-689][0-9]|3[578][0-9]|42[0-9]|50[0-9]|"
                     r"59[0-9]|6[789][0-9]|8[0578][0-9]|9[679][0-9]")
# Words that announce a kind.
TRIGGERS = {
    EMAIL: set("mail email e-mail contact write correo courriel kontakt adresse".split()),
    IP: set("ip ipv4 ipv6 host server client address adresse dirección".split()),
    CARD: set("card credit debit visa mastercard amex karte kreditkarte carte tarjeta payment".split()),
    PHONE: set("phone tel telephone call mobile cell fax telefon anruf téléphone appel teléfono móvil llamar".split())}
# Words before numbers that mean something else.
OTHER = set("version release isbn issn section chapter page serial token hash sha md5 uuid checksum revision build".split())

_TAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_AT = re.compile(r" ?[\[(] ?at ?[\])] ?(?=([A-Za-z0-9-]+(?:(?:\.| ?[\[(] ?dot ?[\])] ?)[A-Za-z0-9-]+)+))", re.IGNORECASE)
_DOT = re.compile(r" ?[\[(] ?dot ?[\])] ?", re.IGNORECASE)
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_IP6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])++")
_GROUP = re.compile(r"[0-9]+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NATIONAL = re.compile(r"(?<![0-9+] )(?<![0-9+-])\([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9-])")
_WORDS = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_CARD_LAYOUTS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)}
_PHONE_LAYOUT = re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}")


class Candidate(NamedTuple):
    kind: int
    start: int
    end: int
    base: bool
    look: tuple[int, ...]  # digits, rule, layout, gazetteer, words before, left, right


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number is right."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def octet(digits: str) -> bool:
    """Whether a number is at most 255, however many zeros lead it."""
    bare = digits.lstrip("0")
    return len(bare) < 4 and int(bare or "0") < 256


def emails(text: str) -> Iterator[tuple[int, int, bool]]:
    """``start, end, base``.  What stands before a sign is found backwards from it, which is where
    the leftmost match starts, in time proportional to the text."""
    end = floor = 0
    for m in _TAIL.finditer(text):
        ahead = text[max(end, floor):m.start()]
        n = len(ahead) - len(ahead.rstrip(LOCAL))
        floor = m.start() + 1
        if n:
            end = m.end()
            yield m.start() - n, end, True
    floor = 0
    if "(" in text or "[" in text:
        for m in _AT.finditer(text):
            ahead = text[floor:m.start()]
            n = len(ahead) - len(ahead.rstrip(LOCAL))
            floor = m.end(1) if n else m.end()
            if n:
                yield m.start() - n, m.end(1), False


def addresses(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in _IP.finditer(text):
        yield m.start(), m.end(), all(octet(p) for p in m[0].split("."))
    if text.count(":") >= 7:
        for m in _IP6.finditer(text):
            yield m.start(), m.end(), False


def cards(text: str) -> Iterator[tuple[int, int, bool]]:
    """Runs of digits; of one that is no number, the parts of a card's layout in it."""
    for m in _DIGITS.finditer(text):
        size = m.end() - m.start()
        digits = _NOT_DIGIT.sub("", m[0]) if size < 64 else ""
        if 12 <= len(digits) <= 19:
            good = luhn(digits)
            yield m.start(), m.end(), good
            if good:
                continue
        if size < 13:
            continue
        groups = [(m.start() + g.start(), m.start() + g.end()) for g in _GROUP.finditer(m[0])]
        sizes, at = [b - a for a, b in groups], 0
        while at < len(groups):
            taken = 1
            for n in (1, 5, 4, 3):
                if n == len(groups) == 1 or at + n > len(groups):
                    continue
                if (13 <= sizes[at] <= 19) if n == 1 else tuple(sizes[at:at + n]) in _CARD_LAYOUTS:
                    begin, end = groups[at][0], groups[at + n - 1][1]
                    if luhn(_NOT_DIGIT.sub("", text[begin:end])):
                        yield begin, end, False
                        taken = n
                        break
            at += taken


def phones(text: str) -> Iterator[tuple[int, int, bool]]:
    """Runs after a plus; of one with too many digits, its beginnings up to a space."""
    if "+" in text:
        for m in _PHONE.finditer(text):
            digits = len(_NOT_DIGIT.sub("", m[0]))
            base = 9 <= digits <= 15
            if base or digits < 9:
                yield m.start(), m.end(), base
                continue
            head = m[0][:48]
            for space in re.finditer(" ", head):
                part = head[:space.start()].rstrip(" ().-")
                if 9 <= len(_NOT_DIGIT.sub("", part)) <= 15:
                    yield m.start(), m.start() + len(part), False
    if "(" in text:
        for m in _NATIONAL.finditer(text):
            yield m.start(), m.end(), False


FINDERS = (emails, addresses, cards, phones)


def side(c: str) -> int:
    """Class of a neighbouring character: edge, space, letter, digit, quote or bracket, other."""
    if not c:
        return 0
    return 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4 if c in "\"'`()[]{}<>=" else 5


def look(text: str, kind: int, start: int, end: int) -> tuple[int, ...]:
    """The description of a candidate, each part a small class; votes follow from it."""
    span = text[start:end]
    digits = _NOT_DIGIT.sub("", span[:64])
    if kind == EMAIL:
        plain = "@" in span
        domain = span.rpartition("@")[2] if plain else _DOT.sub(".", span)
        ending = domain.rpartition(".")[2].lower()
        rule = FOR if plain else SILENT
        layout = FOR if any(c.isalpha() for c in span[:64].partition("@")[0]) and ending.isalpha() and len(ending) > 1 else AGAINST
        known = FOR if ending in ENDINGS else SILENT
    elif kind == IP:
        parts = span.split(".")
        if len(parts) == 4:
            rule = FOR if all(octet(p) for p in parts) else AGAINST
            glued = re.match(r"\.[0-9]", text[end:end + 2]) or re.search(r"[0-9]\.$", text[max(0, start - 2):start])
            layout = AGAINST if glued or any(len(p) > 1 and p[0] == "0" for p in parts) else FOR
            first, second = (int(p) if len(p) < 4 else 999 for p in parts[:2])
            reserved = (first in (0, 10, 127) or first > 223 or (first, second) in ((192, 168), (169, 254))
                        or (first == 172 and 16 <= second < 32))
            known = AGAINST if reserved else FOR
        else:
            rule, layout, known = FOR, FOR, SILENT
    elif kind == CARD:
        rule = FOR if 12 <= len(digits) <= 19 and luhn(digits) else AGAINST
        sizes = tuple(len(g) for g in _GROUP.findall(span[:64]))
        layout = FOR if sizes in _CARD_LAYOUTS or len(sizes) == 1 and 13 <= sizes[0] <= 16 else AGAINST
        known = FOR if ISSUERS.match(digits) else SILENT
    else:
        plus = span[0] == "+"
        rule = SILENT if not plus else FOR if 9 <= len(digits) <= 15 else AGAINST
        layout = FOR if not plus or _PHONE_LAYOUT.fullmatch(span[:64]) else AGAINST
        known = SILENT if not plus else FOR if CALLING.match(digits) else AGAINST
    words = {w.lower() for w in _WORDS.findall(text[max(0, start - BEFORE):start])}
    announced = FOR if words & TRIGGERS[kind] else AGAINST if words & OTHER else SILENT
    return (min(len(digits), 23), rule, layout, known, announced, side(text[start - 1:start] if start else ""), side(text[end:end + 1]))


def votes(description: tuple[int, ...]) -> tuple[int, ...]:
    """What the five labelers say of a candidate with this description."""
    _, rule, layout, known, announced, left, right = description
    alone = AGAINST if left in (2, 3) or right in (2, 3) else SILENT if 4 in (left, right) else FOR
    return rule, layout, known, announced, alone


def candidates(text: str) -> list[Candidate]:
    found = []
    for kind, finder in enumerate(FINDERS):
        seen = set()
        for start, end, base in finder(text):
            if (start, end) not in seen:
                seen.add((start, end))
                found.append(Candidate(kind, start, end, base, look(text, kind, start, end)))
    return found


CANDIDATES = "array<struct<kind:int,start:int,end:int,base:boolean,look:array<int>>>"


def found(docs: DataFrame) -> DataFrame:
    """Stored ``doc_id, candidates`` of every document."""
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
                               ("look", pa.list_(pa.int32()))]))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                each = [[c._asdict() for c in candidates(t or "")] for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(each, kind)], names=["doc_id", "candidates"])
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return stored(rows.mapInArrow(of_batches, f"doc_id long, candidates {CANDIDATES}"), "private-candidates")


def reliabilities(said: np.ndarray, n: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over distinct rows of votes, each found ``n`` times.

    Gives the probability that each row is personal data, the probability of each vote of each
    labeler by truth (``[truth, labeler, vote]``), and the share of personal data.  Labelers are
    taken to err on their own; it starts from pseudo-counts that lean to their being right, the
    first of them, the rule, more than the others.
    """
    trust = np.array([RULE_TRUST] + [TRUST] * (said.shape[1] - 1))
    lean = np.ones((2, said.shape[1], 3))
    lean[0, :, AGAINST] = lean[1, :, FOR] = trust
    picked = np.stack([said == v for v in range(3)], axis=2).astype(float)
    p, chance, share = np.zeros(len(said)), lean / lean.sum(axis=2, keepdims=True), 0.5
    for _ in range(rounds):
        logs = np.einsum("ijv,yjv->yi", picked, np.log(chance)) + np.log([[1 - share], [share]])
        before, p = p, 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
        share = float((n @ p + 1) / (n.sum() + 2))
        chance = np.stack([np.einsum("i,ijv->jv", n * w, picked) + lean[y] for y, w in enumerate((1 - p, p))])
        chance /= chance.sum(axis=2, keepdims=True)
        if np.abs(p - before).max() < 1e-10:
            break
    return p, chance, share


WIDTHS = (24, 3, 3, 3, 3, 6, 6)
OFFSETS = np.concatenate([[0], np.cumsum(WIDTHS)]).astype(int)


def places(looks: np.ndarray) -> np.ndarray:
    """Where the ones of a description stand in the classifier's input; the last is the constant."""
    return np.column_stack([looks + OFFSETS[:-1], np.full(len(looks), OFFSETS[-1])])


def span_classifier(looks: np.ndarray, p: np.ndarray, n: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Logistic regression of descriptions on soft labels, by Newton steps."""
    x = np.zeros((len(looks), OFFSETS[-1] + 1))
    np.put_along_axis(x, places(looks), 1.0, axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (q - p)) + RIDGE * w
        bend = (x * (n * np.maximum(q * (1 - q), 1e-6))[:, None]).T @ x + RIDGE * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def train(rows: DataFrame) -> dict[int, dict]:
    """By kind: ``weights`` of the classifier, ``chance`` (see :func:`reliabilities`), ``share``.

    What reaches the driver is a count for each description, of which there are at most
    46,656 times 4, whatever the input.
    """
    counts = (rows.select(F.explode("candidates").alias("c")).groupBy(F.col("c.kind").alias("kind"), F.col("c.look").alias("look"))
              .count().orderBy("kind", "look").collect())
    model = {}
    for kind in sorted({r.kind for r in counts}):
        looks = np.array([r.look for r in counts if r.kind == kind])
        n = np.array([r["count"] for r in counts if r.kind == kind], dtype=float)
        p, chance, share = reliabilities(np.array([votes(tuple(x)) for x in looks]), n)
        model[kind] = {"weights": span_classifier(looks, p, n), "chance": chance, "share": share}
    return model


def probability(model: dict[int, dict], kind: int, description: tuple[int, ...]) -> float:
    if kind not in model:
        return 0.0
    z = float(model[kind]["weights"][places(np.array([description]))[0]].sum())
    return float(1 / (1 + np.exp(-min(max(z, -30.0), 30.0))))


def settled(each: list[Candidate], chances: list[float], threshold: float = THRESHOLD) -> list[tuple[int, int, int, bool, float]]:
    """``start, kind, end, base, p`` of a document's spans: all base ones, and the likely others that
    break no rule and meet neither a base span nor a likelier (then shorter, then earlier) one."""
    import bisect
    spans = [(c.start, c.kind, c.end, True, p) for c, p in zip(each, chances) if c.base]
    taken = sorted({(s, e) for s, _, e, _, _ in spans})
    # Base spans of different kinds may overlap; what is taken is kept as disjoint stretches.
    flat: list[list[int]] = []
    for s, e in taken:
        if flat and s < flat[-1][1]:
            flat[-1][1] = max(flat[-1][1], e)
        else:
            flat.append([s, e])
    more = sorted((-p, c.end - c.start, c.start, c.kind, c.end) for c, p in zip(each, chances)
                  if not c.base and p >= threshold and c.look[1] != AGAINST)
    for p, _, start, kind, end in more:
        at = bisect.bisect_right(flat, [start, end])
        if (at and flat[at - 1][1] > start) or (at < len(flat) and flat[at][0] < end):
            continue
        flat.insert(at, [start, end])
        spans.append((start, kind, end, False, -p))
    return sorted(spans)


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,p:double>>"


def spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, spans`` of every document: kind, start, end, whether a base span, and what the
    classifier says of it."""
    rows = found(docs)
    sent = docs.sparkSession.sparkContext.broadcast(train(rows))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()),
                               ("p", pa.float64())]))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, float] = {}
        for batch in batches:
            out = []
            for row in batch.column(1).to_pylist():
                each = [Candidate(c["kind"], c["start"], c["end"], c["base"], tuple(c["look"])) for c in row or []]
                for c in each:
                    if (c.kind, c.look) not in known:
                        known[c.kind, c.look] = probability(sent.value, c.kind, c.look)
                out.append([{"kind": KINDS[k], "start": s, "end": e, "base": b, "p": p}
                            for s, k, e, b, p in settled(each, [known[c.kind, c.look] for c in each], threshold)])
            yield pa.record_batch([batch.column(0), pa.array(out, kind)], names=["doc_id", "spans"])
    return rows.mapInArrow(of_batches, f"doc_id long, spans {SPANS}")


def digests(found_spans: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone`` (base spans), ``base_sha256, spans, n_added``."""
    base = F.filter("spans", lambda s: s["base"])

    def said(each: Column) -> Column:
        return F.array_join(F.transform(each, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found_spans.select("doc_id", *[count(k) for k in KINDS], F.sha2(said(base).cast("binary"), 256).alias("base_sha256"),
                              said(F.col("spans")).alias("spans"),
                              F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"))


def redacted(text: str, found_spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by its kinds in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(found_spans, key=lambda s: (s[1], s[2])):
        if start >= at:
            out.append(text[at:start] + f"[{kind}]")
        at = max(at, end)
    return "".join(out) + text[at:]

