"""Chat formatting: records of any known layout to canonical turns, and turns to marked text.

The sorted field paths of a record (``[]`` for the entries of a list) are hashed; the hash
selects a declarative layout, the first whose paths the record has, which says where roles and
texts are.  Every task resolves a hash once.

A turn is written ``<s>role``, line feed, text, ``</s>``.  Control strings inside a text get a
backslash after their first character, one more where there are some already, so that what was
written can be read back.  The loss mask covers the texts of the assistant.

Turns are kept as rows and conversations are read in order from sorted partitions, one turn at
a time, so a conversation need not fit in memory.

Defined results: a null role or text is empty; turns with one number are ordered as written,
and repeated rows are repeated turns; null turn numbers come first; a null id is a
conversation; a record that is no JSON object or has no known layout gives one row without
layout, role and text, which is not formatted; an empty table gives none.  Other columns are
not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

LEARNED = "assistant"
START, END = "<s>", "</s>"
# Control strings of public chat templates.
CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
            "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>"]
_AHEAD = "|".join(
    rf"(?<={re.escape(first)}){{slash}}(?=\\*(?:" + "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == first) + "))"
    for first in sorted({c[0] for c in CONTROLS}))
_TO_ESCAPE = re.compile(_AHEAD.replace("{slash}", ""))
_ESCAPED = re.compile(_AHEAD.replace("{slash}", r"\\"))
_TURN = re.compile(f"{START}([^\n]*)\n(.*){END}", re.DOTALL)


@dataclass(frozen=True)
class Layout:
    """Where the turns of a record are.

    ``each`` names the list of turns; its entries, or the record itself where it is empty, have
    ``turns``: pairs of a role (``@path`` to read it) and the paths of its text, of which those
    that are there and not empty are joined by an empty line.  ``names`` translates roles.
    """

    name: str
    needs: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...]
    each: str = ""
    names: dict[str, str] = field(default_factory=dict)


LAYOUTS = (
    Layout("row", ("role", "text"), (("@role", ("text",)),)),
    Layout("parts", ("messages[].role", "messages[].content[].text"), (("@role", ("content[].text",)),), "messages"),
    Layout("messages", ("messages[].role", "messages[].content"), (("@role", ("content",)),), "messages"),
    Layout("from-value", ("conversations[].from", "conversations[].value"), (("@from", ("value",)),), "conversations",
           {"human": "user", "gpt": "assistant"}),
    Layout("instruction", ("instruction", "output"),
           (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout("completion", ("prompt", "completion"),
           (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout("response", ("prompt", "response"),
           (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout("question", ("question", "answer"),
           (("system", ("system",)), ("user", ("question",)), ("assistant", ("answer",)))),
)


def field_paths(value: object, path: str = "") -> set[str]:
    """Paths of everything inside a parsed record, inner ones included."""
    found = {path} if path else set()
    if isinstance(value, dict):
        for name, inner in value.items():
            found |= field_paths(inner, f"{path}.{name}" if path else name)
    elif isinstance(value, list):
        for inner in value:
            found |= field_paths(inner, f"{path}[]")
    return found


def fingerprint(paths: set[str]) -> int:
    return xxhash.xxh64_intdigest("\n".join(sorted(paths)).encode("utf-8", "surrogatepass"))


def choose(paths: set[str], layouts: tuple[Layout, ...] = LAYOUTS) -> Layout | None:
    """The first layout whose paths are all there."""
    return next((x for x in layouts if paths.issuperset(x.needs)), None)


def _at(value: object, path: str) -> list:
    """What stands at a path; ``name[]`` gives each entry of a list."""
    found = [value]
    for step in path.split("."):
        name = step.removesuffix("[]")
        found = [v[name] for v in found if isinstance(v, dict) and name in v]
        if step.endswith("[]"):
            found = [x for v in found if isinstance(v, list) for x in v]
    return found


def _plain(value: object) -> str:
    return value if isinstance(value, str) else "" if value is None else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, layout: Layout) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a record."""
    for entry in _at(record, f"{layout.each}[]") if layout.each else [record]:
        for role, paths in layout.turns:
            found = [_at(entry, p) for p in paths]
            if not any(found):
                continue
            name = _plain(next(iter(_at(entry, role[1:])), None)) if role.startswith("@") else role
            text = "\n\n".join(t for t in ("".join(map(_plain, f)) for f in found) if t)
            yield layout.names.get(name, name), text


def canonical(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``conv_id, turn, part, layout, role, text`` from ``conv_id, turn, record``; ``part`` counts
    inside a record."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Layout | None] = {}
        for batch in batches:
            place, part, kind, roles, texts = [], [], [], [], []
            for i, raw in enumerate(batch.column(2).to_pylist()):
                try:
                    record = json.loads(raw or "")
                except ValueError:
                    record = None
                layout = None
                if isinstance(record, dict):
                    key = fingerprint(paths := field_paths(record))
                    if key not in known:
                        if len(known) > 10_000:
                            known.clear()
                        known[key] = choose(paths, layouts)
                    layout = known[key]
                turns = list(turns_of(record, layout)) if layout else [(None, None)]
                for n, (role, text) in enumerate(turns):
                    place.append(i)
                    part.append(n)
                    kind.append(layout.name if layout else None)
                    roles.append(role)
                    texts.append(text)
            at = pa.array(place, pa.int64())
            yield pa.record_batch([batch.column(0).take(at), batch.column(1).take(at), pa.array(part, pa.int32()),
                                   pa.array(kind, pa.string()), pa.array(roles, pa.string()), pa.array(texts, pa.string())],
                                  names=["conv_id", "turn", "part", "layout", "role", "text"])
    rows = records.select(records["conv_id"].cast("long").alias("conv_id"), records["turn"].cast("long").alias("turn"),
                          records["record"].cast("string").alias("record"))
    return rows.mapInArrow(of_batches, "conv_id long, turn long, part int, layout string, role string, text string")


def escape(text: str) -> str:
    """The text without control strings; ``unescape`` gives it back."""
    return _TO_ESCAPE.sub(r"\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub("", text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as marked text, and where the text the model learns begins and ends in it."""
    name = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
    inside = escape(text)
    begin = len(START) + len(name) + 1
    return f"{START}{name}\n{inside}{END}", begin, begin + (len(inside) if role == LEARNED else 0)


def read_turn(segment: str) -> tuple[str, str]:
    """Role and text of a marked turn."""
    found = _TURN.fullmatch(segment)
    if not found or segment.count(START) != 1 or segment.count(END) != 1:
        raise ValueError("not one marked turn")
    name = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(found[1]))
    return name, unescape(found[2])


def formatted(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, part, segment, loss_start, loss_end`` of canonical turns; a
    conversation's text is its segments in the order of turn, part, segment."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [write_turn(r or "", t or "") for r, t in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            text, begin, end = zip(*done) if done else ((), (), ())
            yield pa.record_batch([*batch.columns[:3], pa.array(text, pa.string()), pa.array(begin, pa.int64()),
                                   pa.array(end, pa.int64())],
                                  names=["conv_id", "turn", "part", "segment", "loss_start", "loss_end"])
    rows = turns.where("layout IS NOT NULL").select("conv_id", "turn", "part", "role", "text")
    return rows.mapInArrow(of_batches, "conv_id long, turn long, part int, segment string, loss_start long, loss_end long")


def texts(segments: DataFrame) -> DataFrame:
    """``conv_id, formatted, spans``: whole conversations, each in one row, with the spans under
    the loss mask in code points."""
    order = F.array_sort(F.collect_list(F.struct("turn", "part", "segment", "loss_start", "loss_end")))
    rows = segments.groupBy("conv_id").agg(order.alias("rows"))
    begun = F.aggregate("rows", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
                        lambda a, r: F.struct(
                            (a["at"] + F.length(r["segment"])).cast("long").alias("at"),
                            F.when(r["loss_end"] > r["loss_start"], F.concat(a["spans"], F.array(F.struct(
                                (a["at"] + r["loss_start"]).alias("start"), (a["at"] + r["loss_end"]).alias("end")))))
                            .otherwise(a["spans"]).alias("spans")))
    return rows.select("conv_id", F.array_join(F.transform("rows", lambda r: r["segment"]), "").alias("formatted"),
                       begun["spans"].alias("spans"))


def digests(segments: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read back from
    the marked text of each conversation."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, now, done = False, None, []
        n = learned = chars = 0
        whole, loss = hashlib.sha256(), hashlib.sha256()

        def flush() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), (
                pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names=names)
            done.clear()
            return batch
        for batch in batches:
            for conv, segment, start, end in zip(*[batch.column(k).to_pylist() for k in range(4)]):
                if begun and conv != now:
                    done.append((now, n, whole.hexdigest(), learned, loss.hexdigest(), chars))
                    n = learned = chars = 0
                    whole, loss = hashlib.sha256(), hashlib.sha256()
                begun, now = True, conv
                role, text = read_turn(segment)
                whole.update(f"{role}\n{text}\n".encode())
                under = unescape(segment[start:end])
                loss.update(under.encode())
                n, learned, chars = n + 1, learned + len(under), chars + len(segment)
            if len(done) > 1_000:
                yield flush()
        if begun:
            done.append((now, n, whole.hexdigest(), learned, loss.hexdigest(), chars))
            yield flush()
    rows = (segments.select("conv_id", "segment", "loss_start", "loss_end", "turn", "part").repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "part", "segment"))
    return rows.mapInArrow(of_batches, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                       "loss_sha256 string, formatted_chars long")
