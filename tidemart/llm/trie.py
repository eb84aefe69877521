"""Token counts under a unigram vocabulary, by dynamic programming over a shared trie.

Texts are cut into pre-tokens.  Each task inserts its distinct pre-tokens, in sorted order, in a
trie of bytes; the forward score of a node, the best log probability of a segmentation of the
bytes down to it, is computed once for all pre-tokens that share the prefix, and the terminal of
a pre-token keeps score and token count.  A document's count adds up its terminals, so texts
need no shuffle.  Nodes are emptied at ``MOST_NODES`` and terminals at ``MOST_TERMINALS`` and
filled anew, and bytes beyond ``DEEPEST`` are scored without keeping nodes; results do not depend
on any of these.

The vocabulary is a public file of ranked byte strings, read by the driver and sent to the
tasks; its size does not depend on the data.  Files hold ranks, not probabilities, so a piece's
probability follows Zipf's law, one over its rank.  Ties between segmentations go to the one
with fewer tokens.

Defined results: null and empty texts have no tokens and score 0; equal rows are counted one by
one; an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

import base64
import gc
import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PRE_TOKEN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_NODES = 400_000
MOST_TERMINALS = 1_000_000
LONG = 256
DEEPEST = 64
SCALE = 1_000_000


def read_vocabulary(path: str = VOCABULARY) -> dict[bytes, int]:
    """Pieces and their log probabilities in millionths."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    whole = math.log(sum(1 / (1 + r) for r in ranks.values()))
    scores = {piece: round(SCALE * (-math.log(1 + r) - whole)) for piece, r in ranks.items()}
    missing = [b for b in range(256) if bytes([b]) not in scores]
    if missing:
        raise ValueError(f"vocabulary lacks {len(missing)} single bytes")
    return scores


def piece_trie(scores: dict[bytes, int]) -> list:
    """The vocabulary as nested nodes ``[node by byte, score of the piece that ends here]``."""
    top: list = [{}, None]
    for piece, score in scores.items():
        node = top
        for byte in piece:
            node = node[0].setdefault(byte, [{}, None])
        node[1] = score
    return top


class Trie:
    """Pre-tokens seen by a task.  A node is (children, score, tokens, open pieces); an open piece
    is (node of the vocabulary, score, tokens), the latter two of the place where it begins."""

    def __init__(self, pieces: list):
        self.root = ({}, 0, 0, [(pieces, 0, 0)])
        self.pieces = pieces
        self.nodes = 1
        self.terminals: dict[str, tuple[int, int]] = {}

    def insert(self, token: str) -> tuple[int, int]:
        """Tokens and score of a pre-token: walk down the shared prefix and add what is missing."""
        if self.nodes > MOST_NODES:
            self.root[0].clear()
            self.nodes = 1
        node, pieces = self.root, self.pieces
        for depth, byte in enumerate(token.encode("utf-8", "surrogatepass")):
            known = node[0].get(byte)
            if known is None:
                best, tokens, open_pieces = -math.inf, 0, []
                for piece, base, used in node[3]:
                    piece = piece[0].get(byte)
                    if piece is not None:
                        open_pieces.append((piece, base, used))
                        if piece[1] is not None:
                            total = base + piece[1]
                            if total > best or total == best and used + 1 < tokens:
                                best, tokens = total, used + 1
                open_pieces.append((pieces, best, tokens))
                known = {}, best, tokens, open_pieces
                if depth < DEEPEST:
                    node[0][byte] = known
                    self.nodes += 1
            node = known
        return node[2], node[1]

    def count(self, tokens: Counter) -> tuple[int, int]:
        """Tokens and log probability, in millionths, of a bag of pre-tokens."""
        if len(self.terminals) > MOST_TERMINALS:
            self.terminals.clear()
        terminals, total, score = self.terminals, 0, 0
        for token in sorted(t for t in tokens if t not in terminals):
            found = self.insert(token)
            if len(token) <= LONG:
                terminals[token] = found
            else:  # too long to keep
                n = tokens.pop(token)
                total, score = total + n * found[0], score + n * found[1]
        for token, n in tokens.items():
            count, logp = terminals[token]
            total += n * count
            score += n * logp
        return total, score


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, pre_token: str = PRE_TOKEN) -> DataFrame:
    """``doc_id, n_chars, n_pre_tokens, n_tokens, log_prob`` (natural) of every document."""
    spark: SparkSession = docs.sparkSession
    sent = spark.sparkContext.broadcast(read_vocabulary(vocabulary))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, trie = regex.compile(pre_token).findall, Trie(piece_trie(sent.value))
        for batch in batches:
            rows = []
            gc.disable()  # tries hold no cycles, and looking for some takes longer than the rest
            for text in batch.column(1).to_pylist():
                bag = Counter(found := find(text or ""))
                n, score = trie.count(bag)
                rows.append((len(text or ""), len(found), n, score / SCALE))
            gc.enable()
            chars, pre, n, score = zip(*rows) if rows else ((), (), (), ())
            yield pa.record_batch([batch.column(0), pa.array(chars, pa.int64()), pa.array(pre, pa.int64()),
                                   pa.array(n, pa.int64()), pa.array(score, pa.float64())],
                                  names=["doc_id", "n_chars", "n_pre_tokens", "n_tokens", "log_prob"])
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return rows.mapInArrow(of_batches, "doc_id long, n_chars long, n_pre_tokens long, n_tokens long, log_prob double")
