"""Toxicity: a classifier chain over label categories.

Categories are predicted in their order by logistic regressions on the words a text holds; each
also gets the log odds of the earlier categories.  While it is trained these come out of fold: a
row's come from a model that has not seen the row.  All folds of a category are fitted side by
side, one task each, on a bounded sample of labelled documents (``sample_docs``); the words that
tell a category best, at most ``features`` for each, are chosen by chi-squared counts over that
sample; words below ``LEAST_CHI`` tell no more than chance would.
The model is that many weights per category, and every whole document is scored.

Defined results: null and empty texts hold no words and are scored by what remains; an id
labelled more than once has the larger label; a null label does not train its category;
without any labels every probability is one half and nothing is flagged; equal rows are judged
alike and train once; an empty table gives none.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import text_mark
from tidemart.session import stored

SAMPLE_DOCS = 20_000
FEATURES = 2_000
FOLDS = 5
LEAST_DOCS = 5
LEAST_CHI = 15.0
ROUNDS = 250
RATE = 0.2
RIDGE = 1e-4
THRESHOLD = 0.5
_WORD = re.compile(r"[^\W_]+")


def held(text: str | None, index: dict[str, int]) -> list[int]:
    """Numbers of the known words that a text holds."""
    return sorted(index[w] for w in set(_WORD.findall((text or "").lower())) if w in index)


def sample(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], sample_docs: int = SAMPLE_DOCS,
           folds: int = FOLDS) -> DataFrame:
    """Stored ``text, fold`` and a 0/1 column per category of at most ``sample_docs`` documents.

    Ids and hashes of texts are picked first; only the texts of those, whose number is bounded,
    are fetched, so no text is shuffled.
    """
    named = [c.cast("int").alias(f"y_{k}") for k, c in categories.items()]
    marks = (labels.where("doc_id IS NOT NULL").select(labels["doc_id"].alias("label_id"), *named)
             .groupBy("label_id").agg(*[F.max(f"y_{k}").alias(f"y_{k}") for k in categories]))
    order = F.xxhash64(F.lit("toxicity"), "label_id")
    ids = docs.select(docs["doc_id"].alias("doc_id"), text_mark(docs["text"]).alias("mark")).distinct()
    picked = (ids.join(marks, F.col("doc_id") == F.col("label_id")).orderBy(order, "label_id", "mark").limit(sample_docs)
              .select(F.col("label_id").alias("picked_id"), F.col("mark").alias("picked_mark"),
                      F.pmod(order, F.lit(folds)).cast("int").alias("fold"), *[f"y_{k}" for k in categories]))
    picked = F.broadcast(stored(picked, "toxicity-picked"))  # at most sample_docs rows
    texts = docs.select(docs["doc_id"].alias("doc_id"), text_mark(docs["text"]).alias("mark"), docs["text"].alias("text"))
    rows = texts.join(picked, (F.col("doc_id") == F.col("picked_id")) & (F.col("mark") == F.col("picked_mark")))
    return stored(rows.dropDuplicates(["picked_id", "picked_mark"]).select("text", "fold", *[f"y_{k}" for k in categories]),
                  "toxicity-sample")


def choose_words(rows: DataFrame, categories: list[str], features: int = FEATURES) -> dict[str, int]:
    """The words with the largest chi-squared for each category, numbered."""
    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted(set(_WORD.findall((t or "").lower()))) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(words, pa.list_(pa.string())), *batch.columns[1:]],
                                  names=["words", *batch.schema.names[1:]])
    kinds = [f"y_{k}" for k in categories]
    schema = "words array<string>, " + ", ".join(f"{y} int" for y in kinds)
    words = rows.select("text", *kinds).mapInArrow(distinct, schema).select(F.explode("words").alias("word"), *kinds)
    totals = rows.agg(*[F.count(y).alias(f"n_{y}") for y in kinds], *[F.sum(y).alias(f"p_{y}") for y in kinds]).first()
    counts = stored(words.groupBy("word").agg(*[F.count(y).alias(f"n_{y}") for y in kinds],
                                              *[F.sum(y).alias(f"p_{y}") for y in kinds])
                    .where(F.greatest(*[F.col(f"n_{y}") for y in kinds], F.lit(0)) >= LEAST_DOCS), "toxicity-words")
    found: set[str] = set()
    for y in kinds:
        n, p = totals[f"n_{y}"] or 0, totals[f"p_{y}"] or 0
        if not 0 < p < n:
            continue
        expected = F.col(f"n_{y}") * F.lit(p / n)
        chi = F.pow(F.col(f"p_{y}") - expected, F.lit(2)) / (expected * F.lit(1 - p / n) * (1 - F.col(f"n_{y}") / F.lit(n + 1)))
        found.update(r.word for r in counts.where(chi >= LEAST_CHI).orderBy(chi.desc(), "word").limit(features)
                     .select("word").collect())
    return {w: i for i, w in enumerate(sorted(found))}


def odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def fit(words: list, extra: np.ndarray, y: np.ndarray, n_words: int) -> np.ndarray:
    """Weights of words, of the extra columns, and the constant, by logistic loss with a ridge."""
    n, k = len(y), extra.shape[1]
    weights = np.zeros(n_words + k + 1)
    if not n:
        return weights
    sizes = np.array([len(w) for w in words])
    cols = np.concatenate([np.asarray(w, dtype=np.int64) for w in words]) if sizes.sum() else np.zeros(0, dtype=np.int64)
    at = np.repeat(np.arange(n), sizes)
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, ROUNDS + 1):
        z = np.bincount(at, weights=weights[cols], minlength=n) + extra @ weights[n_words:-1] + weights[-1]
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n
        slope = np.concatenate([np.bincount(cols, weights=off[at], minlength=n_words), extra.T @ off, [off.sum()]])
        slope[:-1] += RIDGE * weights[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope ** 2
        weights -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-6)
    return weights


def predict(words: list[int], earlier: list[float], weights: np.ndarray, n_words: int) -> float:
    z = weights[words].sum() + np.dot(weights[n_words:-1], odds(np.array(earlier))) + weights[-1]
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(rows: DataFrame, categories: list[str], features: int = FEATURES, folds: int = FOLDS) -> dict:
    """Word numbers and, by category, the weights fitted on all rows of the sample."""
    index = choose_words(rows, categories, features)
    n_words, model = len(index), {}
    sent = rows.sparkSession.sparkContext.broadcast(index)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [held(t, sent.value) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(ids, pa.list_(pa.int32())), pa.array([[]] * len(ids), pa.list_(pa.float64())),
                                   *batch.columns[1:]], names=["words", "earlier", *batch.schema.names[1:]])
    schema = "words array<int>, earlier array<double>, fold int, " + ", ".join(f"y_{k} int" for k in categories)
    table = stored(rows.mapInArrow(known, schema), "toxicity-rows")
    for category in categories:
        y = f"y_{category}"

        def fitted(part: pd.DataFrame) -> pd.DataFrame:
            early = np.array([odds(np.array(e, dtype=float)) for e in part["earlier"]]).reshape(len(part), -1)
            weights = fit(list(part["words"]), early, part[y].to_numpy(dtype=float), n_words)
            return pd.DataFrame({"without": [int(part["without"].iloc[0])], "weights": [weights.tolist()]})
        # One model without each fold, and one (numbered ``folds``) on all rows.
        every = table.where(F.col(y).isNotNull()).withColumn("without", F.explode(F.sequence(F.lit(0), F.lit(folds))))
        fits = (every.where("without <> fold").select("without", "words", "earlier", y).groupBy("without")
                .applyInPandas(fitted, "without int, weights array<double>").collect())
        weights = {r.without: np.array(r.weights) for r in fits}
        none = np.zeros(n_words + len(model) + 1)
        model[category] = weights.get(folds, none)

        def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                more = [e + [predict(w, e, weights.get(f, none), n_words)] for w, e, f in
                        zip(*[batch.column(c).to_pylist() for c in range(3)])]
                yield batch.set_column(1, "earlier", pa.array(more, pa.list_(pa.float64())))
        table = stored(table.mapInArrow(outside, schema), "toxicity-rows")
    return {"index": index, "weights": model}


def judge(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], threshold: float = THRESHOLD,
          sample_docs: int = SAMPLE_DOCS, features: int = FEATURES, folds: int = FOLDS) -> DataFrame:
    """``doc_id``, ``p_`` and the category's name, and a flag of that name, of every document."""
    names = list(categories)
    sent = docs.sparkSession.sparkContext.broadcast(
        train(sample(docs, labels, categories, sample_docs, folds), names, features, folds))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weights = sent.value["index"], sent.value["weights"]
        for batch in batches:
            chains = []
            for text in batch.column(1).to_pylist():
                words, chain = held(text, index), []
                for name in names:
                    chain.append(predict(words, chain, weights[name], len(index)))
                chains.append(chain)
            p = np.array(chains).reshape(-1, len(names))
            yield pa.record_batch([batch.column(0), *[pa.array(p[:, k]) for k in range(len(names))],
                                   *[pa.array(p[:, k] > threshold) for k in range(len(names))]],
                                  names=["doc_id", *[f"p_{k}" for k in names], *names])
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return rows.mapInArrow(of_batches, "doc_id long, " + ", ".join([f"p_{k} double" for k in names] + [f"{k} boolean" for k in names]))
