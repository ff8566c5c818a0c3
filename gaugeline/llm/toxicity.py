"""Toxicity of texts: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams, with marks at its ends; a text is the bag of
all its words and some padding. Every n-gram has an embedding by its hash, the mean of
a text's embeddings goes through a linear softmax of two classes, and embeddings and
softmax are trained together, by minibatch gradient steps with a step size for each
weight. N-grams of a step are dropped at random, and those of few texts stay zero, so what
counts are parts of words that many texts share: a misspelled word that was never met
still has some of them.

The model is fitted on a bounded sample of labelled texts: the ``sample_rows`` labels of
smallest hash of their id, and of those, in the same order, as many as have
``sample_entries`` bag entries together. All weights an n-gram has in the softmax are one
number, so a fitted model is one array, and a task scores a word it has met by one lookup.

Defined cases: a null text is an empty one; a text without words gets the score of the
bias alone. Of different labels of one id the smallest counts, of rows with that id the one
with the smallest bag. Labels that are null or not 0 or 1, or whose document is missing,
teach nothing; without labels of two kinds every text gets the share of label 1, 0.5 if
there is none. Repeated rows get equal scores. All other columns are passed on and never
looked at; one that is called like the score is refused, and another name can be given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import column, map_arrow, saved

SAMPLE_ROWS = 5_000
SAMPLE_ENTRIES = 10_000_000
BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
DIM = 6
EPOCHS = 6
BATCH = 64
RATE = 0.5
DECAY = 1e-4
LEAST_TEXTS = 5
DROPOUT = 0.5
# Empty subwords that every text has besides its own, so that few words prove little.
PADDING = 200

MARKS = ".,;:!?\"'()[]{}*#$%&|-_<>"
# Words remembered by a task, and characters of them.
KNOWN_WORDS = 300_000
KNOWN_CHARACTERS = 8_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Lower-case words without the punctuation around them."""
    return [w for w in (w.strip(MARKS) for w in (text or "").lower().split()) if w]


def subwords(words: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, word) of every character n-gram of words that are not empty, repeats included.

    Words are marked at their ends, so each has one n-gram of the least length at least.
    """
    marked = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(marked.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    found, owner = [], []
    for n in GRAMS:
        hashes = np.full(max(0, len(codes) - n + 1), n, np.uint64)
        for k in range(n):
            hashes = (hashes + codes[k : k + len(hashes)]) * _BASE
            hashes ^= hashes >> np.uint64(29)
        inside = np.flatnonzero(left[: len(hashes)] >= n)
        found.append((hashes[inside] % np.uint64(buckets)).astype(np.int32))
        owner.append(word[inside])
    return np.concatenate(found), np.concatenate(owner)


def bag(text: str | None, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, share): the different buckets of a text, and their shares of all subwords."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    bucket, count = np.unique(subwords(words, buckets)[0], return_counts=True)
    return bucket, (count / (count.sum() + PADDING)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """``weight[bucket]``: what a subword adds to the margin of class 1 over class 0."""

    weight: np.ndarray
    bias: float

    def margin(self, total: np.ndarray, size: np.ndarray) -> np.ndarray:
        """From sums of weights over subwords, and the numbers of subwords."""
        return total / (size + PADDING) + self.bias


def probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


class Scorer:
    """Scores of texts, by remembered sums of words."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.total, self.size = np.zeros(0), np.zeros(0)
        self.characters = 0

    def _learn(self, words: list[str]) -> None:
        bare = [w.strip(MARKS) for w in words]
        some = np.array([i for i, w in enumerate(bare) if w], np.int64)
        total, size = np.zeros(len(words)), np.zeros(len(words))
        if len(some):
            bucket, owner = subwords([bare[i] for i in some], len(self.model.weight))
            total[some] = np.bincount(owner, self.model.weight[bucket], len(some))
            size[some] = np.bincount(owner, minlength=len(some))
        self.place.update(zip(words, range(len(self.total), len(self.total) + len(words))))
        self.total, self.size = np.r_[self.total, total], np.r_[self.size, size]
        self.characters += sum(map(len, words))

    def margins(self, texts: list[str | None]) -> np.ndarray:
        if len(self.place) > KNOWN_WORDS or self.characters > KNOWN_CHARACTERS:
            self._forget()
        cut = [(t or "").lower().split() for t in texts]
        new = {w for words in cut for w in words}.difference(self.place)
        if new:
            self._learn(list(new))
        sizes = [len(words) for words in cut]
        at = np.fromiter((self.place[w] for words in cut for w in words), np.int64, sum(sizes))
        text = np.repeat(np.arange(len(texts)), sizes)
        total, size = (np.bincount(text, v[at], len(texts)) for v in (self.total, self.size))
        return self.model.margin(total, size)


def fit_bags(
    bags: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    *,
    buckets: int = BUCKETS,
    dim: int = DIM,
    epochs: int = EPOCHS,
    batch: int = BATCH,
    rate: float = RATE,
    decay: float = DECAY,
    least_texts: int = LEAST_TEXTS,
    dropout: float = DROPOUT,
    seed: int = 5,
) -> Model:
    """Embeddings and softmax, trained together on bags of (bucket, share)."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    base = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(buckets, np.float32), base)
    rng = np.random.default_rng(seed)
    met = np.zeros(buckets, np.int64)
    for bucket, _ in bags:
        met[bucket] += 1
    embedding = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    embedding[met < least_texts] = 0
    softmax = rng.uniform(-1 / dim, 1 / dim, (2, dim)).astype(np.float32)
    bias = np.array([-base / 2, base / 2], np.float32)
    steps = [np.full(a.shape, 1e-8, np.float32) for a in (embedding, softmax, bias)]
    target = np.eye(2, dtype=np.float32)[labels.astype(int)]

    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            sizes = np.array([len(bags[r][0]) for r in rows])
            bucket = np.concatenate([bags[r][0] for r in rows])
            weight = np.concatenate([bags[r][1] for r in rows])[:, None]
            row = np.repeat(np.arange(len(rows)), sizes)
            kept = (met[bucket] >= least_texts) & (rng.random(len(bucket)) >= dropout)
            bucket, weight, row = bucket[kept], weight[kept] / (1 - dropout), row[kept]
            parts = embedding[bucket] * weight
            mean = np.stack([np.bincount(row, parts[:, d], len(rows)) for d in range(dim)], 1).astype(np.float32)
            logits = mean @ softmax.T + bias
            logits -= logits.max(axis=1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(axis=1, keepdims=True)
            off = (p - target[rows]) / len(rows)
            slope = off @ softmax  # of the mean embeddings
            used, place = np.unique(bucket, return_inverse=True)
            each = slope[row] * weight
            own = np.stack([np.bincount(place, each[:, d], len(used)) for d in range(dim)], 1).astype(np.float32)
            for array, squares, at_, gradient in (
                (embedding, steps[0], used, own),
                (softmax, steps[1], slice(None), off.T @ mean),
                (bias, steps[2], slice(None), off.sum(axis=0)),
            ):
                squares[at_] += gradient**2
                array[at_] -= step * (gradient / np.sqrt(squares[at_]) + decay * array[at_])
    return Model(embedding @ (softmax[1] - softmax[0]), float(bias[1] - bias[0]))


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    sample_entries: int = SAMPLE_ENTRIES,
) -> Model:
    """A model from labels outside the held-out fold.

    Only ids and bags of the sample reach the driver. The ids are broadcast to the
    documents, so no text is shuffled.
    """
    known = labels.select(
        column(id_column).alias("id"), column(label_column).cast("int").alias("label")
    ).where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    one_each = known.groupBy("id").agg(F.min("label").alias("label"))
    sample = one_each.orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()
    chosen = docs.sparkSession.createDataFrame(sample, known.schema)
    texts = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("t"))
    found = texts.join(F.broadcast(chosen), "id").select("id", "label", "t")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [bag(t) for t in batch.column(2).cast(pa.string()).to_pylist()]
            columns = [
                pa.array([len(b) for b, _ in made], pa.int64()),
                pa.array([b.tobytes() for b, _ in made], pa.binary()),
                pa.array([s.tobytes() for _, s in made], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *columns], ["id", "label", "n", "bucket", "share"]
            )

    kind = dict(known.dtypes)["id"]
    rows = saved(map_arrow(found, work, f"id {kind}, label int, n bigint, bucket binary, share binary"), "bags")
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "n", "bucket", "share")).alias("row"))
    rows = saved(rows.select(F.xxhash64("id").alias("mark"), "id", "row.*"), "bags")
    # As many, in order of hash, as the bound on entries lets in.
    kept, total = [], 0
    for row in rows.select("mark", "id", "n").orderBy("mark", "id").collect():
        total += row["n"]
        if total > sample_entries:
            break
        kept.append(row["mark"])
    if kept:
        rows = rows.where(F.col("mark") <= kept[-1])
    taught = [
        (np.frombuffer(r["bucket"], np.int32), np.frombuffer(r["share"], np.float32), r["label"])
        for r in rows.orderBy("mark", "id").select("label", "bucket", "share").collect()
    ]
    return fit_bags([t[:2] for t in taught], np.array([t[2] for t in taught], dtype=float))


def score_toxicity(
    docs: DataFrame, model: Model, *, text_column: str = "text", score_column: str = "score"
) -> DataFrame:
    """The rows of ``docs`` with all their columns, and their scores as the last."""
    if score_column.lower() in (name.lower() for name in docs.columns):
        raise ValueError(f"there is a column {score_column} already")
    place = docs.columns.index(text_column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            texts = batch.column(place).cast(pa.string()).to_pylist()
            yield batch.append_column(score_column, pa.array(probability(scorer.margins(texts))))

    schema = T.StructType([*docs.schema.fields, T.StructField(score_column, T.DoubleType())])
    return map_arrow(docs, work, schema)
