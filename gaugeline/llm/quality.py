"""Document quality from statistics of the text, by histogram gradient-boosted trees.

The trees are fitted on a bounded sample of labelled documents: the ``sample_rows``
labels with the smallest hash of their id, so the same ones at every run. Values
are cut into histogram bins at quantiles; each level of a tree is chosen from sums
of gradients by node, statistic and bin. The fitted forest is flattened into arrays of
complete binary trees, which a task walks for a whole batch of documents at once.

Defined cases: a null text is an empty one and gets a score like any other. Labels
that are null, or whose document is missing, teach nothing; of different labels of one id
the smallest counts; without labels of two
kinds every document gets the share of good labels, 0.5 if there is none. Repeated
rows get equal scores. All other columns are passed on and never looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import column, map_arrow

SAMPLE_ROWS = 20_000
TREES = 60
DEPTH = 4
BINS = 64
RATE = 0.15
SHRINK = 1.0
LEAST_WEIGHT = 2.0

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "mean_line", "upper", "lower", "digit", "space",
    "stop_marks", "bangs", "bars", "symbols", "other_marks", "beyond_ascii", "distinct_words",
    "top_word", "repeated_pairs", "short_lines", "repeated_lines", "ended_lines", "one_letter",
)

# Byte classes that are counted.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\n\r\x0b\x0c",
    "stop_marks": b".,;:?",
    "bangs": b"!",
    "bars": b"|",
    "symbols": b"#$%&*@^~<>{}[]\\=_+",
    "other_marks": b"\"'()-/`",
    "beyond_ascii": bytes(range(128, 256)),
}
_CLASS_OF = np.zeros(256, np.int64)
for _number, _members in enumerate(_CLASSES.values(), 1):
    _CLASS_OF[list(_members)] = _number


def statistics(text: bytes) -> list[float]:
    """The statistics of one text, in the order of STATISTICS."""
    size = max(1, len(text))
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    classes = np.bincount(_CLASS_OF, by_byte, len(_CLASSES) + 1)[1:] / size
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split(b"\n") if line.strip()]
    n_lines = max(1, len(lines))
    ended = sum(line.rstrip()[-1:] in b".!?" for line in lines)
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        n / n_lines,
        *classes,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
        sum(len(line) < 25 for line in lines) / n_lines,
        1 - len(set(lines)) / n_lines if lines else 0.0,
        ended / n_lines,
        sum(len(word) == 1 for word in words) / n,
    ]


@dataclass(frozen=True)
class Forest:
    """Complete binary trees in arrays: the children of node i are 2i+1 and 2i+2."""

    feature: np.ndarray  # tree, inner node
    threshold: np.ndarray  # tree, inner node; infinite where a node is not split
    value: np.ndarray  # tree, leaf
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of a good document for each row of statistics."""
        if not len(self.feature):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        inner = self.feature.shape[1]
        for _ in range(inner.bit_length()):
            above = x[rows, self.feature[trees, at]] > self.threshold[trees, at]
            at = 2 * at + 1 + above
        total = self.base + self.value[trees, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit_forest(
    x: np.ndarray, y: np.ndarray, *, trees: int = TREES, depth: int = DEPTH, bins: int = BINS
) -> Forest:
    """Boosted trees for the logistic loss, from histograms of binned statistics."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    base = float(np.log(share / (1 - share)))
    inner, width = (1 << depth) - 1, x.shape[1]
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, inner + 1))
    if len(set(y.tolist())) < 2:
        return Forest(feature[:0], threshold[:0], value[:0], base)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    cell = binned + np.arange(width) * bins
    margin = np.full(len(y), base)
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, nodes = (1 << level) - 1, 1 << level
            place = ((at - first)[:, None] * (width * bins) + cell).ravel()
            shape = (nodes, width, bins)
            g = np.bincount(place, np.repeat(gradient, width), np.prod(shape)).reshape(shape)
            h = np.bincount(place, np.repeat(weight, width), np.prod(shape)).reshape(shape)
            g, h = g.cumsum(axis=2), h.cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = (
                g**2 / (h + SHRINK)
                + (g_all - g) ** 2 / (h_all - h + SHRINK)
                - g_all**2 / (h_all + SHRINK)
            )
            gain[(h < LEAST_WEIGHT) | (h_all - h < LEAST_WEIGHT)] = 0
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for node in range(nodes):
                f, cut = divmod(int(best[node]), bins)
                if gain[node, f, cut] > 1e-9 and cut < len(cuts[f]):
                    feature[tree, first + node] = f
                    threshold[tree, first + node] = cuts[f][cut]
            above = x[np.arange(len(y)), feature[tree, at]] > threshold[tree, at]
            at = 2 * at + 1 + above
        leaf = at - inner
        g = np.bincount(leaf, gradient, inner + 1)
        h = np.bincount(leaf, weight, inner + 1)
        value[tree] = RATE * g / (h + SHRINK)
        margin += value[tree, leaf]
    return Forest(feature, threshold, value, base)


def held_out(doc_id: Column) -> Column:
    """Rows that no label may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Forest:
    """A forest from labels outside the held-out fold.

    At most ``sample_rows`` ids and as many rows of statistics are fetched. The ids
    are broadcast to the documents, so no text is shuffled.
    """
    known = labels.select(
        column(id_column).alias("id"), column(label_column).cast("int").alias("label")
    ).where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
    # Of different labels of one id the smallest counts.
    one_each = known.groupBy("id").agg(F.min("label").alias("label"))
    sample = one_each.orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()
    chosen = docs.sparkSession.createDataFrame(sample, known.schema)
    texts = docs.select(column(id_column).alias("id"), column(text_column).cast("string").alias("t"))
    found = texts.join(F.broadcast(chosen), "id").select("id", "label", "t")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t or b"") for t in batch.column(2).cast(pa.binary()).to_pylist()]
            listed = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), listed], ["id", "label", "x"]
            )

    kind = dict(known.dtypes)["id"]
    rows = map_arrow(found, work, f"id {kind}, label int, x array<double>")
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("row"))
    taught = sorted((r["row"]["x"], r["row"]["label"]) for r in rows.select("row").collect())
    x = np.array([t[0] for t in taught]).reshape(-1, len(STATISTICS))
    return fit_forest(x, np.array([t[1] for t in taught], dtype=float))


def score_quality(
    docs: DataFrame, forest: Forest, *, text_column: str = "text", score_column: str = "score"
) -> DataFrame:
    """The rows of ``docs`` with all their columns, and their scores as the last."""
    if score_column.lower() in (name.lower() for name in docs.columns):
        raise ValueError(f"there is a column {score_column} already")
    place = docs.columns.index(text_column)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.string()).cast(pa.binary()).to_pylist()
            x = np.array([statistics(t or b"") for t in texts]).reshape(-1, len(STATISTICS))
            scores = pa.array(forest.scores(x))
            yield batch.append_column(score_column, scores)

    schema = T.StructType([*docs.schema.fields, T.StructField(score_column, T.DoubleType())])
    return map_arrow(docs, work, schema)
