"""Probabilities of texts under a unigram model over subword lattices.

The pieces of an existing vocabulary are the arcs of a word's lattice; the word's
probability is the sum over all its segmentations, by the forward recursion in log
space. Weights start from the vocabulary's scores (as ranks, by Zipf's law) and are
re-estimated by expectation maximisation over all different words of the training
texts. A training word is one arc more, over its whole length, with its relative
frequency. While learning, an occurrence is left out of its own word's frequency,
so that pieces are weighted by the words they are needed for: new and rare ones.
A text is its words and an end.

What is gathered grows with the corpus: a table of all different words with their
counts. The most frequent ones, up to a number, are broadcast to the texts;
occurrences of all others meet the table in a join.

Defined cases: a null text is an empty one and has its end only. Rows are scored
each, also repeated ones; without id they belong to the training texts. Without
training texts every word has count zero. An empty table gives no rows. Very long words
are gone through in blocks of ``PART`` characters, each of which carries on from the one
before, so all their segmentations count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import BROADCAST_ROWS, column, map_arrow, row_numbers, saved

START = "▁"
PART = 256
ROUNDS = 3
COUNTED_WORDS = 200_000
SMOOTHING = 0.1

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 18

# Weights and piece numbers by (word, end, length), and the bytes of odd characters.
Arcs = tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]


@dataclass(frozen=True)
class Vocabulary:
    """Pieces and their natural-log weights; ``bytes_at`` are the 256 byte pieces."""

    pieces: tuple[str, ...]
    bytes_at: tuple[int, ...]
    weights: np.ndarray
    # Of arcs over whole training words.
    share: float = 0.5

    @classmethod
    def of(cls, path: str) -> Vocabulary:
        """The pieces of a sentencepiece model, weighted by the rank of their scores."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, scores, by_byte = [], [], {}
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                by_byte[int(piece[3:5], 16)] = len(pieces)
                piece = ""
            elif model.is_control(number) or model.is_unknown(number) or START in piece[1:]:
                continue
            pieces.append(piece)
            scores.append(model.get_score(number))
        # Byte pieces serve characters that have no piece, so they rank last.
        scores = np.array(scores)
        scores[list(by_byte.values())] = scores.min() - 1
        ranks = np.empty(len(scores))
        ranks[np.argsort(-scores, kind="stable")] = np.arange(len(scores))
        weights = 1 / (ranks + 10)
        weights /= weights.sum()
        at = tuple(by_byte[b] for b in range(256))
        return cls(tuple(pieces), at, np.log(weights))

    def learned(self, expected: np.ndarray, share: float) -> Vocabulary:
        """Weights from expected numbers of pieces."""
        counts = expected + SMOOTHING
        return Vocabulary(self.pieces, self.bytes_at, np.log(counts / counts.sum()), share)


class Lattice:
    """Forward and backward recursions over many words at once."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        real = [(n, p) for n, p in enumerate(vocabulary.pieces) if p]
        self.widest = max(len(p) for _, p in real)
        keys = np.zeros(1 << _SLOTS, np.uint64)
        names = np.full(1 << _SLOTS, -1)
        powers = [pow(int(_BASE), n, 2**64) for n in range(self.widest + 1)]
        self.powers = np.array(powers, np.uint64)
        by_length: dict[int, list[tuple[int, str]]] = {}
        for number, piece in real:
            by_length.setdefault(len(piece), []).append((number, piece))
        for length, found in by_length.items():
            codes = np.array([[ord(c) for c in p] for _, p in found], np.uint64)
            hashes = self._prefixes(codes)[:, length]
            for (number, _), key in zip(found, hashes.tolist()):
                slot = key * int(_BASE) % 2**64 >> (64 - _SLOTS)
                while names[slot] >= 0:
                    slot = (slot + 1) % len(keys)
                keys[slot], names[slot] = key, number
        self.keys, self.names = keys, names
        self.lengths = sorted(by_length)

    def _prefixes(self, codes: np.ndarray) -> np.ndarray:
        out = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
        for at in range(codes.shape[1]):
            out[:, at + 1] = out[:, at] * _BASE + codes[:, at]
        return out

    def _lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of pieces by the hash of their characters, -1 for none."""
        slot = (hashes * _BASE >> np.uint64(64 - _SLOTS)).astype(np.int64)
        out = np.where(self.keys[slot] == hashes, self.names[slot], -1)
        left = np.nonzero((out < 0) & (self.names[slot] >= 0))
        while len(left[0]):
            slot[left] = (slot[left] + 1) % len(self.keys)
            at = slot[left]
            out[left] = np.where(self.keys[at] == hashes[left], self.names[at], -1)
            open_ = (out[left] < 0) & (self.names[at] >= 0)
            left = tuple(x[open_] for x in left)
        return out

    def arcs(self, codes: np.ndarray) -> Arcs:
        """Weights and piece numbers by (word, end, length), and the bytes of odd characters."""
        n, width = codes.shape
        sums = self._prefixes(codes)
        lengths = [x for x in self.lengths if x <= width]
        number = np.full((n, width, max(lengths, default=1)), -1)
        for length in lengths:
            hashes = sums[:, length:] - sums[:, :-length] * self.powers[length]
            number[:, length - 1 :, length - 1] = self._lookup(hashes)
        weight = np.where(number >= 0, self.v.weights[number], -np.inf)
        odd: dict[int, np.ndarray] = {}
        missing = number[:, :, 0] < 0
        for code in np.unique(codes[missing]).tolist() if missing.any() else ():
            raw = np.array([self.v.bytes_at[b] for b in chr(code).encode("utf-8", "replace")])
            odd[code] = raw
            weight[:, :, 0][missing & (codes == code)] = self.v.weights[raw].sum()
        return weight, number, odd

    @staticmethod
    def _extend(alpha: np.ndarray, weight: np.ndarray, first: int, begin: int) -> None:
        """Forward values of the ends after ``first``; place 0 of ``weight`` is ``begin``."""
        for end in range(first + 1, begin + weight.shape[1] + 1):
            reach = min(end, weight.shape[2])
            terms = weight[:, end - 1 - begin, :reach] + alpha[:, end - reach : end][:, ::-1]
            top = terms.max(axis=1)
            alpha[:, end] = top + np.log(np.exp(terms - top[:, None]).sum(axis=1))

    def _forward(self, codes: np.ndarray) -> tuple[np.ndarray, Arcs | None]:
        """Forward values, and the arcs where they are those of whole words.

        Long words go block by block; each block carries on from the values before it.
        """
        n, width = codes.shape
        alpha = np.full((n, width + 1), -np.inf)
        alpha[:, 0] = 0
        arcs = None
        for first in range(0, width, PART):
            begin = max(0, first - self.widest + 1)
            arcs = self.arcs(codes[:, begin : first + PART])
            self._extend(alpha, arcs[0], first, begin)
        return alpha, arcs if width <= PART else None

    def probabilities(self, words: list[str]) -> np.ndarray:
        """Natural-log marginal probability of each word, as part of a text."""
        out = np.zeros(len(words))
        for places, codes in _by_length(words):
            out[places] = self._forward(codes)[0][:, -1]
        return out

    def expected(
        self, words: list[str], counts: np.ndarray, share: float, tokens: int
    ) -> tuple[np.ndarray, float]:
        """Expected numbers of each piece, and of words made of pieces.

        The words were met ``counts`` times among ``tokens``; ``share`` is that of
        whole-word arcs.
        """
        total, made = np.zeros(len(self.v.pieces)), 0.0
        for places, codes in _by_length(words):
            alpha, arcs = self._forward(codes)
            by_pieces = np.log(1 - share) + alpha[:, -1]
            with np.errstate(divide="ignore"):
                whole = np.log(share * (counts[places] - 1) / max(1, tokens - 1))
            times = counts[places] * np.exp(by_pieces - np.logaddexp(by_pieces, whole))
            made += float(times.sum())
            self._add_expected(total, codes, alpha, arcs, times)
        return total, made

    def _add_expected(
        self, total: np.ndarray, codes: np.ndarray, alpha: np.ndarray, arcs: Arcs | None, times: np.ndarray
    ) -> None:
        """Add to ``total`` how often each piece is expected in words met so many times."""
        n, width = codes.shape
        beta = np.full((n, width + 1), -np.inf)
        beta[:, width] = 0
        for first in reversed(range(0, width, PART)):
            last = min(width, first + PART)
            covered = codes[:, first : last + self.widest - 1]
            weight, number, odd = arcs or self.arcs(covered)
            for start in range(last - 1, first - 1, -1):
                reach = min(width - start, weight.shape[2])
                steps = np.arange(reach)
                terms = weight[:, start - first + steps, steps] + beta[:, start + 1 : start + 1 + reach]
                top = terms.max(axis=1)
                beta[:, start] = top + np.log(np.exp(terms - top[:, None]).sum(axis=1))
            # The share of a word's probability that goes through each arc that begins here.
            through = np.full_like(weight, -np.inf)
            for length in range(1, weight.shape[2] + 1):
                begins = min(last, width - length + 1) - first
                if begins > 0:
                    ends = slice(length - 1, length - 1 + begins)
                    through[:, ends, length - 1] = (
                        alpha[:, first : first + begins]
                        + weight[:, ends, length - 1]
                        + beta[:, first + length : first + length + begins]
                    )
            through = np.exp(through - alpha[:, -1][:, None, None]) * times[:, None, None]
            used = number >= 0
            total += np.bincount(number[used], through[used], len(total))
            for code, raw in odd.items():
                amount = through[:, :, 0][(covered == code) & (number[:, :, 0] < 0)].sum()
                np.add.at(total, raw, amount)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, codes): the words with their start mark, in groups of equal length."""
    groups: dict[int, list[tuple[int, str]]] = {}
    for place, word in enumerate(words):
        marked = START + word
        groups.setdefault(len(marked), []).append((place, marked))
    for length, found in groups.items():
        step = max(1, 40_000 // length)
        for at in range(0, len(found), step):
            places, marked = zip(*found[at : at + step])
            codes = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), np.uint32)
            yield np.array(places), codes.reshape(len(marked), length).astype(np.uint64)


# ---- tables

def held_out(doc_id: Column) -> Column:
    """Texts that nothing may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c, n): occurrences in training texts, and in all."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            words = list(seen)
            columns = [pa.array(words, pa.binary())]
            columns += [pa.array(list(map(c.__getitem__, words)), pa.int64()) for c in (learned, seen)]
            return pa.RecordBatch.from_arrays(columns, ["word", "c", "n"])

        learned: Counter = Counter()
        seen: Counter = Counter()
        for batch in batches:
            for out, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (text or b"").lower().split()
                seen.update(words)
                if not out:
                    learned.update(words)
            if len(seen) > COUNTED_WORDS:
                yield rows()
                learned, seen = Counter(), Counter()
        if seen:
            yield rows()

    partial = map_arrow(texts, work, "word binary, c bigint, n bigint")
    return partial.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def learn(words: DataFrame, vocabulary: Vocabulary, tokens: int, rounds: int = ROUNDS) -> Vocabulary:
    """Weights re-estimated over the training words; one row a piece is fetched."""
    counted = words.where("c > 0").agg(F.sum("c")).first()[0]
    if not counted:
        return vocabulary
    for _ in range(rounds):

        def work(batches: Iterator[pa.RecordBatch], current: Vocabulary = vocabulary):
            lattice = Lattice(current)
            # The last place is for words made of pieces.
            total = np.zeros(len(current.pieces) + 1)
            for batch in batches:
                names = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
                pieces, made = lattice.expected(names, batch.column(1).to_numpy(), current.share, tokens)
                total[:-1] += pieces
                total[-1] += made
            some = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["piece", "n"])

        found = map_arrow(words.where("c > 0").select("word", "c"), work, "piece bigint, n double", 8192)
        expected = np.zeros(len(vocabulary.pieces) + 1)
        for piece, n in found.groupBy("piece").agg(F.sum("n")).collect():
            expected[piece] = n
        share = float(np.clip(1 - expected[-1] / counted, 0.001, 0.999))
        vocabulary = vocabulary.learned(expected[:-1], share)
    return vocabulary


def with_lattice(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(word, c, n, lattice): the log10 probability by pieces alone."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary)
        for batch in batches:
            names = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            found = lattice.probabilities(names) / np.log(10)
            yield batch.append_column("lattice", pa.array(found))

    return map_arrow(
        words.select("word", "c", "n"), work, "word binary, c bigint, n bigint, lattice double", 8192
    )


def score_texts(
    docs: DataFrame,
    vocabulary: Vocabulary,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    frequent_words: int = BROADCAST_ROWS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    doc_id = column(id_column)
    texts = docs.select(
        doc_id.cast("bigint").alias("doc_id"),
        held_out(doc_id).alias("held_out"),
        column(text_column).cast("string").cast("binary").alias("text"),
    )
    counted = saved(word_counts(texts), "words")
    ends = texts.where("NOT held_out").count()
    tokens, distinct = counted.where("c > 0").agg(F.sum("c"), F.count("*")).first()
    train_tokens, distinct = (tokens or 0) + ends, distinct + (ends > 0)
    model = learn(counted, vocabulary, train_tokens)
    weighed = saved(with_lattice(counted, model), "words")
    share = model.share

    def base_of(c: Column) -> Column:
        return F.log10((c + 1) / F.lit(float(train_tokens + distinct + 1)))

    def score_of(c: Column, lattice: Column) -> Column:
        whole = share * c / max(1, train_tokens)
        both = F.log10(whole + (1 - share) * F.pow(F.lit(10.0), lattice))
        return F.when(c == 0, lattice + float(np.log10(1 - share))).otherwise(both)

    table = weighed.select(
        "word", "n",
        (F.col("c") > 0).alias("known"),
        base_of(F.col("c")).alias("base"),
        score_of(F.col("c"), F.col("lattice")).alias("score"),
    )
    common = _frequent(table, frequent_words)
    # An end is known as a whole, by as many as there are training texts.
    end_base = np.log10((ends + 1) / (train_tokens + distinct + 1))
    end_score = np.log10(share * max(ends, 1) / max(1, train_tokens))
    end = (float(end_base), float(end_score), int(ends > 0))
    parts = saved(_parts(texts, common, end), "scores")
    rare = (
        parts.where("word IS NOT NULL")
        .select("row", "word", "tf")
        .join(table.drop("n"), "word")
        .select(
            "row",
            F.lit(None).cast("bigint").alias("doc_id"),
            F.lit(None).cast("boolean").alias("held_out"),
            F.lit(0).cast("bigint").alias("n_tokens"),
            F.when(F.col("known"), F.col("tf")).otherwise(0).alias("n_known"),
            (F.col("tf") * F.col("base")).alias("base"),
            (F.col("tf") * F.col("score")).alias("score"),
        )
    )
    whole = parts.where("word IS NULL").drop("word", "tf")
    return (
        whole.unionByName(rare)
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum("n_known").alias("n_known"),
            F.lit(train_tokens).cast("bigint").alias("train_tokens"),
            F.sum("base").alias("base_score"),
            F.sum("score").alias("score"),
        )
        .drop("row")
    )


def _frequent(table: DataFrame, most: int) -> list[tuple]:
    """The most frequent words with what they add, no more than ``most``.

    The least count is taken from a histogram of counts, in steps of a sixteenth of
    a doubling, so nothing but the chosen words is fetched.
    """
    step = F.floor(F.log2("n") * 16)
    sizes = sorted((tuple(r) for r in table.groupBy(step.alias("s")).count().collect()), reverse=True)
    least, total = None, 0
    for s, size in sizes:
        if total + size > most:
            break
        least, total = s, total + size
    if least is None:
        return []
    rows = table.where(step >= least).select("word", "base", "score", "known").collect()
    return [tuple(r) for r in rows]


def _parts(texts: DataFrame, common: list[tuple], end: tuple[float, float, int]) -> DataFrame:
    """A row for each text with what its frequent words and its end add up to, and
    one for each of its other words."""
    names = [bytes(r[0]) for r in common]
    # A place more, for words that are not among them.
    base, score, known = (np.array([*(r[i] for r in common), 0], float) for i in (1, 2, 3))
    schema = pa.schema(
        [
            ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
            ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
            ("score", pa.float64()), ("word", pa.binary()), ("tf", pa.int64()),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = {w: i for i, w in enumerate(names)}.get
        numbers = row_numbers()
        for batch in batches:
            out: list[tuple] = []
            for doc, held, text in zip(*(c.to_pylist() for c in batch.columns)):
                words = (text or b"").lower().split()
                at = np.fromiter(map(get, words, repeat(len(names))), np.int64, len(words))
                row = next(numbers)
                sums = (base[at].sum() + end[0], score[at].sum() + end[1])
                out.append((row, doc, held, len(words) + 1, int(known[at].sum()) + end[2], *sums, None, None))
                others = Counter(map(words.__getitem__, np.flatnonzero(at == len(names)).tolist()))
                out += [(row, None, None, None, None, None, None, w, tf) for w, tf in others.items()]
            columns = zip(*out) if out else repeat((), len(schema))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

    return map_arrow(
        texts,
        work,
        "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, "
        "score double, word binary, tf bigint",
        rows=128,
    )

