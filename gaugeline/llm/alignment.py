"""Links between the tokens of two tokenizers over the same texts.

The tokens of either tokenizer cover the bytes of a text; which token covers which byte is
a sparse matrix in compressed rows. The product of one with the other's transpose, row by
row after Gustavson, has an entry wherever two tokens overlap: the bytes they share. Places
where tokens of both end cut the tokens into groups, read off the ends of the rows of that
product. Token-group matrices multiplied in the same way give the links: all pairs of tokens
that share a group. Products are made in blocks of rows of bounded size.

Texts are cut before a space that follows a mark or letter. Neither tokenizer joins
bytes across such a place: the byte-level one splits there before it merges, and no piece
of the other has a space after other characters (checked; else texts stay whole). So equal
parts of a batch of texts are encoded and aligned once, and a text adds up its parts: one more
product, of the parts of each text with the links of each part.

How many texts hold a pair of ids linked is counted over the corpus. The most frequent
pairs, up to a number, are broadcast to the texts; all others meet the counts in a join.

Defined cases: a text that is null or empty, or whose tokens of either side do not give
back its bytes, has no tokens and no groups. Rows are looked at each, also repeated ones,
and each counts as a text. An empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import BROADCAST_ROWS, column, map_arrow, row_numbers, saved

START = "▁"
# Entries of a product that are made at once.
BLOCK_ENTRIES = 1 << 21
# Characters of texts that are aligned together.
CHARACTERS_AT_ONCE = 1_000_000
LONGEST_STRETCH = 2000

ALIGNED = (
    "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups string, pairs array<bigint>, links array<bigint>"
)

# A space after anything but white space. The marks excluded are white space to one of the
# libraries at least.
_CUT = re.compile("(?<=[^\\s\\x1c-\\x1f\\x85\\u180e\\u200b\\u2060\\ufeff]) ")


# ---- sparse matrices

@dataclass(frozen=True)
class Rows:
    """A sparse matrix in compressed rows: row i has ``value`` in ``column`` from ends[i] to ends[i + 1]."""

    ends: np.ndarray
    column: np.ndarray
    value: np.ndarray
    width: int

    @classmethod
    def marks(cls, sizes: np.ndarray, column: np.ndarray, width: int) -> Rows:
        """Ones in the given columns, so many in each row."""
        return cls(np.r_[0, np.cumsum(sizes)], column, np.ones(len(column), np.int64), width)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ends) - 1), np.diff(self.ends))

    def transposed(self) -> Rows:
        order = np.argsort(self.column, kind="stable")
        sizes = np.bincount(self.column, minlength=self.width)
        return Rows(np.r_[0, np.cumsum(sizes)], self.row[order], self.value[order], len(self.ends) - 1)


def row_products(one: Rows, other: Rows, most: int = BLOCK_ENTRIES) -> Iterator[tuple[int, Rows]]:
    """Blocks of rows of the product, each with its first row: row i is the sum of the rows of
    ``other`` that the entries of row i name, times those entries."""
    added = np.r_[0, np.cumsum(np.diff(other.ends)[one.column])]
    upto = added[one.ends]  # entries before each row
    first, rows = 0, len(one.ends) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(upto, upto[first] + most, "right")) - 1)
        a, b = one.ends[first], one.ends[last]
        named = one.column[a:b]
        sizes = np.diff(other.ends)[named]
        row = np.repeat(np.repeat(np.arange(last - first), np.diff(one.ends[first : last + 1])), sizes)
        within = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(other.ends[named], sizes) + within
        value = np.repeat(one.value[a:b], sizes) * other.value[at]
        # Equal places of a row are added up.
        place = row * other.width + other.column[at]
        if len(place) and (np.diff(place) < 0).any():
            order = np.argsort(place, kind="stable")
            place, value = place[order], value[order]
        starts = np.flatnonzero(np.r_[True, np.diff(place) != 0]) if len(place) else place
        place, total = place[starts], np.add.reduceat(value, starts) if len(place) else value
        ends = np.searchsorted(place, np.arange(last - first + 1) * other.width)
        yield first, Rows(ends, place % max(1, other.width), total, other.width)
        first = last


def overlaps(a_sizes: np.ndarray, b_sizes: np.ndarray, most: int = BLOCK_ENTRIES) -> Iterator[tuple[int, Rows]]:
    """Bytes that tokens of one side share with tokens of the other, by their sizes in bytes.

    In blocks of rows; a row is a token of the first side.
    """
    n = int(a_sizes.sum())
    a, b = (Rows.marks(s, np.arange(n), n) for s in (a_sizes, b_sizes))
    yield from row_products(a, b.transposed(), most)


def groups_of(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of either side: the next one begins where both end."""
    a_group, b_group = np.zeros(len(a_sizes), np.int64), np.zeros(len(b_sizes), np.int64)
    group, last = -1, -1
    for first_row, block in overlaps(a_sizes, b_sizes):
        low, high = block.column[block.ends[:-1]], block.column[block.ends[1:] - 1]
        begins = low > np.r_[last, high[:-1]]
        own = group + np.cumsum(begins)
        a_group[first_row : first_row + len(own)] = own
        b_group[block.column] = own[block.row]
        group, last = int(own[-1]), int(high[-1])
    return a_group, b_group


def shared_groups(a_group: np.ndarray, b_group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of tokens (of one side, of the other) in one group, in blocks."""
    n = int(max(a_group.max(initial=-1), b_group.max(initial=-1))) + 1
    a, b = (Rows.marks(np.ones(len(g), np.int64), g, n) for g in (a_group, b_group))
    for first_row, block in row_products(a, b.transposed()):
        yield first_row + block.row, block.column


# ---- tokenizers

class ByteLevel:
    """Tokens of a byte-level tokenizer file.

    Where the file's merges make its ids in ascending order, an id is the rank of its merge, and
    an encoder by ranks gives the same ids in a quarter of the time, given the pattern that the
    tokenizer splits by. Its time grows with the square of what the pattern does not split,
    so long parts go to the file's own library, as all do where ids are no ranks.
    """

    cuttable = True

    def __init__(self, path: str, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        letters = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(c in letters for c in token)
            self.bytes_of[number] = bytes(letters[c] for c in token) if known else token.encode()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"]["".join(m)] for m in merges]
        ranked = made == sorted(made) and len(set(made)) == len(made)
        self.encoding = None
        if pattern and ranked:
            import tiktoken

            plain = {t: n for t, n in model["vocab"].items() if all(c in letters for c in t)}
            bare = {n for t, n in plain.items() if len(t) == 1}
            if bare | set(made) == set(plain.values()):
                ranks = {self.bytes_of[n]: n for n in plain.values()}
                self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Of a space and each text."""
        spaced = [" " + t for t in texts]
        if self.encoding is None:
            return self._by_library(spaced)
        quick = self.encoding.encode_ordinary
        return [quick(t) if len(t) <= LONGEST_STRETCH else self._by_library([t])[0] for t in spaced]

    def _by_library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces:
    """Tokens of a sentencepiece model, which begins each text with a space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of, self.cuttable = [], True
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            if model.is_byte(number):
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes_of.append(piece.replace(START, " ").encode())
                self.cuttable &= START not in piece.lstrip(START)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Of a space and each text."""
        # No text at all gets no space either, only one that ends with it.
        found = self.model.encode([t or "x " for t in texts], num_threads=1)
        if "" in texts:
            before = len(self.model.encode("x"))
            found = [ids if t else ids[before:] for ids, t in zip(found, texts)]
        return found


class Tokens:
    """The tokens of one side in a row, and how many of them each part has."""

    def __init__(self, tokenizer: ByteLevel | Pieces):
        self.tokenizer = tokenizer
        self.sizes = np.array([len(b) for b in tokenizer.bytes_of])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(tokenizer.bytes_of), np.uint8)
        # Ids as text, each with every mark that may follow it, and how long that is.
        numbers = range(len(tokenizer.bytes_of))
        self.names = [[f"{n}{mark}" for n in numbers] for mark in ",|;"]
        self.name_sizes = np.array([len(name) for name in self.names[0]])

    def of(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(parts)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        return self.letters[np.arange(int(sizes.sum())) + np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes)]


@dataclass(frozen=True)
class Parts:
    """What each part of texts has: whether its tokens give back its bytes, numbers of tokens,
    groups and links, its groups as text, and its links by pair of ids."""

    right: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    ends: np.ndarray
    pairs: np.ndarray
    links: np.ndarray


_NOTHING = np.zeros(0, np.int64)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of so many values each."""
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


class Aligner:
    """Texts to linked tokens, for use inside a task."""

    def __init__(self, one: ByteLevel | Pieces, other: ByteLevel | Pieces):
        self.cuttable = one.cuttable and other.cuttable
        self.sides = Tokens(one), Tokens(other)
        self.width = len(other.bytes_of)  # a pair is (id of one) * width + (id of other)
        self.span = len(one.bytes_of) * self.width

    def parts(self, text: str) -> list[str]:
        """What the text is cut into, each without the space before it."""
        return _CUT.split(text) if self.cuttable else [text]

    def align(self, parts: list[str]) -> Parts:
        """Every part, each with a space before it."""
        raw = [b" " + part.encode() for part in parts]
        raw_sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        found = [side.of(parts) for side in self.sides]
        right = np.ones(len(parts), bool)
        for side, (ids, counts) in zip(self.sides, found):
            right &= _sums(side.sizes[ids], counts) == raw_sizes
        # Of parts as long as their tokens are, so the bytes stand one below the other.
        long = right.copy()
        if not long.all():
            raw = [r for r, fine in zip(raw, long.tolist()) if fine]
        letters = np.frombuffer(b"".join(raw), np.uint8)
        for side, (ids, counts) in zip(self.sides, found):
            differ = side.bytes_of(ids[np.repeat(long, counts)]) != letters
            if differ.any():
                right[np.flatnonzero(long)[_sums(differ, raw_sizes[long]) > 0]] = False
        (a, n_a), (b, n_b) = ((ids[np.repeat(right, counts)], np.where(right, counts, 0)) for ids, counts in found)
        none = np.zeros(len(parts), np.int64)
        if not len(a):
            return Parts(right, none, none, none, none, [""] * len(parts), np.zeros(len(parts) + 1, np.int64), _NOTHING, _NOTHING)
        a_group, b_group = groups_of(self.sides[0].sizes[a], self.sides[1].sizes[b])
        part_of = np.repeat(np.arange(len(parts)), n_a)
        # Links by part and pair, added up block by block.
        keys, counts = [], []
        for row, col in shared_groups(a_group, b_group):
            key, count = np.unique(part_of[row] * self.span + a[row] * self.width + b[col], return_counts=True)
            keys.append(key)
            counts.append(count)
        key, number = np.unique(np.concatenate(keys), return_inverse=True)
        links = np.bincount(number.reshape(-1), np.concatenate(counts), len(key)).astype(np.int64)
        ends = np.searchsorted(key, np.arange(len(parts) + 1) * self.span)
        # The last group of each part, and so their numbers.
        last = np.cumsum(n_a) - 1
        upto = np.where(last >= 0, a_group[np.maximum(last, 0)] + 1, 0)
        n_groups = np.diff(np.r_[0, upto])
        return Parts(
            right, n_a, n_b, n_groups, _sums(links, np.diff(ends)),
            self._texts(a, b, a_group, b_group, n_a, n_b), ends, key % self.span, links,
        )

    def _texts(self, a, b, a_group, b_group, n_a, n_b) -> list[str]:
        """The groups of each part as text, cut out of that of all."""
        group = np.r_[a_group, b_group]
        order = np.argsort(group, kind="stable")  # of equal groups those of one side first
        side = order >= len(a)
        ids = np.r_[a, b][order]
        # Between tokens of a group a comma, between its sides a bar, after it a semicolon.
        same_group = np.r_[group[order][1:] == group[order][:-1], False]
        same_side = np.r_[side[1:] == side[:-1], False]
        kind = np.where(~same_group, 2, np.where(same_side, 0, 1)) + 3 * side
        names = self.sides[0].names + self.sides[1].names
        text = "".join([names[k][i] for k, i in zip(kind.tolist(), ids.tolist())])
        sizes = np.where(side, self.sides[1].name_sizes[np.where(side, ids, 0)], self.sides[0].name_sizes[np.where(side, 0, ids)])
        ends = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(n_a + n_b)]].tolist()
        return [text[i : max(i, j - 1)] for i, j in zip(ends, ends[1:])]

    def texts(self, texts: list[str | None]) -> Iterator[tuple]:
        """(n_a, n_b, n_groups, n_links, groups, pairs, links) of each text."""
        at, size = 0, 0
        for place, text in enumerate(texts):
            size += len(text or "")
            if size >= CHARACTERS_AT_ONCE or place == len(texts) - 1:
                yield from self._batch(texts[at : place + 1])
                at, size = place + 1, 0

    def _batch(self, texts: list[str | None]) -> Iterator[tuple]:
        cut = [self.parts(t) if t else [] for t in texts]
        number: dict[str, int] = {}
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        place = np.fromiter(
            (number.setdefault(p, len(number)) for parts in cut for p in parts), np.int64, int(sizes.sum())
        )
        if not number:
            yield from repeat((0, 0, 0, 0, "", _NOTHING, _NOTHING), len(texts))
            return
        parts = self.align(list(number))
        row = np.repeat(np.arange(len(texts)), sizes)
        wrong = np.bincount(row, ~parts.right[place], len(texts)) > 0
        fine = ((sizes > 0) & ~wrong).tolist()
        sums = [
            np.bincount(row, values[place], len(texts)).astype(np.int64).tolist()
            for values in (parts.n_a, parts.n_b, parts.n_groups, parts.n_links)
        ]
        met, times = np.unique(row * len(number) + place, return_counts=True)
        ends = np.searchsorted(met, np.arange(len(texts) + 1) * len(number))
        by_text = Rows(ends, met % len(number), times, len(number))
        pairs, pair = np.unique(parts.pairs, return_inverse=True)
        by_part = Rows(parts.ends, pair.reshape(-1), parts.links, len(pairs))
        listed = parts.groups
        ends = np.r_[0, np.cumsum(sizes)].tolist()
        order = place.tolist()
        for first, block in row_products(by_text, by_part):
            for at, (i, j) in enumerate(zip(block.ends[:-1].tolist(), block.ends[1:].tolist()), first):
                if not fine[at]:
                    yield 0, 0, 0, 0, "", _NOTHING, _NOTHING
                    continue
                groups = ";".join([listed[p] for p in order[ends[at] : ends[at + 1]]])
                yield *(s[at] for s in sums), groups, pairs[block.column[i:j]], block.value[i:j]


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(one: str, pattern: str | None, other: str) -> Aligner:
    """One a worker process, whatever number of tasks it runs."""
    key = (one, pattern, other)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(ByteLevel(one, pattern), Pieces(other))
    return _ALIGNERS[key]


# ---- tables

def align_tokens(
    docs: DataFrame,
    *,
    byte_level: str,
    pieces: str,
    pattern: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """ALIGNED rows: of every text, its tokens by groups and its links by pair of ids.

    ``groups`` lists the ids of each group in order, "a1,a2|b1;a3|b2"; a pair is the id of the
    first side times the number of ids of the second, and the id of the second. ``pattern`` is
    what the byte-level tokenizer splits texts by; given, it is encoded faster.
    """
    rows = docs.select(
        column(id_column).cast("bigint").alias("doc_id"), column(text_column).cast("string").alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, numbers = aligner(byte_level, pattern, pieces), row_numbers()
        for batch in batches:
            n = batch.num_rows
            found = list(align.texts(batch.column(1).to_pylist()))
            *sums, groups, pairs, links = zip(*found) if found else repeat((), 7)
            ends = pa.array(np.cumsum([0, *map(len, pairs)], dtype=np.int32))
            listed = [pa.array(np.concatenate([_NOTHING, *values])) for values in (pairs, links)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(numbers) for _ in range(n)], pa.int64()),
                    batch.column(0),
                    *(pa.array(s, pa.int64()) for s in sums),
                    pa.array(groups, pa.string()),
                    *(pa.ListArray.from_arrays(ends, values) for values in listed),
                ],
                ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "links"],
            )

    return map_arrow(rows, work, ALIGNED, rows=256)


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): texts that hold each pair linked; best if no pair of its first id has more."""
    counted = saved(
        aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")),
        "pairs",
    )
    first = F.expr(f"pair div {width}")
    # One row for each id of a vocabulary.
    most = counted.groupBy(first.alias("first")).agg(F.max("n").alias("most"))
    return counted.withColumn("first", first).join(F.broadcast(most), "first").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )


def link_counts(aligned: DataFrame, width: int, *, frequent_pairs: int = BROADCAST_ROWS) -> DataFrame:
    """(row, n_best, count_sum) of every row of a stored ALIGNED table that has links.

    ``count_sum`` adds up the counts of the pairs of all links, ``n_best`` counts the links
    whose pair is a best one.
    """
    table = saved(pair_counts(aligned, width), "counts")
    common = _frequent(table, frequent_pairs)
    known = np.array([r[0] for r in common], np.int64)
    count, best = (np.array([*(r[i] for r in common), 0], np.int64) for i in (1, 2))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            pair, links = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in (1, 2))
            at = np.searchsorted(known, pair)
            hit = np.zeros(len(pair), bool)
            inside = at < len(known)
            hit[inside] = known[at[inside]] == pair[inside]
            at[~hit] = len(known)
            place = np.repeat(np.arange(len(sizes)), sizes)
            sums = [np.zeros(len(sizes), np.int64) for _ in range(2)]
            for total, values in zip(sums, (best, count)):
                np.add.at(total, place, links * values[at])
            rows = batch.column(0).to_numpy()
            rare = np.flatnonzero(~hit)
            nothing = np.zeros(len(rare), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[rows, rows[place[rare]]]),
                    *(pa.array(np.r_[total, nothing]) for total in sums),
                    pa.concat_arrays([pa.nulls(len(rows), pa.int64()), pa.array(pair[rare])]),
                    pa.concat_arrays([pa.nulls(len(rows), pa.int64()), pa.array(links[rare])]),
                ],
                ["row", "n_best", "count_sum", "pair", "links"],
            )

    sums = map_arrow(
        aligned.where(F.size("pairs") > 0).select("row", "pairs", "links"),
        work,
        "row bigint, n_best bigint, count_sum bigint, pair bigint, links bigint",
    )
    sums = saved(sums, "link-sums")
    rare = (
        sums.where("pair IS NOT NULL")
        .select("row", "pair", "links")
        .join(table, "pair")
        .select(
            "row",
            F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"),
            (F.col("links") * F.col("n")).alias("count_sum"),
        )
    )
    whole = sums.where("pair IS NULL").select("row", "n_best", "count_sum")
    return (
        whole.union(rare)
        .groupBy("row")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )


def _frequent(table: DataFrame, most: int) -> list[tuple]:
    """(pair, n, best) of the most frequent pairs by pair, no more than ``most``.

    The least count is taken from a histogram of counts, in steps of a sixteenth of
    a doubling, so nothing but the chosen pairs is fetched.
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
    rows = table.where(step >= least).select("pair", "n", F.col("best").cast("int")).collect()
    return sorted(tuple(r) for r in rows)
