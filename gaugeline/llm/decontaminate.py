"""Passages of benchmark items in texts, found by n-grams and scored by alignment.

The word n-grams of the items are the seeds, and where a text has one, the two are joined.
n is ``seed_words``, and half the words of items that are shorter than two seeds (two words at
least): one changed word leaves so many in a row. That so many words of an item stand in
a text is rare by itself; a seed that is common nonetheless is looked for like any
other, as in an edited copy it may be the only one left. The passage around the seeds
of an item is aligned with it by Smith-Waterman over words, and the score is the
share of the best possible one; edited copies lose a little, chance meetings most. A match
is reported from a score of ``least_score`` on, and from an aligned stretch on that is worth
``least_stretch`` equal words in a row, whatever share of the item that is. A passage is not
aligned if too few words of the item are in it for either.

All of it is joins, for benchmarks of any size: a bitmap of bounded size tells a task which
n-grams of its texts may be seeds, so that little but them is joined with the
items; texts that have some are stored with their words; the items of one text
are aligned in blocks of a bounded number of words. Joins are between stored tables, so
a seed or an item that very many texts have is split over tasks.

Defined cases: null texts and items count as empty and match nothing. An item of
one word is a seed of one word. Repeated items are one
item to the search, and each of their ids is reported. Repeated rows are judged each. An
empty benchmark or table gives no matches. Further columns are passed on by
``drop_contaminated`` and not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import column, fresh_name, map_arrow, row_numbers, saved

SEED_WORDS = 5
LEAST_SCORE = 0.5
LEAST_STRETCH = 13
MATCH, MISMATCH, GAP = 2, -1, -1
# Words of the items that are aligned with one text at once.
BLOCK_WORDS = 200_000
# Passages of one item are padded to one length and aligned together.
CELLS_AT_ONCE = 1 << 21
# Bits of the bitmap of seeds: 8 MB.
SEED_BITS = 1 << 26

MARKS = ".,;:!?\"'()[]{}*#$%&|"
KNOWN_WORDS = 300_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    """Lower-case words without the punctuation around them."""
    return [w for w in (w.strip(MARKS) for w in (text or "").lower().split()) if w]


class WordHashes(dict):
    """Hashes of written words without the punctuation around them, 0 if nothing is left."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= KNOWN_WORDS:
            self.clear()
        bare = word.strip(MARKS)
        self[word] = found = (xxhash.xxh64_intdigest(bare.encode("utf-8", "replace")) or 1) if bare else 0
        return found

    def of(self, text: str | None) -> np.ndarray:
        """The hashes of the words of a text."""
        written = (text or "").lower().split()
        hashes = np.fromiter(map(self.__getitem__, written), np.uint64, len(written))
        return hashes[hashes != 0]


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each n consecutive words."""
    out = np.full(max(0, len(hashes) - n + 1), n, np.uint64)
    for k in range(n):
        out = (out ^ hashes[k : k + len(out)]) * _BASE
        out ^= out >> np.uint64(29)
    return out


def seed_length(words: int, n: int) -> int:
    """Words in a row that an item of so many words keeps if one of them is changed, n at most."""
    return min(n, max(words // 2, min(words, 2)))


def align(item: np.ndarray, passages: np.ndarray) -> np.ndarray:
    """Smith-Waterman scores of an item with each row of passages, as shares of the best.

    Rows are padded with -1. A row of the table is filled at once: a gap within it
    is a running maximum of scores with the slope of the gap taken out.
    """
    width = passages.shape[1]
    slope = -GAP * np.arange(width + 1)
    above = np.zeros((len(passages), width + 1))
    best = np.zeros(len(passages))
    for word in item:
        step = np.where(passages == word, MATCH, MISMATCH)
        row = np.maximum(above + GAP, 0)
        np.maximum(row[:, 1:], above[:, :-1] + step, out=row[:, 1:])
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        best = np.maximum(best, row.max(axis=1))
        above = row
    return best / (MATCH * len(item))


def best_passage(
    own: np.ndarray, ids: np.ndarray, begins: np.ndarray, slack: int, least: float, stretch: int
) -> tuple[float, int, int] | None:
    """(score, first word, end word) of the best passage of a text for an item.

    ``own`` and ``ids`` number the words of the item and of the text, ``begins`` says
    where the item would begin by each of its seeds. None if no passage reaches the score
    or the stretch.
    """
    starts = np.sort(begins)
    # Seeds of one copy agree on its begin but for insertions and deletions.
    cut = np.flatnonzero(np.diff(starts) > slack) + 1
    lows = np.clip(starts[np.r_[0, cut]] - slack, 0, len(ids))
    highs = np.clip(starts[np.r_[cut - 1, len(starts) - 1]] + len(own) + slack, 0, len(ids))
    needed = min(least * len(own), stretch)
    # No more words than are there can be aligned.
    there = [np.isin(own, ids[a:b]).sum() for a, b in zip(lows.tolist(), highs.tolist())]
    hopeful = np.array(there) >= needed
    if not hopeful.any():
        return None
    lows, highs = lows[hopeful], highs[hopeful]
    best = (0.0, 0, 0)
    at_once = max(1, CELLS_AT_ONCE // max(1, int((highs - lows).max())))
    for at in range(0, len(lows), at_once):
        low, high = lows[at : at + at_once], highs[at : at + at_once]
        grid = low[:, None] + np.arange(int((high - low).max()))
        rows = np.where(grid < high[:, None], ids[np.minimum(grid, len(ids) - 1)], -1)
        scores = align(own, rows)
        top = int(scores.argmax())
        best = max(best, (float(scores[top]), int(low[top]), int(high[top])))
    return best if best[0] * len(own) >= needed else None


# ---- tables

def _items(benchmark: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """(item_id, words, k1, k2) of every item that has words; the keys stand for the words."""
    rows = benchmark.select(
        column(item_column).cast("bigint").alias("item_id"), column(text_column).cast("string").alias("t")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [" ".join(words_of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.string())], ["item_id", "words"]
            )

    cut = map_arrow(rows, work, "item_id bigint, words string").where("words <> ''")
    keys = (F.xxhash64("words").alias("k1"), F.xxhash64("words", F.lit(1)).alias("k2"))
    return saved(cut.select("item_id", "words", *keys), "items")


def _seeds(items: DataFrame, n: int) -> DataFrame:
    """(seed, size, k1, k2, item_place) of every seed of different items."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            hashes = [known.of(words) for words in batch.column(0).to_pylist()]
            sizes = [seed_length(len(h), n) for h in hashes]
            found = [_grams(h, size) for h, size in zip(hashes, sizes)]
            counts = list(map(len, found))
            item = pa.array(np.repeat(np.arange(len(found)), counts))
            places = np.concatenate([np.zeros(0, np.int64), *(np.arange(c) for c in counts)])
            seeds = np.concatenate([np.zeros(0, np.uint64), *found])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(seeds.view(np.int64)),
                    pa.array(np.repeat(np.array(sizes, np.int32), counts), pa.int32()),
                    batch.column(1).take(item),
                    batch.column(2).take(item),
                    pa.array(places, pa.int32()),
                ],
                ["seed", "size", "k1", "k2", "item_place"],
            )

    different = items.dropDuplicates(["k1", "k2"]).select("words", "k1", "k2")
    schema = "seed bigint, size int, k1 bigint, k2 bigint, item_place int"
    return saved(map_arrow(different, work, schema), "seeds")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """Bits of the seeds, 64 to a word: SEED_BITS / 64 rows are fetched at most."""
    place = f"(seed & {SEED_BITS - 1})"
    words = seeds.groupBy(F.expr(f"{place} div 64").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST({place} % 64 AS INT))")).alias("bits")
    )
    bits = np.zeros(SEED_BITS // 64, np.int64)
    for at, found in words.collect():
        bits[at] = found
    return bits.view(np.uint64)


def _texts_with_seeds(texts: DataFrame, sizes: list[int], bits: np.ndarray) -> DataFrame:
    """(row, doc_id, m1, m2, words, seeds, places) of texts that may have seeds.

    Of a run of equal n-grams the first and the last count: a passage that is aligned
    around either has all that those between could give.
    """
    kind = dict(texts.dtypes)["doc_id"]

    def hits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seeds, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for size in sizes:
            grams = _grams(hashes, size)
            bit = grams & np.uint64(SEED_BITS - 1)
            at = np.flatnonzero(bits[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1))
            inside = np.zeros(len(at), bool)
            inside[1:-1] = (grams[at[1:-1]] == grams[at[1:-1] - 1]) & (grams[at[1:-1]] == grams[at[1:-1] + 1])
            seeds.append(grams[at[~inside]])
            places.append(at[~inside])
        return np.concatenate(seeds), np.concatenate(places)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = WordHashes(), row_numbers()
        for batch in batches:
            taken, words, seeds, places = [], [], [], []
            for at, text in enumerate(batch.column(3).to_pylist()):
                seed, place = hits(known.of(text))
                if len(seed):
                    taken.append(at)
                    words.append(" ".join(words_of(text)))
                    seeds.append(seed.view(np.int64))
                    places.append(place)
            at = pa.array(taken, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(numbers) for _ in taken], pa.int64()),
                    *(batch.column(c).take(at) for c in range(3)),
                    pa.array(words, pa.string()),
                    pa.array(seeds, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(pa.int32())),
                ],
                ["row", "doc_id", "m1", "m2", "words", "seeds", "places"],
            )

    schema = f"row bigint, doc_id {kind}, m1 bigint, m2 bigint, words string, seeds array<bigint>, places array<int>"
    return saved(map_arrow(texts, work, schema), "texts-with-seeds")


def _aligned(texts: DataFrame, seeds: DataFrame, items: DataFrame, n: int, least: float, stretch: int, block_words: int) -> DataFrame:
    """(row, k1, k2, score, first_word, end_word) of the items found in each text."""
    hits = texts.select("row", F.explode(F.arrays_zip("seeds", "places")).alias("hit"))
    begins = (
        hits.select("row", F.col("hit.seeds").alias("seed"), F.col("hit.places").alias("place"))
        .join(seeds, "seed")
        .groupBy("row", "k1", "k2")
        .agg(F.collect_set(F.col("place") - F.col("item_place")).alias("begins"))
    )
    begins = saved(begins, "begins")
    different = saved(items.dropDuplicates(["k1", "k2"]).select("k1", "k2", F.col("words").alias("item")), "different-items")
    pairs = begins.join(different, ["k1", "k2"])
    size = F.size(F.split("item", " "))
    before = F.sum(size).over(Window.partitionBy("row").orderBy("k1", "k2")) - size
    blocks = (
        pairs.withColumn("block", F.floor(before / block_words))
        .groupBy("row", "block")
        .agg(F.collect_list(F.struct("k1", "k2", "item", "begins")).alias("items"))
    )
    tasks = blocks.join(texts.select("row", "words"), "row").select("row", "words", "items")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, words, found in zip(*(c.to_pylist() for c in batch.columns)):
                own = [f["item"].split(" ") for f in found]
                number: dict[str, int] = {}
                for item in own:
                    for word in item:
                        number.setdefault(word, len(number) + 1)
                text = words.split(" ")
                ids = np.fromiter((number.get(w, 0) for w in text), np.int64, len(text))
                for item, f in zip(own, found):
                    numbers = np.array([number[w] for w in item], np.int64)
                    slack = len(item) // 2 + n
                    best = best_passage(numbers, ids, np.array(f["begins"]), slack, least, stretch)
                    if best:
                        out.append((row, f["k1"], f["k2"], *best))
            kinds = [*[pa.int64()] * 3, pa.float64(), *[pa.int32()] * 2]
            columns = zip(*out) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["row", "k1", "k2", "score", "first_word", "end_word"],
            )

    schema = "row bigint, k1 bigint, k2 bigint, score double, first_word int, end_word int"
    return map_arrow(tasks, work, schema, rows=16)


def _marks(text) -> tuple:
    """Two hashes that stand for a text."""
    return F.xxhash64(text), F.xxhash64(text, F.lit(1))


def _found(
    docs: DataFrame,
    doc_id,
    benchmark: DataFrame,
    *,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    seed_words: int = SEED_WORDS,
    least_score: float = LEAST_SCORE,
    least_stretch: int = LEAST_STRETCH,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored (row, doc_id, m1, m2, ...) of texts, (item_id, k1, k2, ...) of items, and the matches."""
    items = _items(benchmark, item_column, item_text_column)
    seeds = _seeds(items, seed_words)
    sizes = sorted(r[0] for r in seeds.select("size").distinct().collect())
    text = column(text_column).cast("string")
    m1, m2 = _marks(text)
    rows = docs.select(doc_id.alias("doc_id"), m1.alias("m1"), m2.alias("m2"), text.alias("t"))
    texts = _texts_with_seeds(rows, sizes, _bitmap(seeds))
    matches = _aligned(texts, seeds.drop("size"), items, seed_words, least_score, least_stretch, block_words)
    return texts, items, saved(matches, "matches")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **how
) -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word) of every item found in a text."""
    texts, items, matches = _found(docs, column(id_column), benchmark, text_column=text_column, **how)
    return (
        matches.join(texts.select("row", "doc_id"), "row")
        .join(items.select("item_id", "k1", "k2"), ["k1", "k2"])
        .select("doc_id", "item_id", "score", "first_word", "end_word")
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, *, text_column: str = "text", **how
) -> DataFrame:
    """The rows of ``docs`` in which no item was found."""
    nothing = F.lit(None).cast("int")
    texts, _, matches = _found(docs, nothing, benchmark, text_column=text_column, **how)
    one, two = fresh_name(docs, "m1"), fresh_name(docs, "m2")
    found = matches.select("row").distinct().join(texts, "row").select(
        F.col("m1").alias(one), F.col("m2").alias(two)
    )
    found = saved(found.distinct(), "contaminated")
    m1, m2 = _marks(column(text_column).cast("string"))
    return docs.join(found, (m1 == column(one)) & (m2 == column(two)), "left_anti")
