"""Periodic runs of words, by maximal pairs of an LCP-interval tree.

A run is a stretch of consecutive words whose smallest period is ``period``, of ``least_words``
words and ``least_periods`` periods at least, that no neighbouring word extends. Its first
period is kept and the words after it are collapsed.

The words of a text become a suffix array by prefix doubling, and the ranks of all its
steps give the longest common prefix of neighbours. The intervals of equal prefixes are
walked from the bottom up. Each holds its positions in lists by the word to their left;
where two intervals meet, a position of one and a position of the other with different
left words are a maximal pair: their prefix can be extended neither way. Such a pair whose
distance d and length l satisfy l >= (least_periods - 1) * d and l + d >= least_words is
the run of l + d words from its first position, whole as it is. Multiples of a period give
the same stretch, so the smallest distance counts.

Among positions that share a prefix and lie within half its length, all but the first have
one and the same left word (the last of the period before it). So a position is paired
with the list of one class to its right, or with one position to its left, and the pairs
looked at are runs and their multiples only.

Only stretches that repeat are sorted: prefixes of a run's pair have a least length, and
texts in which no sequence of so many words comes twice are left out by their hashes first.
Short texts are handled together, up to a number of words, longer ones one by one.

Defined cases: words are cut at ASCII white space. Null and empty texts have no words and
no runs. Runs come by start, then by period. Rows are looked at each, also repeated ones.
An empty table gives no rows; all other columns are passed on and never looked at. One that
is called like a column added here is refused, and other names can be given.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import column, fresh_name, map_arrow

LEAST_WORDS = 24
LEAST_PERIODS = 3
# Words of short texts that are handled together.
WORDS_AT_ONCE = 1 << 17

RUNS = T.ArrayType(
    T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
)

Run = tuple[int, int, int]


def least_prefix(least_words: int, least_periods: int) -> int:
    """The least length of the common prefix of a run's pair, for whatever period."""
    return min(max((least_periods - 1) * d, least_words - d) for d in range(1, least_words + 1))


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all words, first place of each text); each text ends with a number of its own."""
    known: dict[bytes, int] = {}
    number = known.setdefault
    flat = np.array([number(w, len(known)) for words in texts for w in [*words, None]], np.int64)
    sizes = np.array([len(words) + 1 for words in texts])
    ends = np.cumsum(sizes) - 1
    flat[ends] = len(known) + np.arange(len(texts))
    return flat, ends - sizes + 1


def _repeating(flat: np.ndarray, firsts: np.ndarray, n: int) -> np.ndarray:
    """Which texts may have a sequence of n words twice, by hashes."""
    sizes = np.diff(np.r_[firsts, len(flat)])
    text = np.repeat(np.arange(len(firsts)), sizes)
    if len(flat) < n:
        return np.zeros(len(firsts), bool)
    each = (flat.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    each ^= each >> np.uint64(32)
    hashes = np.zeros(len(flat) - n + 1, np.uint64)
    for k in range(n):
        hashes = (hashes + each[k : k + len(hashes)]) * np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(31)
    hashes ^= (text[: len(hashes)].astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    order = np.argsort(hashes)
    twice = np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])
    out = np.zeros(len(firsts), bool)
    out[text[order[twice]]] = True
    return out


def suffix_ranks(flat: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... numbers, until all differ."""
    ranks = [np.unique(flat, return_inverse=True)[1].reshape(-1)]
    width = 1
    while int(ranks[-1].max()) < len(flat) - 1:
        now = ranks[-1].astype(np.int64)
        after = np.zeros(len(flat), np.int64)
        after[: max(0, len(flat) - width)] = now[width:] + 1
        key = now * (len(flat) + 1) + after
        ranks.append(np.unique(key, return_inverse=True)[1].reshape(-1).astype(np.int32))
        width *= 2
    return ranks


def common_prefixes(ranks: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each position in the order with the next one."""
    n = len(order)
    one, other = order[:-1].astype(np.int64), order[1:].astype(np.int64)
    length = np.zeros(n - 1, np.int64)
    for step in range(len(ranks) - 2, -1, -1):
        at, beside = one + length, other + length
        inside = (at < n) & (beside < n)
        same = inside & (ranks[step][np.minimum(at, n - 1)] == ranks[step][np.minimum(beside, n - 1)])
        length[same] += 1 << step
    return length


def maximal_pairs(
    order: list[int], prefix: list[int], left: list[int], least: int, least_periods: int
) -> Iterator[Run]:
    """(first position, distance, length) of maximal pairs at most a share of their length apart.

    ``prefix[i]`` is that of order[i] and order[i + 1]; a share is 1 / (least_periods - 1),
    which has to be a half or less. ``left[i]`` stands for the word before position i.
    """

    def meet(one: tuple, other: tuple, length: int) -> Iterator[Run]:
        """Pairs of the two intervals; the smaller one's positions are looked up in the other."""
        if len(one[0]) < len(other[0]):
            one, other = other, one
        places, classes = one
        reach = length // (least_periods - 1)
        for p in other[0]:
            after = bisect_right(places, p)
            if after < len(places) and places[after] <= p + reach:
                kind = left[places[after]]
                if kind != left[p]:
                    listed = classes[kind]
                    for q in listed[bisect_right(listed, p) : bisect_right(listed, p + reach)]:
                        yield p, q - p, length
            before = bisect_left(places, p - reach)
            if before < len(places) and places[before] < p and left[places[before]] != left[p]:
                yield places[before], p - places[before], length

    def joined(one: tuple, other: tuple) -> tuple:
        if len(one[0]) < len(other[0]):
            one, other = other, one
        places, classes = one
        if len(other[0]) * 8 < len(places):
            for p in other[0]:
                insort(places, p)
        else:
            places = sorted(places + other[0])
        for kind, listed in other[1].items():
            mine = classes.get(kind)
            if mine is None:
                classes[kind] = listed
            elif len(listed) * 8 < len(mine):
                for p in listed:
                    insort(mine, p)
            else:
                classes[kind] = sorted(mine + listed)
        return places, classes

    # Open intervals from the root down, as (prefix length, what has been joined so far).
    stack: list[tuple[int, tuple]] = []
    for at, p in enumerate(order):
        length = prefix[at] if at < len(prefix) else 0
        below: tuple = ([p], {left[p]: [p]})
        while stack and stack[-1][0] > length:
            depth, held = stack.pop()
            yield from meet(held, below, depth)
            below = joined(held, below)
        if length < least:
            continue
        if stack and stack[-1][0] == length:
            held = stack[-1][1]
            yield from meet(held, below, length)
            stack[-1] = (length, joined(held, below))
        else:
            stack.append((length, below))


def find_runs(
    texts: list[list[bytes]], *, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> list[list[Run]]:
    """(start, length, period) of the runs of each text, by start, then by period."""
    found: list[list[Run]] = [[] for _ in texts]
    least = least_prefix(least_words, least_periods)
    if not texts:
        return found
    flat, firsts = numbered(texts)
    some = np.flatnonzero(_repeating(flat, firsts, least))
    if not len(some):
        return found
    if len(some) < len(texts):
        flat, firsts = numbered([texts[t] for t in some])
    ranks = suffix_ranks(flat)
    order = np.empty(len(flat), np.int64)
    order[ranks[-1]] = np.arange(len(flat))
    prefix = common_prefixes(ranks, order)
    del ranks
    # Positions without a neighbour of the least prefix are in no interval that counts.
    long = prefix >= least
    kept = np.r_[long, False] | np.r_[False, long]
    order, prefix = order[kept], np.r_[prefix, 0][kept]
    # The word before a text's first one is the end of the text before it, or none.
    left = np.r_[-1, flat[:-1]].tolist()
    stretches: dict[tuple[int, int], int] = {}
    for p, distance, length in maximal_pairs(order.tolist(), prefix.tolist(), left, least, least_periods):
        if length + distance >= least_words:
            key = (p, length + distance)
            stretches[key] = min(distance, stretches.get(key, distance))
    starts = firsts.tolist()
    for (p, length), period in sorted(stretches.items(), key=lambda r: (r[0][0], r[1])):
        text = bisect_right(starts, p) - 1
        found[int(some[text])].append((p - starts[text], length, period))
    return found


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that are in no run after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def with_runs(
    docs: DataFrame,
    *,
    text_column: str = "text",
    words_column: str = "n_words",
    runs_column: str = "runs",
    collapsed_column: str = "collapsed",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """The rows of ``docs`` with all their columns, and as further ones the number of words, the
    runs, and the words left after collapsing them, joined by single spaces."""
    if least_periods < 3 or least_words < least_periods:
        raise ValueError("a run has three periods at least, and a word in each")
    names = (words_column, runs_column, collapsed_column)
    if any(fresh_name(docs, name) != name for name in names):
        raise ValueError(f"there are columns {names} already")
    place = docs.columns.index(text_column)
    kinds = (T.LongType(), RUNS, T.StringType())
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, names, kinds)])
    run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).cast(pa.string()).cast(pa.binary())
            waiting: list[list[bytes]] = []
            total, done = 0, 0
            for row, text in enumerate(texts):
                words = (text.as_py() or b"").split()
                waiting.append(words)
                total += len(words)
                if total >= WORDS_AT_ONCE or row == batch.num_rows - 1:
                    runs = find_runs(waiting, least_words=least_words, least_periods=least_periods)
                    kept = [b" ".join(collapsed(*both)).decode() for both in zip(waiting, runs)]
                    listed = [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs]
                    part = batch.slice(done, len(waiting))
                    for name, values in (
                        (words_column, pa.array(list(map(len, waiting)), pa.int64())),
                        (runs_column, pa.array(listed, run_type)),
                        (collapsed_column, pa.array(kept, pa.string())),
                    ):
                        part = part.append_column(name, values)
                    yield part
                    done, waiting, total = row + 1, [], 0

    return map_arrow(docs, work, schema)


def with_planted_runs(docs: DataFrame, *, id_column: str, text_column: str) -> DataFrame:
    """The rows of ``docs``, a tenth of them with their words from some place on repeating.

    Of those ids whose checksum h is divisible by 10, with g = h div 10, the n words from
    number a = g % n on repeat the first 1 + (n - a) div (3 + g % 8) of them. Rows without
    id or words stay as they are.
    """
    h = F.crc32(column(id_column).cast("string"))
    text = column(text_column).cast("string")
    words, h_name = fresh_name(docs, "words"), fresh_name(docs, "checksum")
    some = F.when(h % 10 == 0, F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    marked = docs.withColumns({words: some, h_name: F.floor(h / 10)})
    planted = F.expr(
        f"""array_join(transform(`{words}`, (w, i) -> if(
              i < `{h_name}` % size(`{words}`), w,
              `{words}`[cast(
                `{h_name}` % size(`{words}`)
                + (i - `{h_name}` % size(`{words}`))
                  % (1 + (size(`{words}`) - `{h_name}` % size(`{words}`)) div (3 + `{h_name}` % 8))
                AS int)])), ' ')"""
    )
    changed = F.when(F.size(words) > 0, planted).otherwise(text)
    return marked.withColumn(text_column, changed).drop(words, h_name)
