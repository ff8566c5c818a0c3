"""Repeated passages, exact or nearly so, by MinHash banding of paragraphs.

A text is cut into paragraphs by its words, not by its lines: a paragraph begins before a
pair of words whose hash is the least among the ``reach`` pairs on either side. Wherever a
passage stands, in lines of its own, wrapped, or within longer lines, it is cut in the
same places, from ``reach`` words after its begin to ``reach`` words before its end. So a
passage of over 50 words holds one whole paragraph at least in 92 of 100 cases, one of 60 words
in 98, one of 70 words almost always; paragraphs have 15 words on average, 8 at least.

Equal paragraphs, word for word, are one node. Nodes are linked
if their sets of word shingles have a Jaccard similarity of ``similarity`` or more:
bands of MinHash values, tuned for the recall asked for at that similarity, give buckets
of candidates; within a bucket the sets are compared exactly, in blocks of
bounded size when it is large, and only links that span its groups leave it. Classes
are the connected components. Of a class, paragraphs of fewer than ``least_words`` words
count as repeated only where those are that are equal together with as many words of either
side as they lack, so that lines and phrases of a few words that many texts share are no
passages; the words beside a cut within a passage are the passage's own. All but the first
of those that count together go.

Defined cases: words are lower-cased and cut at ASCII white space. Texts that are null or
have fewer than ``least_words`` words have no paragraphs; texts too short to be cut, and
repetitions of the same few words, are one. Rows are texts each, also those without id or of
equal id and text: all but the first of them go. Order is by id, nulls first, then by row,
then by place. An empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import column, map_arrow, row_numbers, saved
from gaugeline.llm.components import connected_components

SIMILARITY = 0.8
SHINGLE = 5
REACH = 7
LEAST_WORDS = 20
RECALL = 0.98
MOST_HASHES = 64
CHANCE, CHANCE_SHARE = 0.2, 0.2
# A block of a bucket, in shingles.
BLOCK_SHINGLES = 1 << 18
KNOWN_WORDS = 500_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True


def tune_bands(similarity: float, recall: float, most_hashes: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the fewest bands that find pairs of the similarity with the recall.

    At least so many rows a band that of chance pairs, at ``CHANCE`` similarity, no
    more than ``CHANCE_SHARE`` become candidates; if none serve, the recall counts.
    """
    found = []
    for rows in range(1, most_hashes + 1):
        for bands in range(1, most_hashes // rows + 1):
            if 1 - (1 - similarity**rows) ** bands >= recall:
                chance = 1 - (1 - CHANCE**rows) ** bands
                found.append((chance > CHANCE_SHARE, bands, rows))
                break
    if not found:
        return most_hashes, 1
    return min(found)[1:]


# ---- paragraphs

class WordHashes(dict):
    """Hashes of words, remembered up to a number of them."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def _mixed(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    out = (one ^ (other >> np.uint64(17))) * _BASE + other
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(29))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive word hashes."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        out = (out ^ words[k : k + len(out)]) * _BASE
        out ^= out >> np.uint64(31)
    return out


def begins(words: np.ndarray, place: np.ndarray, after: np.ndarray, reach: int) -> np.ndarray:
    """Which words begin a paragraph.

    ``place`` counts the words before each in its text, ``after`` those from it on. The hash
    of a word and the next has to be less than those of the ``reach`` pairs before it, and no more
    than those of as many pairs after it, all in its text and none of them at its very begin.
    """
    n = len(words)
    pairs = np.zeros(n, np.uint64)
    pairs[:-1] = _mixed(words[:-1], words[1:])
    least = (place > reach) & (after >= reach + 2)
    for k in range(1, min(reach, n - 1) + 1):
        least[k:] &= pairs[k:] < pairs[: n - k]
        least[: n - k] &= pairs[: n - k] <= pairs[k:]
    return least | (place == 0)


class Paragraphs:
    """The paragraphs of a batch of texts.

    ``words`` holds the hashes of all words; paragraph i has the words from first[i] to
    end[i] and belongs to ``text[i]``, of which it is number ``number[i]``. With words of
    either side, where it has few, it reaches from low[i] to high[i].
    """

    def __init__(self, texts: list[bytes], known: WordHashes, reach: int, least_words: int):
        joined = b"\n".join(texts)
        words = joined.lower().split()
        self.words = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        raw = np.frombuffer(joined, np.uint8)
        space = _SPACE[raw]
        self.byte_first = np.flatnonzero(~space & np.r_[True, space[:-1]])
        self.byte_end = np.flatnonzero(~space & np.r_[space[1:], True]) + 1
        text_first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        word_first = np.searchsorted(self.byte_first, text_first)
        sizes = np.diff(word_first)
        place = np.arange(len(words)) - np.repeat(word_first[:-1], sizes)
        first = np.flatnonzero(begins(self.words, place, np.repeat(sizes, sizes) - place, reach))
        end = np.r_[first[1:], len(words)][: len(first)]
        text = np.repeat(np.arange(len(texts)), sizes)[first]
        number = np.arange(len(first)) - np.searchsorted(text, text)
        kept = sizes[text] >= least_words
        self.first, self.end, self.text, self.number = (x[kept] for x in (first, end, text, number))
        # As many words on either side as are lacking, on the other one at a text's ends.
        lacking = np.maximum(0, least_words - (self.end - self.first) + 1) // 2
        text_end = word_first[1:][self.text]
        low = np.maximum(self.first - lacking, word_first[:-1][self.text])
        high = np.minimum(self.end + lacking, text_end)
        low = np.maximum(np.minimum(low, high - least_words), word_first[:-1][self.text])
        self.low, self.high = low, np.minimum(np.maximum(high, low + least_words), text_end)
        # Characters before each byte, counted from the begin of the batch.
        self._characters = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
        self._text_first = text_first

    def __len__(self) -> int:
        return len(self.first)

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """(first character in its text, number of characters) of each paragraph."""
        if not len(self):
            return self.first, self.first
        a = self._characters[self.byte_first[self.first]]
        b = self._characters[self.byte_end[self.end - 1]]
        return a - self._characters[self._text_first[self.text]], b - a

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """64 bits that stand for the words of each paragraph, and 64 others for those it
        reaches to. Of long ones both stand for the same."""
        out = []
        for factor, first, end in (
            (0x9E3779B97F4A7C15, self.first, self.end), (0xC2B2AE3D27D4EB4F, self.low, self.high)
        ):
            # A polynomial of the word hashes; powers count from the paragraph's begin.
            power = np.full(len(self.words), factor, np.uint64)
            power[:1] = 1
            power = np.multiply.accumulate(power)
            inverse = np.full(len(self.words), pow(factor, -1, 2**64), np.uint64)
            inverse[:1] = 1
            inverse = np.multiply.accumulate(inverse)
            mixed = _mixed(self.words, np.uint64(factor) + np.zeros_like(self.words)) * power
            total = np.r_[np.zeros(1, np.uint64), np.cumsum(mixed, dtype=np.uint64)]
            total = (total[end] - total[first]) * inverse[first]
            out.append(_mixed(total, (end - first).astype(np.uint64)))
        return out[0], out[1]

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the n-word shingles of all paragraphs, where those of each begin)."""
        counts = self.end - self.first - n + 1
        starts = np.cumsum(counts) - counts
        at = np.arange(int(counts.sum())) + np.repeat(self.first - starts, counts)
        return shingle_hashes(self.words, n)[at], starts


def band_columns(bands: int) -> list[str]:
    return [f"band_{b}" for b in range(bands)]


def paragraph_rows(
    texts: DataFrame, *, bands: int, rows: int, reach: int, least_words: int, shingle: int
) -> DataFrame:
    """A row for each paragraph of (doc_id, mark, text); ``number`` is its own in the whole
    table, ``node`` and ``reached`` are its names, and there is one key for each band."""
    rng = np.random.default_rng(11)
    mix = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
    add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    names = ["doc_id", "mark", "number", "paragraph", "start", "n_chars", "n_words", "node", "reached", *band_columns(bands)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, numbers = WordHashes(), row_numbers()
        for batch in batches:
            found = Paragraphs([t or b"" for t in batch.column(2).to_pylist()], known, reach, least_words)
            if not len(found):
                continue
            flat, starts = found.shingles(shingle)
            keys = []
            for band in range(bands):
                key = np.full(len(found), band, np.uint64)
                for k in range(band * rows, (band + 1) * rows):
                    mixed = flat * mix[k] + add[k]
                    # The low bits of a product are weak; compare by the high ones.
                    low = np.minimum.reduceat(mixed >> np.uint64(16), starts)
                    key = (key ^ low) * _BASE
                    key ^= key >> np.uint64(29)
                keys.append(key)
            at = pa.array(found.text)
            n = len(found)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array([next(numbers) for _ in range(n)], pa.int64()),
                    *(pa.array(x.astype(np.int32)) for x in (found.number, *found.spans(), found.end - found.first)),
                    *(pa.array(x.view(np.int64)) for x in (*found.names(), *keys)),
                ],
                names,
            )

    kinds = ["bigint"] * 3 + ["int"] * 4 + ["bigint"] * (2 + bands)
    return map_arrow(texts, work, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)), rows=64)


# ---- links

def similar_in_block(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links (place, place) that span the groups of similar sets.

    The sets are turned round into lists of who has a shingle. A set's common shingles
    with all others are counted from the lists of its own, so only sets that
    share something cost anything, and a link is kept only where it joins two groups.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(flat, kind="stable")
    owners = owner[order]
    starts = np.flatnonzero(np.r_[True, np.diff(flat[order]) != 0])
    ends = np.r_[starts[1:], len(flat)]
    number = np.empty(len(flat), np.int64)
    number[order] = np.repeat(np.arange(len(starts)), ends - starts)
    shared = ends - starts > 1
    label = np.arange(n)
    links = []
    for own, place in zip(np.split(number, np.cumsum(sizes)[:-1]), range(n)):
        own = own[shared[own]]
        if not len(own):
            continue
        lists = [owners[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist())]
        common = np.bincount(np.concatenate(lists), minlength=n)
        near = np.flatnonzero(common >= similarity * (sizes[place] + sizes - common))
        groups, first = np.unique(label[near], return_index=True)
        if len(groups) > 1:
            links += [(place, int(near[f])) for f, g in zip(first, groups) if g != label[place]]
            label[np.isin(label, groups)] = groups[0]
    return links


def _node_sets(texts: DataFrame, wanted: DataFrame, shingle: int, reach: int, least_words: int) -> DataFrame:
    """(id, shingles): the shingle sets of wanted (id, doc_id, mark, paragraph)."""
    listed = F.collect_list(F.struct("paragraph", "id")).alias("wanted")
    by_text = wanted.groupBy("doc_id", "mark").agg(listed)
    same = texts["doc_id"].eqNullSafe(by_text["doc_id"]) & (texts["mark"] == by_text["mark"])
    found = texts.join(by_text, same).select("text", "wanted")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, sets = [], []
            paragraphs = Paragraphs([t or b"" for t in batch.column(0).to_pylist()], known, reach, least_words)
            flat, starts = paragraphs.shingles(shingle)
            parts = np.split(flat, starts[1:])
            place = {both: at for at, both in enumerate(zip(paragraphs.text.tolist(), paragraphs.number.tolist()))}
            for text, own in enumerate(batch.column(1).to_pylist()):
                for w in own:
                    ids.append(w["id"])
                    sets.append(np.unique(parts[place[text, w["paragraph"]]]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], ["id", "shingles"]
            )

    # Rows of equal id and text all give the same sets.
    return map_arrow(found, work, "id bigint, shingles binary", rows=64).dropDuplicates(["id"])


def paragraph_links(
    texts: DataFrame, nodes: DataFrame, *, bands: int, similarity: float, shingle: int, reach: int, least_words: int
) -> DataFrame:
    """(a, b): links whose components are those of all similar pairs of nodes.

    ``nodes`` has (id, n_words, doc_id, mark, paragraph) and the bands, one row a node.
    """
    keyed = nodes.select("id", "n_words", F.explode(F.array(*band_columns(bands))).alias("band"))
    shared = keyed.groupBy("band").agg(
        F.count("*").alias("n"), F.ceil(F.sum("n_words") / BLOCK_SHINGLES).alias("blocks")
    )
    shared = saved(shared.where("n > 1").select("band", "blocks"), "buckets")
    members = saved(keyed.select("band", "id").join(shared, "band"), "candidates")
    wanted = members.select("id").distinct().join(nodes.select("id", "doc_id", "mark", "paragraph"), "id")
    sets = saved(_node_sets(texts, wanted, shingle, reach, least_words), "shingles")
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    tasks = (
        members.select(
            "band", "id", own.alias("own"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
        )
        .join(sets, "id")
        .groupBy("band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
        .agg(F.collect_list(F.struct("id", "shingles")).alias("block"))
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for block in batch.column(0).to_pylist():
                sets = [np.frombuffer(m["shingles"], np.uint64) for m in block]
                found += [(block[i]["id"], block[j]["id"]) for i, j in similar_in_block(sets, similarity)]
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return map_arrow(tasks.select("block"), work, "a bigint, b bigint", rows=16)


def repeated_passages(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    reach: int = REACH,
    least_words: int = LEAST_WORDS,
    recall: float = RECALL,
    most_hashes: int = MOST_HASHES,
) -> DataFrame:
    """(doc_id, paragraph, start, n_chars, n_words, class_doc_id, class_paragraph,
    class_size, removed) of every paragraph in a class of two or more."""
    if not max(shingle, reach + 1) <= least_words <= 3 * reach:
        raise ValueError("a paragraph with reach words on either side has to hold the least words")
    bands, rows = tune_bands(similarity, recall, most_hashes)
    text = column(text_column).cast("string")
    texts = docs.select(
        column(id_column).cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("mark"),
        text.cast("binary").alias("text"),
    )
    met = saved(paragraph_rows(
        texts, bands=bands, rows=rows, reach=reach, least_words=least_words, shingle=shingle
    ), "paragraphs")
    nodes = met.groupBy("node").agg(
        F.min(F.struct("doc_id", "number", "paragraph", "mark")).alias("place"),
        F.count("*").alias("n"),
        *(F.any_value(c).alias(c) for c in ("n_words", *band_columns(bands))),
    )
    # A node goes by the number of its first paragraph.
    nodes = saved(nodes.withColumn("id", F.col("place.number")).select("*", "place.*").drop("place"), "nodes")
    links = paragraph_links(
        texts, nodes, bands=bands, similarity=similarity, shingle=shingle, reach=reach, least_words=least_words
    )
    rooted = (
        nodes.select("id", "node", "n")
        .join(connected_components(links).withColumnRenamed("node", "id"), "id", "left")
        .where("n > 1 OR root IS NOT NULL")
        .select("node", F.coalesce("root", "id").alias("root"))
    )
    # Stored, here and below, so the joins can split a class that very many paragraphs are in.
    rooted = saved(rooted, "classes")
    slim = met.select("doc_id", "number", "paragraph", "start", "n_chars", "n_words", "node", "reached")
    together = F.when(F.col("n_words") >= least_words, F.lit(0)).otherwise(F.col("reached"))
    members = saved(slim.join(rooted, "node").withColumn("together", together).drop("node", "reached"), "members")
    place = F.struct("doc_id", "number", "paragraph")
    groups = members.groupBy("root", "together").agg(
        F.min(place).alias("first"), F.count("*").alias("class_size")
    )
    groups = saved(groups.where("class_size > 1"), "groups")
    return members.join(groups, ["root", "together"]).select(
        "doc_id",
        "paragraph",
        "start",
        "n_chars",
        "n_words",
        F.col("first.doc_id").alias("class_doc_id"),
        F.col("first.paragraph").alias("class_paragraph"),
        "class_size",
        (F.col("number") != F.col("first.number")).alias("removed"),
    )
