"""SimHash fingerprints, and groups of texts whose fingerprints nearly agree.

Two different fingerprints are linked if at most ``radius`` of their 64 bits
differ. Candidates share three of six blocks of bits: three differing bits touch
three blocks at most, so no link is missed. Within a bucket the fingerprints are
stored as vertical bit planes, 64 to a word; one query updates 64 distances at a
time with carry-save counters, and a word is dropped once all its distances
exceed the radius. A bucket gives only links that span its groups, never all its
pairs, and large buckets are compared block by block in several tasks.

Defined cases: a null text is an empty one; texts without words have fingerprint
zero, linked like any other. Equal fingerprints are one node. Repeated rows each
get their result. A component's id is its smallest document id, null only if all
its rows lack one. An empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.llm.common import column, fresh_name, map_arrow, row_numbers, saved
from gaugeline.llm.components import connected_components

SEED = 42
BLOCKS = 6
BUCKET_BLOCK = 1024
# Words of 64 distances that are updated together.
LANE_WORDS = 1 << 14
HASHES_AT_ONCE = 1 << 15


def fingerprint(text: bytes, shingle: int) -> int:
    """Bit i is set if it is set in over half the hashes of the word shingles."""
    import xxhash

    words = text.lower().split()  # of bytes: A-Z, and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[: -shingle].tolist()]
        stops = (ends[shingle - 1 :] - 1).tolist()
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, stops)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = np.array(hashes[at : at + HASHES_AT_ONCE], dtype="<u8").view(np.uint8)
        bits = np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(
    docs: DataFrame, *, shingle: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t or b"", shingle) for t in batch.column(1).to_pylist()]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], ["doc_id", "fp"])

    rows = docs.select(
        column(id_column).cast("bigint").alias("doc_id"),
        column(text_column).cast("string").cast("binary").alias("text"),
    )
    return map_arrow(rows, work, "doc_id bigint, fp bigint")


def _block_masks() -> list[int]:
    """Masks of all choices of half the blocks."""
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    chosen = combinations(blocks, BLOCKS // 2)
    return [int(np.array(sum(c), np.uint64).view(np.int64)) for c in chosen]


class Planes:
    """Buckets of fingerprints as bit planes: ``planes[bit][word]``, 64 members a word."""

    def __init__(self, buckets: list[np.ndarray]):
        sizes = np.array([len(b) for b in buckets])
        words = -(-sizes // 64)
        self.members = np.zeros(int(words.sum()) * 64, np.uint64)
        self.valid = np.zeros(len(self.members), bool)
        first = np.cumsum(words) - words
        for at, bucket in zip(first * 64, buckets):
            self.members[at : at + len(bucket)] = bucket
            self.valid[at : at + len(bucket)] = True
        lanes = self.members.view(np.uint8).reshape(-1, 64, 8)
        bits = np.unpackbits(lanes, axis=2, bitorder="little")  # word, member, bit
        packed = np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")
        self.planes = np.ascontiguousarray(packed).view("<u8")[..., 0]
        packed_valid = np.packbits(self.valid.reshape(-1, 64), axis=1, bitorder="little")
        self.valid_words = np.ascontiguousarray(packed_valid).view("<u8")[:, 0]
        # Every member of a bucket is a query against every word of it.
        self.query = np.concatenate(
            [np.repeat(np.arange(a * 64, a * 64 + n), w) for a, n, w in zip(first, sizes, words)]
        )
        self.word = np.concatenate(
            [np.tile(np.arange(a, a + w), n) for a, n, w in zip(first, sizes, words)]
        )

    def close_pairs(self, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of members at most ``radius`` (below 4) bits apart, as (query, member)."""
        query, word = self.query, self.word
        own = self.members[query]
        ones = np.zeros(len(query), np.uint64)
        twos = np.zeros_like(ones)
        over = ~self.valid_words[word]
        for bit in range(64):
            asked = np.uint64(0) - ((own >> np.uint64(bit)) & np.uint64(1))
            differs = self.planes[bit][word] ^ asked
            carry = ones & differs
            ones ^= differs
            over |= twos & carry
            twos ^= carry
            if bit % 8 == 7 and bit < 63:
                alive = ~(over | self._beyond(ones, twos, radius)) != 0
                if not alive.all():
                    query, word, own = query[alive], word[alive], own[alive]
                    ones, twos, over = ones[alive], twos[alive], over[alive]
        near = ~(over | self._beyond(ones, twos, radius))
        hit = np.flatnonzero(near)
        lanes = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, lane = np.nonzero(lanes)
        left, right = query[hit][row], word[hit][row] * 64 + lane
        differ = left < right
        return left[differ], right[differ]

    @staticmethod
    def _beyond(ones: np.ndarray, twos: np.ndarray, radius: int) -> np.ndarray:
        """Lanes whose two-bit count is above the radius."""
        if radius == 0:
            return ones | twos
        if radius == 1:
            return twos
        return ones & twos if radius == 2 else np.zeros_like(ones)


def spanning_links(buckets: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For every member linked within its bucket, (fingerprint, its group's smallest place)."""
    planes = Planes(buckets)
    left, right = planes.close_pairs(radius)
    label = np.arange(len(planes.members))
    while len(left):
        low = np.minimum(label[left], label[right])
        if (label[left] == label[right]).all():
            break
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
    joined = np.flatnonzero(label != np.arange(len(label)))
    return planes.members[joined], planes.members[label[joined]]


def fingerprint_links(prints: DataFrame, radius: int) -> DataFrame:
    """(a, b): links whose components are those of all pairs within the radius.

    ``prints`` has one row for each different ``fp``.
    """
    if not 0 <= radius <= BLOCKS // 2:
        raise ValueError("the block scheme covers 0 to 3 differing bits")
    masks = F.array(
        *[
            F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(mask)))
            for number, mask in enumerate(_block_masks())
        ]
    )
    keyed = prints.select("fp", F.explode(masks).alias("key"))
    # Stored before they are joined, here and below, so a hot key can be split.
    shared = saved(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    # Large buckets are dealt out: a task for each pair of their blocks.
    blocks = F.ceil(F.col("n") / BUCKET_BLOCK)
    own = F.pmod(F.xxhash64("fp", F.lit(7)), blocks)
    members = keyed.join(shared, "key").select(
        "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    )
    tasks = members.groupBy(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    ).agg(F.collect_list("fp").alias("fps"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(buckets: list[np.ndarray]) -> pa.RecordBatch:
            a, b = spanning_links(buckets, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"]
            )

        waiting: list[np.ndarray] = []
        lanes = 0
        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            for bucket in np.split(flat, ends[:-1]):
                waiting.append(bucket)
                lanes += len(bucket) * -(-len(bucket) // 64)
                if lanes >= LANE_WORDS:
                    yield links(waiting)
                    waiting, lanes = [], 0
        if waiting:
            yield links(waiting)

    return map_arrow(tasks.select("fps"), work, "a bigint, b bigint", rows=512).distinct()


def _group_firsts(prints: DataFrame, radius: int) -> DataFrame:
    """(fp, group_first): the least ``first`` in the group of each fingerprint."""
    groups = connected_components(fingerprint_links(prints, radius))
    rooted = prints.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    firsts = saved(rooted.groupBy("root").agg(F.min("first").alias("group_first")), "firsts")
    return rooted.join(firsts, "root").select("fp", "group_first")


def simhash_groups(
    docs: DataFrame,
    *,
    shingle: int,
    radius: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, fp and component_id of every row."""
    rows = saved(
        fingerprints(docs, shingle=shingle, id_column=id_column, text_column=text_column),
        "fingerprints",
    )
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = _group_firsts(prints, radius)
    return rows.join(named, "fp").select("doc_id", "fp", F.col("group_first").alias("component_id"))


def drop_near_copies(
    docs: DataFrame,
    *,
    shingle: int,
    radius: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row of each group, with all columns: one of the smallest id, rows without id last."""
    place = docs.columns.index(text_column)
    fp, number = fresh_name(docs, "fp"), fresh_name(docs, "row_number")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = row_numbers()
        for batch in batches:
            texts = batch.column(place).cast(pa.string()).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t or b"", shingle) for t in texts], dtype=np.uint64)
            own = np.fromiter(islice(numbers, len(texts)), np.int64, len(texts))
            yield batch.append_column(fp, pa.array(found.view(np.int64))).append_column(
                number, pa.array(own)
            )

    longs = [T.StructField(name, T.LongType()) for name in (fp, number)]
    marked = saved(map_arrow(docs, work, T.StructType([*docs.schema.fields, *longs])), "marked")
    doc_id = column(id_column).cast("bigint")
    first = F.struct(doc_id.isNull().alias("no_id"), doc_id.alias("id"), column(number).alias("row"))
    prints = marked.groupBy(column(fp).alias("fp")).agg(F.min(first).alias("first"))
    kept = _group_firsts(prints, radius).select(F.col("group_first.row").alias(number)).distinct()
    return marked.join(kept, number, "left_semi").select(*map(column, docs.columns))
