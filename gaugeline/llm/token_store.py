"""Token ids in directly addressable codes, written and read by Spark.

An id is cut into bytes, lowest first. Level 0 holds the low byte of every id,
level k+1 the next byte of those ids that have one, and a bitmap of each level
marks which ids go on. A rank directory counts the marks before every 512th id,
so the place of an id on the next level is one directory entry and a few
population counts: any id is read without decoding its neighbours.

A store is a folder of two Parquet tables. ``segments`` has a row for every
million ids or so, with the codes as one binary value, in ascending order of
document id within and across the files; ``parts`` says how many ids lie before
each range of documents.

Defined cases: a null text is an empty one, and every document gets the end id,
so an empty document is one id long. Documents without id come first. Rows of
equal id are documents of their own, in the order of their texts. An empty table
gives an empty store. Further columns are not looked at.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.llm.common import column, map_arrow, partitions

RANK_BITS = 512
SEGMENT_IDS = 1 << 20
CACHED_PIECES = 700_000

SEGMENT = (
    "part int, segment int, part_start bigint, n_tokens bigint, doc_ids array<bigint>, "
    "doc_ends array<bigint>, code binary"
)


# ---- codes

def encode_codes(ids: np.ndarray) -> bytes:
    """Directly addressable codes of non-negative ids below 2**32."""
    out, rest = [], np.asarray(ids, dtype=np.uint32)
    while len(rest):
        goes_on = rest > 0xFF
        bits = np.packbits(goes_on, bitorder="little")
        blocks = np.add.reduceat(goes_on, np.arange(0, len(rest), RANK_BITS), dtype=np.uint32)
        ranks = np.concatenate([np.zeros(1, np.uint32), np.cumsum(blocks, dtype=np.uint32)])
        out.append(
            struct.pack("<I", len(rest))
            + ranks.astype("<u4").tobytes()
            + bits.tobytes()
            + (rest & 0xFF).astype(np.uint8).tobytes()
        )
        rest = rest[goes_on] >> 8
    return struct.pack("<B", len(out)) + b"".join(out)


class Codes:
    """Random access to the ids behind ``encode_codes``."""

    def __init__(self, code: bytes):
        self.levels = []
        at = 1
        for _ in range(code[0]):
            (n,) = struct.unpack_from("<I", code, at)
            blocks, width = -(-n // RANK_BITS) + 1, -(-n // 8)
            ranks = np.frombuffer(code, "<u4", blocks, at + 4)
            bits = np.frombuffer(code, np.uint8, width, at + 4 + 4 * blocks)
            chunks = np.frombuffer(code, np.uint8, n, at + 4 + 4 * blocks + width)
            self.levels.append((ranks, bits, chunks))
            at += 4 + 4 * blocks + width + n

    def __len__(self) -> int:
        return len(self.levels[0][2]) if self.levels else 0

    @staticmethod
    def _rank(ranks: np.ndarray, bits: np.ndarray, position: int) -> int:
        """Marks before a position."""
        block = position // RANK_BITS
        ones = int(np.bitwise_count(bits[block * RANK_BITS // 8 : position // 8]).sum())
        if position % 8:
            ones += (int(bits[position // 8]) & ((1 << position % 8) - 1)).bit_count()
        return int(ranks[block]) + ones

    def __getitem__(self, position: int) -> int:
        value = 0
        for level, (ranks, bits, chunks) in enumerate(self.levels):
            value |= int(chunks[position]) << 8 * level
            if not bits[position // 8] >> position % 8 & 1:
                break
            position = self._rank(ranks, bits, position)
        return value

    def read(self, start: int, end: int) -> np.ndarray:
        """The ids of a range; the levels are read from their first to last byte in it."""
        if start >= end:
            return np.empty(0, np.uint32)
        spans = []
        for ranks, bits, chunks in self.levels:
            if start >= end:
                break
            marks = np.unpackbits(bits[start // 8 : -(-end // 8)], bitorder="little")
            marks = marks[start % 8 : start % 8 + end - start].astype(bool)
            spans.append((chunks[start:end], marks))
            start = self._rank(ranks, bits, start)
            end = start + int(marks.sum())
        ids = np.empty(0, np.uint32)
        for chunks, marks in reversed(spans):
            longer = chunks.astype(np.uint32)
            if len(ids):
                longer[marks] |= ids << 8
            ids = longer
        return ids


# ---- encoding of texts

class Uncuttable(Exception):
    """The text has white space or marks at which it can't be cut."""


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}


class PieceEncoder(dict):
    """Whole texts to ids, by remembered ids of words.

    A byte-level tokenizer of this kind never joins a non-space character with the
    white space after it, nor a letter with a mark of punctuation. So a text whose only
    white space is a single space or line feed between words is cut before each of
    them, and equal words are encoded once; words of letters go straight to the
    tokenizer's model. Any other text goes through the tokenizer as a whole.

    Keys are words; one that begins with a line feed had that before it, any other
    a space.
    """

    _MARKS = ".,;:!?"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.marks: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.asarray(found[0].ids, dtype=np.uint32).tobytes()

    def _letters(self, word: str) -> bytes:
        shown = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _piece(self, lead: str, word: str) -> bytes:
        bare = word.rstrip(self._MARKS)
        marks = word[len(bare) :]
        if not bare.isalpha():
            return self._whole(lead + word)
        if marks and lead == " ":
            return self[bare] + self._end(marks)
        before = self._end(lead) if lead == "\n" else b""
        joined = bare if before else lead + bare
        return before + self._letters(joined) + (self._end(marks) if marks else b"")

    def _end(self, marks: str) -> bytes:
        if marks not in self.marks:
            self.marks[marks] = self._whole(marks)
        return self.marks[marks]

    def __missing__(self, word: str) -> bytes:
        lead = "\n" if word[:1] == "\n" else " "
        body = word.removeprefix("\n")
        if body.split() != [body] or "<|" in body:
            raise Uncuttable
        if len(self) >= CACHED_PIECES:
            self.clear()
        self[word] = found = self._piece(lead, body)
        return found

    def encode(self, text: str) -> np.ndarray:
        first, *words = text.replace("\n", " \n").split(" ")
        try:
            begin = self._piece("", first) if first and first.split() == [first] else b""
            if first and not begin or "<|" in first:
                raise Uncuttable
            ids = begin + b"".join(map(self.__getitem__, words))
        except Uncuttable:
            ids = self._whole(text)
        return np.frombuffer(ids, np.uint32)


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder a worker process, whatever number of tasks it runs."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


# ---- store

def write_tokens(
    docs: DataFrame,
    path: str,
    *,
    tokenizer: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Encode every text and write the store.

    The texts cross the network once, in ranges of ids. A task encodes its range
    in order and writes its segments; what lies before each range is added up
    from the number of ids in each, one row a range.
    """
    rows = docs.select(
        column(id_column).cast("bigint").alias("doc_id"),
        F.coalesce(column(text_column).cast("string"), F.lit("")).alias("text"),
    )
    spark = docs.sparkSession
    ranged = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions(
        "doc_id", "text"
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        part, number, before = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        size = 0
        schema = pa.schema(
            [
                ("part", pa.int32()),
                ("segment", pa.int32()),
                ("part_start", pa.int64()),
                ("n_tokens", pa.int64()),
                ("doc_ids", pa.list_(pa.int64())),
                ("doc_ends", pa.list_(pa.int64())),
                ("code", pa.binary()),
            ]
        )

        def flush() -> pa.RecordBatch:
            ends = list(accumulate(len(x) for x in ids))
            code = encode_codes(np.concatenate(ids))
            values = [part, number, before, size, doc_ids, ends, code]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, schema.types)], schema=schema
            )

        end = np.array([end_id], np.uint32)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for name, text in zip(names, batch.column(1).to_pylist()):
                found = encode(text)
                doc_ids.append(name)
                ids.append(np.concatenate([found, end]))
                size += len(found) + 1
                if size >= SEGMENT_IDS:
                    yield flush()
                    number, before, doc_ids, ids, size = number + 1, before + size, [], [], 0
        if doc_ids:
            yield flush()

    written = map_arrow(ranged, segments, SEGMENT, rows=64)
    # Codes hardly compress, and a reader should find them as they are.
    written.write.option("compression", "none").parquet(f"{path}/segments")
    sizes = (
        spark.read.schema(SEGMENT)
        .parquet(f"{path}/segments")
        .groupBy("part")
        .agg(F.sum("n_tokens"))
        .collect()
    )
    starts, total = [], 0
    for part, size in sorted(sizes):
        starts.append((part, total))
        total += size
    frame = spark.createDataFrame(starts, "part int, part_base bigint")
    frame.coalesce(1).write.parquet(f"{path}/parts")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments, each with ``first_token``: the ids of all documents before it."""
    parts = spark.read.schema("part int, part_base bigint").parquet(f"{path}/parts")
    segments = spark.read.schema(SEGMENT).parquet(f"{path}/segments")
    # One row a range of documents, as many as the job had tasks.
    return segments.join(F.broadcast(parts), "part").withColumn(
        "first_token", F.col("part_base") + F.col("part_start")
    )


def document_digests(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of each document's stored ids."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes, start = Codes(row["code"]), 0
                out: tuple[list, ...] = ([], [], [], [])
                for name, end in zip(row["doc_ids"], row["doc_ends"]):
                    stored = codes.read(start, end).astype("<u4").tobytes()
                    values = (name, row["first_token"] + start, end - start, zlib.crc32(stored))
                    for target, value in zip(out, values):
                        target.append(value)
                    start = end
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in out],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    wanted = segments.select("first_token", "doc_ids", "doc_ends", "code")
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return map_arrow(wanted, digests, schema, rows=4)


def tokens_at(segments: DataFrame, positions: Sequence[int]) -> DataFrame:
    """(position, token) for stated positions of the whole corpus.

    Only segments that hold one of them are opened, and in them only the bytes
    of the ids asked for are looked at. Positions outside the corpus give no row.
    """
    asked = sorted(set(positions))
    spark = segments.sparkSession
    wanted = spark.createDataFrame([(p,) for p in asked], "position bigint")
    width = F.col("first_token") + F.col("n_tokens")
    inside = F.col("position").between(F.col("first_token"), width - 1)
    holding = (
        segments.select("first_token", "n_tokens", "code")
        .join(F.broadcast(wanted), inside)
        .groupBy("first_token")
        .agg(F.first("code").alias("code"), F.collect_list("position").alias("positions"))
    )

    def access(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                codes = Codes(row["code"])
                found = [codes[p - row["first_token"]] for p in row["positions"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["positions"], pa.int64()), pa.array(found, pa.int64())],
                    ["position", "token"],
                )

    return map_arrow(holding, access, "position bigint, token bigint", rows=4)
