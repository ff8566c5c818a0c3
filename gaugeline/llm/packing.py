"""Sequences of equal padded length, in batches of a token budget, with their token ids.

Texts are encoded and cut into sequences of at most ``longest`` tokens. The histogram of
sequence lengths over the whole corpus has that many bins at most; dynamic
programming over it chooses the bucket boundaries with the least padding there can
be. Within a bucket sequences are numbered and dealt into batches of as many as
the budget holds at the bucket's length.

Numbering needs no bucket in one task: sequences are counted in many small groups
of a bucket, the groups' offsets are added up, and each group numbers its own.

``pack`` seats sequences; its tokens are those of a byte-level vocabulary of ranks
(``encoding``), what ``tokens`` counts, or else white-space separated words. ``write_batches``
also writes a row for each batch: the ids of its sequences one after the other, where each
ends, and what it is of. Defined cases: null and empty texts have no tokens and give no sequence. Rows of equal
id are packed each. An empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeline.llm.common import column, map_arrow, row_numbers, saved

LONGEST = 2048
BUCKETS = 16
BUDGET = 65_536
GROUP_ROWS = 200
MOST_GROUPS = 4096
# Longer stretches without white space are encoded bit by bit elsewhere, see ``Encoder``.
LONGEST_STRETCH = 2000

BATCH = (
    "bucket bigint, batch bigint, doc_ids array<bigint>, pieces array<bigint>, "
    "first_tokens array<bigint>, ends array<bigint>, tokens array<int>"
)


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper lengths of at most ``buckets`` buckets with the least total padding.

    ``lengths`` ascend. best[j] is the least padding of the first j lengths; a
    bucket over lengths i to j-1 is padded to the last of them.
    """
    n = len(lengths)
    if n <= buckets:
        return [int(x) for x in lengths]
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    tokens = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    # padding[i, j]: of one bucket over lengths i..j
    padding = (rows[None, 1:] - rows[:-1, None]) * lengths[None, :] - (
        tokens[None, 1:] - tokens[:-1, None]
    )
    padding[np.tril_indices(n, -1)] = np.inf
    best = padding[0]
    splits = []
    for _ in range(buckets - 1):
        # the last bucket starts at i, the others end at i - 1
        total = np.vstack([padding[:1], best[:-1, None] + padding[1:]])
        splits.append(total.argmin(axis=0))
        best = total.min(axis=0)
    out, end = [], n - 1
    for split in reversed(splits):
        out.append(int(lengths[end]))
        end = int(split[end]) - 1
        if end < 0:
            break
    else:
        out.append(int(lengths[end]))
    return sorted(out)


def word_count(text: Column) -> Column:
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D]", " "))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, " +"))).cast("bigint")


def pack(
    docs: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokens: Column | None = None,
    encoding: dict | None = None,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """(doc_id, piece, first_token, n_tokens, bucket, batch, seat) of every sequence.

    ``bucket`` is the padded length; ``batch`` counts from 0 in each bucket.
    """
    if encoding is not None:
        counted = token_counts(docs, id_column=id_column, text_column=text_column, **encoding)
    else:
        n = word_count(column(text_column).cast("string")) if tokens is None else tokens
        doc_id = column(id_column).cast("bigint")
        counted = docs.select(doc_id.alias("doc_id"), n.cast("bigint").alias("n"))
    return _seats(saved(counted, "lengths"), ["doc_id"], longest, buckets, budget)


def _seats(counted: DataFrame, keys: list[str], longest: int, buckets: int, budget: int) -> DataFrame:
    """(keys, piece, first_token, n_tokens, bucket, batch, seat) of every sequence of (keys, n).

    ``doc_id`` is one of the keys and gives the order; further ones tell rows of equal id apart.
    """
    pieces = (
        counted.where("n > 0")
        .select(*keys, "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / longest))))
        .select(
            *keys,
            F.col("col").alias("piece"),
            (F.col("col") * longest).alias("first_token"),
            F.least(F.lit(longest), F.col("n") - F.col("col") * longest).alias("n_tokens"),
        )
    )
    # One row for each length, ``longest`` at most.
    bins = sorted(tuple(r) for r in pieces.groupBy("n_tokens").count().collect())
    lengths = np.array([b[0] for b in bins], np.int64)
    counts = np.array([b[1] for b in bins], np.int64)
    uppers = boundaries(lengths, counts, buckets) if bins else [longest]
    groups = max(1, min(MOST_GROUPS, int(counts.sum()) // GROUP_ROWS))
    bucket = F.coalesce(*[F.when(F.col("n_tokens") <= u, u) for u in uppers]).cast("bigint")
    dealt = pieces.withColumn("bucket", bucket).withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups))
    )
    sizes = dealt.groupBy("bucket", "part").count()
    before = F.sum("count").over(
        Window.partitionBy("bucket").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = sizes.select("bucket", "part", F.coalesce(before, F.lit(0)).alias("start"))
    own = F.row_number().over(
        Window.partitionBy("bucket", "part").orderBy("doc_id", "piece", "n_tokens", *keys)
    )
    numbered = dealt.withColumn("own", own).join(starts, ["bucket", "part"])
    number = F.col("start") + F.col("own") - 1
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket")))
    return numbered.select(
        *keys,
        "piece",
        "first_token",
        "n_tokens",
        "bucket",
        F.floor(number / room).alias("batch"),
        F.pmod(number, room).alias("seat"),
    )


# ---- token ids

class Encoder:
    """Ids by a vocabulary of ranks, for use inside a task.

    The encoder's time grows with the square of a stretch that its pattern does not split, so
    texts with a very long one go to the same vocabulary in another library.
    """

    def __init__(self, ranks: str, pattern: str, other: str | None):
        import tiktoken

        with open(ranks, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})
        self.other = None
        if other:
            from tokenizers import Tokenizer

            self.other = Tokenizer.from_file(other)
            self.other.encode_special_tokens = True

    def encode(self, text: str) -> list[int]:
        # An empty or white text has no longest word.
        if self.other and len(text) > LONGEST_STRETCH and max(map(len, text.split()), default=0) > LONGEST_STRETCH:
            return self.other.encode(text, add_special_tokens=False).ids
        return self.encoding.encode_ordinary(text)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(ranks: str, pattern: str, other: str | None) -> Encoder:
    """One a worker process, whatever number of tasks it runs."""
    key = (ranks, pattern, other)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def token_counts(
    docs: DataFrame,
    *,
    ranks: str,
    pattern: str,
    tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, n) of every row."""
    rows = docs.select(
        column(id_column).cast("bigint").alias("doc_id"), column(text_column).cast("string").alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, pattern, tokenizer).encode
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["doc_id", "n"])

    return map_arrow(rows, work, "doc_id bigint, n bigint")


def token_ids(
    docs: DataFrame,
    *,
    ranks: str,
    pattern: str,
    tokenizer: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(row, doc_id, n, ids) of every row, ``row`` a number of its own."""
    rows = docs.select(
        column(id_column).cast("bigint").alias("doc_id"), column(text_column).cast("string").alias("text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, numbers = encoder(ranks, pattern, tokenizer).encode, row_numbers()
        for batch in batches:
            found = [np.array(encode(t or ""), np.int32) for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = pa.array(np.concatenate([np.zeros(0, np.int32), *found]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(numbers) for _ in found], pa.int64()),
                    batch.column(0),
                    pa.array(np.diff(ends).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), flat),
                ],
                ["row", "doc_id", "n", "ids"],
            )

    return map_arrow(rows, work, "row bigint, doc_id bigint, n bigint, ids array<int>")


def write_batches(
    docs: DataFrame,
    path: str,
    *,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    **encoding,
) -> None:
    """Encode, pack and write BATCH rows; ``encoding`` are the options of ``token_ids``.

    The ids are encoded once and stored. Seats are dealt by lengths alone, so the ids cross
    the network twice: to their seats, and to their batches of ``budget`` tokens.
    """
    stored = saved(token_ids(docs, **encoding), "token-ids")
    seats = _seats(stored.select("row", "doc_id", "n"), ["row", "doc_id"], longest, buckets, budget)
    seated = seats.join(stored.select("row", "ids"), "row").select(
        "bucket", "batch", "seat", "doc_id", "piece", "first_token", "n_tokens",
        F.slice("ids", (F.col("first_token") + 1).cast("int"), F.col("n_tokens").cast("int")).alias("ids"),
    )
    end = F.sum("n_tokens").over(Window.partitionBy("bucket", "batch").orderBy("seat"))
    # A batch is bounded by its budget.
    ended = seated.withColumn("end", end).groupBy("bucket", "batch").agg(
        F.array_sort(
            F.collect_list(F.struct("seat", "end", "doc_id", "piece", "first_token", "ids"))
        ).alias("seats")
    )
    ended.select(
        "bucket",
        "batch",
        F.col("seats.doc_id").alias("doc_ids"),
        F.col("seats.piece").alias("pieces"),
        F.col("seats.first_token").alias("first_tokens"),
        F.col("seats.end").alias("ends"),
        F.flatten("seats.ids").alias("tokens"),
    ).write.parquet(path)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BATCH).parquet(path)


def sequences(batches: DataFrame) -> DataFrame:
    """(doc_id, piece, first_token, n_tokens, bucket, batch, seat, ids) of stored batches."""
    before = "if(i = 0, 0L, ends[i - 1])"
    return batches.selectExpr(
        "bucket",
        "batch",
        f"""inline(transform(ends, (e, i) -> named_struct(
              'doc_id', doc_ids[i], 'piece', pieces[i], 'first_token', first_tokens[i],
              'n_tokens', e - {before}, 'seat', bigint(i),
              'ids', slice(tokens, int({before}) + 1, int(e - {before})))))""",
    ).select("doc_id", "piece", "first_token", "n_tokens", "bucket", "batch", "seat", "ids")
