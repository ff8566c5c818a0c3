from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as driver
from gaugeline.llm import packing as K


@pytest.mark.parametrize("seed", range(6))
def test_boundaries_have_the_least_padding(seed):
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 60), 9, replace=False))
    counts = rng.integers(1, 50, 9)
    for buckets in (1, 2, 4, 9, 12):
        def padding(uppers):
            at = np.searchsorted(uppers, lengths)
            return int(((np.array(uppers)[at] - lengths) * counts).sum())

        found = K.boundaries(lengths, counts, buckets)
        assert len(found) <= buckets and found[-1] == lengths[-1]
        every = [
            padding(sorted([*c, lengths[-1]]))
            for k in range(min(buckets, 9))
            for c in combinations(lengths[:-1], k)
        ]
        assert padding(found) == min(every)


def check(rows, tokens, longest, budget):
    pieces = defaultdict(list)
    batches = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.first_token, r.n_tokens))
        batches[r.bucket, r.batch].append((r.seat, r.n_tokens))
    for doc, n in tokens.items():
        expected = [(i, at, min(longest, n - at)) for i, at in enumerate(range(0, n, longest))]
        assert sorted(pieces.get(doc, [])) == expected
    last = defaultdict(int)
    for bucket, batch in batches:
        last[bucket] = max(last[bucket], batch)
    lower = dict(zip(sorted(last), [0, *sorted(last)]))
    for (bucket, batch), seats in batches.items():
        assert sorted(s for s, _ in seats) == list(range(len(seats)))
        assert all(lower[bucket] < n <= bucket for _, n in seats)
        room = max(1, budget // bucket)
        assert len(seats) <= room and (len(seats) == room or batch == last[bucket])


def test_odd_rows(texts, monkeypatch):
    monkeypatch.setattr(K, "GROUP_ROWS", 3)
    docs = [(i, "w " * (i % 13)) for i in range(60)] + [(100, None), (101, " \t\n"), (102, "x " * 30_001), (103, "\va\fb\r c")]
    tokens = {i: i % 13 for i in range(60)} | {100: 0, 101: 0, 102: 30_001, 103: 3}
    rows = K.pack(texts(docs), longest=50, buckets=5, budget=200).collect()
    check(rows, tokens, 50, 200)
    assert len({r.bucket for r in rows}) <= 5
    twice = K.pack(texts([(7, "a b"), (7, "a b"), (None, "c")]), longest=50).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in twice) == [(0, 1), (7, 2), (7, 2)]
    assert len({(r.bucket, r.batch, r.seat) for r in twice}) == 3
    assert K.pack(texts([])).count() == 0


ENCODING = {
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
    "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
}


def ids_by_library(text):
    t = Tokenizer.from_file(ENCODING["tokenizer"])
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


def test_batches_hold_the_ids_of_their_texts(spark, texts, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "GROUP_ROWS", 3)
    docs = [(i, " ".join(f"word{k * i}" for k in range(i % 23))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "x yé 🙂\n" * 3000), (103, "<|endoftext|> a"), (104, "unbroken" * 4000)]
    docs += [(7, "same id"), (None, "no id")]
    K.write_batches(texts(docs), f"{tmp_path}/b", longest=50, buckets=5, budget=200, **ENCODING)
    batches = K.read_batches(spark, f"{tmp_path}/b")
    rows = K.sequences(batches).collect()
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.piece, r.bucket, r.batch, r.seat)):
        assert r.first_token == r.piece * 50 and len(r.ids) == r.n_tokens <= r.bucket
        found[r.doc_id].append(r)
    texts_of = defaultdict(list)
    for doc, text in docs:
        texts_of[doc].append(ids_by_library(text))
    for doc, expected in texts_of.items():
        if len(expected) == 1:
            assert [i for r in found[doc] for i in r.ids] == expected[0], doc
        else:
            assert sorted(r.ids for r in found[doc]) == sorted(expected)
    single = {doc: len(ids[0]) for doc, ids in texts_of.items() if len(ids) == 1}
    assert sum(r.n_tokens for r in rows) == sum(len(i) for ids in texts_of.values() for i in ids)
    assert len(single) == len(docs) - 2
    for b in batches.collect():
        assert b.ends[-1] == len(b.tokens) and b.ends == sorted(b.ends) and len(b.ends) <= max(1, 200 // b.bucket)
    K.write_batches(texts([]), f"{tmp_path}/none", **ENCODING)
    assert K.read_batches(spark, f"{tmp_path}/none").count() == 0


def test_encoder_equals_the_other_library():
    encode = K.Encoder(*ENCODING.values()).encode
    for text in ["", " ", " " * 5000, "a  b\n\n c", "<|endoftext|>", "日本語 テキスト", "\x1c \u0085x", "it's 12'll", "q" * 50_000, "ab " * 900]:
        assert encode(text) == ids_by_library(text)


def test_query(spark):
    directory = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{directory}/documents.parquet").collect()
    tokens = {d.doc_id: len(ids_by_library(d.text)) for d in docs[:40]}
    rows = driver.queries()["op8_packing"](spark, directory).collect()
    encode = K.encoder(ENCODING["ranks"], ENCODING["pattern"], ENCODING["tokenizer"]).encode
    every = {d.doc_id: len(encode(d.text)) for d in docs}
    assert tokens.items() <= every.items()
    check(rows, every, K.LONGEST, K.BUDGET)
