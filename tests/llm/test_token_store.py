import random
import zlib

import numpy as np
import pytest

import __spark_entry__ as driver
from gaugeline.llm import token_store as S
from gaugeline.session import scratch_dir

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def plain_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("top", [1, 255, 256, 65_535, 65_536, 2**24, 2**32 - 1])
def test_codes_give_every_id_back(top):
    rng = np.random.default_rng(top % 1000)
    ids = rng.integers(0, top, 3000, endpoint=True).astype(np.uint32)
    codes = S.Codes(S.encode_codes(ids))
    assert len(codes) == 3000
    assert [codes[i] for i in range(0, 3000, 7)] == ids[::7].tolist()
    for start, end in [(0, 3000), (0, 0), (511, 513), (7, 1029), (2999, 3000)]:
        assert codes.read(start, end).tolist() == ids[start:end].tolist()


def test_no_ids():
    codes = S.Codes(S.encode_codes(np.zeros(0, np.uint32)))
    assert len(codes) == 0 and codes.read(0, 0).tolist() == []


def test_pieces_equal_whole_texts(tokenizer):
    letters = "ab é\n\t.,'!12\u00a0\u3000<|日'"
    rng = random.Random(3)
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(3000)]
    texts += ["", " ", "a  b", "it's 12.5 o'clock!!", "<|endoftext|>", "a <| b", "\n\nx", "x. \n y"]
    encode = S.PieceEncoder(PATH).encode
    for text in texts:
        assert encode(text).tolist() == plain_ids(tokenizer, text), repr(text)


def test_store_of_odd_rows(spark, texts, tokenizer, monkeypatch):
    rows = [(5, "one two"), (3, None), (5, "one two"), (None, "x"), (9, ""), (4, "long " * 3000)]
    path = scratch_dir(spark, "store")
    S.write_tokens(texts(rows), path, tokenizer=PATH, end_id=2)
    segments = S.read_segments(spark, path)
    found = S.document_digests(segments).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    stream = []
    for row, (doc, text) in zip(found, order, strict=True):
        ids = np.array([*plain_ids(tokenizer, text), 2], "<u4")
        assert tuple(row) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
        stream += ids.tolist()
    asked = [0, 1, 7, len(stream) - 1, len(stream) + 5]
    at = {r.position: r.token for r in S.tokens_at(segments, asked).collect()}
    assert at == {p: stream[p] for p in asked if p < len(stream)}


def test_empty_table(spark, texts):
    path = scratch_dir(spark, "store")
    S.write_tokens(texts([]), path, tokenizer=PATH, end_id=2)
    assert S.document_digests(S.read_segments(spark, path)).count() == 0


def test_query(spark, tokenizer):
    directory = "/root/testdata/sf0.001"
    found = driver.queries()["op1_token_store"](spark, directory).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{directory}/documents.parquet").orderBy("doc_id").collect()
    start = 0
    for row, doc in zip(found, docs, strict=True):
        ids = np.array([*plain_ids(tokenizer, doc.text), 2], "<u4")
        assert tuple(row) == (doc.doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
