import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import __spark_entry__ as driver
from gaugeline.llm import alignment as A
from tests.llm.conftest import SMALL

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "a", " ", "  ", "a ", " a", "a  b", "a \n b\n", "\n", "\t x", "it's  we'll 12 345", "<|endoftext|> <s> <unk> <0x0A>",
    "日本語のテキスト 日本", "🙂🙃 naïve café", "a b   c", "zero\u200b width", "x\u0085 y", "\x1c a \x1f b",
    "a ▁ b", "▁", "é combining", "end of ... text!!! (ok)", "ab" * 200, " \u3000 ", "Ünï-cödé", "\ufeff bom", "\u180e a", "a\u180e b",
    "ａｂｃ ｄ", "ﬁne", "tab\tseparated words ", "\x00 nul", "क्षि त्र",
]


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(BYTE_LEVEL)
    t.encode_special_tokens = True
    return t, sentencepiece.SentencePieceProcessor(model_file=PIECES), A.ByteLevel(BYTE_LEVEL).bytes_of


def plain(libraries, text):
    """(ids of A, ids of B, groups as (A places, B places)) by whole-text encoding."""
    t, model, bytes_of = libraries
    if not text:
        return [], [], []
    a, b = t.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
    a_bytes = [bytes_of[i] for i in a]
    b_bytes = [
        bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
        else model.id_to_piece(i).replace("▁", " ").encode()
        for i in b
    ]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], [], []
    a_end, b_end = np.cumsum(list(map(len, a_bytes))), np.cumsum(list(map(len, b_bytes)))
    groups, at_a, at_b = [], 0, 0
    for end in sorted(set(a_end.tolist()) & set(b_end.tolist())):
        to_a, to_b = np.searchsorted(a_end, end) + 1, np.searchsorted(b_end, end) + 1
        groups.append((range(at_a, to_a), range(at_b, to_b)))
        at_a, at_b = to_a, to_b
    return a, b, groups


def listed(a, b, groups):
    both = (",".join(str(x[i]) for i in g) for ga, gb in groups for x, g in ((a, ga), (b, gb)))
    return ";".join(f"{one}|{two}" for one, two in zip(both, both))


@pytest.mark.parametrize("pattern", [None, public_tokenizers.PATTERN])
def test_parts_add_up_to_the_whole_text(libraries, pattern):
    rng = random.Random(3)
    pieces = [*ODD, "word", "the", ",", "\n", "é"]
    made = ["".join(rng.choice(pieces) + rng.choice(["", " ", "  ", "\n", " "]) for _ in range(rng.randrange(1, 9))) for _ in range(1500)]
    texts = [*ODD, *made, None, ""]
    texts += ["q" * 5000, "ab " * 900 + "x" * 3000 + " é" * 50]
    aligner = A.Aligner(A.ByteLevel(BYTE_LEVEL, pattern), A.Pieces(PIECES))
    assert (aligner.sides[0].tokenizer.encoding is None) == (pattern is None)
    assert aligner.cuttable
    linked = 0
    for text, found in zip(texts, [r for at in range(0, len(texts), 64) for r in aligner.texts(texts[at : at + 64])]):
        a, b, groups = plain(libraries, text)
        links = Counter(a[i] * aligner.width + b[j] for ga, gb in groups for i in ga for j in gb)
        assert found[:5] == (len(a), len(b), len(groups), sum(links.values()), listed(a, b, groups)), text
        assert dict(zip(found[5].tolist(), found[6].tolist())) == links
        linked += len(groups) > 0
    assert linked > 1000


def test_products_equal_dense_ones_in_blocks_of_any_size():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n, k, m = rng.integers(1, 12, 3)
        dense = rng.integers(0, 3, (n, k)), rng.integers(0, 3, (k, m))
        sparse = [A.Rows(np.r_[0, np.cumsum((d > 0).sum(1))], np.nonzero(d)[1], d[d > 0], d.shape[1]) for d in dense]
        for most in (1, 5, 10**6):
            out = np.zeros((n, m), int)
            for first, block in A.row_products(*sparse, most):
                out[first + block.row, block.column] += block.value
            assert np.array_equal(out, dense[0] @ dense[1])
        turned = sparse[0].transposed()
        again = np.zeros((k, n), int)
        again[turned.row, turned.column] = turned.value
        assert np.array_equal(again, dense[0].T)


def test_overlaps_are_shared_bytes():
    a, b = np.array([3, 1, 2, 4]), np.array([1, 3, 3, 3])
    found = {(f + r, c): v for f, m in A.overlaps(a, b, 2) for r, c, v in zip(m.row, m.column, m.value)}
    assert found == {(0, 0): 1, (0, 1): 2, (1, 1): 1, (2, 2): 2, (3, 2): 1, (3, 3): 3}
    one, other = A.groups_of(a, b)
    assert one.tolist() == [0, 0, 1, 1] and other.tolist() == [0, 0, 1, 1]


def expected_rows(libraries, docs):
    made = [(doc_id, *plain(libraries, text)) for doc_id, text in docs]
    links = [Counter((a[i], b[j]) for ga, gb in groups for i in ga for j in gb) for _, a, b, groups in made]
    count = Counter(pair for found in links for pair in found)
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (doc_id, a, b, groups), found in zip(made, links):
        text = listed(a, b, groups)
        best = sum(n for pair, n in found.items() if count[pair] == most[pair[0]])
        total = sum(n * count[pair] for pair, n in found.items())
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((doc_id, len(a), len(b), len(groups), sum(found.values()), best, total, digest))
    return sorted(out, key=str)


def test_odd_rows_and_any_number_of_frequent_pairs(spark, texts, libraries):
    rows = [(1, "of the on"), (1, "of the on"), (None, "of"), (2, None), (3, ""), (4, "a ▁ b"), (5, "日本語 of")]
    expected = expected_rows(libraries, rows)
    aligned = A.align_tokens(texts(rows), byte_level=BYTE_LEVEL, pieces=PIECES)
    aligned = A.saved(aligned, "aligned")
    width = len(A.Pieces(PIECES).bytes_of)
    for most in (0, 3, 1000):
        counts = A.link_counts(aligned, width, frequent_pairs=most)
        joined = aligned.join(counts, "row", "left").fillna(0, ["n_best", "count_sum"])
        got = [
            (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum,
             hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
            for r in joined.collect()
        ]
        assert sorted(got, key=str) == expected
    empty = A.saved(A.align_tokens(texts([]), byte_level=BYTE_LEVEL, pieces=PIECES), "aligned")
    assert empty.count() == 0 and A.link_counts(empty, width).count() == 0


def test_query_equals_a_plain_version(spark, libraries):
    found = driver.queries()["op11_alignment"](spark, SMALL)
    assert found.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, found.collect()), key=str) == expected_rows(libraries, docs)
