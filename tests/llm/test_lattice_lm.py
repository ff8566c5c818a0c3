import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as driver
from gaugeline.llm import lattice_lm as M

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    return M.Vocabulary.of(public_tokenizers.path("piece_bpe_32k.model"))


def arcs_of(vocabulary, word):
    """(start, end, log weight, piece) of a marked word, by slicing."""
    by_piece = {p: (w, n) for n, (p, w) in enumerate(zip(vocabulary.pieces, vocabulary.weights)) if p}
    for start in range(len(word)):
        for end in range(start + 1, len(word) + 1):
            if word[start:end] in by_piece:
                yield start, end, *by_piece[word[start:end]]
        if word[start] not in by_piece:
            raw = [vocabulary.bytes_at[b] for b in word[start].encode()]
            yield start, start + 1, sum(vocabulary.weights[r] for r in raw), None


def all_segmentations(vocabulary, word, start=0):
    """Sum over all segmentations, each multiplied out."""
    if start == len(word):
        return 1.0
    arcs = [a for a in arcs_of(vocabulary, word) if a[0] == start]
    return sum(np.exp(w) * all_segmentations(vocabulary, word, end) for _, end, w, _ in arcs)


WORDS = ["the", "a", "reading", "日本", "🙂x", "Éa", "\u0000"]


def test_marginal_is_the_sum_over_segmentations(vocabulary):
    found = M.Lattice(vocabulary).probabilities(WORDS)
    expected = [np.log(all_segmentations(vocabulary, M.START + w)) for w in WORDS]
    assert np.allclose(found, expected, rtol=1e-12)


def plain_forward(vocabulary, word):
    """Log marginal probability, forward and backward values of a marked word, arc by arc."""
    arcs = sorted(arcs_of(vocabulary, word), key=lambda a: a[:2])
    alpha, beta = np.full(len(word) + 1, -np.inf), np.full(len(word) + 1, -np.inf)
    alpha[0] = beta[-1] = 0
    for start, end, w, _ in sorted(arcs, key=lambda a: a[1]):
        alpha[end] = np.logaddexp(alpha[end], alpha[start] + w)
    for start, end, w, _ in sorted(arcs, key=lambda a: -a[0]):
        beta[start] = np.logaddexp(beta[start], beta[end] + w)
    return arcs, alpha, beta


def plain_expected(vocabulary, word):
    """(expected number of each piece, log marginal probability) of a marked word."""
    out = np.zeros(len(vocabulary.pieces))
    arcs, alpha, beta = plain_forward(vocabulary, word)
    for start, end, w, piece in arcs:
        share = np.exp(alpha[start] + w + beta[end] - alpha[-1])
        names = [piece] if piece is not None else [vocabulary.bytes_at[b] for b in word[start].encode()]
        np.add.at(out, names, share)
    return out, alpha[-1]


@pytest.mark.parametrize("part", [7, 20, 256])
def test_blocks_of_long_words_change_nothing(vocabulary, monkeypatch, part):
    monkeypatch.setattr(M, "PART", part)
    lattice = M.Lattice(vocabulary)
    words = ["internationalreadings" * 40, "日本語のテキスト🙂" * 60, "the" * 3, "a" * 300, "éß" * 150]
    expected = [plain_expected(vocabulary, M.START + w) for w in words]
    assert np.allclose(lattice.probabilities(words), [p for _, p in expected], rtol=1e-12)
    counts = np.ones(5)  # so the whole words, however likely, are left out
    found, made = lattice.expected(words, counts, 1e-300, 10**9)
    assert np.isclose(made, counts.sum())
    assert np.allclose(found, sum(c * e for c, (e, _) in zip(counts, expected)), rtol=1e-9, atol=1e-9)


def test_expected_pieces(vocabulary):
    """Each piece's expected number is the derivative by its log weight."""
    counts = np.array([3.0, 1.0, 2.0])
    words = WORDS[:3]
    found, made = M.Lattice(vocabulary).expected(words, counts, 1e-12, 10**9)
    assert np.isclose(made, counts.sum())
    step = 1e-5
    for piece in np.flatnonzero(found)[:12]:
        moved = vocabulary.weights.copy()
        moved[piece] += step
        other = M.Vocabulary(vocabulary.pieces, vocabulary.bytes_at, moved)
        change = M.Lattice(other).probabilities(words) - M.Lattice(vocabulary).probabilities(words)
        assert np.isclose(found[piece], (change * counts).sum() / step, rtol=1e-3, atol=1e-6)


def check_base(rows, docs):
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs if d is not None}
    train = [(d, t) for d, t in docs if not held.get(d, False)]
    c = Counter(w for _, t in train for w in (t or "").encode().lower().split())
    n, v, ends = sum(c.values()) + len(train), len(c) + bool(train), len(train)
    expected = []
    for d, t in docs:
        words = (t or "").encode().lower().split()
        base = sum(np.log10((c[w] + 1) / (n + v + 1)) for w in words) + np.log10((ends + 1) / (n + v + 1))
        known = sum(c[w] > 0 for w in words) + bool(ends)
        expected.append((d or -1, held.get(d, False), len(words) + 1, known, n, round(base, 6)))
    got = [(r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows]
    assert sorted(got) == sorted(expected)
    assert all(np.isfinite(r.score) and r.score < 0 for r in rows)


@pytest.mark.parametrize("frequent", [0, 2, 1000])
def test_odd_rows(texts, vocabulary, frequent):
    docs = [(i, f"the reading {i} was good good") for i in range(12)]
    docs += [(3, None), (None, "New words"), (2, ""), (2, ""), (5, "z" * 3000 + " \tthe"), (4, "x y " * 20_000)]
    found = M.score_texts(texts(docs), vocabulary, frequent_words=frequent).collect()
    check_base(found, docs)
    assert M.score_texts(texts([]), vocabulary).count() == 0


def plain_scores(vocabulary, docs):
    """The model's score of each text: EM over all different words, arc by arc."""
    words_of = lambda t: [w.decode() for w in t.encode().lower().split()]
    cut = [(zlib.crc32(str(d).encode()) % 7 == 2, words_of(t)) for d, t in docs]
    c = Counter(w for held, words in cut if not held for w in words)
    ends = sum(not held for held, _ in cut)
    tokens, share = sum(c.values()) + ends, vocabulary.share
    for _ in range(M.ROUNDS):
        total, made = np.zeros(len(vocabulary.pieces)), 0.0
        for word, n in c.items():
            own, p = plain_expected(vocabulary, M.START + word)
            by_pieces = (1 - share) * np.exp(p)
            times = n * by_pieces / (by_pieces + share * (n - 1) / (tokens - 1))
            total, made = total + times * own, made + times
        vocabulary = vocabulary.learned(total, share)
        share = float(np.clip(1 - made / sum(c.values()), 0.001, 0.999))
    out = []
    for _, words in cut:
        by = [(1 - share) * np.exp(plain_forward(vocabulary, M.START + w)[1][-1]) + share * c[w] / tokens for w in words]
        out.append(np.log10(by).sum() + np.log10(share * ends / tokens))
    return out


@pytest.mark.parametrize("frequent", [0, 15, 1000])
def test_scores_equal_a_plain_model(spark, texts, vocabulary, frequent):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    docs = [tuple(r) for r in rows if 20 < len(r.text) < 400][:25]
    docs += [(9001, "unbrokenabcdefghij" * 30), (9002, "unbrokenabcdefghij" * 30 + " the")]
    assert {zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs} == {False, True}
    expected = plain_scores(vocabulary, docs)
    got = {r.doc_id: r.score for r in M.score_texts(texts(docs), vocabulary, frequent_words=frequent).collect()}
    assert np.allclose([got[d] for d, _ in docs], expected, rtol=1e-7)


def test_only_held_out_texts(texts, vocabulary):
    held = [d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2][:2]
    docs = [(held[0], "a b"), (held[1], "")]
    check_base(M.score_texts(texts(docs), vocabulary).collect(), docs)


def test_query_and_learning(spark, vocabulary):
    directory = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").collect()]
    found = driver.queries()["op2_lattice_lm"](spark, directory).collect()
    check_base(found, docs)
    # Learned weights beat the vocabulary's own on texts nothing was learned from.
    lattice = M.Lattice(vocabulary)
    texts = dict(docs)
    held = [r for r in found if r.held_out]
    before = sum(lattice.probabilities([w.lower() for w in texts[r.doc_id].split()]).sum() for r in held[:40])
    after = sum(r.score for r in held[:40]) * np.log(10)
    assert after > 0.8 * before
