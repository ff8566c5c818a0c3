import hashlib
import random
import zlib
from fractions import Fraction

import pytest

import __spark_entry__ as driver
from gaugeline.llm import periodic_runs as P
from tests.llm.conftest import SMALL


def plain_runs(words, least_words, least_periods):
    """Runs by trying every period: stretches in which words so far apart are equal."""
    n, found = len(words), {}
    for period in range(1, n // least_periods + 1):
        at = 0
        while at + period < n:
            if words[at] != words[at + period]:
                at += 1
                continue
            end = at
            while end + period < n and words[end] == words[end + period]:
                end += 1
            length = end + period - at
            if length >= max(least_words, least_periods * period):
                found.setdefault((at, length), period)
            at = end + 1
    return [(s, length, p) for (s, length), p in sorted(found.items(), key=lambda r: (r[0][0], r[1]))]


def plain_collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def texts_of(seed, count):
    rng = random.Random(seed)
    for _ in range(count):
        words = []
        while len(words) < rng.randrange(0, 160):
            block = [rng.choice("abc") for _ in range(rng.randrange(1, 12))]
            words += block * rng.randrange(1, 9)
            words = words[: -rng.randrange(1, 4)] if rng.random() < 0.5 else words
        yield [w.encode() for w in words]


@pytest.mark.parametrize("least_words, least_periods", [(24, 3), (6, 3), (9, 4), (3, 3)])
def test_runs_equal_those_by_trying_all_periods(least_words, least_periods):
    texts = [*texts_of(1, 400), [], [b"a"] * 300, [b"a", b"b"] * 150, [b"x"], [b"a"] * 24, [b"a"] * 23]
    how = {"least_words": least_words, "least_periods": least_periods}
    found = P.find_runs(texts, **how)
    assert found == [plain_runs(words, least_words, least_periods) for words in texts]
    assert sum(map(len, found)) > 100
    assert [P.find_runs([words], **how)[0] for words in texts[:60]] == found[:60]
    for words, runs in zip(texts, found):
        assert P.collapsed(words, runs) == plain_collapsed(words, runs)


def test_a_repeated_passage_with_other_words_around_it_is_no_run():
    passage = [str(i).encode() for i in range(40)]
    words = [w for n in range(3000) for w in [*passage, b"x%d" % n]]
    assert P.find_runs([words]) == [[]]


def test_long_periodic_texts():
    words = [str(i % 7).encode() for i in range(60_000)]
    assert P.find_runs([words, [b"a"] * 60_000]) == [[(0, 60_000, 7)], [(0, 60_000, 1)]]


def test_odd_rows(spark, texts):
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, "é " * 30), (4, "A b " * 12 + "c"), (4, "A b " * 12 + "c")]
    found = P.with_runs(texts(rows))
    assert found.columns[-3:] == ["n_words", "runs", "collapsed"]
    got = sorted(
        (r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()
    )
    both = (4, 25, [(0, 24, 2)], "A b c")
    assert got == [(0, 30, [(0, 30, 1)], "é"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), both, both]
    assert P.with_runs(texts([])).count() == 0
    with pytest.raises(ValueError):
        P.with_runs(texts([]), words_column="N")


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words, 24, 3)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    values = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    kept = b" ".join(plain_collapsed(words, runs))
    return (doc_id, len(runs), *values, *(hashlib.sha256(x).hexdigest() for x in (listed.encode(), kept)))


def test_query_equals_a_plain_version(spark):
    found = driver.queries()["op12_periodic_runs"](spark, SMALL)
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    short = [d for d in docs if len(d.text or "") < 6000]
    rows = {r.doc_id: tuple(r) for r in found.collect()}
    assert len(rows) == len(docs) and len(short) > 100
    assert all(rows[d.doc_id] == expected_row(*d) for d in short)
    assert sum(row[1] > 0 for row in rows.values()) > 10
