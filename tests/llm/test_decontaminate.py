import random

import numpy as np
import pytest

import __spark_entry__ as driver
from gaugeline.llm import decontaminate as D


def plain_alignment(a, b):
    best, table = 0, np.zeros((len(a) + 1, len(b) + 1))
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            step = D.MATCH if a[i - 1] == b[j - 1] else D.MISMATCH
            table[i, j] = max(0, table[i - 1, j - 1] + step, table[i - 1, j] + D.GAP, table[i, j - 1] + D.GAP)
    return table.max() / (D.MATCH * len(a)) if len(a) else best


def test_alignment_scores():
    rng = np.random.default_rng(2)
    for _ in range(30):
        item = rng.integers(1, 6, rng.integers(1, 15))
        rows = [rng.integers(1, 6, rng.integers(1, 20)) for _ in range(5)]
        padded = np.full((5, max(map(len, rows))), -1)
        for at, row in enumerate(rows):
            padded[at, : len(row)] = row
        expected = [plain_alignment(item, row) for row in rows]
        assert np.allclose(D.align(item, padded), expected)


@pytest.fixture
def bench(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(words, k=40))) for i in range(12)]
    return items, words, rng


def test_copies_edited_copies_and_clean_texts(spark, texts, bench):
    items, words, rng = bench
    around = lambda middle: " ".join(rng.choices(words, k=60)) + " " + middle + " " + " ".join(rng.choices(words, k=60))
    rows, expected = [], set()
    for i, text in items:
        own = text.split()
        edited = [w if n % 9 else "changed" for n, w in enumerate(own)]
        shorter = own[:20] + own[23:]
        rows += [(10 * i, around(text.upper())), (10 * i + 1, around(" ".join(edited))), (10 * i + 2, around(" ".join(shorter)))]
        rows.append((10 * i + 3, around(" ".join(own[:6]))))
        rows.append((10 * i + 4, around("")))
        expected |= {(10 * i + k, i) for k in (0, 1, 2)}
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    for block in (1_000_000, 100):
        found = D.contaminated(texts(rows), benchmark, block_words=block).collect()
        assert {(r.doc_id, r.item_id) for r in found} == expected
    clean = D.drop_contaminated(texts(rows), benchmark)
    assert clean.columns == texts(rows).columns
    assert {r.doc_id for r in clean.collect()} == {10 * i + k for i in range(12) for k in (3, 4)}


def test_items_in_very_many_texts_are_found(spark, texts, bench):
    items, words, rng = bench
    rows = [(i, "start " + items[0][1] + " end") for i in range(300)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.contaminated(texts(rows), benchmark)
    assert found.where("item_id = 0 AND score = 1").count() == 300


@pytest.mark.parametrize("every", [9, 10, 11, 12])
@pytest.mark.parametrize("beside_exact", [False, True])
def test_copies_edited_all_over_are_found(spark, texts, bench, every, beside_exact):
    items, words, rng = bench
    noise = lambda: " ".join(rng.choices(words, k=60))
    rows = []
    for i, text in items:
        own = text.split()
        # Each changed word breaks five 5-grams, and no 8 in a row are all whole.
        own[every // 2 :: every] = ["changed"] * len(own[every // 2 :: every])
        rows.append((i, f"{noise()} {' '.join(own)} {noise()}"))
        if beside_exact:
            rows.append((100 + i, f"{noise()} {text} {noise()}"))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in D.contaminated(texts(rows), benchmark).collect()}
    assert found == {(doc, doc % 100) for doc, _ in rows}


def test_short_items_with_one_changed_word(spark, texts):
    items = [(n, " ".join(f"w{n}x{k}" for k in range(n))) for n in range(4, 17)]
    rows = []
    for n, text in items:
        for k in range(n):
            own = text.split()
            own[k] = "changed"
            rows.append((100 * n + k, f"some words before {' '.join(own)} and some after"))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in D.contaminated(texts(rows), benchmark).collect()}
    assert found == {(doc, doc // 100) for doc, _ in rows}


def test_a_verbatim_stretch_counts_whatever_its_share(spark, texts, bench):
    items, words, rng = bench
    noise = lambda: " ".join(rng.choices(words, k=60))
    long = [(50, " ".join(f"v{i}" for i in range(59)))]
    rows = [(n, f"{noise()} {' '.join(long[0][1].split()[20 : 20 + n])} {noise()}") for n in range(5, 59)]
    # Of 59 words with every fifth changed four in a row are left.
    own = long[0][1].split()
    own[4::5] = ["changed"] * len(own[4::5])
    rows.append((100, " ".join(own)))
    benchmark = spark.createDataFrame(items + long, "item_id bigint, text string")
    found = {r.doc_id for r in D.contaminated(texts(rows), benchmark).collect()}
    assert found == set(range(13, 59))
    none = D.contaminated(texts(rows), benchmark, least_stretch=100).collect()
    assert {r.doc_id for r in none} == set(range(30, 59))


@pytest.mark.parametrize("bits", [64, 1 << 12])
def test_a_crowded_bitmap_and_small_blocks_change_nothing(spark, texts, bench, monkeypatch, bits):
    items, words, rng = bench
    items += [(100 + i, " ".join(rng.choices(words[:12], k=30))) for i in range(30)]
    rows = [(i, " ".join(rng.choices(words[:14], k=rng.randint(3, 90)))) for i in range(60)]
    rows += [(200 + i, " ".join(t for _, t in rng.sample(items, 5))) for i in range(15)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = lambda **how: sorted(map(tuple, D.contaminated(texts(rows), benchmark, **how).collect()))
    expected = found()
    assert len(expected) >= 75 and len({d for d, *_ in expected}) >= 15
    monkeypatch.setattr(D, "SEED_BITS", bits)
    assert found() == expected and found(block_words=1) == expected


def plain_matches(rows, items):
    """Scores by aligning whole texts with all items that share a seed with them."""
    out = set()
    for doc, text in rows:
        words = D.words_of(text)
        for item, item_text in items:
            own = D.words_of(item_text)
            n = D.seed_length(len(own), D.SEED_WORDS)
            grams = lambda w: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}  # noqa: B023, E731
            if own and grams(own) & grams(words):
                score = plain_alignment(own, words)
                if score >= D.LEAST_SCORE or score * len(own) >= D.LEAST_STRETCH:
                    out.add((doc, item, round(score, 9)))
    return out


def test_matches_equal_those_of_whole_alignments(spark, texts):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 45)))) for i in range(25)]
    rows = []
    for doc in range(60):
        own = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(own))
            own[at : at + rng.randint(0, 2)] = rng.choices(words, k=rng.randint(0, 2))
            own = own or ["w1"]
        around = [rng.choices(words, k=rng.randint(0, 20)) for _ in range(2)]
        rows.append((doc, " ".join([*around[0], *own, *around[1]])))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id, round(r.score, 9)) for r in D.contaminated(texts(rows), benchmark).collect()}
    expected = plain_matches(rows, items)
    assert {m[:2] for m in got} == {m[:2] for m in expected} and len(got) > 40
    assert len(got & expected) >= 0.98 * len(expected)


def test_clashing_names(spark, texts, bench):
    items, _, _ = bench
    docs = spark.createDataFrame(
        [(1, items[0][1], 5, "x"), (2, "clean", 6, "y"), (None, None, 7, "z")],
        "doc_id bigint, text string, _FOUND int, M1 string",
    )
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    kept = D.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and {r._FOUND for r in kept.collect()} == {6, 7}
    assert docs.count() == D.drop_contaminated(docs, benchmark.where("false")).count()


def test_odd_rows(spark, texts):
    rows = [(1, None), (2, ""), (3, "only one"), (None, "only one"), (3, "only one"), (4, "x " * 200_000 + "only one")]
    items = [(7, None), (8, ""), (9, "Only, one!"), (10, "only one"), (None, "... !!")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = D.contaminated(texts(rows), benchmark).collect()
    ids = sorted((r.doc_id or 0, r.item_id) for r in found)
    assert ids == [(0, 9), (0, 10), (3, 9), (3, 9), (3, 10), (3, 10), (4, 9), (4, 10)]
    assert D.contaminated(texts([]), benchmark).count() == 0
    assert D.contaminated(texts(rows), benchmark.where("item_id < 0")).count() == 0
    assert D.drop_contaminated(texts(rows), benchmark.where("item_id < 0")).count() == len(rows)


def test_query_finds_every_verbatim_item(spark):
    directory = "/root/testdata/sf0.01"
    found = {(r.doc_id, r.item_id) for r in driver.queries()["op5_decontaminate"](spark, directory).collect()}
    docs = spark.read.parquet(f"{directory}/documents.parquet").collect()
    items = spark.read.parquet(f"{directory}/benchmark.parquet").collect()
    padded = [(i.item_id, f" {' '.join(D.words_of(i.text))} ") for i in items]
    verbatim = set()
    for doc in docs:
        text = f" {' '.join(D.words_of(doc.text))} "
        verbatim |= {(doc.doc_id, item) for item, words in padded if words in text}
    assert verbatim and verbatim <= found
    assert len(found - verbatim) <= 0.05 * len(verbatim)
