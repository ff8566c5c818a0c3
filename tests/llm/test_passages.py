import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

import __spark_entry__ as driver
from gaugeline.llm import passages as P


def plain_paragraphs(text, reach=P.REACH, least=P.LEAST_WORDS):
    """(number, words, words to compare) of each paragraph, pair by pair of words."""
    words = (text or "").encode().lower().split()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    pairs = P._mixed(hashes[:-1], hashes[1:]).tolist()
    cuts = [0] if words else []
    for i in range(reach + 1, len(words) - reach - 1):
        before, after = pairs[i - reach : i], pairs[i + 1 : i + reach + 1]
        if pairs[i] < min(before) and pairs[i] <= min(after):
            cuts.append(i)
    out = []
    for number, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(words)])):
        more = max(0, -(-(least - (b - a)) // 2))
        low, high = max(0, a - more), min(len(words), b + more)
        if high - low < least:
            low, high = (0, least) if low == 0 else (max(0, high - least), high)
        out.append((number, words[a:b], words[low:high]))
    return out if len(words) >= least else []


def plain(docs, similarity=0.8, n=5):
    """{(row, paragraph): first of its class} for classes of two or more, by all pairs.

    Rows are numbered in order of ids, without an id first.
    """
    items, together = [], {}
    order = sorted(range(len(docs)), key=lambda r: (docs[r][0] is not None, docs[r][0] or 0, r))
    for row, at in enumerate(order):
        for number, words, reached in plain_paragraphs(docs[at][1]):
            items.append(((row, number), {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}))
            together[row, number] = None if len(words) >= P.LEAST_WORDS else tuple(reached)
    label = {p: p for p, _ in items}
    where = defaultdict(list)
    sets = dict(items)
    links = []
    for place, grams in items:
        common = Counter(q for g in grams for q in where[g])
        links += [(place, q) for q, k in common.items() if k >= similarity * (len(grams) + len(sets[q]) - k)]
        for g in grams:
            where[g].append(place)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    groups = defaultdict(list)
    for p, root in label.items():
        groups[root, together[p]].append(p)
    return {p: min(group) for group in groups.values() if len(group) > 1 for p in group}


def classes(rows, docs):
    """The same of found rows; docs have different ids."""
    row = {d: n for n, d in enumerate(sorted(d for d, _ in docs))}
    return {(row[r.doc_id], r.paragraph): (row[r.class_doc_id], r.class_paragraph) for r in rows}


def test_bands_reach_the_recall():
    for similarity in (0.5, 0.8, 0.95):
        bands, rows = P.tune_bands(similarity, 0.998)
        assert 1 - (1 - similarity**rows) ** bands >= 0.998
        assert bands * rows <= P.MOST_HASHES


def test_paragraphs_of_a_batch_equal_those_cut_one_by_one():
    rng = random.Random(2)
    made = [" ".join(rng.choices("a b c dd é Ff".split(), k=rng.randint(0, 200))) for _ in range(60)]
    texts = [*made, "", " \n", "x", "a b c d e f g", "a b c d e f g h " * 2 + "i j k", "a b c d e f g h " * 2 + "i j k l", "of " * 500, "x y " * 300, "\t" + made[0]]
    raw = [t.replace(" ", "\n", 3).encode() for t in texts]
    batch = P.Paragraphs(raw, P.WordHashes(), P.REACH, P.LEAST_WORDS)
    got = {}
    for text, number, first, n_chars, a, b in zip(batch.text, batch.number, *batch.spans(), batch.first, batch.end):
        span = raw[text].decode()[first : first + n_chars]
        got[text, number] = span.encode().lower().split()
        assert span == span.strip() and len(got[text, number]) == b - a
    expected = {(t, n): words for t, text in enumerate(raw) for n, words, _ in plain_paragraphs(text.decode())}
    assert got == expected and len(got) > 300
    compared = {(t, n): words for t, text in enumerate(raw) for n, _, words in plain_paragraphs(text.decode())}
    assert min(map(len, compared.values())) == P.LEAST_WORDS
    # Names stand for words: equal ones exactly where the words are.
    for names, words_of in zip(batch.names(), (got, compared)):
        words = [tuple(words_of[k]) for k in zip(batch.text, batch.number)]
        assert len(set(names.tolist())) == len(set(words)) == len(set(zip(names.tolist(), words)))
    assert P.Paragraphs([], P.WordHashes(), P.REACH, P.LEAST_WORDS).names()[0].size == 0


@pytest.mark.parametrize("block", [1 << 19, 400])
def test_edited_passages(texts, monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK_SHINGLES", block)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    bases = [rng.choices(words, k=rng.randint(22, 90)) for _ in range(8)]
    docs = []
    for doc in range(80):
        lines = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(3)]
        own = list(rng.choice(bases))
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = "edit"
        lines.insert(rng.randint(0, 3), " ".join(own).upper() if rng.random() < 0.3 else " ".join(own))
        docs.append((doc, rng.choice("\n ").join(lines)))
    found = P.repeated_passages(texts(docs), recall=0.99999).collect()
    expected = plain(docs)
    assert classes(found, docs) == expected and len(expected) > 100
    assert all(r.removed == ((r.doc_id, r.paragraph) != (r.class_doc_id, r.class_paragraph)) for r in found)


def test_passages_are_found_however_they_are_set(texts):
    """Of 51 to 120 words: on lines of 8 words, on one line, within a longer line."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    fresh = lambda low, high: rng.choices(words, k=rng.randint(low, high))
    docs, sizes = [], {}
    for n in range(150):
        passage = fresh(51, 120)
        for way in range(3):
            before, after = fresh(20, 200), fresh(20, 200)
            wrapped = "\n".join(" ".join(passage[i : i + 8]) for i in range(0, len(passage), 8))
            middle = (wrapped, " ".join(passage), " ".join(passage))[way]
            gap = ("\n", "\n", " ")[way]
            docs.append((n * 3 + way, gap.join([" ".join(before), middle, " ".join(after)])))
            sizes[n * 3 + way] = len(passage)
    docs += [(1000 + n, " ".join(fresh(40, 300))) for n in range(100)]
    found = {r.doc_id for r in P.repeated_passages(texts(docs)).collect()}
    assert max(found) < 1000
    assert len(found) >= 0.97 * len(sizes)
    long = {d for d, size in sizes.items() if size >= 75}
    assert len(found & long) == len(long)


def test_links_span_groups_of_all_similar_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**60, 100, dtype=np.uint64)
    sets = []
    for step in range(8):
        changed = base.copy()
        changed[: step * 6] = rng.integers(0, 2**60, step * 6, dtype=np.uint64)
        base = changed if step == 4 else base
        sets.append(np.unique(changed))
    sets += [np.unique(rng.integers(0, 2**60, 30, dtype=np.uint64)) for _ in range(5)] + sets[:2]
    pairs = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))
    ]

    def groups(links):
        label = list(range(len(sets)))
        for _ in label:
            for i, j in links:
                label[i] = label[j] = min(label[i], label[j])
        return label

    links = P.similar_in_block(sets, 0.8)
    assert groups(links) == groups(pairs) and len(pairs) > len(links) > 2
    assert len(links) == len(sets) - len(set(groups(pairs)))


def test_short_lines_that_many_texts_share_are_no_passages(texts):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(4000)]
    licence = "this work is licensed under the public licence version three of that kind only".split()
    docs = [(n, " ".join(rng.choices(words, k=90) + licence + rng.choices(words, k=90))) for n in range(120)]
    assert P.repeated_passages(texts(docs)).count() == 0


def test_odd_rows(texts):
    line = " ".join(f"word{i}" for i in range(21))
    docs = [(2, line), (1, None), (3, ""), (2, line), (None, "é\n" + line.upper()), (4, "short line"), (5, "of " * 30)]
    docs += [(8, line[:80]), (9, line[:80])]  # too few words
    docs += [(None, line), (None, line), (6, "of " * 30), (7, " ".join(f"v{i}" for i in range(60_000)))]
    found = P.repeated_passages(texts(docs)).collect()
    assert P.repeated_passages(texts([])).count() == 0
    got = Counter((r.doc_id, r.paragraph, r.start, r.n_chars, r.class_doc_id, r.class_size, r.removed) for r in found)
    # Of rows without id and with one id, all but the first go.
    assert got.pop((5, 0, 0, 89, 5, 2, False)) == 1 and got.pop((6, 0, 0, 89, 5, 2, True)) == 1
    # The line is two paragraphs; the first of the longer text reaches to another word.
    assert [len(p) for _, p, _ in plain_paragraphs(line)] == [10, 11]
    one, two = (len(line[:59]), None, 4), (76, None, 5)
    assert got == {
        (None, 0, 0, *one, False): 1, (None, 0, 0, *one, True): 1, (2, 0, 0, *one, True): 2,
        (None, 1, 62, *two, False): 1, (None, 1, 60, *two, True): 2, (2, 1, 60, *two, True): 2,
    }
    with pytest.raises(ValueError):
        P.repeated_passages(texts(docs), reach=3)
    with pytest.raises(ValueError):
        P.repeated_passages(texts(docs), least_words=4)


def test_query(spark):
    directory = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{directory}/documents.parquet").select("doc_id", "text").collect()]
    assert len({d for d, _ in docs}) == len(docs)
    assert classes(driver.queries()["op4_passages"](spark, directory).collect(), docs) == plain(docs)
