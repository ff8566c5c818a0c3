import re

import numpy as np
import pytest
import xxhash

import __spark_entry__ as driver
from gaugeline.llm import simhash as S
from gaugeline.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius):
    """The smallest place reachable from each fingerprint, by all pairs."""
    label = list(range(len(prints)))
    values = np.array(prints, np.uint64)
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            near = np.flatnonzero(np.bitwise_count(values ^ values[i]) <= radius)
            low = min(label[j] for j in near)
            for j in near:
                changed |= label[j] != low
                label[j] = low
    return label


def near_prints(seed, clusters, size, most=4):
    """Chains of fingerprints, each a few bits from the one before."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(clusters):
        value = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(size):
            out.append(value)
            for bit in rng.choice(64, rng.integers(1, most, endpoint=True), replace=False):
                value ^= 1 << int(bit)
    return out


@pytest.mark.parametrize("text", ["", None, " \t\n", "One", "a B", "x y z", "The İ É ß q r s " * 40])
def test_fingerprint(text):
    assert S.fingerprint((text or "").encode(), 3) == plain_print(text, 3)


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_bit_sliced_distances(radius):
    buckets = [np.array(sorted(set(near_prints(s, 2, n))), np.uint64) for s, n in [(1, 1), (2, 40), (3, 70)]]
    planes = S.Planes(buckets)
    got = set(zip(*(planes.members[x].tolist() for x in planes.close_pairs(radius))))
    want = {
        (int(a), int(b))
        for bucket in buckets
        for i, a in enumerate(bucket)
        for b in bucket[i + 1 :]
        if (int(a) ^ int(b)).bit_count() <= radius
    }
    assert got == want


@pytest.mark.parametrize("block", [1024, 16])
def test_links_have_the_components_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BUCKET_BLOCK", block)
    prints = sorted(set(near_prints(5, 30, 12) + near_prints(6, 200, 1) + near_prints(7, 1, 150, 3)))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    roots = {r.node: r.root for r in connected_components(S.fingerprint_links(frame, 3)).collect()}
    got = {}
    for v in signed:
        got.setdefault(roots.get(v, v), set()).add(v)
    want = {}
    for v, label in zip(signed, plain_groups(prints, 3)):
        want.setdefault(label, set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
    assert any(len(g) > 20 for g in got.values())


def test_odd_rows(spark, texts):
    rows = [(4, "a b c d"), (2, "A b  c d"), (7, None), (6, ""), (6, ""), (None, "p q r s"), (3, "q " * 50_000)]
    found = S.simhash_groups(texts(rows), shingle=3, radius=3).collect()
    component = {(r.doc_id, r.fp): r.component_id for r in found}
    assert len(found) == 7
    assert {r.component_id for r in found if r.doc_id in (2, 4)} == {2}
    assert {r.component_id for r in found if r.doc_id in (6, 7)} == {6}
    assert [r.component_id for r in found if r.doc_id is None] == [None], component
    kept = S.drop_near_copies(texts(rows), shingle=3, radius=3)
    assert kept.columns == texts(rows).columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 3, 6]
    assert S.simhash_groups(texts([]), shingle=3, radius=3).count() == 0
    assert S.drop_near_copies(texts([]), shingle=3, radius=3).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (7, 9), (5, 5), (10, 11), (11, 10), (None, 4)]
    links += [(100 + i, 101 + i) for i in range(60)]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.root for r in connected_components(frame).collect()}
    chain = {100 + i: 100 for i in range(61)}
    assert found == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 10: 10, 11: 10} | chain
    assert connected_components(frame.where("a = 0")).count() == 0


def test_query(spark):
    directory = "/root/testdata/sf0.001"
    found = driver.queries()["op10_simhash"](spark, directory).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{directory}/documents.parquet").orderBy("doc_id").collect()
    prints = [plain_print(d.text, 3) for d in docs]
    groups = plain_groups(prints, 3)
    assert [r.fingerprint for r in found] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in found] == [docs[g].doc_id for g in groups]
