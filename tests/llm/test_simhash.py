"""SimHash components against comparing all pairs."""

import random

import numpy as np
import pytest
import xxhash

from stowage.llm import simhash
from stowage.llm.common import components


def slow_fingerprint(text, words=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or [b" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, radius=2):
    prints = [slow_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc)
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(((d, f"{prints[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows)), key=str)


def near_texts(seed, n):
    rng = random.Random(seed)
    base = [rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(400)]
    texts = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = "X" + str(rng.randrange(50))
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair(radius):
    masks = simhash.covering_masks(list(range(64)), radius)
    rng = random.Random(radius)
    for _ in range(3000):
        diff = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(diff & m == 0 for m in masks)


def test_second_level_is_bounded():
    for m in simhash.covering_masks(list(range(64)), 2):
        rest = [b for b in range(64) if not m >> b & 1]
        for s in simhash.covering_masks(rest, 2):
            assert 64 - (m | s).bit_count() <= 12


def test_against_all_pairs(spark, rows):
    given = list(enumerate(near_texts(1, 150)))
    given += [(900, None), (901, ""), (902, " \t"), (903, "one"), (904, "ONE"), (905, "one two"), (None, "lone words here now")]
    given += [given[3], given[3], (950, given[3][1]), (951, "é É ß"), (952, "é é ß")]
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in given], "doc_id bigint, text string, fingerprint string, TEXT string")
    assert rows(simhash.near_duplicates(df), "doc_id", "fingerprint", "component_id") == slow_components(given)


def test_crowded_buckets(spark, monkeypatch):
    """Fingerprints within a few bits of one: first-level buckets overflow and are masked again."""
    monkeypatch.setattr(simhash, "BUCKET", 8)
    rng = random.Random(5)
    center = rng.getrandbits(64)
    found = sorted({center ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(6))) for _ in range(300)})
    signed = [simhash.signed(f) for f in found]
    nodes = spark.createDataFrame([(f,) for f in signed], "fingerprint bigint").repartition(3)
    got = {r.node: r.root for r in components(simhash.fingerprint_links(nodes)).collect()}
    want = {}
    arr = np.array(signed)
    left = set(signed)
    while left:
        group, queue = set(), [left.pop()]
        while queue:
            x = queue.pop()
            group.add(x)
            near = {int(y) for y in arr[np.bitwise_count(arr ^ x) <= 2]} & left
            left -= near
            queue.extend(near)
        if len(group) > 1:
            want |= {g: min(group) for g in group}
    assert got == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(empty).collect() == []


def test_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (101, 102)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100, 102: 100}
