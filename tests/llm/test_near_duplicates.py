import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from cartwise.llm import simhash

DOCS = "doc_id long, text string, fingerprint string"


def _fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(values, radius):
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(values, 2):
        if (a ^ b).bit_count() <= radius:
            parent[root(a)] = root(b)
    return {v: root(v) for v in values}


def test_masks_cover_every_pair_within_the_radius():
    for radius in (0, 1, 2, 3):
        masks = simhash.covering_masks(radius)
        for bits in combinations(range(0, 64, 3), radius):
            assert any(all(not m >> b & 1 for b in bits) for m in masks)


def _near_values(rng):
    values = {rng.getrandbits(64) for _ in range(200)}
    for _ in range(6):
        seed = rng.getrandbits(64)
        for _ in range(40):
            seed ^= 1 << rng.randrange(64)
            values.add(seed)
            values.add(seed ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    return values | {0, 1, (1 << 63) | 1, 7}


@pytest.mark.parametrize("radius,bucket", [(2, 4_096), (2, 1), (1, 1), (1, 64), (0, 64)])
def test_links_give_the_components_of_all_pairs(spark, radius, bucket):
    values = _near_values(random.Random(radius))
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.links(frame, radius, bucket)).collect()}
    groups, expected = {}, {}
    for v in values:
        s = v - (1 << 64) if v >> 63 else v
        groups.setdefault(found.get(s, s), set()).add(v)
    for v, r in _components(values, radius).items():
        expected.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_forest_of_a_bucket_has_one_link_less_than_members():
    values = np.array([1 << i for i in range(60)], np.uint64)
    assert len(simhash._forest(values, 2)) == 59


def test_documents_like_by_hand(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3_000)]
    base = [rng.choice(words) for _ in range(400)]
    docs = [(i, " ".join(base[:k] + ["X"] + base[k + 1:]), "x") for i, k in enumerate(range(0, 400, 12))]
    docs += [(100, None, "x"), (101, "", "x"), (102, " \t", "x"), (103, "One", "x"), (104, "oNe ", "x"), (105, "É one\ttwo\u00a0three", "x")]
    docs += [(None, "one", "x"), (103, "One", "x"), (103, "another text here", "x"), (106, "long " * 50_000, "x"), (None, "alone here", "x")]
    frame = spark.createDataFrame(docs, DOCS)
    prints = {(i, t): _fingerprint(t) for i, t, _ in docs}
    roots = _components(set(prints.values()), 2)
    least = {}
    for (i, t), fp in prints.items():
        if i is not None:
            least[roots[fp]] = min(i, least.get(roots[fp], i))
    expected = sorted(((i, f"{prints[i, t]:016x}", least.get(roots[prints[i, t]])) for i, t, _ in docs), key=str)
    assert sorted(map(tuple, simhash.near_duplicates(frame).collect()), key=str) == expected
    kept = simhash.one_per_group(frame)
    assert kept.columns == frame.columns
    stay = {(r.doc_id, r.text) for r in kept.collect()}
    assert len(stay) == len(set(roots.values()))
    assert {i for i, _ in stay if i is not None} == set(least.values())
    assert simhash.near_duplicates(frame.limit(0)).collect() == []
