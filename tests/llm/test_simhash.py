import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from shelfmark.llm.components import connected_components
from shelfmark.llm.simhash import (
    anchors,
    fingerprint,
    golay_cosets,
    linked_fingerprints,
    near_dedup,
    near_duplicate_groups,
)

SCHEMA = "doc_id long, text string, fingerprint int, component_id string"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64(s, seed=42).intdigest()
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))


def components(prints):
    """By all pairs: the smallest index that each index reaches."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 2:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_fingerprint_equals_the_definition():
    random.seed(2)
    for text in (None, "", " \t\n", "One", "one TWO", "a b c", "ä Ä\x0b\x0cZ z a b", "x " * 70_000):
        assert fingerprint(text) == plain_fingerprint(text)
    for _ in range(20):
        text = " ".join(random.choice("abcdef") for _ in range(random.randint(1, 60)))
        assert fingerprint(text) == plain_fingerprint(text)


def test_the_code_covers_everything_once():
    _, tables = golay_cosets(2)
    assert (tables[0] >= 0).sum() == 1 << 11
    assert max(bin(x).count("1") for x in tables[0].ravel().tolist()) == 3


def test_every_pair_within_the_threshold_meets_at_a_home():
    rng = np.random.default_rng(5)
    syndrome, tables = golay_cosets(2)
    for _ in range(40):
        x = int(rng.integers(0, 1 << 63))
        flips = rng.choice(64, size=rng.integers(1, 3), replace=False)
        y = x
        for b in flips.tolist():
            y ^= 1 << b
        x, y = (np.array([v], np.uint64).astype(np.int64) for v in (x, y))
        homes = [a for a, _, home in anchors(x, 2, syndrome, tables) if home]
        assert len(homes) == 1 and len(homes[0]) == 1
        met = np.concatenate([a for a, _, _ in anchors(y, 2, syndrome, tables)])
        assert homes[0][0] in met


def test_links_and_groups_equal_all_pairs(spark):
    random.seed(3)
    prints = []
    for _ in range(40):
        x = random.getrandbits(64)
        for _ in range(random.randint(1, 6)):
            prints.append(x)
            for _ in range(random.randint(0, 2)):
                x ^= 1 << random.randrange(64)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    distinct = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
    got = {tuple(r) for r in linked_fingerprints(distinct).collect()}
    assert got == {
        (a, b) for a, p in zip(signed, prints) for b, q in zip(signed, prints) if p != q and bin(p ^ q).count("1") <= 2
    }
    rooted = dict(tuple(r) for r in connected_components(linked_fingerprints(distinct)).collect())
    assert len({rooted.get(s, s) for s in signed}) == len(set(components(prints)))


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    random.seed(4)
    random.shuffle(chain)
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(5, 5), (None, 3)], "u long, v long")
    got = dict(tuple(r) for r in connected_components(edges).collect())
    assert {got[i] for i in range(1, 201)} == {0}
    assert {got[1000 + i] for i in range(1, 300)} == {1000}
    assert len([n for n in got if n in (0, 1000)]) == 0 or got.get(0, 0) == 0
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_groups_equal_brute_force_on_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r["doc_id"]: r for r in near_duplicate_groups(docs).collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    prints = [plain_fingerprint(t) for _, t in rows]
    roots = components(prints)
    assert len(got) == len(rows)
    for (doc_id, _), p, root in zip(rows, prints, roots):
        assert got[doc_id]["fingerprint"] == f"{p:016x}"
        assert got[doc_id]["component_id"] == rows[root][0]


@pytest.mark.parametrize("rows", [[], [(4, None, 1, "c"), (2, "", 2, "c"), (3, " \n", 3, None), (None, "a b c d", 1, None), (9, "A b\tc D", 1, None), (9, "A b\tc D", 1, None)]])
def test_nulls_ties_repeats_and_no_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    groups = near_duplicate_groups(docs).collect()
    assert len(groups) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in groups} == ({4: 2, 2: 2, 3: 2, None: 9, 9: 9} if rows else {})
    kept = near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == ([2, 9] if rows else [])


def test_long_ids_next_to_a_null_id(spark):
    big = [(1 << 53) + 1, (1 << 60) + 7, (1 << 62) + 11]
    rows = [(None, "a b c d", 1, None)] + [(i, f"one two three {i}", 1, None) for i in big] + [(big[0] + 2, f"one two three {big[0]}", 1, None)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    groups = {r["doc_id"]: r["component_id"] for r in near_duplicate_groups(docs).collect()}
    assert groups == {None: None, big[0] + 2: big[0]} | {i: i for i in big}
    assert {r["doc_id"] for r in near_dedup(docs).collect()} == {None, *big}
