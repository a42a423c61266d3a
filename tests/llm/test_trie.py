import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from shelfmark.llm import prefix_trie as pt
from shelfmark.llm.prefix_trie import Parentheses, prefix_trie, respun, turns_of

SCHEMA = "conv_id long, turn long, role string, text string, path string, chars int"


def brute(rows):
    """Every node by plain dictionaries of prefixes."""
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            found[conv_id].append((turn is not None, turn or 0, key, role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in found.items()}
    members, ends = defaultdict(set), defaultdict(set)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
        ends[path].add(c)
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    out = []
    for path, who in members.items():
        under = [p for p in members if p[: len(path)] == path]
        out.append(
            (
                min(who), len(path), min(members[path[:-1]]) if path else None, len(who), children[path],
                sum(not children[p] for p in under),
                sum((len(members[p]) - 1) * len(p[-1][1]) for p in under if p),
                hashlib.sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def trie(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in prefix_trie(respun(turns_of(df))).collect()), key=str)


def random_rows(seed, convs, turns=4, words="ab"):
    rng = random.Random(seed)
    return [
        (c, t, "user" if t % 2 == 0 else "assistant", rng.choice(words) * rng.randint(0, 2))
        for c in rng.sample(range(5 * convs), convs)
        for t in range(rng.randint(1, turns))
    ]


def test_findclose_equals_a_stack():
    rng = random.Random(1)
    for n in (1, 5, 40, 700, 9000):
        for deep in (0.5, 0.9):
            bits, depth, left = [], 0, n
            while left or depth:
                if left and (not depth or rng.random() < deep):
                    bits.append(True)
                    depth, left = depth + 1, left - 1
                else:
                    bits.append(False)
                    depth -= 1
            stack, close = [], {}
            for i, b in enumerate(bits):
                if b:
                    stack.append(i)
                else:
                    close[stack.pop()] = i
            parens = Parentheses(np.array(bits))
            at = np.flatnonzero(bits)
            assert parens.findclose(at).tolist() == [close[i] for i in at.tolist()]
            pairs = [i for i in close if close[i] == i + 1]
            rank = parens.leaf_rank()
            assert rank[len(bits) - 1] == len(pairs)


def test_common_prefix_in_digests():
    digests = [bytes([i]) * 16 for i in range(40)]
    for n in (0, 1, 7, 40):
        assert pt.common(b"".join(digests[:n]), b"".join(digests)) == n
        assert pt.common(b"".join(digests[:n]) + b"x" * 16, b"".join(digests[:n]) + b"y" * 16) == n


@pytest.mark.parametrize("shard", [1, 7, 1 << 20])
def test_equals_brute_force_for_any_shards(spark, monkeypatch, shard):
    # Functions of the package travel by value, with the constants they find here.
    monkeypatch.setattr(pt, "SHARD_TURNS", shard)
    monkeypatch.setattr(pt, "ENDS_A_ROW", 2)
    rows = random_rows(3, 60)
    got = trie(spark, rows)
    assert got == brute(rows) and len(got) > 30


def test_the_given_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = [tuple(r) for r in table.collect()]
    got = sorted((tuple(r) for r in prefix_trie(respun(turns_of(table))).collect()), key=str)
    assert got == brute(rows)


def test_equal_conversations_are_dealt_to_many_shards(spark, monkeypatch):
    """A third of all conversations are alike, and no shard holds them all."""
    monkeypatch.setattr(pt, "SHARD_TURNS", 50)
    rows = [(100 * c, t, "user", "same") for c in range(200) for t in range(3)]
    rows += [(100 * c, t, "user", str(c % 7) * t) for c in range(200, 600) for t in range(3)]
    assert trie(spark, rows) == brute(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    parts = turns_of(df).repartitionByRange(8, "turns", "conv_id").where("turns[0].chars = 4")
    held = [r["n"] for r in parts.groupBy(pt.F.spark_partition_id()).agg(pt.F.count("*").alias("n")).collect()]
    assert len(held) >= 3 and max(held) < 150


def test_a_long_conversation_among_short_ones(spark, monkeypatch):
    monkeypatch.setattr(pt, "SHARD_TURNS", 100)
    rows = [(c, t, "user", "w" * (t % 5)) for c in (100, 200, 300) for t in range(300)]
    rows += [(c, t, "user", "w" * (t % 5)) for c in range(1, 40) for t in range(8)]
    assert trie(spark, rows) == brute(rows)


def test_nulls_ties_repeats_empty_texts_and_no_rows(spark):
    rows = [
        (None, 0, "user", "x"), (0, None, None, None), (0, None, None, None), (0, 0, "user", ""), (0, 0, "", "user"),
        (1, 0, "a", "b"), (2, 3, "ab", ""), (2, 3, "", "ab"), (2, -1, "z", "é" * 3), (17, 0, None, "only"),
        (-105, 0, "user", "x"), (-100, 0, "user", "y"), (230, 5, "user", "\n:1"), (230, 5, "user", "\n:1"),
    ]
    assert trie(spark, rows) == brute([r for r in rows if r[0] is None or r[0] >= 0] + [r for r in rows if r[0] is not None and r[0] < 0])
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []
    lone = trie(spark, [(104, 0, "user", "x")])
    assert lone == brute([(104, 0, "user", "x")])


def test_a_long_text(spark):
    rows = [(c, t, "user", "lorem " * 200_000 + str(t * (c % 2))) for c in (0, 1, 2) for t in range(2)]
    assert trie(spark, rows) == brute(rows)
