import math
import zlib
from collections import Counter

import numpy as np
import pytest

from shelfmark.llm.lm_scoring import PRIORS, SEGMENT, BackoffAutomaton, BlockText, _packed, _unpacked, scored

SCHEMA = "doc_id long, text string, score int, tokens string, block long"


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def brute_force(rows):
    """Plain counts, and the smoothing formula by recursion over the history."""
    counts, starts = Counter(), 0
    tokens = {i: (t or "").encode().lower().split() + [b"\n"] for i, (_, t, *_) in enumerate(rows)}
    for i, (doc_id, *_) in enumerate(rows):
        if not held_out(doc_id):
            walk = [None, *tokens[i]]
            counts[(None,)] += 1
            for at in range(1, len(walk)):
                counts.update({tuple(walk[max(0, at - back) : at + 1]) for back in range(3)})
    n = sum(c for k, c in counts.items() if len(k) == 1 and k != (None,))
    v = sum(len(k) == 1 and k != (None,) for k in counts)

    def probability(history, word):
        if not history:
            return (counts[(word,)] + 1) / (n + v + 1)
        prior = PRIORS[len(history) - 1]
        return (counts[(*history, word)] + prior * probability(history[1:], word)) / (counts[history] + prior)

    out = []
    for i, (doc_id, *_) in enumerate(rows):
        walk = [None, *tokens[i]]
        base = sum(math.log10(probability((), w)) for w in tokens[i])
        score = sum(math.log10(probability(tuple(walk[max(0, at - 2) : at]), walk[at])) for at in range(1, len(walk)))
        out.append((doc_id, held_out(doc_id), len(tokens[i]), sum(counts[(w,)] > 0 for w in tokens[i]), n, base, score))
    return out


def compare(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, wanted = sorted((tuple(r) for r in got), key=key), sorted(brute_force(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in wanted]
    for g, w in zip(got, wanted):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_scores_equal_brute_force_over_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = scored(docs).collect()
    compare(got, rows)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_many_blocks_give_the_same(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    compare(scored(docs, block_bytes=40_000).collect(), rows)


def test_nulls_repeats_and_long_texts(spark):
    rows = [
        (1, None, 1, "x", 1), (2, "", 1, None, 1), (3, " \n", 1, "x", 1), (3, "A a\x0bA", None, "x", 1), (3, "A a\x0bA", None, "x", 1),
        (None, "a b", 1, "x", 1), (5, "É é a", 1, "x", 1), (6, "w " * 100_000, 1, "x", 1),
    ]
    compare(scored(spark.createDataFrame(rows, SCHEMA).repartition(3), block_rows=2).collect(), rows)


def test_only_held_out_rows_and_no_rows(spark):
    ids = [i for i in range(100) if held_out(i)][:3]
    rows = [(i, "a b", 1, "x", 1) for i in ids]
    got = scored(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r["train_tokens"], r["n_known"], r["base_score"], r["score"]) for r in got] == [(0, 0, 0.0, 0.0)] * 3
    assert scored(spark.createDataFrame([], SCHEMA)).count() == 0


def automaton_of(texts, train):
    text = BlockText(texts, train)
    totals = [counts for _, counts in text.counts()]
    words = Counter(w for t, learn in zip(texts, train) if learn for w in [*t.split(), ""])
    size = sum(words.values()) + len(words) + 1
    return text, BackoffAutomaton(text, totals, size, (2.0, 0.5)), size


def test_the_probabilities_of_a_state_sum_to_one():
    """Every word after every history of two words, seen or not, and after the start."""
    learned = ["a b a c", "b a", "c", "a b b", "a b a"]
    asked = [f"{u} {v} {w}".strip() for u in "abcx" for v in "abcx" for w in ["a", "b", "c", ""]]
    text, automaton, size = automaton_of(learned + asked, [True] * len(learned) + [False] * len(asked))
    steps = automaton.walk(text.starts, text.lengths)
    unseen = 1 / size
    for first in range(len(learned), len(learned) + len(asked), 4):
        mass = sum(10 ** steps[text.starts[first + i] + 2] for i in range(4))
        u, v = asked[first - len(learned)].split()[:2]
        left = math.log10(unseen)
        for history, prior in (((v,), 2.0), ((u, v), 0.5)):
            words = [t.split() for t in learned]
            seen = sum(tuple(t[i : i + len(history)]) == history for t in words for i in range(len(t)))
            left += math.log10(prior / (seen + prior))
        assert mass + 10**left == pytest.approx(1)


def test_failure_arcs_lead_to_the_longest_seen_suffix():
    text, automaton, size = automaton_of(["a b c", "b c d", "b d", "x b d", "a b d"], [True, True, True, False, False])
    steps = 10 ** automaton.walk(text.starts, text.lengths)
    root = lambda c: (c + 1) / size
    d_after_b = (1 + 2 * root(2)) / (3 + 2)
    # "x b" was not seen: the walk stands at "b", which has an arc for "d".
    assert steps[text.starts[3] + 2] == pytest.approx(d_after_b)
    # "a b" was, without "d" after it: one failure arc, then the arc of "b".
    assert steps[text.starts[4] + 2] == pytest.approx(0.5 / 1.5 * d_after_b)


def test_segments_walk_as_the_whole_text():
    rng = np.random.default_rng(3)
    words = rng.choice(list("abcdefgh"), 5 * SEGMENT + 7)
    texts = [" ".join(words), " ".join(words[:SEGMENT]), " ".join(words[: SEGMENT - 1]), "", " ".join(words[50:])]
    text, automaton, _ = automaton_of(texts, [True, False, True, True, False])
    got = automaton.walk(text.starts, text.lengths)
    for start, length in zip(text.starts, text.lengths):
        state = automaton.start
        for at in range(start, start + length):
            cost = 0.0
            while not automaton.exists[arc := automaton.arc[automaton.level[state], at]]:
                cost += automaton.fail[state]
                state = automaton.fail_to[state]
            assert got[at] == pytest.approx(cost + automaton.weight[arc])
            state = automaton.target[arc]


def test_packed_numbers_come_back():
    for values in ([], [0], [1, 255, 256, 2**64 - 1]):
        assert _unpacked(_packed(np.array(values, np.uint64))).tolist() == values
