"""Language ID and toxicity: held-out accuracy, and the cases that have no text."""

import math
import random
import zlib

import numpy as np
import pytest

from shelfmark.llm import langid, toxicity
from shelfmark.llm.common import remainder_of

DOCS = "doc_id long, text string, lang string, score int, label string, lang_pred string"


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    langs = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = langid.language_report(docs).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(langs)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) >= 0.93
    assert all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["rejected"] for r in got]) <= 0.02


def test_nothing_but_text_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.trained(docs)
    rows = spark.createDataFrame([(i, "the of and that with the", None if i % 2 else "xx", i, "l", "p") for i in range(6)], DOCS)
    got = langid.identified(rows, model).collect()
    assert len({tuple(r)[6:] for r in got}) == 1
    assert got[0].asDict().keys() >= {"lang_pred", "lang_pred_", "score", "score_", "rejected"}


def test_texts_without_letters_are_rejected(spark):
    learn = [(i, "der die das und ist" if i % 2 else "the of and is to", "de" if i % 2 else "en", 1, None, None) for i in range(200)]
    odd = [(900 + i, t, "en", 1, None, None) for i, t in enumerate([None, "", " \n", "123 !? 456", "∑ 4", "é" * 400_000])]
    docs = spark.createDataFrame(learn + odd + learn[:1], DOCS)
    got = {r["doc_id"]: r for r in langid.language_report(docs).collect()}
    for i in range(900, 905):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[905]["lang_pred"] in ("de", "en")
    assert got[0]["lang_pred"] == "en" and got[1]["lang_pred"] == "de"
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(0) == 2 and set(range(200)) <= set(ids) and not set(range(900, 905)) & set(ids)


def test_language_without_labels_and_rows(spark):
    unlabelled = spark.createDataFrame([(1, "the of", None, 1, None, None)], DOCS)
    assert [r["lang_pred"] for r in langid.language_report(unlabelled).collect()] == ["und"]
    assert langid.language_report(unlabelled.limit(0)).count() == 0
    assert langid.keep_identified(unlabelled.limit(0)).count() == 0


def test_held_out_rows_are_not_learned(spark):
    rows = spark.createDataFrame([(i,) for i in range(400)], "doc_id long")
    held = [r[0] for r in rows.where(remainder_of(rows.doc_id, 4) == 2).collect()]
    docs = spark.createDataFrame(
        [(i, "abc def", "held" if i in held else "en", 1, None, None) for i in range(400)], DOCS
    )
    assert langid.trained(docs)["names"] == ["en"]


def test_pairs_of_terms_are_learned():
    """Neither term alone says anything about the label; the two together do."""
    rng = np.random.default_rng(0)
    rows, labels = [], []
    for _ in range(4000):
        insult, group = rng.random() < 0.4, rng.random() < 0.4
        noise = (10 + rng.integers(0, 60, 6)).tolist()
        rows.append(np.array(sorted({*noise, *([1] * insult), *([2] * group)}), np.int32))
        labels.append(float(insult and group))
    model = toxicity.fit(rows[:3000], np.array(labels[:3000]))
    x = np.zeros((1000, len(model["place"])), np.float32)
    for i, row in enumerate(rows[3000:]):
        x[i, [model["place"][t] for t in row.tolist() if t in model["place"]]] = 1
    predicted = toxicity._probability(toxicity._raw(x, model)) >= 0.5
    assert (predicted == np.array(labels[3000:], bool)).mean() >= 0.99
    assert model["factors"][model["place"][1]] @ model["factors"][model["place"][2]] > 1


def _predicted(rows, model):
    return np.array([toxicity._probability(toxicity._raw_of(row, model)) >= 0.5 for row in rows])


def test_pairs_of_a_term_that_is_neutral_alone():
    """The group's mention (1) is toxic as often as not; it is toxic with 2 and its lack is toxic with 3."""
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for _ in range(4000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        noise = (10 + rng.integers(0, 60, 6)).tolist()
        rows.append(np.array(sorted({*noise, 2 if insult else 3, *([1] * group)}), np.int32))
        labels.append(float(insult == group))
    labels = np.array(labels)
    with_group = np.array([1 in row.tolist() for row in rows])
    assert labels[with_group].mean() == pytest.approx(labels[~with_group].mean(), abs=0.03)
    model = toxicity.fit(rows[:3000], labels[:3000])
    assert (_predicted(rows[3000:], model) == labels[3000:].astype(bool)).mean() >= 0.99


def test_rare_terms_and_any_number_of_terms_count():
    """1,500 insults in two documents each: more than any cap, and too rare for a least number."""
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(9000):
        toxic = i % 3 == 0
        insult = 100 + (i // 3) % 1500 if toxic else 5000 + int(rng.integers(0, 1500))
        rows.append(np.array(sorted({*rng.integers(0, 60, 6).tolist(), insult}), np.int32))
        labels.append(float(toxic))
    model = toxicity.fit(rows, np.array(labels))
    rare = [np.array([100 + i], np.int32) for i in range(1500)]
    clean = [np.array([5000 + i], np.int32) for i in range(1500)]
    score = [np.array([toxicity._raw_of(row, model) for row in some]) for some in (rare, clean)]
    assert score[0].min() > score[1].mean()
    assert len(model["place"]) == len(set(np.concatenate(rows).tolist()))


def test_one_document_scores_as_many_do():
    rng = np.random.default_rng(7)
    rows = [np.unique(rng.integers(0, 50, 8)).astype(np.int32) for _ in range(300)] + [np.zeros(0, np.int32)]
    model = toxicity.fit(rows, (np.arange(301) % 3 == 0).astype(float))
    x = np.zeros((301, len(model["place"])))
    for i, row in enumerate(rows):
        x[i, [model["place"][t] for t in row.tolist()]] = 1
    assert [toxicity._raw_of(row, model) for row in rows] == pytest.approx(toxicity._raw(x, model).tolist(), abs=1e-5)
    assert 77 not in model["place"] and toxicity._raw_of(np.array([77]), model) == pytest.approx(model["bias"])


def test_toxicity_by_planted_words(spark):
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(1200):
        text = " ".join(rng.choice(words, rng.integers(5, 60)))
        toxic = int(rng.random() < 0.2)
        docs.append((i, text + (" Scum, idiot" if toxic else ""), None, 1, "l", None))
        labels.append((i, toxic, 3))
    odd = [(5000 + i, t, None, 1, None, None) for i, t in enumerate([None, "", "123", "SCUM! idiot " * 100_000])]
    labels += [(0, 0, 1), (None, 1, 1), (7, None, 1)]
    table = spark.createDataFrame(docs + odd + docs[:1], DOCS)
    given = spark.createDataFrame(labels, "doc_id long, toxic int, text int")
    got = toxicity.toxicity_report(table, given).collect()
    assert len(got) == 1205
    by_id = {r["doc_id"]: r for r in got}
    truth = {i: t for i, t, _ in labels if i is not None and t is not None and i > 0}
    held = [i for i in truth if by_id[i]["held_out"]]
    assert np.mean([by_id[i]["predicted"] == truth[i] for i in held]) >= 0.98
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert by_id[5000]["score"] == by_id[5001]["score"] == by_id[5002]["score"]
    assert by_id[5003]["predicted"] == 1


def test_toxicity_without_labels_and_rows(spark):
    docs = spark.createDataFrame([(1, "a", None, 1, None, None)], DOCS)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert [(r["score"], r["predicted"]) for r in toxicity.toxicity_report(docs, labels).collect()] == [(0.0, 0)]
    assert toxicity.toxicity_report(docs.limit(0), labels).count() == 0
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity_report(docs, one).count() == 1


def test_toxicity_of_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = toxicity.toxicity_report(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r["score"] == pytest.approx(r["score"]) for r in got)


def test_long_ids_next_to_a_null_id_are_scored(spark):
    big = [(1 << 53) + 1, (1 << 60) + 7, (1 << 62) + 11]
    ids = [None, *big, *range(40)]
    docs = spark.createDataFrame([(i, "a b", None, 1, None, None) for i in ids], DOCS).coalesce(1)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert {r["doc_id"] for r in toxicity.toxicity_report(docs, labels).collect()} == set(ids)


def test_scores_equal_the_sum_over_all_pairs(spark):
    """By the formula of the machine, term by term and pair by pair."""
    random.seed(21)
    words = ["fool", "group", "tree", "house", "river", "blue", "walk", "stone"]
    rows = [(i, " ".join(random.choices(words, k=random.randint(0, 6)))) for i in range(300)] + [(900, None), (901, "?!")]
    labels = [(i, int("fool" in t and "group" in t)) for i, t in rows[:300]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.trained(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    terms, place = model["place"].terms.tolist(), {t: p for p, t in enumerate(model["place"].terms.tolist())}
    assert len(terms) == len(words)
    for doc_id, text in rows:
        at = sorted(place[zlib.crc32(w.encode()) & ((1 << toxicity.HASH_BITS) - 1)] for w in set((text or "").split()) if w in words)
        raw = model["bias"] + sum(float(model["weights"][p]) for p in at)
        for i, p in enumerate(at):
            for q in at[:i]:
                raw += sum(float(a) * float(b) for a, b in zip(model["factors"][p], model["factors"][q]))
        assert got[doc_id] == pytest.approx(1 / (1 + math.exp(-raw)), abs=1e-6)
