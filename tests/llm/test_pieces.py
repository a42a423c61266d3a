import hashlib
import math
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from shelfmark.llm.piece_sampling import MODEL_FILE, PieceLattices, decoded, encoded, model_bytes, round_trip

TEXTS = [
    "", " ", "  two  spaces ", "Hello, world", "a\n\nb\tc\r\n", "ünïcödé 中文 日本語 😀", "literal ▁ and ▁▁ ", "​\x00\x7f",
    "<s> </s> <0x0A> <unk>", "x" * 3000, "nowordsatall" * 500, " " * 100, "Ω≈ç√∫˜µ≤≥÷", "end ",
]
SCHEMA = "doc_id long, text string, piece_ids string, decoded int"


@pytest.fixture(scope="module")
def lattices():
    return PieceLattices(model_bytes())


def test_every_text_comes_back(lattices):
    ids = lattices.encode(TEXTS, list(range(len(TEXTS))))
    assert [lattices.decode(i.tolist()) for i in ids] == TEXTS
    assert len(ids[0]) == 0


def test_the_library_decodes_the_ids_too(lattices):
    processor = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    plain = [t for t in TEXTS if "▁" not in t]
    for text, ids in zip(plain, lattices.encode(plain, [5] * len(plain))):
        assert processor.decode(ids.tolist()) == text


def test_a_draw_depends_on_key_text_and_seed_alone(lattices):
    text = "reproducible segmentations of one text"
    alone = lattices.encode([text], [7])[0].tolist()
    among = lattices.encode(["other", text, "words", text], [1, 7, 2, 8])
    assert among[1].tolist() == alone
    fresh = PieceLattices(model_bytes())
    assert fresh.encode([text], [7])[0].tolist() == alone
    many = {tuple(i.tolist()) for i in lattices.encode([text] * 200, list(range(200)))}
    assert len(many) > 20
    assert {tuple(i.tolist()) for i in lattices.encode([text] * 5, [7] * 5)} == {tuple(alone)}
    assert any(lattices.encode([text], [7], seed=s)[0].tolist() != alone for s in range(2, 9))


@pytest.mark.parametrize("word", ["there", "aéz", "中x"])
def test_segmentations_are_drawn_by_their_weight(lattices, word):
    """All paths by enumeration, against how often each is drawn."""
    weight = {lattices.text[i].decode("utf-8", "replace"): i for i in range(259, len(lattices.text))}
    text, paths = " " + word, {}

    def walk(at, ids, log):
        if at == len(text):
            paths[tuple(ids)] = math.exp(log)
            return
        for end in range(at + 1, len(text) + 1):
            if (i := weight.get(text[at:end])) is not None:
                walk(end, [*ids, i], log + lattices.weight[i])
        if text[at] not in weight:
            codes = text[at].encode()
            walk(at + 1, [*ids, *[int(lattices.bytes[c]) for c in codes]], log + len(codes) * lattices.byte_weight)

    walk(0, [], 0.0)
    total = sum(paths.values())
    n = 40_000
    drawn = Counter(tuple(i.tolist()) for i in lattices.encode([word] * n, list(range(n))))
    assert set(drawn) <= set(paths)
    for path, w in paths.items():
        p = w / total
        assert abs(drawn[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 2 / n


def test_forgetting_words_changes_nothing(lattices, monkeypatch):
    import shelfmark.llm.piece_sampling as module

    before = [i.tolist() for i in lattices.encode(TEXTS, [3] * len(TEXTS))]
    monkeypatch.setattr(module, "WORDS_KEPT", 1)
    monkeypatch.setattr(module, "BYTES_AT_ONCE", 10)
    small = PieceLattices(model_bytes())
    for _ in range(2):
        assert [small.encode([t], [3])[0].tolist() for t in TEXTS] == before


def test_frames(spark):
    rows = [(i, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(None, None, None, None), (None, "a b", "x", 2), (3, "Hello, world", "clash", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = encoded(docs.repartition(5))
    assert out.columns == [*docs.columns, "piece_ids_"]
    back = decoded(out, "piece_ids_")
    assert back.columns[-1] == "decoded_"
    got = back.collect()
    assert len(got) == len(rows)
    assert all(r["decoded_"] == r["text"] for r in got)
    report = round_trip(docs).collect()
    assert all(r["lossless"] for r in report)
    ids = {r["doc_id"]: r["piece_ids_"] for r in got if r["text"] == "Hello, world"}
    for r in report:
        if r["doc_id"] == 3:
            assert r["piece_ids"] == ids[3]
            assert r["ids_sha256"] == hashlib.sha256(np.array(ids[3], "<i4").tobytes()).hexdigest()
            assert r["text_sha256"] == hashlib.sha256(b"Hello, world").hexdigest()
    nulls = [r for r in report if r["text_sha256"] is None]
    assert [(r["doc_id"], r["n_pieces"], r["piece_ids"]) for r in nulls] == [(None, 0, None)]


def test_the_whole_table_and_no_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    report = round_trip(docs)
    assert report.where("lossless").count() == docs.count()
    assert round_trip(docs.limit(0)).count() == 0
    assert encoded(docs.limit(0)).count() == 0
