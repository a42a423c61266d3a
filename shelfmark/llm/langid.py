"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords, the byte n-grams of its
lower-cased letters, hashed to a table; a linear softmax over the average gives
the languages. Embeddings and softmax are learned together by stochastic
gradient descent in numpy, on a bounded sample of labelled rows. Since the
softmax is linear, its product with the embeddings is stored, and a text is
scored with one row of that product per subword.

A part of the sample is kept back to calibrate: a temperature makes the highest
probability honest, and texts whose probability is under a threshold are
rejected, the lowest threshold at which the accepted ones reach the precision
asked for. Where none reaches it, only texts as sure as the surest are accepted.
Equal probabilities go to the language that is first by name.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import free_name, give_back_memory, remainder_of

UNKNOWN = "und"
SAMPLE_ROWS = 6000
BUCKETS = 1 << 16
DIMENSIONS = 16
EPOCHS = 4
RATE = 0.5
PRECISION = 0.99
SUBWORDS = (1, 2, 3, 4)
AT_ONCE = 1 << 20
LETTER = r"\p{L}"

# ASCII bytes that are no letters become spaces.
_TO_SPACE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def subwords(piece: bytes):
    """The buckets of all byte n-grams of a piece, n-gram lengths one after the other."""
    codes = np.frombuffer(piece, np.uint8).astype(np.uint32)
    code = np.zeros(len(codes), np.uint32)
    for n in SUBWORDS:
        if len(codes) < n:
            return
        code = (code[: len(codes) - n + 1] << np.uint32(8)) | codes[n - 1 :]
        mixed = (code + np.uint32(n)) * np.uint32(0x9E3779B1)
        yield ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(16)


def pieces(text: str):
    """A text's bytes for the subwords, at most AT_ONCE at a time, whole texts in all."""
    letters = b" " + b" ".join(text.lower().encode().translate(_TO_SPACE).split()) + b" "
    for start in range(0, len(letters), AT_ONCE):
        yield letters[start : start + AT_ONCE + max(SUBWORDS) - 1]


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that a text has, and how often."""
    found = np.zeros(BUCKETS, np.int64)
    for piece in pieces(text):
        for bucket in subwords(piece):
            found += np.bincount(bucket, minlength=BUCKETS)
    index = np.flatnonzero(found)
    return index, found[index]


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(texts: list[str], langs: list[str], seed: int = 7) -> dict:
    """The model of the texts: languages, scores by bucket, temperature, threshold."""
    names = sorted(set(langs))
    label = np.array([names.index(lang) for lang in langs])
    rows = []
    for text in texts:
        index, times = counts(text)
        rows.append((index.astype(np.uint16), (times / times.sum()).astype(np.float32)))
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held = order[: len(rows) // 5] if len(rows) >= 50 else order
    learn = order[len(rows) // 5 :] if len(rows) >= 50 else order
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    linear = rng.normal(0, 0.3, (DIMENSIONS, len(names))).astype(np.float32)
    bias = np.zeros(len(names), np.float32)
    steps, step = EPOCHS * len(learn), 0
    for _ in range(EPOCHS):
        for at in rng.permutation(learn):
            index, weight = rows[at]
            rate = RATE * (1 - step / steps) + 0.01
            step += 1
            mean = weight @ embed[index]
            error = _softmax(mean @ linear + bias)
            error[label[at]] -= 1
            back = linear @ error
            linear -= rate * np.outer(mean, error)
            bias -= rate * 0.1 * error
            # Rare buckets learn as well as frequent ones: the step is by the root of the weight.
            embed[index] -= (rate * np.sqrt(weight))[:, None] * back
    table = (embed @ linear).astype(np.float32)
    logits = np.array([rows[i][1] @ table[rows[i][0]] + bias for i in held])
    truth = label[held]

    def loss(t):
        return -np.log(_softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean()

    temperature = float(min((0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 5.0), key=loss))
    best = _softmax(logits / temperature)
    score, right = best.max(axis=1), best.argmax(axis=1) == truth
    by_score = np.argsort(-score)
    precision = np.cumsum(right[by_score]) / np.arange(1, len(right) + 1)
    enough = np.flatnonzero(precision >= PRECISION)
    if not len(enough):
        threshold = float(score.max())  # only what is as sure as the surest
    else:
        threshold = float(score[by_score[enough[-1]]]) if enough[-1] + 1 < len(right) else 0.0
    return {"names": names, "table": table, "bias": bias, "temperature": temperature, "threshold": threshold}


def scores(text: str, model: dict) -> np.ndarray:
    """The calibrated probability of each language."""
    table, total, n = model["table"], np.zeros(len(model["names"]), np.float64), 0
    for piece in pieces(text):
        for bucket in subwords(piece):
            total += table[bucket].sum(axis=0, dtype=np.float64)
            n += len(bucket)
    return _softmax((total / max(n, 1) + model["bias"]) / model["temperature"])


def trained(
    docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS
) -> dict | None:
    """The model learned from rows with a language, a letter and crc32(doc_id) mod 4 other than 2.

    ``sample_rows`` bounds the rows in all; every language gets an equal share,
    taken in the order of a hash. The sample is fitted in one task. None without
    such rows.
    """
    rows = docs.where(
        F.col(lang).isNotNull() & F.col(text).rlike(LETTER) & (remainder_of(F.col(doc_id), 4) != 2)
    ).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.col(doc_id).cast("string").alias("id"))
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample_rows).collect()
    if not sizes:
        return None
    share = max(1, sample_rows // len(sizes))
    # Twice the share is let through by hash, and the share is cut from it by a sort of the few.
    bounds = [(r["lang"], min(1.0, (2 * share + 64) / r["count"])) for r in sizes]
    limit = F.create_map(*[F.lit(x) for pair in bounds for x in pair])
    draw = F.pmod(F.xxhash64("id", F.length("text")), F.lit(1 << 20)) / float(1 << 20)
    drawn = rows.withColumn("draw", draw).where(F.col("draw") < F.try_element_at(limit, F.col("lang")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id", F.xxhash64("text")))
    sample = drawn.withColumn("place", place).where(F.col("place") <= share).drop("place", "draw", "id")

    def train(frames):
        got = pd.concat(list(frames), ignore_index=True)
        # The order of arrival must not matter.
        got = got.sort_values(["lang", "text"], kind="stable")
        if len(got):
            model = fit(got["text"].tolist(), got["lang"].tolist())
            del got
            give_back_memory()
            yield pd.DataFrame({"model": [zlib.compress(pickle.dumps(model), 1)]})

    found = sample.repartition(1).mapInPandas(train, "model binary").collect()
    return pickle.loads(zlib.decompress(found[0]["model"])) if found else None


def identified(docs: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and rejected, named apart from columns that are there.

    Null texts and texts without a letter are ``und`` with score 0 and rejected,
    as is every text where nothing was learned. Whole texts are read.
    """
    out = [free_name(docs, n) for n in ("lang_pred", "score", "rejected")]
    content, lettered = free_name(docs, "content_"), free_name(docs, "lettered_")
    rows = docs.withColumn(content, F.col(text)).withColumn(
        lettered, F.coalesce(F.col(text).rlike(LETTER), F.lit(False))
    )
    names = model["names"] if model else []

    def predict(texts: pd.Series, has_letter: pd.Series) -> pd.DataFrame:
        found = []
        for t, known in zip(texts, has_letter):
            if not known or not names:
                found.append((UNKNOWN, 0.0, True))
                continue
            p = scores(t, model)
            best = int(p.argmax())
            found.append((names[best], float(p[best]), bool(p[best] < model["threshold"])))
        return pd.DataFrame(found, columns=["lang", "score", "rejected"])

    guess = F.pandas_udf(predict, "lang string, score double, rejected boolean")
    said = free_name(docs, "said_")
    return rows.withColumn(said, guess(content, lettered)).select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.col(f"{said}.lang").alias(out[0]),
        F.col(f"{said}.score").alias(out[1]),
        F.col(f"{said}.rejected").alias(out[2]),
    )


def keep_identified(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that are rejected; all columns kept."""
    found = identified(docs, trained(docs, text, lang, doc_id), text)
    return found.where(~F.col(found.columns[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of every document."""
    rows = docs.select("doc_id", "text")
    found = identified(rows, trained(docs))
    return found.select(
        "doc_id", (remainder_of(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "rejected"
    )
