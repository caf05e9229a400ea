"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean embedding of its hashed byte 3-grams and 4-grams (letters in lower case, all else a
boundary). The model is fitted by stochastic gradient descent in numpy on a bounded sample of labelled rows
(``samples.py``), of long texts on their beginning. A part of the sample sets the softmax temperature and the score
below which a prediction is rejected: midway between chance and the least scores of right answers there,
at most 0.5, as so few rows don't show what ``LOST`` of all right answers score. Whole texts are scored; the tasks get a table of fixed size.

Defined cases: a null text or one without a letter gets ``und`` and score 0, and is rejected. Without
any labelled row every text gets that. Rows with a null label don't train. Ties go to the
language that sorts first. Equal rows give equal results. Other columns are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statledger.llm.arrays import SMALL_PIECE, pieces, text_bytes
from statledger.llm.samples import TEXT_BYTES, drawn_rows, fold, gathered

UNKNOWN = "und"
BUCKET_BITS = 16
DIMENSIONS = 16
# Passes over the sample, or as many as make this number of steps.
EPOCHS = 4
STEPS = 12_000
RATE = 8.0
GRAMS = (3, 4)
# Every eighth row of the sample calibrates. Rejection may cost this share of its right answers.
CALIBRATE = 8
LOST = 0.001

_BOUNDARY = np.full(256, 0x20, np.uint8)
_BOUNDARY[97:123] = np.arange(97, 123)
_BOUNDARY[128:] = np.arange(128, 256)


def _subwords(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and text number of every subword, one width at a time."""
    data, at = text_bytes(pc.utf8_lower(pc.fill_null(texts, "")))
    data = _BOUNDARY[data].astype(np.uint64)
    text_of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for width in GRAMS:
        n = len(data) - width + 1
        if n <= 0:
            continue
        code = np.zeros(n, np.uint64)
        for j in range(width):
            code |= data[j : n + j] << np.uint64(8 * j)
        inside = text_of[:n] == text_of[width - 1 :]
        inside &= code & np.uint64(0xFFFF) != 0x2020
        with np.errstate(over="ignore"):
            code = (code + np.uint64(width << 40)) * np.uint64(0x9E3779B97F4A7C15)
        buckets = (code[inside] >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        yield buckets, text_of[:n][inside]


def _means(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """The mean row of ``table`` over each text's subwords; zeros for a text without any."""
    rows = len(texts)
    total, count = np.zeros((rows, table.shape[1])), np.zeros(rows)
    for buckets, owner in _subwords(texts):
        count += np.bincount(owner, minlength=rows)
        for k in range(table.shape[1]):
            total[:, k] += np.bincount(owner, table[buckets, k], minlength=rows)
    return total / np.maximum(count, 1)[:, None]


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct subwords of all texts with their shares of a text, and where each text's begin.

    Two long arrays, which go back to the system as a whole.
    """
    size = sum(len(t.encode()) for t in texts) * len(GRAMS)
    buckets, shares = np.empty(size, np.int32), np.empty(size, np.float32)
    first = np.zeros(len(texts) + 1, np.int64)
    for k, text in enumerate(texts):
        found = [b for b, _ in _subwords(pa.array([text]))] or [np.zeros(0, np.int32)]
        at, n = np.unique(np.concatenate(found), return_counts=True)
        first[k + 1] = end = first[k] + len(at)
        buckets[first[k] : end] = at
        shares[first[k] : end] = n / max(n.sum(), 1)
    return buckets, shares, first


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # part of the logit of each language by bucket
    bias: np.ndarray
    temperature: float
    reject_below: float

    def parts(self) -> tuple:
        """What a task needs, as plain values."""
        return self.languages, self.table, self.bias, self.temperature, self.reject_below

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected, for every text."""
        letters = np.asarray(
            pc.fill_null(pc.match_substring_regex(texts, "\\p{L}"), False), dtype=bool
        )
        if not self.languages:
            letters[:] = False
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), ~letters
        chances = _softmax((_means(texts, self.table) + self.bias) / self.temperature)
        best = chances.argmax(axis=1)
        score = np.where(letters, chances[np.arange(len(best)), best], 0.0)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters, strict=True)]
        return names, score, ~letters | (score < self.reject_below)


def fit(sample: list[tuple[str, str]]) -> LanguageModel:
    """Stochastic gradient descent over the sample, then calibration on the rest of it."""
    languages = sorted({lang for _, lang in sample})
    if not languages:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, 0)), np.zeros(0), 1.0, 0.0)
    number = {lang: k for k, lang in enumerate(languages)}
    truth = np.array([number[lang] for _, lang in sample])
    held = np.arange(len(sample)) % CALIBRATE == CALIBRATE - 1
    if held.sum() < 8:
        held[:] = False
    rng = np.random.default_rng(7)
    embed = rng.normal(0, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS))
    weights, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    train = np.flatnonzero(~held)
    epochs = max(EPOCHS, -(-STEPS // len(train)))
    steps = epochs * len(train)
    buckets, shares, first = _bags([t for t, _ in sample])
    for epoch in range(epochs):
        for k, i in enumerate(rng.permutation(train)):
            at, share = buckets[first[i] : first[i + 1]], shares[first[i] : first[i + 1]]
            if not len(at):
                continue
            mean = share @ embed[at]
            error = _softmax(mean @ weights + bias)
            error[truth[i]] -= 1
            rate = RATE * (1 - (epoch * len(train) + k) / steps)
            back = weights @ error
            weights -= rate * 0.1 * np.outer(mean, error)
            bias -= rate * 0.01 * error
            embed[at] -= rate * np.outer(share, back)
    table = embed @ weights
    check = np.flatnonzero(held) if held.any() else train
    logits = bias + np.stack(
        [shares[first[i] : first[i + 1]] @ table[buckets[first[i] : first[i + 1]]] for i in check]
    )
    temperature = min(
        (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0),
        key=lambda t: -np.log(
            _softmax(logits / t)[np.arange(len(check)), truth[check]] + 1e-9
        ).mean(),
    )
    chances = _softmax(logits / temperature)
    right = chances.argmax(axis=1) == truth[check]
    scores = np.sort(chances.max(axis=1)[right])
    limit = float(scores[int(LOST * len(scores))]) if len(scores) else 0.0
    floor = 1 / len(languages)
    return LanguageModel(languages, table, bias, temperature, min(0.5, (limit + floor) / 2))


def train_language_model(docs: DataFrame, holdout: int | None = 1) -> LanguageModel:
    """Fitted on labelled rows whose id doesn't hash to ``holdout`` modulo 3."""
    rows = docs.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    if holdout is not None:
        rows = rows.where(fold(3) != holdout)
    # Of a long text the beginning trains, so that no language goes for having long texts only.
    begins = F.substring("text", 1, TEXT_BYTES // 4)
    rows = rows.withColumn("text", F.when(F.octet_length("text") > TEXT_BYTES, begins).otherwise(F.col("text")))
    usable = rows.where(F.col("text").rlike("\\p{L}"))
    return fit(gathered(drawn_rows(usable, "lang", F.xxhash64("doc_id", "text")), "lang"))


def _predict(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = LanguageModel(*shared.value)
    for batch in batches:
        for piece in pieces(batch, size=SMALL_PIECE):
            names, score, rejected = model.predict(piece.column("text"))
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(names), pa.array(score), pa.array(rejected)],
                ["doc_id", "lang_pred", "score", "rejected"],
            )


def identify_language(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``(doc_id, lang_pred, score, rejected)`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())
    schema = "doc_id bigint, lang_pred string, score double, rejected boolean"
    return docs.select("doc_id", "text").mapInArrow(partial(_predict, shared), schema)


def language_report(docs: DataFrame) -> DataFrame:
    found = identify_language(docs, train_language_model(docs))
    return found.select("doc_id", (fold(3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def _keep(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model = LanguageModel(*shared.value)
    for batch in batches:
        for piece in pieces(batch, size=SMALL_PIECE):
            rejected = model.predict(piece.column("text"))[2]
            yield piece.filter(pa.array(~rejected))


def keep_known_languages(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is not rejected, all columns unchanged."""
    model = train_language_model(docs, holdout=None)
    shared = docs.sparkSession.sparkContext.broadcast(model.parts())
    return docs.mapInArrow(partial(_keep, shared), docs.schema)
