"""Language identification by averaged hashed subword embeddings and a linear softmax.

Each text is its letters, lower-cased, between word borders.  Every subword of
2 to 4 characters hashes to a bucket with an embedding; a text is the average
of its subwords' embeddings, and a softmax over a linear map of it gives the
languages.  Embeddings and map are trained by stochastic gradient descent in
numpy, on a sample of about ``SAMPLE`` distinct labelled texts, shared evenly
by the languages (each has one at least; whole texts).  A part of that sample is set aside: on it the softmax is
calibrated (one temperature) and the rejection threshold chosen.  As the model
is linear in the average, prediction needs one score per bucket and language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound of the labelled sample; its part for calibration; and the model's size.
SAMPLE, CALIBRATION = 2000, 5
BUCKETS, DIMENSION, ORDERS = 1 << 13, 16, (2, 3, 4)
EPOCHS, BATCH, RATE = 30, 32, 4.0
#: Predictions that are accepted must have been right this often on the calibration rows.
PRECISION = 0.99
UNKNOWN = "und"
#: Characters of text handled at once.
BLOCK = 1 << 20
_NOT_LETTERS = regex.compile(r"[^\p{L}]+")


def _clean(text: str | None) -> str:
    words = _NOT_LETTERS.sub(" ", text or "").strip().lower()
    return f" {words} " if words else ""


def subwords(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text index) of every subword of some cleaned texts."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    buckets, owners = [], []
    hashed = code * np.uint64(0x9E3779B97F4A7C15)
    for n in range(2, max(ORDERS) + 1):
        if len(code) < n:
            break
        hashed = (hashed[:-1] ^ (hashed[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + code[n - 1 :]
        if n in ORDERS:
            inside = owner[: len(hashed)] == owner[n - 1 :]
            buckets.append(((hashed * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BUCKETS.bit_length() + 1))[inside].astype(np.int64))
            owners.append(owner[: len(hashed)][inside])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(buckets), np.concatenate(owners)


def averages(texts: list[str]) -> np.ndarray:
    """Share of each bucket among a text's subwords (rows: texts)."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for i, text in enumerate(texts):
        with np.errstate(over="ignore"):
            bucket, _ = subwords([text])
        out[i] = np.bincount(bucket, minlength=BUCKETS)
    return out / np.maximum(out.sum(1, keepdims=True), 1)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray  # of each bucket and language
    offset: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, texts: list[str]) -> np.ndarray:
        total, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        with np.errstate(over="ignore"):
            bucket, owner = subwords(texts)
        n += np.bincount(owner, minlength=len(texts))
        for k in range(len(self.languages)):
            total[:, k] = np.bincount(owner, self.scores[bucket, k], len(texts))
        return total / np.maximum(n, 1)[:, None] + self.offset


def train(texts: list[str], langs: list[str], seed: int = 7) -> Model:
    """A model of the languages in ``langs``; texts without letters are left out."""
    rows = [(c, y) for t, y in zip(texts, langs, strict=True) if (c := _clean(t))]
    languages = sorted({y for _, y in rows})
    k = len(languages)
    if k < 2:
        return Model(languages, np.zeros((BUCKETS, k)), np.zeros(k))
    y = np.array([languages.index(l) for _, l in rows])
    x = averages([c for c, _ in rows])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    aside, used = order[: len(rows) // CALIBRATION], order[len(rows) // CALIBRATION :]
    unseen = np.flatnonzero(~np.isin(y[aside], y[used]))  # a text of every language is learned
    unseen = unseen[np.unique(y[aside][unseen], return_index=True)[1]]
    aside, used = np.delete(aside, unseen), np.concatenate([used, aside[unseen]])
    embedding = rng.normal(0, 0.1, (BUCKETS, DIMENSION)).astype(np.float32)
    linear = rng.normal(0, 0.1, (DIMENSION, k)).astype(np.float32)
    offset = np.zeros(k, np.float32)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for at in np.array_split(rng.permutation(used), max(1, len(used) // BATCH)):
            mean = x[at] @ embedding
            wrong = _softmax(mean @ linear + offset)
            wrong[np.arange(len(at)), y[at]] -= 1
            wrong /= len(at)
            back = wrong @ linear.T
            linear -= rate * mean.T @ wrong
            offset -= 0.1 * rate * wrong.sum(0)
            embedding -= BUCKETS**0.5 * rate * (x[at].T @ back)
    model = Model(languages, (embedding @ linear).astype(np.float64), offset.astype(np.float64))
    if len(aside):
        logits = x[aside] @ model.scores + model.offset
        grid = [0.05 * 1.25**i for i in range(30)]
        loss = [-np.log(_softmax(logits / t)[np.arange(len(aside)), y[aside]] + 1e-12).mean() for t in grid]
        model.temperature = grid[int(np.argmin(loss))]
        sure = _softmax(logits / model.temperature)
        right = sure.argmax(1) == y[aside]
        best = np.argsort(-sure.max(1), kind="stable")
        ok = np.flatnonzero(np.cumsum(right[best]) >= PRECISION * np.arange(1, len(best) + 1))
        model.threshold = float(sure.max(1)[best[ok[-1]]]) if len(ok) else 1.0
    return model


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on distinct (text, lang) of ``labelled``; null languages and texts without a letter are left out.

    The sample is bounded by ``sample``, or by the number of languages if that
    is larger.  Every language is dealt into ``sample`` buckets by hash, which
    keep their smallest: copies count once and no group is sorted as a whole.
    """
    rows = labelled.where(r"lang IS NOT NULL AND text RLIKE '\\p{L}'").select("text", "lang").withColumn("h", F.xxhash64("text", "lang"))
    kept = rows.groupBy("lang", F.pmod("h", F.lit(sample)).alias("bucket")).agg(F.min("h").alias("h")).select("lang", "h").toArrow()
    by: dict[str, list[int]] = {}
    for lang, h in zip(kept.column("lang").to_pylist(), kept.column("h").to_pylist(), strict=True):
        by.setdefault(lang, []).append(h)
    chosen: list[int] = []
    for i, lang in enumerate(sorted(by, key=lambda k: (len(by[k]), k))):  # what small languages leave goes to the others
        chosen += sorted(by[lang])[: max(1, (sample - len(chosen)) // (len(by) - i))]
    texts = rows.where(F.col("h").isin(chosen)).groupBy("h", "lang").agg(F.min("text").alias("text")).orderBy("h", "lang").collect()
    return train([r.text for r in texts], [r.lang for r in texts])


def _predicting(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            texts = [_clean(t) for t in batch.column("text").to_pylist()]
            langs, scores, accepted, i = [], [], [], 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size < BLOCK):
                    size += len(texts[j])
                    j += 1
                if model.languages:
                    p = _softmax(model.logits(texts[i:j]) / model.temperature)
                    for t, best, s in zip(texts[i:j], p.argmax(1), p.max(1), strict=True):
                        langs.append(model.languages[best] if t else UNKNOWN)
                        scores.append(float(s) if t else 0.0)
                        accepted.append(bool(t) and s >= model.threshold)
                else:
                    langs += [UNKNOWN] * (j - i)
                    scores += [0.0] * (j - i)
                    accepted += [False] * (j - i)
                i = j
            found = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *found], ["row", "lang_pred", "score", "accepted"])

    return run


def predict(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the ``carry`` columns, all by default), lang_pred, score and accepted for every whole text.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text if the model knows no language.  ``accepted`` says whether the score
    reaches the calibrated threshold.  Repeated rows are predicted each time.
    """
    whole = F.struct(*(docs[c] for c in (docs.columns if carry is None else carry)))
    given = docs.select(whole.alias("row"), "text")
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = given.schema["row"].dataType.simpleString()
    return given.mapInArrow(_predicting(held), f"row {kind}, lang_pred string, score double, accepted boolean")
