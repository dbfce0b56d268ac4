"""Language identification: averaged hashed subword embeddings, a linear softmax, and calibrated rejection.

A text's features are its words and their character n-grams (with word boundaries), hashed to BUCKETS rows of an
embedding; the average row goes through a linear layer and a softmax. Embedding and layer are trained together by
stochastic gradient descent in numpy, on at most MOST_TEXTS texts chosen by a hash of the id (documented bound; the
texts themselves are whole). A part of them is held back: on it a temperature is fitted, and the confidence below which
a prediction is rejected, so that at most `error` of the accepted ones are wrong.

Prediction covers whole texts: as the layer is linear, a word adds its n-grams' class scores, looked up once for each
distinct word. Defined results: a null text, and one without a letter, is `und` with score 0; repeated rows get equal
results; without training texts everything is `und`; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.llm.words import Buckets, Rows, bounded_sample, bucket, fold

MOST_TEXTS = 1600
BUCKETS = 1 << 16
WIDTH = 16
GRAMS = (1, 2, 3)
UNKNOWN = "und"

#: Words of a training text in one example; a longer text gives several.
EXAMPLE = 60


#: Buckets of n-grams seen in this process; there are few of them beside the words.
_KNOWN = Buckets(BUCKETS)


def features(word: str) -> np.ndarray:
    """Rows of a lower-case word and its n-grams."""
    own = word if word.isalpha() else "".join(filter(str.isalpha, word))
    if not own:
        return np.zeros(0, np.int32)
    marked = f"<{own}>"
    grams = [marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)]
    return np.array([*map(_KNOWN.__getitem__, grams), bucket(f"={own}", BUCKETS)], dtype=np.int32)


def words(text: str) -> list[str]:
    return text.lower().split()


@dataclass
class Language:
    langs: list[str]
    scores: np.ndarray  # BUCKETS x langs: embedding times layer
    bias: np.ndarray
    temperature: float
    least: float  # confidence below which a prediction is rejected

    def predictor(self):
        n = len(self.langs)

        scores = np.column_stack([self.scores, np.ones(len(self.scores), np.float32)]) if n else self.scores

        def row(word: str) -> np.ndarray:
            return scores[features(word)].sum(axis=0)

        known = Rows(row, n + 1)

        def predict(text: str | None) -> tuple[str, float]:
            total = known.total(words(text)) if text and n else np.zeros(n + 1)
            if not total[n]:
                return UNKNOWN, 0.0
            z = (total[:n] / total[n] + self.bias) / self.temperature
            q = np.exp(z - z.max())
            best = int(q.argmax())
            return self.langs[best], float(q[best] / q.sum())

        return predict


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], langs: list[str], epochs: int = 3, rate: float = 4.0, error: float = 0.01, seed: int = 0) -> Language:
    names = sorted(set(langs))
    rng = np.random.default_rng(seed)
    known: dict[str, np.ndarray] = {}
    parts, marks, held = [], [], []
    for k, (text, lang) in enumerate(zip(texts, langs, strict=True)):
        found = words(text)
        for at in range(0, len(found), EXAMPLE):
            here = found[at : at + EXAMPLE]
            for w in here:
                if w not in known:
                    known[w] = features(w)
            ids = np.concatenate([known[w] for w in here])
            if len(ids):
                parts.append(ids)
                marks.append(names.index(lang))
                held.append(k % 10 == 0)
    y, held = np.array(marks, dtype=np.int64), np.array(held, dtype=bool)
    embed, layer, bias = rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32), np.zeros((WIDTH, len(names)), np.float32), np.zeros(len(names), np.float32)
    layer += rng.normal(0, 0.1, layer.shape).astype(np.float32)
    learn = np.flatnonzero(~held)
    for epoch in range(epochs):
        for batch in np.array_split(rng.permutation(learn), max(1, len(learn) // 32)):
            if not len(batch):
                continue
            flat = np.concatenate([parts[i] for i in batch])
            sizes = np.array([len(parts[i]) for i in batch])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(embed[flat], starts, axis=0) / sizes[:, None]
            slope = _softmax(mean @ layer + bias)
            slope[np.arange(len(batch)), y[batch]] -= 1
            slope /= len(batch)
            back = (slope @ layer.T / sizes[:, None]).astype(np.float32)
            step = rate * (1 - epoch / epochs)
            layer -= step * mean.T @ slope
            bias -= step * slope.sum(axis=0)
            np.subtract.at(embed, flat, step * 10 * np.repeat(back, sizes, axis=0))
    scores = (embed @ layer).astype(np.float32)
    check = np.flatnonzero(held)
    if not len(check):
        return Language(names, scores, bias, 1.0, 0.0)
    z = np.array([scores[parts[i]].mean(axis=0) for i in check]) + bias
    right = z.argmax(axis=1) == y[check]
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(_softmax(z / t)[np.arange(len(check)), y[check]] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    sure = _softmax(z / temperature).max(axis=1)
    order = np.argsort(-sure)
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    fine = np.flatnonzero(wrong <= error)
    least = float(sure[order][fine[-1]]) if len(fine) else 1.0
    return Language(names, scores, bias, temperature, 0.0 if len(fine) and fine[-1] == len(order) - 1 else least)


def train(docs: DataFrame, folds: int = 4, held_out: int = 2, most: int = MOST_TEXTS, **how) -> Language:
    """docs(doc_id, text, lang); rows of fold `held_out`, and rows without text or lang, take no part in it."""
    kept = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null").where(fold(F.col("doc_id"), folds) != held_out)
    sample = bounded_sample(kept, "doc_id", most).select("text", "lang").toPandas().sort_values(["lang", "text"])
    return fit(sample.text.tolist(), sample.lang.tolist(), **how)


def identify(docs: DataFrame, model: Language, column: str = "_language") -> DataFrame:
    """docs with a struct `column`: lang, score, and accepted, whether the score reaches the rejection limit."""
    if column in docs.columns:
        raise ValueError(f"{column} is taken")

    @F.pandas_udf("lang string, score double, accepted boolean")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = model.predictor()
        for texts in batches:
            out = pd.DataFrame([one(t) for t in texts], columns=["lang", "score"])
            out["accepted"] = (out.lang != UNKNOWN) & (out.score >= model.least)
            yield out

    return docs.withColumn(column, predicted("text"))
