"""Toxicity by non-negative positive-unlabelled learning: confirmed toxic texts and unlabelled texts, no negatives.

Texts are sets of hashed features: words and beginnings of words, in lower case. A feature is kept if the number of
toxic training texts that have it clearly exceeds what unlabelled texts suggest. A linear classifier over the kept features
is trained in numpy to minimise the non-negative risk

    prior * R_positive(+1) + max(0, R_unlabelled(-1) - prior * R_positive(-1))

with the logistic loss, where prior is the share of toxic texts among all. When the second term of a batch turns
negative, the step goes the other way, as that method prescribes. Last, the bias is raised until the share of
unlabelled texts that count as toxic is the prior.

Training takes at most MOST_POSITIVE and MOST_UNLABELLED texts, chosen by a hash of the id (documented bound); scores
cover every whole text. Defined results: null and empty texts have no features and get the score of the bias; repeated
rows get equal scores; without toxic training texts every score is the prior; columns of docs other than doc_id and
text are never looked at, and pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triplake.llm.shared import stored
from triplake.llm.words import MEMORY, bounded_sample, bucket, fold

MOST_POSITIVE = 4000
MOST_UNLABELLED = 8000
BUCKETS = 1 << 20

#: Standard errors by which a feature's share among toxic texts must exceed that among unlabelled ones: the first for
#: few toxic texts, the second for many.
MIN_Z = (3.0, 8.0)

STARTS = (4, 5, 6)

#: By how much a text without any feature stays below a score of 0.5, in log odds.
MARGIN = 1.0

EDGES = ".,;:!?\"'()[]{}<>*#&$%|-_"


def features(word: str) -> list[str]:
    word = word.strip(EDGES)
    return [word, *(f"^{word[:n]}" for n in STARTS if len(word) > n)] if word else []


def text_features(text: str | None, known: dict[str, tuple[int, ...]] | None = None) -> list[int]:
    """Distinct hashed features of the whole text. known: memory of words seen."""
    known = {} if known is None else known
    if len(known) > MEMORY:
        known.clear()
    found: set[int] = set()
    for word in set((text or "").lower().split()):
        ids = known.get(word)
        if ids is None:
            ids = known[word] = tuple(bucket(f, BUCKETS) for f in features(word))
        found.update(ids)
    return list(found)


@dataclass
class Toxicity:
    ids: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        """Text to score; only words with a kept feature are remembered with it."""
        at = dict(zip(self.ids.tolist(), self.weights.tolist(), strict=True))
        known: dict[str, dict[int, float]] = {}

        def score(text: str | None) -> float:
            if len(known) > MEMORY:
                known.clear()
            hit: dict[int, float] = {}
            for word in set((text or "").lower().split()):
                own = known.get(word)
                if own is None:
                    own = known[word] = {i: at[i] for i in (bucket(f, BUCKETS) for f in features(word)) if i in at}
                if own:
                    hit.update(own)
            z = self.bias + sum(hit.values())
            return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

        return score


def fit_nnpu(rows: list[np.ndarray], positive: np.ndarray, width: int, prior: float, epochs: int = 200, rate: float = 0.05, l2: float = 1e-4, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias. rows: places of the features each text has; positive: which texts are confirmed toxic."""
    rng = np.random.default_rng(seed)
    p, u = np.flatnonzero(positive), np.flatnonzero(~positive)
    w, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    w[width] = np.log(prior / (1 - prior))
    batches = max(1, (len(p) + len(u)) // 512)
    step = 0

    def scores(chosen):
        flat = np.concatenate([rows[i] for i in chosen]) if len(chosen) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(chosen)), [len(rows[i]) for i in chosen])
        return flat, owner, np.bincount(owner, w[flat], minlength=len(chosen)) + w[width]

    def slope(flat, owner, by_text):
        """Of the mean loss by the weights, given its slope by each text's score."""
        g = np.bincount(flat, by_text[owner], minlength=width + 1)
        g[width] += by_text.sum()
        return g / max(1, len(by_text))

    for _ in range(epochs):
        ps, us = np.array_split(rng.permutation(p), batches), np.array_split(rng.permutation(u), batches)
        for bp, bu in zip(ps, us, strict=True):
            fp, op, zp = scores(bp)
            fu, ou, zu = scores(bu)
            up = 1 / (1 + np.exp(-zp))
            uu = 1 / (1 + np.exp(-zu))
            as_negative = np.logaddexp(0, zu).mean() - prior * (np.logaddexp(0, zp).mean() if len(bp) else 0)
            of_negative = slope(fu, ou, uu) - prior * slope(fp, op, up)
            if as_negative >= 0:
                g = prior * slope(fp, op, up - 1) + of_negative
            else:
                g = -of_negative
            g[:width] += l2 * w[:width]
            step += 1
            first = 0.9 * first + 0.1 * g
            second = 0.999 * second + 0.001 * g * g
            w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w[:width], matched(w, rows, u, prior)


def matched(w: np.ndarray, rows: list[np.ndarray], unlabelled: np.ndarray, prior: float) -> float:
    """The bias moved so that the share of unlabelled texts scored 0.5 or more is the prior.

    It is only raised, and a text without features stays well below.
    """
    bias = float(w[-1])
    z = np.array([w[rows[i]].sum() for i in unlabelled])
    border = float(np.quantile(z, 1 - prior)) if len(z) else 0.0
    return max(bias, -max(border, MARGIN))


def _collected(pdfs):
    known: dict = {}
    for pdf in pdfs:
        yield pd.DataFrame({"doc": pdf.doc, "positive": pdf.positive, "f": [text_features(t, known) for t in pdf.text]})


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, most_positive: int = MOST_POSITIVE, most_unlabelled: int = MOST_UNLABELLED) -> Toxicity:
    """docs(doc_id, text), labels(doc_id, toxic); rows of fold `held_out` take no part in it."""
    kept = docs.select("doc_id", "text").where(fold(F.col("doc_id"), folds) != held_out)
    known = labels.select("doc_id", "toxic").where(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), folds) != held_out)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.avg("toxic")).first()[0]
    if not share:
        return Toxicity(np.zeros(0, np.int64), np.zeros(0), -6.0)
    prior = min(max(float(share), 0.01), 0.9)
    # About most_positive ids.
    positive = bounded_sample(known.where("toxic = 1"), "doc_id", most_positive).select("doc_id")
    positive = kept.join(F.broadcast(positive), "doc_id").select("text", F.lit(True).alias("positive"))
    unlabelled = bounded_sample(kept, "doc_id", most_unlabelled).select("text", F.lit(False).alias("positive"))
    sample = positive.unionByName(unlabelled).select(F.xxhash64("text", "positive").alias("doc"), "text", "positive")
    found = stored(sample.mapInPandas(_collected, "doc long, positive boolean, f array<int>"))
    sizes = {r.positive: r.n for r in found.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    np_, nu = sizes.get(True, 0), sizes.get(False, 0)
    if not np_ or not nu:
        return Toxicity(np.zeros(0, np.int64), np.zeros(0), float(np.log(prior / (1 - prior))))
    counts = found.select("positive", F.explode("f").alias("f")).groupBy("f").agg(F.sum(F.col("positive").cast("int")).alias("p"), F.sum((~F.col("positive")).cast("int")).alias("u"))
    share_p, share_u = (F.col("p") + 0.5) / (np_ + 1), (F.col("u") + 0.5) / (nu + 1)
    spread = F.sqrt(share_p * (1 - share_p) / np_ + share_u * (1 - share_u) / nu)
    # At most BUCKETS features exist, however many texts there are.
    least = float(np.clip(0.2 * np.sqrt(np_), *MIN_Z))
    chosen = counts.where((F.col("p") >= 5) & (share_p - share_u >= least * spread)).select("f")
    ids = np.sort(np.array([r.f for r in chosen.collect()], dtype=np.int64))

    def kept_only(pdfs):
        for pdf in pdfs:
            yield pd.DataFrame({"positive": pdf.positive, "f": [np.searchsorted(ids, f[np.isin(f, ids)]) for f in pdf.f]})

    # The bounded sample's kept features: a few numbers for each text.
    sample_rows = found.select("positive", "f").mapInPandas(kept_only, "positive boolean, f array<int>").toPandas()
    rows = [np.asarray(f, dtype=np.int64) for f in sample_rows.f]
    weights, bias = fit_nnpu(rows, sample_rows.positive.to_numpy(dtype=bool), len(ids), prior)
    return Toxicity(ids, weights, bias)


def score(docs: DataFrame, model: Toxicity, column: str = "_toxicity") -> DataFrame:
    """docs with a score between 0 and 1 in `column`."""
    if column in docs.columns:
        raise ValueError(f"{column} is taken")

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = model.scorer()
        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype=float)

    return docs.withColumn(column, scored("text"))
