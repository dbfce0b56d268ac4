"""Quality classifier from weak labels: overlapping heuristic labellers, expectation-maximisation, hashed linear scorer.

Each labeller votes good (1) or bad (0) on a text or abstains (-1), from plain counts of the whole text (DataFrame
functions). Votes are counted by pattern over all documents; expectation-maximisation on these counts estimates, for
each class, how often each labeller votes what, and the share of good texts, without any true label. There are at
most 3 to the number of labellers patterns, however many documents there are. The posterior of its pattern is a text's
weak label. A linear scorer over hashed features of the text (word shapes, endings and repeats, words) is trained on
the weak labels by stochastic gradient descent in numpy, on at most MOST_TEXTS texts chosen by a hash (documented
bound), weighted by how sure the posterior is; it scores every whole text.

Defined results: null and empty texts have no features and get the score of the bias; every labeller abstains on them;
repeated rows get equal results; other columns pass through untouched; without documents the score is 0.5.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triplake.llm.shared import let, stored
from triplake.llm.words import Buckets, Rows, bounded_sample, bucket

MOST_TEXTS = 3000
BUCKETS = 1 << 16

ABSTAIN = -1


def measured(docs: DataFrame) -> DataFrame:
    """docs with _m, plain counts of each text: shares of characters or words; null for a null or empty one."""
    n = F.length("text")
    share = lambda count: F.when(n > 0, count / n)
    without = lambda mark: n - F.length(F.replace("text", F.lit(mark), F.lit("")))

    def of_words(words: Column) -> Column:
        k = F.size(words)
        same = F.filter(F.zip_with(F.slice(words, 1, F.greatest(k - 1, F.lit(0))), F.slice(words, 2, F.greatest(k - 1, F.lit(0))), lambda a, b: a == b), lambda x: x)
        return F.struct(F.when(k > 0, k).alias("words"), F.when(k > 0, F.size(F.array_distinct(words)) / k).alias("distinct"), F.when(k > 1, F.size(same) / k).alias("repeats"))

    return docs.withColumn("_w", let(F.array_remove(F.split("text", r"\s+"), ""), of_words)).withColumn(
        "_m",
        F.struct(
            share(F.regexp_count("text", F.lit(r"\p{Lu}"))).alias("upper"),
            share(F.regexp_count("text", F.lit(r"[^\p{L}\p{N}\s.,;:'\"()!?-]"))).alias("symbols"),
            share(without("!")).alias("shouts"),
            share(without("|")).alias("bars"),
            "_w.*",
        ),
    ).drop("_w")


def votes(m=lambda name: F.col(name)) -> dict[str, Column]:
    """One vote for each labeller: each of the first ones knows one kind of bad text and abstains on the rest."""
    bad_from = lambda value, limit: F.when(value >= limit, 0).otherwise(ABSTAIN)
    prose = (m("words") >= 20) & (m("distinct") > 0.3) & (m("upper") < 0.08) & (m("symbols") < 0.01) & (m("repeats") < 0.05)
    return {
        "case": bad_from(m("upper"), 0.3),
        "symbols": bad_from(m("symbols"), 0.05),
        "shouts": bad_from(m("shouts"), 0.03),
        "bars": bad_from(m("bars"), 0.02),
        "repeats": bad_from(m("repeats"), 0.25),
        "variety": F.when((m("words") >= 40) & (m("distinct") < 0.15), 0).otherwise(ABSTAIN),
        "prose": F.when(prose, 1).otherwise(ABSTAIN),
    }


def voted(docs: DataFrame) -> DataFrame:
    """docs with _votes, an array of one vote for each labeller."""
    found = measured(docs)
    all_votes = F.array(*(v.cast("int") for v in votes(lambda n: F.col(f"_m.{n}")).values()))
    return found.withColumn("_votes", all_votes).drop("_m")


@dataclass
class Labellers:
    good: float
    tables: np.ndarray  # class x labeller x vote (-1, 0, 1)
    posterior: dict[tuple[int, ...], float] = field(default_factory=dict)


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> Labellers:
    """patterns: votes of each kind of text; counts: texts of that kind. Starts from any vote for bad."""
    n, m = patterns.shape
    q = np.where((patterns == 0).any(axis=1), 0.1, 0.9)
    onehot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)
    good, tables = 0.5, np.full((2, m, 3), 1 / 3)
    for _ in range(rounds):
        weight = np.stack([(1 - q) * counts, q * counts])
        tables = np.einsum("cn,nmv->cmv", weight, onehot) + 0.5
        tables /= tables.sum(axis=2, keepdims=True)
        good = float(np.clip(weight[1].sum() / counts.sum(), 0.01, 0.99))
        log = np.einsum("nmv,cmv->cn", onehot, np.log(tables)) + np.log([[1 - good], [good]])
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500)))
        if np.abs(new - q).max() < 1e-6:
            break
        q = new
    return Labellers(good, tables, {tuple(int(x) for x in p): float(x) for p, x in zip(patterns, q, strict=True)})


#: Buckets of features seen in this process.
_KNOWN = Buckets(BUCKETS)


def features(word: str, same: bool) -> list[int]:
    """Hashed features of a word that follows an equal one or not."""
    if word.isalpha() and (word.islower() or word.istitle()):
        shape = "x" if word.islower() else "Xx" if len(word) > 1 else "X"
    else:
        shape = re.sub(r"(.)\1+", r"\1", "".join("X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c for c in word))
    end = "a" if word[-1].isalnum() else word[-2:]
    return [_KNOWN[f"shape={shape}"], _KNOWN[f"end={end}"], _KNOWN[f"same={same}"], bucket(f"word={word.lower()}", BUCKETS)]


def _keys(text: str | None) -> list[str]:
    """Words, each marked if it repeats the one before."""
    words = (text or "").split()
    return [f"={w}" if w == before else f" {w}" for before, w in zip([None, *words], words)]


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def scorer(self):
        weights = self.weights.tolist()
        known = Rows(lambda k: (sum(weights[i] for i in features(k[1:], k[0] == "=")), 1.0), 2)

        def score(text: str | None) -> float:
            total, n = known.total(_keys(text))
            return float(1 / (1 + np.exp(-np.clip(self.bias + total / max(n, 1), -40, 40))))

        return score


def fit_linear(texts: list[str], targets: np.ndarray, epochs: int = 15, rate: float = 4.0, seed: int = 0) -> Scorer:
    """Averaged features of a text against its posterior of being good."""
    rng = np.random.default_rng(seed)
    rows = []
    known: dict[str, list[int]] = {}
    for t in texts:
        ids = [i for k in _keys(t) for i in (known.get(k) or known.setdefault(k, features(k[1:], k[0] == "=")))]
        place, times = np.unique(np.array(ids, dtype=np.int64), return_counts=True)
        rows.append((place, times * 4 / max(1, len(ids))))
    w, bias = np.zeros(BUCKETS), 0.0
    sure = np.abs(targets - 0.5) * 2
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 32)):
            if not len(batch):
                continue
            flat = np.concatenate([rows[i][0] for i in batch])
            value = np.concatenate([rows[i][1] for i in batch])
            owner = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            z = np.bincount(owner, w[flat] * value, minlength=len(batch)) + bias
            slope = (1 / (1 + np.exp(-z)) - targets[batch]) * sure[batch] / len(batch)
            np.subtract.at(w, flat, step * value * slope[owner])
            bias -= step * 0.1 * slope.sum()
    return Scorer(w, float(bias))


def train(docs: DataFrame, most: int = MOST_TEXTS) -> tuple[Labellers, Scorer]:
    """Both models from docs(doc_id, text)."""
    ballots = stored(voted(docs.select("doc_id", "text")).select("doc_id", F.xxhash64("text").alias("_hash"), "_votes"))
    counted = ballots.groupBy("_votes").agg(F.count(F.lit(1)).alias("n")).toPandas()
    if counted.empty:
        return Labellers(0.5, np.zeros((2, 0, 3))), Scorer(np.zeros(BUCKETS), 0.0)
    patterns = np.array(counted._votes.tolist(), dtype=int)
    order = np.lexsort(patterns.T)
    labellers = expectation_maximisation(patterns[order], counted.n.to_numpy(dtype=float)[order])
    # Bad texts are few: as many with a vote for bad as without, up to the bound.
    bad = F.exists("_votes", lambda v: v == 0)
    sample = bounded_sample(ballots.where(bad), "doc_id", most // 2).unionByName(bounded_sample(ballots.where(~bad), "doc_id", most // 2))
    keyed = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("_hash"), "text")
    # The bounded sample's texts.
    sample = keyed.join(F.broadcast(sample.distinct()), ["doc_id", "_hash"]).select("text", "_votes").toPandas().sort_values("text", kind="stable")
    targets = np.array([labellers.posterior[tuple(int(x) for x in v)] for v in sample._votes])
    return labellers, fit_linear(sample.text.tolist(), targets)


def score(docs: DataFrame, scorer: Scorer, column: str = "_quality") -> DataFrame:
    """docs with a score between 0 and 1 in `column`; higher is better."""
    if column in docs.columns:
        raise ValueError(f"{column} is taken")

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = scorer.scorer()
        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype=float)

    return docs.withColumn(column, scored("text"))
