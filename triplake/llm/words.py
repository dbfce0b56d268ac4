"""Word features of texts inside tasks: words are looked up once, texts are sums over their words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words kept in a task's memory; beyond it the memory starts anew.
MEMORY = 400_000


class Rows(dict):
    """word -> row of a growing table; make(word) gives the row's values."""

    def __init__(self, make: Callable[[str], np.ndarray], width: int):
        self.make, self.width = make, width
        self.table = np.zeros((1024, width), np.float32)

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[row] = self.make(word)
        self[word] = row
        return row

    def total(self, words) -> np.ndarray:
        """Sum of the words' rows; a word counts as often as it is given."""
        if len(self) > MEMORY:
            self.clear()
        # In portions, so that a very long text needs no more memory than a short one.
        out = np.zeros(self.width)
        for at in range(0, len(words), 65536):
            part = np.fromiter(map(self.__getitem__, words[at : at + 65536]), np.int64)
            out += self.table[part].sum(axis=0, dtype=np.float64)
        return out


def bucket(feature: str, buckets: int) -> int:
    return xxhash.xxh64_intdigest(feature.encode("utf-8", "replace")) % buckets


class Buckets(dict):
    """feature -> its bucket, worked out once."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) > MEMORY:
            self.clear()
        self[feature] = found = bucket(feature, self.buckets)
        return found


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; a null id counts as the text '-'."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("-")).cast("binary")) % folds


def bounded_sample(df: DataFrame, key: str, most: int) -> DataFrame:
    """About `most` rows (all, where there are fewer), chosen by a hash of key alone; the bound is on training data only."""
    n = df.count()
    if n <= most:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1_000_000)) < int(1_000_000 * most / n))
