"""The lists of the n-gram join are counted in one packed exchange."""

from collections import Counter, defaultdict

import numpy as np

from triplake.llm import ngram_join


def test_lengths_of_lists_that_several_sets_hold(spark):
    rng = np.random.default_rng(4)
    pool = np.unique(rng.integers(-(2**63), 2**63 - 1, 400))
    sets = {k: np.sort(rng.choice(pool, int(rng.integers(1, 12)), replace=False)) for k in range(-60, 60)}
    rows = spark.createDataFrame([(k, s.tolist()) for k, s in sets.items()], "node long, some array<long>").repartition(5)
    for percent in (80, 90, 50):
        limit = ngram_join.counted_below(percent)
        times = Counter(m for s in sets.values() for m in s.tolist() if m < limit)
        names = dict(zip(ngram_join.upper(pool).tolist(), pool.tolist(), strict=True))
        got = defaultdict(dict)
        for r in ngram_join.held_by_several(rows, percent).collect():
            got[r.node][names[r.member]] = r.length
        want = {k: {m: times[m] for m in s.tolist() if times.get(m, 0) > 1} for k, s in sets.items()}
        assert got == {k: x for k, x in want.items() if x}
