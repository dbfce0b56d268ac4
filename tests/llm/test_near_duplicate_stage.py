"""The pipeline's near-duplicate stage against a brute-force join of 5-word shingles at 0.8."""

from itertools import combinations

import corpus_pipeline
from tests.llm.conftest import SF_DIR
from tests.llm.test_duplicates import Groups


def shingles(text, size):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()


def linked(a, b, size, percent):
    x, y = shingles(a, size), shingles(b, size)
    return bool(x and y) and 100 * len(x & y) >= percent * len(x | y)


def test_kept_documents_against_brute_force(spark, documents):
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in documents.orderBy("doc_id").limit(60).collect()]
    words = [f"w{k}" for k in range(200)]
    spread = [w if k not in (40, 80, 120, 160) else "x" for k, w in enumerate(words)]
    more = [" ".join(words), " ".join(spread), " ".join(words + [f"y{k}" for k in range(35)]), " ".join(words + [f"z{k}" for k in range(70)])]
    rows += [(90_000 + k, t, "en", "s", len(t)) for k, t in enumerate(more)]
    # The first two copies lie between the thresholds, the last is below both.
    assert [(linked(more[0], t, 5, 80), linked(more[0], t, 3, 90)) for t in more[1:]] == [(True, False), (True, False), (False, False)]
    groups = Groups()
    for (i, a, *_), (j, b, *_) in combinations(rows, 2):
        if linked(a, b, 5, 80):
            groups.join(i, j)
    docs = spark.createDataFrame(rows, documents.select(*corpus_pipeline.COLUMNS).schema)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({groups.find(r[0]) for r in rows})
