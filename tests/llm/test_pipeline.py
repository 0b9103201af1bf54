"""Stages of the corpus pipeline against brute force."""

import corpus_pipeline as P
from test_pairs_and_spans import LOWER, near_copies


def least_of_components(rows, size=5, percent=80):
    """The least doc_id of each component, by comparing all pairs."""
    sets = {}
    for d, t in rows:
        w = (t or "").translate(LOWER).encode().split()
        sets[d] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    comp = {d: d for d in sets}
    find = lambda d: d if comp[d] == d else find(comp[d])
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {find(d) for d in sets}


def test_near_copies_go_at_five_words_and_80_percent(spark):
    rows = near_copies(5, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = [r["doc_id"] for r in P.drop_near_copies(spark, docs, "").collect()]
    want = least_of_components(rows)
    assert sorted(kept) == sorted(want) and want != least_of_components(rows, 4, 85)
