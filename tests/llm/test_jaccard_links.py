"""Links between texts of which one continues the other, beside brute force."""

import random

import pytest

from spindrift.llm import jaccard_join


def least_linked(rows, words, percent):
    """{id: least id reachable by links}, over all pairs."""
    cut = {k: t.split() for k, t in rows}
    sets = {k: {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} for k, w in cut.items()}
    group = {k: k for k in sets}
    for a in sets:
        for b in sets:
            if a < b and group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if g == old else g for k, g in group.items()}
    return group


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_longer_copies_are_linked(spark, words, percent):
    rng = random.Random(words)
    rows: list[tuple[int, str]] = []
    for base in range(12):
        own = [f"b{base}x{i}" for i in range(rng.randint(80, 130))]
        rows += [(len(rows) + 1, " ".join(own))]
        for copy in range(rng.choice([1, 1, 12])):  # one longer copy, or many, so that the base is common
            new = [f"n{base}x{copy}x{i}" for i in range(len(own) * rng.randint(10, 18) // 100)]
            rows += [(len(rows) + 1, " ".join(own + new if rng.random() < 0.5 else new + own))]
    # 85 common n-grams of 100.
    base = [f"c{i}" for i in range(84 + words)]
    rows += [(1001, " ".join(base)), (1002, " ".join([*base, *(f"d{i}" for i in range(15))]))]
    found = jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), words=words, percent=percent)
    assert {r.doc_id: r.component_id for r in found.collect()} == least_linked(rows, words, percent)
