"""Hard negatives against DuckDB and against plain loops, and the pruning of the tree."""

import math
import random

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from notequarry.llm import hard_negatives
from notequarry.llm.queries import ORACLES, QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, lane int, score string"


def plain(rows, modulus=10):
    """(anchor, positive, rank, negative, scores) by looking at all pairs."""
    kept = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * x) for x in v], label))
    out = []
    for a, (anchor, v, label) in enumerate(kept):
        if anchor % modulus:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other, n) for n, (i, w, other) in enumerate(kept) if n != a]
        for score, positive, _, _ in sorted(x for x in scored if x[2] == label)[:5]:
            best = sorted(x for x in scored if x[2] != label and 30 * -score <= 100 * -x[0] <= 90 * -score)[:10]
            out += [(anchor, positive, r, x[1], -score, -x[0]) for r, x in enumerate(best, 1)]
    return sorted(out)


def answers(spark, rows, **options):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    found = hard_negatives.hard_negatives(table, F.col("id") % 10 == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def clustered(n, width, seed=3, clusters=12):
    rand = np.random.default_rng(seed)
    centres = rand.normal(0, 1, (clusters, width))
    return [(i, (centres[i % clusters] + rand.normal(0, 0.25, width)).tolist(), int(rand.integers(4))) for i in range(n)]


@pytest.mark.parametrize("sample", [4, 2048])
def test_clusters_against_all_pairs(spark, sample):
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in clustered(400, 6)]
    got = answers(spark, rows, sample=sample)
    assert got == plain(rows) and len(got) > 500


def test_odd_rows_ties_and_copies(spark):
    rand = random.Random(2)
    rows = [(i, [float(rand.randrange(-1, 3)) for _ in range(3)], rand.randrange(3)) for i in range(120)]
    # a third of the rows are the same vector, some ids come twice
    rows += [(200 + i, [1.0, 1.0, 1.0], i % 2) for i in range(80)]
    rows += [(10, [1.0, 2.0, 0.0], 1), (10, [1.0, 2.0, 0.0], 1), (20, [2.0], 0), (30, [], 0), (31, [], 1)]
    rows += [(40, None, 1), (50, [1.0, None, 1.0], 1), (60, [float("nan")] * 3, 1), (70, [float("inf"), 1.0, 1.0], 0)]
    rows += [(80, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (90, [9.0, 9.0, 9.0], 7)]
    assert answers(spark, rows) == plain(rows)


def test_empty_and_lonely(spark):
    assert answers(spark, []) == []
    assert answers(spark, [(10, [1.0], 1)]) == []
    assert answers(spark, [(1, [1.0], 1), (2, [2.0], 2)]) == []


def test_ranges_hold_all_vectors_and_prune(spark):
    rows = clustered(3000, 6, clusters=30)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)
    whole = hard_negatives.whole_vectors(table, "vec_id", "embedding", table["label"], 256)
    index = hard_negatives.index(hard_negatives.materialise(whole, "vectors"), sample=500)
    tree, held = index.tree, index.rows.collect()
    vectors = np.array([r.vector for r in held])
    leaf = np.array([r.leaf for r in held])
    assert (tree.leaves(vectors) == leaf).all() and len(tree.paths) > 30
    some = list(range(0, 3000, 60))
    scores = (vectors[some] @ vectors.T).astype(np.int64)
    top = np.sort(scores, axis=1)[:, -2:-1]
    low, high = top * 6 // 10, top * 9 // 10
    annuli = hard_negatives._annuli(tree, vectors[some], low, high)
    seen = 0
    for x in range(len(tree.paths)):
        alive = tree.alive(*annuli, x)[:, 0]
        inside = (scores[:, leaf == x] >= low) & (scores[:, leaf == x] <= high)
        assert not inside[~alive].any()
        seen += int(alive.sum()) * int((leaf == x).sum())
    assert seen < 0.6 * len(some) * len(held)


def test_query_matches_sql(spark):
    duck = compare.connect("/root/testdata/sf0.001")
    name = "op12_hard_negatives"
    assert compare.compare(QUERIES[name](spark, "/root/testdata/sf0.001"), duck, ORACLES[name]) == []


def test_no_blocks_are_sent_whole(spark, monkeypatch):
    kept, found = hard_negatives.materialise, []
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")

    def seen(df, name):
        plan = df._jdf.queryExecution().explainString(mode)
        found.extend(f"{name}: {x.strip()}" for x in plan.splitlines() if "BroadcastExchange" in x)
        return kept(df, name)

    monkeypatch.setattr(hard_negatives, "materialise", seen)
    rows = [(i, np.float32(v).tolist(), label) for i, v, label in clustered(100, 4)]
    assert answers(spark, rows) == plain(rows)
    assert found == []
