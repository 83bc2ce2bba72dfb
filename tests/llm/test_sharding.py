"""The uniform shuffle into shards: its draws against exact chances, its places against plain loops."""

import zlib
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from notequarry.llm import shard_shuffle
from notequarry.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def drawn(spark, good, bad, draws, n):
    whole = [F.lit(x).cast("long") for x in (good, bad, draws)]
    uniform = shard_shuffle._uniform(F.lit(5), F.col("id"))
    found = spark.range(n).select(shard_shuffle.hypergeometric(*whole, uniform).alias("x"))
    return {r.x: r["count"] for r in found.groupBy("x").count().collect()}


@pytest.mark.parametrize("good,bad,draws", [(30, 20, 12), (3, 400, 50), (7, 2, 8), (1, 1, 1), (60, 60, 60)])
def test_draws_follow_the_exact_chances(spark, good, bad, draws):
    n, off = 40_000, 0.0
    found = drawn(spark, good, bad, draws, n)
    low, high = max(0, draws - bad), min(draws, good)
    assert min(found) >= low and max(found) <= high
    for x in range(low, high + 1):
        expected = n * comb(good, x) * comb(bad, draws - x) / comb(good + bad, draws)
        off += (found.get(x, 0) - expected) ** 2 / max(expected, 1.0)
    assert off < 3 * (high - low + 1) + 12


@pytest.mark.parametrize("good,bad,draws,only", [(0, 5, 3, 0), (5, 0, 3, 3), (5, 5, 0, 0), (5, 5, 10, 5), (0, 0, 0, 0)])
def test_draws_that_have_one_result(spark, good, bad, draws, only):
    assert set(drawn(spark, good, bad, draws, 5)) == {only}


def test_large_draws_stay_near_their_mean(spark):
    found = drawn(spark, 10**9, 9 * 10**9, 3 * 10**8, 20)
    assert all(abs(x - 3 * 10**7) < 6 * (3 * 10**7 * 0.9 * 0.97) ** 0.5 for x in found)
    assert len(found) == 20


def test_matrix_has_the_given_margins(spark):
    rows = [(p, (p * 37) % 11) for p in range(1500) if p % 5]
    n = sum(x for _, x in rows)
    sizes = [n // 7 + (j < n % 7) for j in range(7)]
    counts = spark.createDataFrame(rows, "part int, n int")
    matrix = {r.part: r.drawn for r in shard_shuffle.communication_matrix(counts, sizes, 3).collect()}
    assert {p: sum(matrix[p]) for p in matrix} == dict(rows)
    assert [sum(x[j] for x in matrix.values()) for j in range(7)] == sizes
    assert min(min(x) for x in matrix.values()) >= 0


def test_places_do_not_follow_the_input(spark):
    n, shards, parts = 2400, 4, 6
    rows = spark.range(n).repartitionByRange(parts, "id")
    orders = [shard_shuffle.shuffle_to_shards(rows, shards, seed).collect() for seed in (1, 2)]
    for placed in orders:
        met = Counter((r.row.id * parts // n, r.shard) for r in placed)
        expected = n / shards / parts
        assert sum((met[p, s] - expected) ** 2 / expected for p in range(parts) for s in range(shards)) < 40
        halves = Counter((r.row.id >= n // 2, r.slot >= n // shards // 2) for r in placed)
        assert all(abs(x - n / 4) < 110 for x in halves.values())
    first, second = ({r.row.id: (r.shard, r.slot) for r in placed} for placed in orders)
    assert sum(first[i] == second[i] for i in first) < 20


def test_odd_rows(spark):
    rows = [(1, "x" * 200_000, 9), (1, "x" * 200_000, 9), (None, None, 1), (2, "", None), (3, "ä", 0), (None, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").repartition(4)
    placed = shard_shuffle.shuffle_to_shards(docs, 4).collect()
    assert sorted(map(str, (tuple(r.row) for r in placed))) == sorted(map(str, rows))
    assert Counter(r.shard for r in placed) == {0: 2, 1: 2, 2: 1, 3: 1}
    made = shard_shuffle.document_shards(docs, 4).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in made) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows
    )
    assert shard_shuffle.document_shards(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        shard_shuffle.shuffle_to_shards(docs, 0)


def test_query(spark):
    frame = QUERIES["op11_shard_shuffle"](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    got = frame.collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d.doc_id, len((d.text or "").encode()) + 8, zlib.crc32((d.text or "").encode())) for d in docs
    )
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}


def test_written_shards(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    shard_shuffle.write_shards(shard_shuffle.shuffle_to_shards(docs, 5, 1), str(tmp_path / "shards"))
    read = spark.read.parquet(str(tmp_path / "shards"))
    assert read.groupBy("_shard").count().count() == 5
    assert sorted(r.doc_id for r in read.collect()) == sorted(r.doc_id for r in docs.collect())
