"""Exact and near duplicates, against plain loops over small tables."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from notequarry.llm import components, exact_dedup, simhash

DOCS = "doc_id long, text string, keep_id string, kept int"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (5, "Same Text", "x", 1), (9, "same text", "x", 1), (7, "SAME TEXT", None, None), (1, "sÀme text", "x", 1),
        (2, None, None, 0), (3, "", "x", 0), (4, " ", "x", 0), (8, "long " * 30_000, "x", 0),
        (8, "long " * 30_000, "x", 0), (None, "no id", "x", 0), (None, "same text", "x", 0), (6, "sàme text", "x", 1),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_exact_groups(docs):
    got = exact_dedup.exact_dedup(docs).collect()
    groups = {}
    for row in docs.collect():
        groups.setdefault(lowered(row.text), []).append(row.doc_id)
    expected = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, keep, len(ids), i == keep, digest) for i in ids]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def test_exact_kept_rows(docs):
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, len(r.text or "")) for r in kept.collect()) == [
        (-1, 5), (1, 9), (3, 0), (4, 1), (6, 9), (8, 150_000), (9, 9)
    ]


def test_empty_table(spark, docs):
    none = docs.limit(0)
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.drop_exact_copies(none).count() == 0
    assert simhash.simhash_dedup(none).count() == 0
    assert simhash.drop_near_copies(none).count() == 0


def test_cuckoo_index_against_a_set():
    index, live, rand = exact_dedup.CuckooIndex(8), {}, random.Random(1)
    keys = [hashlib.sha256(bytes([i % 256, i // 256])).digest() for i in range(3000)]
    # every fourth digest shares its fingerprint, and often a bucket, with another
    keys += [k[:2] + bytes(6) + bytes(8) + k[16:] for k in keys[::4]]
    for step in range(20_000):
        key = rand.choice(keys)
        if rand.random() < 0.6:
            assert index.insert(key, step) == (key not in live)
            live[key] = live.get(key, 0) + 1
        else:
            assert index.delete(key) == (live.pop(key, None) is not None)
    assert {e[0]: e[2] for e in index} == live
    assert index.resizes > 0
    assert all((index.find(k) is not None) == (k in live) for k in keys)


def test_index_changes(spark):
    digest = lambda x: hashlib.sha256(x.encode()).digest()
    table = lambda rows: spark.createDataFrame([(i, bytearray(digest(x))) for i, x in rows], "doc_id long, digest binary")
    index = exact_dedup.live_index(table([(1, "a"), (2, "b"), (3, "a")]))
    after = exact_dedup.update_index(index, table([(9, "b"), (4, "c")]), table([(0, "a"), (0, "none")]))
    assert {(bytes(r.digest), r.keep_id, r.members) for r in after.collect()} == {(digest("b"), 9, 2), (digest("c"), 4, 1)}


def plain_fingerprint(text):
    words = lowered(text).encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


@pytest.mark.parametrize("text", ["", "  ", "One", "a b c", "a b c d", "A b\tc\nd e  f", "x " * 50, "é ü — ß a b"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_fingerprint_is_the_hash_of_spark(spark):
    row = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()
    assert row[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def linked(prints, limit=4):
    """Smallest print reachable, by comparing all pairs."""
    prints = np.array(sorted(set(prints)), np.uint64)
    root = np.arange(len(prints))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= limit
    while True:
        new = np.array([root[near[i]].min() for i in range(len(prints))])
        if (new == root).all():
            return {int(p): int(prints[r]) for p, r in zip(prints, root, strict=True)}
        root = new


def clusters(n, seed):
    rand = random.Random(seed)
    found = [0, 2**64 - 1]
    for _ in range(n):
        p = rand.getrandbits(64)
        for _ in range(rand.randrange(1, 9)):
            found.append(p)
            p ^= sum(1 << b for b in rand.sample(range(64), rand.randrange(0, 6)))
    # a dense group: all within a few bits of each other
    found += [p ^ (1 << a) ^ (1 << b) for a in range(0, 20) for b in range(20, 40, 2)]
    return found


@pytest.mark.parametrize("full", [4096, 8])
def test_components_against_all_pairs(spark, full):
    prints = clusters(150, full)
    expected = linked(prints)
    table = spark.createDataFrame([(p - 2**64 if p >= 2**63 else p,) for p in prints], "print long")
    found = {r.node % 2**64: r.root % 2**64 for r in simhash.near_components(table, full=full).collect()}
    assert set(found) == {p for p, r in expected.items() if list(expected.values()).count(r) > 1}
    groups = {}
    for p, r in found.items():
        groups.setdefault(r, set()).add(p)
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(p for p in expected if expected[p] == r) for r in {expected[p] for p in found}
    }


def test_near_links_span_a_dense_group():
    prints = np.array(clusters(30, 7), np.uint64)
    prints = np.unique(prints)
    a, b = simhash.near_links(np.zeros(len(prints), np.int64), prints)
    assert len(a) < len(prints)
    expected = linked(prints.tolist())
    root = {int(p): int(p) for p in prints}
    for _ in range(len(prints)):
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            root[x] = root[y] = min(root[x], root[y])
    assert len(set(root.values())) == len(set(expected.values()))


def test_star_steps_on_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (2000, 2001), (2001, 2000)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1100)} | {2000: 2000, 2001: 2000}


def test_simhash_rows(docs):
    got = simhash.simhash_dedup(docs).collect()
    prints = {r.fingerprint for r in got}
    assert sorted((r.doc_id or -1, r.fingerprint) for r in got) == sorted(
        (r.doc_id or -1, f"{plain_fingerprint(r.text):016x}") for r in docs.collect()
    )
    roots = linked([int(p, 16) for p in prints])
    lowest = {}
    for r in got:
        root = roots[int(r.fingerprint, 16)]
        if r.doc_id is not None:
            lowest[root] = min(lowest.get(root, r.doc_id), r.doc_id)
    assert all(r.component_id == lowest.get(roots[int(r.fingerprint, 16)]) for r in got)


def test_near_copies_keep_columns(docs):
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {2, 8, None}


def test_repeated_ids_keep_one_row_of_each_group(spark):
    one = " ".join(f"alpha{i}" for i in range(300))
    other = " ".join(f"omega{i}" for i in range(300))
    # 5 leads the first group; in the second it stands behind 3; 9 is alone, twice; 7 leads two groups
    lone, left, right = ("of a third kind " * 40, " ".join(f"left{i}" for i in range(90)), " ".join(f"right{i}" for i in range(90)))
    rows = [(5, one), (6, one), (5, other), (3, other), (9, lone), (9, lone), (7, left), (7, right), (8, right), (None, one)]
    # two versions of one text under one id
    long = " ".join(f"word{i}" for i in range(3000))
    longer = (long + "".join(f" more{i}" for i in range(n)) for n in range(1, 300))
    far = lambda t: (simhash.fingerprint(long.encode()) ^ simhash.fingerprint(t.encode())).bit_count()
    rows += [(20, long), (20, next(t for t in longer if 0 < far(t) <= simhash.LIMIT)), (21, long)]
    got = simhash.drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    kept = [(r.doc_id, r.text) for r in got if r.doc_id != 20]
    assert sorted(kept, key=str) == sorted([(5, one), (3, other), (9, lone), (7, left), (7, right), (None, one)], key=str)
    assert sum(r.doc_id == 20 for r in got) == 1
