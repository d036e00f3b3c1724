"""Sharding and mixing against plain Python."""

from __future__ import annotations

import os
import random
import zlib

import pytest

from lunaria.llm import mixing, sharding
from lunaria.llm.common import table

KIND = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], KIND)


def brute(sizes, k):
    """The smallest capacity, by trying all."""
    def fits(c):
        n, room = 1, c
        for s in sizes:
            if s > c:
                return False
            if s > room:
                n, room = n + 1, c
            room -= s
        return n <= k

    c = max(sizes)
    while not fits(c):
        c += 1
    return c


@pytest.mark.parametrize(("seed", "n", "k"), [(0, 1, 3), (1, 5, 8), (2, 60, 4), (3, 300, 16), (4, 300, 2)])
def test_capacity_is_the_least(spark, seed, n, k):
    rng = random.Random(seed)
    rows = [(rng.getrandbits(60), rng.choice([1, 2, 3, rng.randrange(1, 400)])) for _ in range(n)]
    groups = spark.createDataFrame(rows, "h long, bytes long")
    capacity, cuts = sharding.minimax_cuts(groups, k)
    ordered = sorted(rows)
    assert capacity == brute([s for _, s in ordered], k)
    assert cuts == greedy(ordered, capacity)


def greedy(ordered, capacity):
    """Hashes at which a greedy pass begins a new shard."""
    cuts, room = [], capacity
    for h, s in ordered:
        if s > room:
            cuts.append(h)
            room = capacity
        room -= s
    return cuts


@pytest.mark.parametrize("seed", range(7))
def test_hot_group_among_many(spark, seed):
    """One group that outweighs a fair shard (or, in the last seeds, half of one) among 10,000 small ones."""
    rng = random.Random(100 + seed)
    rows = [(rng.getrandbits(60), rng.randrange(1, 60)) for _ in range(10_000)]
    total = sum(s for _, s in rows)
    rows.append((rng.getrandbits(60), 2 * total if seed < 4 else total // 30))
    ordered = sorted(rows)
    capacity, cuts = sharding.minimax_cuts(spark.createDataFrame(rows, "h long, bytes long"), 16)
    sizes = [s for _, s in ordered]
    fits = lambda c: c >= max(sizes) and len(greedy(ordered, c)) < 16
    assert fits(capacity) and not fits(capacity - 1)
    assert cuts == greedy(ordered, capacity)


def test_hot_group_and_close_hashes(spark):
    rows = [(h, 5) for h in range(-1, 39)] + [(1 << 40, 1000)] + [((1 << 59) + h, 7) for h in range(40)]
    capacity, _ = sharding.minimax_cuts(spark.createDataFrame(rows, "h long, bytes long"), 3)
    assert capacity == brute([s for _, s in sorted(rows)], 3) == 1000


def test_shard_rows(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["same", "", None, "é" * rng.randrange(50), f"text {i}"]), "s") for i in range(400)]
    rows += [rows[7], rows[7], (None, "x", "s")]
    out = sharding.shard(docs(spark, rows).withColumnRenamed("lang", "shard"), 4).collect()
    assert len(out) == len(rows)
    place = {}
    text = {i: t for i, t, _ in rows}
    for r in out:
        t = text[r.doc_id]
        assert r["size"] == len((t or "").encode()) + 1 and r.law == "bytes" and r.grown_shard is None
        assert r.text_crc32 == (None if t is None else zlib.crc32(t.encode()))
        assert place.setdefault(t, r.shard) == r.shard
    for k in range(4):
        own = sorted(r.slot for r in out if r.shard == k)
        assert own == list(range(len(own)))


def test_shard_of_nothing(spark):
    assert sharding.shard(docs(spark, []), 4).count() == 0
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.emit(docs(spark, [])).count() == 0


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    held, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in held]
        left, w = total - sum(held.values()), sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * left > 3 * sizes[s] * w]
        if not over:
            return held | {s: weight[s] * left / w for s in free}
        held |= {s: 3 * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 10, 1000, 100_000]) for s in ["a", "B", "é", "", None, "z", "zz"]}
    if not any(sizes.values()):
        sizes["a"] = 5
    df = spark.createDataFrame([(s, n // 2) for s, n in sizes.items()] + [(s, n - n // 2) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)


def test_mix_counts_and_reruns(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 40)) + " \t", rng.choice(["a", "b", None])) for i in range(3000)]
    rows += [(None, None, "a"), (1, " ", "b")]
    d = docs(spark, rows)
    a, b = (sorted(map(tuple, mixing.mix(x).collect()), key=str) for x in (d, d.repartition(3)))
    assert a == b
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").replace("\t", " ").split(" ")) - (t or "").replace("\t", " ").split(" ").count("")
    for r in mixing.mix(d).groupBy("source_size", "target").sum("taken", "size").collect():
        assert r["sum(size)"] == r.source_size in size.values()
        assert abs(r["sum(taken)"] - r.target) < 0.01 * r.target
    assert all(r.taken <= 3 * r["size"] for r in mixing.mix(d).collect())


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_taken_words_are_near_the_targets(spark, sf):
    path = f"/root/testdata/{sf}"
    if not os.path.isdir(path):
        pytest.skip("the driver's tables are not here")
    rows = mixing.mix(table(spark, path, "documents")).groupBy("source_size", "target").sum("taken").collect()
    assert rows and all(abs(r["sum(taken)"] / r.target - 1) < 0.05 for r in rows)


def test_emit_repeats_rows(spark):
    d = docs(spark, [(i, "w w", "a" if i % 10 else "b") for i in range(200)])
    taken = {r.doc_id: r.taken // 2 for r in mixing.mix(d).collect()}
    out = mixing.emit(d)
    assert out.columns == d.columns
    n = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert n == {i: k for i, k in taken.items() if k}


@pytest.mark.parametrize("hot", [(12_000,), (9_000, 8_000), (900, 40)])
def test_hot_texts_leave_the_others_balanced(spark, hot):
    """Texts of most rows have shards to themselves; the rest is spread evenly over all other shards; the SQL agrees."""
    import duckdb

    rng = random.Random(3)
    rows = [(f"t{rng.randrange(10**9)}", "s") for _ in range(3000)] + [("hot" * (k + 1), "s") for k, n in enumerate(hot) for _ in range(n)]
    df = docs(spark, [(i, t, s) for i, (t, s) in enumerate(rows)])
    got = sharding.shard(df, 16).collect()
    size, of = {}, {}
    for r in got:
        size[r.shard] = size.get(r.shard, 0) + r.size
        of.setdefault(rows[r.doc_id][0], set()).add(r.shard)
    assert set(size) == set(range(16)) and all(len(v) == 1 for v in of.values())
    alone = {next(iter(of["hot" * (k + 1)])) for k, n in enumerate(hot) if n > 500}
    others = [v for k, v in size.items() if k not in alone]
    assert len(alone) == sum(n > 500 for n in hot) and max(others) < 1.2 * sum(others) / len(others) and min(others) > 0.7 * sum(others) / len(others)
    pdf = df.select("doc_id", "text").toPandas()
    con = duckdb.connect()
    con.register("documents", pdf)
    want = con.sql(sharding.ORACLE_SQL).fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


def test_all_texts_outsized(spark):
    df = docs(spark, [(i, "x" * (1 << i), "s") for i in range(12)])
    assert len({r.shard for r in sharding.shard(df, 16).collect()}) == 12
