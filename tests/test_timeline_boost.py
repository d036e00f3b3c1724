"""As-of joins, the cover of intervals, and boosted trees against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest

from lunaria import jobs
from lunaria.errors import DuplicateChannel, LunariaError, RateMismatch
from lunaria.operators import align, boost, timeline

LEFT, RIGHT = "recording_id string, ts_ns long, n int", "recording_id string, ts_ns long, label int, other string"


@pytest.mark.parametrize(("size", "tolerance"), [(1, None), (7, None), (10**6, None), (7, 5)])
def test_asof_as_by_search(spark, size, tolerance):
    rng = random.Random(size)
    left = [(rng.choice("aab"), rng.randrange(-60, 60), k) for k in range(150)] + [("c", 3, 900), (None, 3, 901), ("a", None, 902), ("a", 5, 903), ("a", 5, 903)]
    right = [(rng.choice("aaabd"), rng.randrange(-40, 50), rng.randrange(5), rng.choice(["x", None])) for _ in range(60)] + [(None, 3, 1, "x"), ("a", None, 1, "x")]
    made = timeline.asof_join(spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT), ["label", "other"], size=size, tolerance=tolerance)
    rank = lambda r: (r[1], r[2], r[3] is not None, r[3] or "")

    def wanted(key, t):
        seen = [r for r in right if key is not None and t is not None and r[0] == key and r[1] is not None and r[1] <= t and (tolerance is None or t - r[1] <= tolerance)]
        return max(seen, key=rank)[2:] if seen else (None, None)

    assert sorted(map(tuple, made.collect()), key=repr) == sorted([(*x, *wanted(x[0], x[1])) for x in left], key=repr)


def test_asof_keeps_names_apart(spark):
    with pytest.raises(DuplicateChannel):
        timeline.asof_join(spark.createDataFrame([], LEFT), spark.createDataFrame([], "recording_id string, ts_ns long, n int"), ["n"])


@pytest.mark.parametrize("size", [1, 9, 10**6])
def test_cover_as_by_counting(spark, size):
    rng = random.Random(size)
    parts = [(rng.choice("ab"), s, s + rng.randrange(0, 12)) for s in (rng.randrange(-50, 90) for _ in range(30))] + [("a", 5, 5), ("b", None, 4), ("c", 1, 2), (None, 1, 9)]
    made = sorted(map(tuple, timeline.covered(spark.createDataFrame(parts, "recording_id string, start_ns long, end_ns long"), size=size).collect()))
    for key in "abc":
        own = [(a, b) for k, a, b in parts if k == key and a is not None and a < b]
        mine = [(a, b, n) for k, a, b, n in made if k == key]
        assert mine[0][0] == min(a for a, _ in own) and mine[-1][1] == max(b for _, b in own)
        assert all(x[1] == y[0] and x[2] != y[2] for x, y in zip(mine, mine[1:], strict=False))
        assert all(n == sum(p <= t < q for p, q in own) for a, b, n in mine for t in range(a, b))


def test_concatenation_moves_times(spark):
    part = lambda t0, n, t: spark.createDataFrame([("a", i, t0 + i * 250_000_000, float(t + i)) for i in range(n)], "recording_id string, sample_idx long, ts_ns long, value double")
    whole = align.concatenate([part(5, 3, 0), part(9_000, 2, 10), part(7, 2, 20)], rates=[4.0, 4.0, 4.0]).orderBy("sample_idx").collect()
    assert [(r.ts_ns - 5) // 250_000_000 for r in whole] == list(range(7)) and [r.value for r in whole] == [0, 1, 2, 10, 11, 20, 21]
    with pytest.raises(RateMismatch):
        align.concatenate([part(5, 3, 0), part(9, 2, 10)], rates=[4.0, 8.0])
    assert [r.ts_ns for r in align.concatenate([part(5, 1, 0), part(9, 1, 10)]).orderBy("sample_idx").collect()] == [5, 9]


# ------------------------------------------------------------------ boosted trees


def table(spark, n=400, noise=0.0, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    y = np.where(x[:, 0] > 0.3, "N2", np.where(x[:, 1] > 0, "W", "REM"))
    y = np.where(rng.random(n) < noise, rng.choice(["N2", "W", "REM"], n), y)
    rows = [(int(i % 40), *map(float, r), str(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    rows[3] = (3, None, float("nan"), 0.0, 0.0, "W")
    return spark.createDataFrame([*rows, (1, 0.0, 0.0, 0.0, 0.0, None)], "subj int, a double, b double, c double, d double, stage string"), x, y


NAMES = ["a", "b", "c", "d"]


def test_histograms_and_gains_as_by_hand(spark):
    """Every split of a second level, gradients from the scores of a first round."""
    df, *_ = table(spark)
    own = df.where("stage is not null").withColumns({"w": boost.F.col("subj") % 3 + 1.0, "held": boost.F.col("subj") == 5})
    edges = boost.quantile_edges(own.where("not held"), NAMES, 6)
    rows = boost._rows(own, NAMES, "stage", "w", "held", ["N2", "REM", "W"], edges)
    tree = lambda f, b: boost.Tree([f, -1, -1], [b, 0, 0], [0.0, 0.4, -0.7])
    rows = rows.mapInArrow(boost._added([tree(0, 2), tree(1, 1), tree(2, 3)]), boost.ROWS)
    grown = [tree(3, 2), tree(0, 1), boost.Tree([-1] * 3, [0] * 3, [0.0] * 3)]
    got = boost.gains(boost.histograms(rows, grown, 1, 4, 6), 1.0)
    data = [(np.frombuffer(r.x, np.uint8), r.y, r.w, np.frombuffer(r.s, np.float64)) for r in rows.where("not held").collect()]
    for k in range(3):
        for node in range(2):
            for f in range(4):
                for b in range(6):
                    sums = np.zeros((2, 2))
                    for x, y, w, s in data:
                        t = grown[k]
                        if t.feature[0] < 0 or (x[t.feature[0]] > t.bin[0]) != node:
                            continue
                        p = (np.exp(s) / np.exp(s).sum())[k]
                        sums[int(x[f] > b)] += (w * (p - (y == k)), w * p * (1 - p))
                    whole = sums.sum(0)
                    want = sum(g**2 / (h + 1) for g, h in sums) - whole[0] ** 2 / (whole[1] + 1)
                    assert got[k, node, f, b] == pytest.approx(want, abs=1e-9)


def test_learns_and_stops_early(spark, tmp_path):
    clean, x, y = table(spark, 600)
    model = boost.train(clean, NAMES, "stage", "subj", trees=40, depth=3, rate=0.4, bins=16, patience=3)
    fresh, _, truth = table(spark, 300, seed=1)
    got = [r.guess for r in model.predicted(fresh.where("stage is not null")).collect()]
    assert np.mean(np.array(got) == truth) > 0.93 and model.classes == ["N2", "REM", "W"]
    assert all(b <= a for a, b in zip([t for t, _ in model.losses], [t for t, _ in model.losses][:1], strict=False))
    model.save(spark, str(tmp_path / "m"))
    again = boost.Booster.load(spark, str(tmp_path / "m"))
    assert [r.guess for r in again.predicted(fresh.where("stage is not null")).collect()] == got
    random_labels, *_ = table(spark, 300, noise=1.0, seed=2)
    stopped = boost.train(random_labels, NAMES, "stage", "subj", trees=40, depth=3, rate=0.5, bins=16, patience=3)
    held = [v for _, v in stopped.losses]
    assert len(held) < 40 and len(held) - stopped.rounds == 3 and held[stopped.rounds - 1] == min(held)


def test_class_weights(spark):
    """Where classes cannot be told apart, the weightier one is guessed."""
    df = spark.createDataFrame([(i, 0.0, "a" if i % 3 else "b") for i in range(90)], "subj int, x double, stage string")
    guess = lambda w: {r.guess for r in boost.train(df, ["x"], "stage", "subj", w, trees=5, held=0.0).predicted(df).collect()}
    assert guess(None) == {"a"} and guess({"b": 5.0}) == {"b"}
    with pytest.raises(LunariaError):
        boost.train(df.where("stage = 'z'"), ["x"], "stage", "subj")
    with pytest.raises(LunariaError):
        boost.train(df, ["x"], "stage", "subj", bins=1)


def test_job_trains_a_booster(spark, tmp_path):
    df, *_ = table(spark, 200)
    whole = df.where("stage is not null").select("subj", boost.F.when(boost.F.col("subj") < 8, "test").otherwise("train").alias("set"), *[boost.F.col(c).alias(f"eeg_{c}") for c in NAMES], "stage")
    whole.write.parquet(str(tmp_path / "f"))
    report = jobs.train_stages(spark, str(tmp_path / "f"), ["eeg_"], str(tmp_path / "m"), trees=8, depth=3, boosted=True).collect()
    assert [r.label for r in report] == ["N2", "REM", "W"] and sum(r.support for r in report) == 40 and min(r.f1 for r in report) > 0.6
