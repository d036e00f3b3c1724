"""Top-k search, Jaccard components and decontamination against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from lunaria.llm import components, decontaminate, jaccard, topk
from lunaria.llm.common import text_chunks

V = "vec_id long, embedding array<float>, label int"


def brute_topk(rows, k=5, every=50):
    fine = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in fine if i != q and len(b) == len(a))
            out += [(q, r + 1, i, -n) for r, (n, i) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize(("shard_rows", "part"), [(16, (2, 5)), (8192, (512, 8192)), (8192, (3, 7))])
def test_topk(spark, monkeypatch, shard_rows, part):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "SLICE", part)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "FAN", 4)
    rng = random.Random(0)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.0, rng.random()]) for _ in range(4)]) for i in range(0, 420, 1)]
    rows += [(1001, None), (1050, [1.0, None, 0.0, 0.0]), (1100, [float("nan"), 0.0, 0.0, 0.0]), (1150, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0, 1.0, 1.0, 1.0]), (1200, []), (1300, []), (1301, []), (1250, [1.0, 2.0]), (1251, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], V).withColumnRenamed("label", "score")
    got = sorted(map(tuple, topk.search(df).collect()))
    assert got == brute_topk(rows)


def test_topk_repeats_large_and_few(spark):
    rows = [(0, [3e38, 1.0]), (1, [3e38, 1.0]), (2, [-3e38, 1.0])]
    got = sorted(map(tuple, topk.search(spark.createDataFrame([(i, v, 0) for i, v in rows], V)).collect()))
    assert [(q, r, i) for q, r, i, _ in got] == [(0, 1, 1), (0, 2, 2)] and got[0][3] == (1 << 63) - 1
    twice = [(0, [1.0], 0), (0, [1.0], 0), (1, [1.0], 0), (1, [1.0], 0)]
    got = sorted(map(tuple, topk.search(spark.createDataFrame(twice, V)).collect()))
    assert got == [(0, 1, 1, 65536), (0, 2, 1, 65536)]
    assert topk.search(spark.createDataFrame([], V)).count() == 0


def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingles(text, n):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", fold(text or "")) if x]
    return frozenset(tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute_components(rows, n, percent):
    own = {i: shingles(t, n) for i, t in rows if i is not None}
    label = {i: i for i in own}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in itertools.combinations(sorted(own), 2):
        s, t = own[a], own[b]
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    return {i: (len(own[i]), find(i)) for i in own}


def family(rng, base, edits):
    w = base.split()
    for _ in range(edits):
        at = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[at] = f"new{rng.randrange(999)}"
        elif kind == 1:
            w.insert(at, f"in{rng.randrange(999)}")
        elif len(w) > 2:
            del w[at]
    return " ".join(w)


@pytest.mark.parametrize(("n", "percent", "seed"), [(4, 85, 0), (5, 80, 1), (1, 60, 2)])
def test_components(spark, n, percent, seed):
    rng = random.Random(seed)
    texts = []
    for size in (1, 2, 3, 4, 5, 8, 12, 20, 40, 90, 200, 400):
        for _ in range(2):
            base = " ".join(f"w{rng.randrange(40 if size < 20 else 5000)}" for _ in range(size))
            texts += [base, base.upper()] + [family(rng, base, rng.randrange(1, max(2, size // 25 + 2))) for _ in range(6)]
    chain = " ".join(f"c{i}" for i in range(100))
    for _ in range(8):  # neighbours link, ends do not
        chain = family(rng, chain, 1)
        texts.append(chain)
    texts += ["", None, "   ", "\t\n"]
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([*rows, (None, "w1 w2 w3"), rows[0], rows[1]], "doc_id long, text string").withColumnsRenamed({}).selectExpr("*", "1 as label", "2 as sig", "3 as id")
    out = jaccard.jaccard_components(df, n, percent).collect()
    want = brute_components(rows, n, percent)
    assert len(out) == len(rows) + 3
    for r in out:
        assert (r.n_shingles, r.component_id) == (want[r.doc_id] if r.doc_id is not None else (max(1, 3 - n + 1), None))


def test_components_through_tiles(spark, monkeypatch):
    for name, value in (("TILE", 4), ("UNIT", 2), ("SAMPLE", 2), ("COMMON_LEAST", 2)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(4)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(120))
    rows = [(i, family(rng, base, rng.randrange(0, 6))) for i in range(60)]
    out = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    want = brute_components(rows, 4, 85)
    assert {r.doc_id: r.component_id for r in out} == {i: c for i, (_, c) in want.items()}


def test_many_copies_cost_one_link_each(spark, monkeypatch):
    """A group that is dealt to many salts merges by about one verification a member and turn."""
    monkeypatch.setattr(jaccard, "TILE", 10)
    counts, verified = [], jaccard._Join.verified

    def counted(self, pairs):
        counts.append(pairs.count())
        return verified(self, pairs)

    monkeypatch.setattr(jaccard._Join, "verified", counted)
    rng = random.Random(7)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(150))
    rows = [(i, family(rng, base, 1)) for i in range(200)]
    out = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 4, 85).collect()
    assert {r.component_id for r in out} == {0}
    assert sum(counts) < 5 * len(rows)  # all pairs would be 19,900


def test_components_by_deletions(spark):
    """Planned for large bands, small documents are found by one-deletion neighbourhoods."""
    large = 10**9
    chosen = [jaccard.allocate(a, b, large, 85) for a, b in itertools.pairwise(jaccard.bands(60)) if a >= 9]
    assert sum(p[1] > 0 for p in chosen) >= 3  # segments with v = 2
    rng = random.Random(9)
    rows = []
    for size in (12, 16, 22, 30, 40, 52):
        for _ in range(3):
            base = " ".join(f"w{rng.randrange(3000)}" for _ in range(size))
            rows += [family(rng, base, rng.randrange(0, 1 + size // 14)) for _ in range(6)]
    rows = list(enumerate(rows))
    out = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 1, 85, large).collect()
    want = brute_components(rows, 1, 85)
    assert {r.doc_id: r.component_id for r in out} == {i: c for i, (_, c) in want.items()}
    assert len({c for _, c in want.values()}) < len(rows) - 30


@pytest.mark.parametrize(("unit", "block", "sample"), [(200, 500, 64), (2, 4, 1)])
def test_join_finds_all_links(spark, monkeypatch, unit, block, sample):
    for name, value in (("UNIT", unit), ("BLOCK", block), ("SAMPLE", sample), ("COMMON_LEAST", 8), ("TILE", 10 * unit)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(6)
    texts = []
    for size in (8, 60, 120, 240):
        for _ in range(2):
            base = " ".join(f"w{rng.randrange(3000)}" for _ in range(size))
            texts += [base, base.upper()] + [family(rng, base, rng.randrange(0, 1 + size // 60 + (size > 8))) for _ in range(14)]
    rng.shuffle(texts)
    rows = [(i * 3, t) for i, t in enumerate([*texts, "", None])]
    df = spark.createDataFrame([*rows, (None, texts[0]), rows[1]], "doc_id long, text string")
    own = {i: shingles(t, 4) for i, t in rows}
    rep = {s: min(i for i in own if own[i] == s) for s in own.values()}
    links = [(a, b) for a, b in itertools.combinations(sorted(own), 2) if own[a] and own[b] and 100 * len(own[a] & own[b]) >= 85 * len(own[a] | own[b])]
    want = {(a, b) for a, b in links if own[a] != own[b] and a == rep[own[a]] and b == rep[own[b]]}
    got = [tuple(r) for r in jaccard.jaccard_links(df, 4, 85).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 80
    out = jaccard.jaccard_join(df, 4, 85).collect()
    label = brute_components(rows, 4, 85)
    assert len(out) == len(rows) + 2
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.n_links is None
        else:
            assert (r.n_shingles, r.component_id, r.n_links) == (*label[r.doc_id], sum(r.doc_id in p for p in links))


def test_components_of_nothing(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    few = spark.createDataFrame([(3, None), (5, "")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.jaccard_components(few).collect())) == [(3, 0, 3), (5, 0, 5)]


def test_join_of_nothing(spark):
    assert jaccard.jaccard_join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    few = spark.createDataFrame([(3, None), (5, "")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.jaccard_join(few).collect())) == [(3, 0, 3, 0), (5, 0, 5, 0)]


@pytest.mark.parametrize("plan", [(5, 0, 0), (3, 1, 0), (1, 2, 0), (7, 0, 1), (5, 1, 1), (0, 3, 0)])
def test_linked_sets_share_a_signature(plan):
    """The pigeonhole: whatever the allocation, sets within H share one."""
    one, two, r = plan
    h = one + 2 * two - 2 * r - 1
    rng = np.random.default_rng(sum(plan))
    for _ in range(300):
        s = rng.integers(0, 1 << 63, rng.integers(1, 30)).astype(np.uint64)
        gone = rng.integers(0, min(h, len(s) - 1) + 1)
        t = np.concatenate([s[gone:], rng.integers(0, 1 << 63, h - gone).astype(np.uint64)])
        a, b = (set(jaccard.signatures(np.unique(x), 3, plan).tolist()) for x in (s, t))
        assert a & b


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_linked_sets_share_first_shingles(percent):
    """Of the first shingles by hash, linked sets have as many in common as either must have to go on."""
    rng = np.random.default_rng(percent)
    for _ in range(400):
        same = rng.integers(0, 1 << 63, rng.integers(1, 200)).astype(np.uint64)
        most = len(same) * (100 - percent) // percent  # of the union, what is not in both
        left, right = np.sort(rng.integers(0, most + 1, 2))
        a, b = (np.unique(np.concatenate([same, rng.integers(0, 1 << 63, k).astype(np.uint64)])) for k in (left, right - left))
        both = len(np.intersect1d(jaccard.first_by_hash(a, percent), jaccard.first_by_hash(b, percent)))
        assert 100 * len(same) >= percent * len(np.union1d(a, b))
        assert both >= jaccard.least_shared(len(a), percent) and both >= jaccard.least_shared(len(b), percent)


@pytest.mark.parametrize("least", [64, 2])
def test_sets_that_share_little_get_no_signatures(spark, monkeypatch, least):
    """Only texts that share more shingles than a line with others are indexed, whether shingles are common or not."""
    for name, value in (("SAMPLE", 1), ("COMMON_LEAST", least)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(3)
    fresh = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))
    line = "one line of some words that many of these texts hold somewhere"
    alone = [(i, f"{fresh()} {line} {fresh()}") for i in range(60)]
    pairs = [(100 + i, family(rng, t, 2)) for i, t in alone[:5]]
    join = jaccard._Join(spark.createDataFrame([*alone, *pairs, (201, None)], "doc_id long, text string"), 4, 85)
    links = {tuple(r)[:2] for r in join.links(False).collect()}
    assert links == {(i, 100 + i) for i in range(5)}
    assert {r.doc_id for r in join.texts.collect()} == {*range(5), *range(100, 105)}


def test_sketch_bounds_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(100):
        s = rng.integers(0, 1 << 63, 50).astype(np.uint64)
        t = np.concatenate([s[rng.integers(0, 20) :], rng.integers(0, 1 << 63, rng.integers(0, 9)).astype(np.uint64)])
        a, b = (np.frombuffer(jaccard.sketch(np.unique(x)), np.uint64) for x in (s, t))
        while len(a) > len(b):
            a = a[: len(a) // 2] ^ a[len(a) // 2 :]
        while len(b) > len(a):
            b = b[: len(b) // 2] ^ b[len(b) // 2 :]
        assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(s, t))


def test_allocation_uses_deletions_where_they_pay():
    assert any(jaccard.allocate(a, a + a // 2, 10**9, 85)[1] for a in (10, 20, 40))
    assert jaccard.allocate(2, 4, 100, 85) is None


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (200, 201), (201, 200), (None, 3)] + [(500 + rng.randrange(30), 500 + rng.randrange(30)) for _ in range(20)]
    got = {r.id: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[201] == 200 and got[100] == 100
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, j in itertools.product(range(len(a)), range(len(b))):
        h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return h.max()


def test_alignment_score():
    rng = np.random.default_rng(0)
    items, passages = rng.integers(0, 5, (20, 9)).astype(np.uint64), rng.integers(0, 5, (20, 25)).astype(np.uint64)
    lengths = rng.integers(1, 26, 20)
    got, _ = decontaminate.align(items, passages, lengths)
    assert got.tolist() == [smith_waterman(a, b[:n]) for a, b, n in zip(items, passages, lengths, strict=True)]


def words(rng, n, vocabulary=400):
    return " ".join(f"w{int(rng.expovariate(1 / 60)) % vocabulary}" for _ in range(n))


def test_decontamination(spark):
    rng = random.Random(0)
    items = [(i, words(rng, rng.randrange(15, 60))) for i in range(20)] + [(90, None), (91, ""), (92, "short one"), (None, words(rng, 20))]
    clean = [words(rng, rng.randrange(5, 300)) for _ in range(150)]
    rows, planted = [(i, t) for i, t in enumerate(clean)], set()
    for k in range(60):
        item, text = items[rng.randrange(20)]
        w = text.split()
        if k % 3 == 1:  # edited: about one word in eight
            for at in range(rng.randrange(8), len(w), 8):
                w[at] = f"edit{at}"
        if k % 3 == 2:
            w = [x.upper() + "," for x in w]
        around = clean[rng.randrange(150)].split()
        at = rng.randrange(len(around) + 1)
        rows.append((1000 + k, " ".join(around[:at] + w + around[at:])))
        planted.add((1000 + k, item))
    rows += [(5000, None), (5001, ""), (5002, "a SHORT one, here"), (5003, "a short, long one")] + [(6000 + i, items[0][1]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as item_id", "1 as score")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == planted | {(5002, 92)} | {(6000 + i, items[0][0]) for i in range(200)}
    flagged = decontaminate.with_flag(df, bench).collect()
    assert {r.doc_id for r in flagged if r.contaminated} == {d for d, _ in got} and len(flagged) == len(rows)
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(df.limit(0), bench).count() == 0


def test_repeated_sentence_in_a_long_document():
    """64 items share a sentence that one document repeats to 60,000 words: bounded time and memory."""
    import time
    import tracemalloc

    rng = random.Random(3)
    shared = words(rng, 8)
    block = decontaminate.Block(list(range(64)), [f"{words(rng, 15)} {shared} {words(rng, 15)}" for _ in range(64)])
    block.keep_rare(np.zeros(len(block.values)), 1000)
    hidden = " ".join(block_text(block, 5, rng))
    text = " ".join([shared] * 7500) + " " + hidden
    (_, _, data, offsets), *_ = text_chunks(pa.array([text]))
    began = time.perf_counter()
    found = block.hits(data, offsets)
    assert time.perf_counter() - began < 2
    tracemalloc.start()
    assert [f[1] for f in block.hits(data, offsets)] == [f[1] for f in found] == [7]
    assert tracemalloc.get_traced_memory()[1] < 50e6
    tracemalloc.stop()


def block_text(block, every, rng):
    """The words of item 7, remade in the test, with one in `every` replaced."""
    rng = random.Random(3)
    shared = words(rng, 8)
    texts = [f"{words(rng, 15)} {shared} {words(rng, 15)}" for _ in range(8)]
    own = texts[7].split()
    for at in range(2, len(own), every + 4):
        own[at] = f"edit{at}"
    return own


def test_recall_against_all_pairs(spark):
    """Every pair that plain Smith-Waterman over whole texts finds, at all rates of edits."""
    rng = random.Random(12)
    items = [(i, words(rng, rng.randrange(12, 40), 2000)) for i in range(12)]
    docs = []
    for k in range(150):
        own = items[k % 12][1].split()
        share = rng.choice([0, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3])
        own = [w for w in (x if rng.random() >= share else rng.choice(["", f"new{rng.randrange(99)}", f"{x} plus"]) for x in own) if w]
        docs.append((k, f"{words(rng, 20, 2000)} {' '.join(own)} {words(rng, 20, 2000)}"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = {(d, i) for d, t in docs for i, s in items if smith_waterman(s.split(), t.split()) >= decontaminate.SIMILARITY * 2 * len(s.split())}
    assert got <= want and len(want) > 100
    recall = len(got) / len(want)
    print("recall", recall, len(want))
    assert recall >= 0.95


def test_items_in_blocks(spark, monkeypatch):
    rng = random.Random(1)
    items = [(i, words(rng, 30)) for i in range(12)]
    df = spark.createDataFrame([(i, t) for i, t in items] * 2, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontaminate.contaminated(df, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    assert sorted(map(tuple, decontaminate.contaminated(df, bench).collect())) == one and len(one) >= 24


def test_long_document_is_searched_whole():
    rng = random.Random(3)
    item = " ".join(f"i{k}" for k in range(20))
    block = decontaminate.Block([7], [item])
    block.keep_rare(np.ones(len(block.values)), 10)
    text = words(rng, 200_000) + " " + item
    (_, _, data, offsets) = next(text_chunks(pa.array([text])))
    assert [(d, i) for d, i, *_ in block.hits(data, offsets)] == [(0, 0)]


@pytest.mark.parametrize("kind", ["inserted", "spread", "both"])
def test_edited_copies_against_plain_alignment(kind):
    rng = random.Random(len(kind))
    for m in (8, 15, 24, 38, 60):
        item = [f"i{k}" for k in range(m)]
        block = decontaminate.Block([7], [" ".join(item)])
        block.keep_rare(np.ones(len(block.values)), 10)
        texts, want = [], []
        for trial in range(25):
            w = list(item)
            if kind != "inserted":
                for at in rng.sample(range(m), rng.randrange(1, max(2, m // 4) + 1)):
                    w[at] = f"edit{at}"
            if kind != "spread":
                at = rng.randrange(m // 3, 2 * m // 3)
                w[at:at] = [f"new{k}" for k in range(int(m * rng.uniform(0.3, 0.9)))]
            if kind == "spread" and m == 8 and trial == 0:
                w = ["i0", "i1", "i2", "X", "i4", "X", "i6", "i7"]
            text = words(rng, 40).split() + w + words(rng, 40).split()
            score = smith_waterman(item, text)
            texts.append(" ".join(text))
            seeded = any(w[k : k + 3] == item[j : j + 3] for k in range(len(w) - 2) for j in range(m - 2))
            want.append(score if score >= decontaminate.SIMILARITY * 2 * m and seeded else None)
        (_, _, data, offsets) = next(text_chunks(pa.array(texts)))
        got = {d: s for d, _, s, *_ in block.hits(data, offsets)}
        assert got == {d: s for d, s in enumerate(want) if s is not None} and got


def brute_rows(rows, n, percent):
    """(doc_id, n_shingles, component_id, n_links) of each row: texts of equal sets are one class, texts of one id one document."""
    def shingles(text):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = [shingles(t) for _, t in rows]
    classes = sorted({s for s in sets if s}, key=sorted)
    docs = {c: {i for (i, _), s in zip(rows, sets, strict=True) if s == c and i is not None} for c in classes}
    linked = {c: [d for d in classes if d is not c and 100 * len(c & d) >= percent * len(c | d)] for c in classes}
    group = {c: k for k, c in enumerate(classes)}
    while True:
        low = {c: min([group[c], *(group[d] for d in classes if d in linked[c] or docs[c] & docs[d])]) for c in classes}
        if low == group:
            break
        group = low
    least = {g: min(i for c in classes if group[c] == g for i in docs[c]) for g in set(group.values()) if any(docs[c] for c in classes if group[c] == g)}
    out = []
    for (i, _), s in zip(rows, sets, strict=True):
        links = None if i is None else len(docs[s]) - 1 + sum(len(docs[d]) for d in linked[s]) if s else 0
        out.append((i, len(s), None if i is None else least[group[s]] if s else i, links))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_ids_with_several_texts(spark, seed):
    """An id's texts are told apart: no link is lost, and they are in one component."""
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(500)}" for _ in range(40)] for _ in range(6)]

    def near():
        t = list(rng.choice(base))
        if rng.random() < 0.6:
            t[rng.choice([0, 1, 38, 39])] = "edit"
        return " ".join(t)

    rows = [(rng.randrange(12) if rng.random() < 0.95 else None, rng.choice([near(), near(), near(), "", None, "two words"])) for _ in range(30)]
    a, b = " ".join(base[0]), " ".join([*base[0][:-1], "changed"])
    rows += [[], [(105, a), (105, "other text of five words"), (103, "other text of five words"), (109, b)], [(201, "x " * 9 + "y"), (201, a), (202, a)], [(-5, a), (-5, b), (-5, "z y x w v u")]][seed]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, jaccard.jaccard_join(df, 4, 85).collect()), key=repr)
    assert got == brute_rows(rows, 4, 85)
    parts = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, 4, 85).collect() if r.doc_id is not None)
    assert parts == sorted(r[:3] for r in got if r[0] is not None)


def test_wide_vectors_get_smaller_tiles(spark, monkeypatch):
    """Tiles are bounded by bytes: at a width of 64 and 4 KB a side, eight rows."""
    monkeypatch.setattr(topk, "TILE_BYTES", 4096)
    seen = []
    real = topk._tiles
    monkeypatch.setattr(topk, "_tiles", lambda k: seen.append(k) or real(k))
    rng = random.Random(7)
    rows = [(i, [rng.random() for _ in range(64)]) for i in range(200)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], V)
    assert sorted(map(tuple, topk.search(df, 5, 10).collect())) == brute_topk(rows, 5, 10) and seen == [5]
