"""Vector codes, packing and resampling against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from lunaria.llm import packing, resampling, vectorcodes

# ------------------------------------------------------------------ vector codes


def brute_codes(rows, parts=8, k=16, rounds=6):
    """{vec_id: (code, error, label_error, digest)} by plain searches in whole numbers."""
    fine = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], t) for i, v, t in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, errors = {}, Counter()
    for width in {len(v) for _, v, _ in fine}:
        own = sorted((r for r in fine if len(r[1]) == width), key=lambda r: (r[0] is None, r[0], r[1]))
        cut = [p * width // parts for p in range(parts + 1)]
        books = [[v[cut[p] : cut[p + 1]] for _, v, _ in own[:k]] for p in range(parts)]
        far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
        near = lambda p, v: min(range(len(books[p])), key=lambda j: (far(books[p][j], v[cut[p] : cut[p + 1]]), j))
        for _ in range(rounds):
            for p in range(parts):
                given = [near(p, v) for _, v, _ in own]
                for j in set(given):
                    mine = [v[cut[p] : cut[p + 1]] for (_, v, _), g in zip(own, given, strict=True) if g == j]
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
        digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for i, v, t in own:
            code = [near(p, v) for p in range(parts)]
            error = sum(far(books[p][c], v[cut[p] : cut[p + 1]]) for p, c in enumerate(code))
            errors[t] += error
            out.setdefault(i, []).append(("".join(f"{c:02x}" for c in code), error, t, digest))
    return sorted((i is None, i or 0, c, e, errors[t], d) for i, found in out.items() for c, e, t, d in found)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, t, "x", 0.0) for i, v, t in rows], "vec_id long, embedding array<float>, label int, code string, error double")


def got_codes(df):
    return sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vectorcodes.encode(df).collect())


@pytest.mark.parametrize("grid", [None, 4])
def test_codes_as_by_plain_search(spark, monkeypatch, grid):
    """Random vectors, and vectors on a coarse grid, where ties and equal entries abound."""
    monkeypatch.setattr(vectorcodes, "CELLS", 500)
    rng = random.Random(1)
    value = (lambda: rng.gauss(0, 1)) if grid is None else (lambda: rng.randrange(-grid, grid) / 4096)
    rows = [(i * 3, [value() for _ in range(24)], rng.choice([0, 1, None])) for i in range(300)]
    assert got_codes(vectors(spark, rows).repartition(3)) == brute_codes(rows)


def test_odd_vectors(spark):
    rng = random.Random(2)
    row = lambda i, n, t=0: (i, [rng.uniform(-2, 2) for _ in range(n)], t)
    rows = [row(i, 16, i % 2) for i in range(40)] + [row(100 + i, 11) for i in range(20)] + [row(200 + i, 3, None) for i in range(5)] + [(300, [], 1), (301, [], 1)]
    rows += [(400, None, 0), (401, [None] * 16, 0), (402, [float("nan")] * 16, 0), (403, [float("-inf")] * 16, 0), row(None, 16), rows[5], rows[5], (rows[6][0], rows[7][1], 0)]
    assert got_codes(vectors(spark, rows)) == brute_codes(rows)


def test_few_and_no_vectors(spark):
    rows = [(i, [float(i)] * 8, 0) for i in range(5)]
    assert got_codes(vectors(spark, rows)) == brute_codes(rows)
    assert got_codes(vectors(spark, [])) == []
    with pytest.raises(ValueError):
        vectorcodes.compress(vectors(spark, rows), entries=300)


def test_huge_components_are_held(spark):
    rows = [(i, [3e38 * (-1) ** i] * 16, i % 2) for i in range(20)]
    found = vectorcodes.encode(vectors(spark, rows)).collect()
    assert len(found) == 20 and all(r.error == 0 for r in found)


def test_bounds_spare_distances_and_never_lie():
    """Over many rounds of moving entries, bounds as stored hold, and most distances are not measured."""
    rng = np.random.default_rng(3)
    x = rng.integers(-9000, 9000, (2000, 8)) + 4000 * rng.integers(0, 5, (2000, 1))
    book = vectorcodes.Book(x[:16].copy())
    own, upper, lower, _ = vectorcodes.first_assigned(x, book)
    measured = []
    for _ in range(12):
        sums = {int(j): (int((own == j).sum()), x[own == j].sum(0).tolist()) for j in np.unique(own)}
        book = book.next(sums)
        stored = vectorcodes._up32(upper[:, None])[:, 0].astype(float), vectorcodes._from16(vectorcodes._down16(lower))
        own, upper, lower, n = vectorcodes.assigned(x, book, own, *stored)
        d = np.sqrt(((x[:, None] - book.entries[None]) ** 2).sum(2).astype(float))
        assert (own == ((x[:, None] - book.entries[None]) ** 2).sum(2).argmin(1)).all()
        assert (upper >= d[np.arange(len(x)), own]).all() and (lower <= d).all()
        measured.append(n)
    assert measured[-1] < len(x) * 16 * 0.4


def test_codes_can_be_decoded(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.25, -0.5, 1.0]) for _ in range(8)], 0) for i in range(60)]
    done = vectorcodes.compress(vectors(spark, rows))
    back = {r.vec_id: r.embedding for r in done.decoded().collect()}
    assert all(back[i] == v for i, v, _ in rows)  # one component a part and three values: no loss


# ------------------------------------------------------------------ packing

TEXTS = ["", None, "One two  three.", "don't\n\n  stop\t\tnow  ", "ünïcödé Straße 北京市 ひらがな 한국어 ١٢٣ <|endoftext|> x", "a" * 5000, " " * 3000 + "end", "wörter " * 900, "՘౜\U0001f600 odd", "\x1c\x1d\x85\xa0 blanks"]


def reference_ids(text):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.VOCABULARY)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, 0]


def test_both_tokenizers_agree_on_every_character_named_alike():
    fast, slow = packing.tokeniser(), packing.tokeniser(ranks=None)
    named = re.compile(f"[{packing.ALIKE}]")
    chars = [c for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if named.match(c)]
    assert len(chars) > 30_000
    for at in range(0, len(chars), 200):
        text = "".join(f"a{c}1{c}-{c} {c}{c}\n{c}" for c in chars[at : at + 200])
        assert fast(text).tolist() == slow(text).tolist()


@pytest.mark.parametrize("length", [7, 64, 1024])
def test_pieces_cut_the_stream(spark, monkeypatch, length):
    monkeypatch.setattr(packing, "CHARS", 2000)
    rows = [(i if i % 9 else None, t) for i, t in enumerate(TEXTS * 4)]
    docs = spark.createDataFrame([(i, t, 5, "s") for i, t in rows], "doc_id long, text string, start int, ids string").repartition(3)
    made = [r.asDict() for r in packing.pack(docs, length).collect()]
    stream = sorted(made, key=lambda p: (p["sequence_id"], p["offset"]))
    at = 0
    for p in stream:  # the pieces fill the sequences without gaps
        assert p["sequence_id"] * length + p["offset"] == at and 1 <= p["length"] <= length - p["offset"]
        at += p["length"]
    wanted = Counter((i, tuple(reference_ids(t))) for i, t in rows)
    assert at == sum(len(ids) * n for (_, ids), n in wanted.items())
    held, k = Counter(), 0
    while k < len(stream):  # documents follow each other whole
        total, n, own = stream[k]["doc_tokens"], 0, []
        while n < total:
            assert stream[k]["start"] == n
            own.append((stream[k]["length"], stream[k]["ids_crc32"]))
            n, k = n + stream[k]["length"], k + 1
        assert n == total
        held[stream[k - 1]["doc_id"], tuple(own)] += 1
    for (i, own), n in held.items():  # and their pieces hold their ids
        fits = [ids for (j, ids) in wanted if j == i and len(ids) == sum(m for m, _ in own)]
        crc = lambda ids: tuple((m, zlib.crc32(np.array(ids[a : a + m], "<u4").tobytes())) for a, m in zip(np.cumsum([0, *[m for m, _ in own]])[:-1], [m for m, _ in own], strict=True))
        assert any(crc(ids) == own for ids in fits) and n >= 1


@pytest.mark.parametrize(("length", "partitions"), [(16, 1), (16, 5), (1024, 4)])
def test_sequences_are_whole(spark, length, partitions):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 2)], "doc_id int, text string").repartition(partitions)
    stream = packing.Stream(docs, length)
    pieces = sorted(stream.pieces().collect(), key=lambda p: (p.sequence_id, p.offset))
    flat = b"".join(bytes(p.ids) for p in pieces)
    made = sorted(stream.sequences().collect(), key=lambda s: s.sequence_id)
    assert [s.sequence_id for s in made] == list(range(len(made)))
    assert b"".join(bytes(s.ids)[: 4 * s.n_tokens] for s in made) == flat
    for s in made:
        n = len(s.ids) // 4
        assert n == length or (s is made[-1] and n == s.n_tokens and n & (n - 1) == 0)
        assert not any(bytes(s.ids)[4 * s.n_tokens :])


def test_nothing_to_pack(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert packing.pack(none).collect() == [] and packing.sequences(none).collect() == []
    one = spark.createDataFrame([({"a": 1}, None)], "doc_id struct<a:int>, text string")
    assert [(r.doc_id.a, r.length, r.doc_tokens) for r in packing.pack(one).collect()] == [(1, 1, 1)]


# ------------------------------------------------------------------ resampling


def brute_sample(docs, target, orders=2, buckets=10_000, percent=25, least=20):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, orders + 1) for i in range(len(w) - n + 1)]

    own, goal = [(i, *features(t)) for i, t in docs], Counter(b for t in target for b in features(t)[1])
    count = Counter(b for _, _, f in own for b in f)
    s, t = sum(count.values()), sum(goal.values())
    gain = {b: math.floor(1000 * math.log((goal[b] + 1) * (s + buckets) / ((n + 1) * (t + buckets)))) for b, n in count.items()}
    rows = []
    for i, words, f in own:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    drawn = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    place = {id(r): k + 1 for k, r in enumerate(drawn[: len(drawn) * percent // 100])}
    return sorted((r[0] is None, r[0] or 0, *r[1:4], place.get(id(r), 0)) for r in rows)


def some_docs(n, seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Ünter", "STRASSE", "straße", "x1y2", "日本"]
    return [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 2, 19, 20, 21, 90]))) if i % 17 else rng.choice([None, "", " .,-!"])) for i in range(n)]


@pytest.mark.parametrize(("orders", "block"), [(2, 2048), (2, 5), (1, 3), (3, 4), (3, 1)])
def test_sample_as_by_plain_counts(spark, monkeypatch, orders, block):
    """Blocks shorter than n-grams give what whole documents do."""
    monkeypatch.setattr(resampling, "BLOCK", block)
    rows, target = some_docs(160), ["w1 w2 w3 w1", None, "", "straße, W7!"]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, row int, b1 int").repartition(3)
    made = resampling.importance(docs, spark.createDataFrame([(t,) for t in target], "text string"), orders).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_features, r.weight, r.score, r["rank"] or 0) for r in made) == brute_sample(rows, target, orders)


def test_sample_of_odd_rows(spark):
    """Rows that repeat compete each by themselves; a null id hashes as an empty text; empty tables."""
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, text), (3, text), (3, text), (3, text), (3, text), (4, None), (4, "a b"), (None, None)]
    goal = spark.createDataFrame([], "text string")
    made = resampling.importance(spark.createDataFrame(rows, "doc_id long, text string"), goal).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_features, r.weight, r.score, r["rank"] or 0) for r in made) == brute_sample(rows, [])
    assert resampling.importance(spark.createDataFrame([], "doc_id long, text string"), goal).collect() == []


def test_resample_gives_documents(spark):
    rows = some_docs(120)
    docs = spark.createDataFrame([(i, t, i * 2) for i, t in rows], "doc_id long, text string, extra long")
    goal = spark.createDataFrame([("w1 w2",)], "text string")
    drawn = {r.doc_id for r in resampling.importance(docs, goal).collect() if r["rank"]}
    made = resampling.resample(docs, goal).collect()
    assert {r.doc_id for r in made} == drawn and len(made) == len(drawn) and all(r.extra == 2 * r.doc_id for r in made)
