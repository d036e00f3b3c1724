"""Exact n-gram Jaccard join: universe partition, pigeonhole and verification.

A document is its set of distinct word shingles. Two documents link when
100 * |intersection| >= percent * |union|.

1. Texts with equal sets form a class (by a 128-bit fingerprint), which goes on as one: under its smallest
   doc_id, or, where that stands for another class already (an id may have several texts), under a number
   above all ids.
2. Sets that share too little with all others are left out. A set of a shingles lacks at most u of them in
   one that it links with (u is percent's rest of a). So if both sets of a linked pair are ordered by hash,
   each has l common ones among its first u + l (the l-th common one has at most u others before it). Only
   sets go on of whose first u + l shingles l are among the first of another set, with l at least a
   SHARED-th of the size.
3. Sizes are cut into bands. For a band, H is the largest symmetric difference that a linked pair
   whose smaller set lies in the band can have. The universe is hashed into segments, and segment i
   gets v_i = 1 (its subset is indexed) or 2 (its subset and all subsets with one element deleted
   are), so that the v_i sum to H + 1 + 2R. Each document leaves out its R weakest (smallest, hence
   commonest) segments with v_i = 1. In a linked pair at most 2R units are left out by either side,
   so if every remaining segment differed by v_i or more, the difference would exceed H: the pair
   shares a signature. R and the number of segments with v_i = 2 come from a cost model over the
   band's population.
4. Documents that share a signature meet in a group, named by the lowest id that shares it. Parity
   sketches bound their difference from below, so a pair beyond the bound goes at once.
5. The join (jaccard_join, jaccard_links): the pairs that sketches allow cut each group into clusters,
   and in a cluster the sets of all pairs are compared, in blocks of bounded size to which each text is
   sent once. A pair that shares several groups is compared in the first of them. No link is lost.
6. Components alone (jaccard_components): first each member is paired with one leader of its group at
   most; these pairs are verified on the whole texts, and the links give components. Then, in the
   groups of which not all pairs have been tried so, every pair that still lies in two components is,
   and if the sketches allow a link it is verified. Thus g copies cost about g verifications, and no
   link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, cut, cut_at, discard, mix, shingle_set, text_chunks
from .components import components

BAND = 1.5
#: What a chance partner (a sketch comparison) and a row in a chance bucket (shuffled with its sketch)
#: cost beside a signature (made, shuffled, sorted).
PARTNER, MEMBER = 0.01, 10.0
_U = np.uint64


def bands(most: int) -> list[int]:
    """Lower bounds of the size bands up to a size; the last entry is above it."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return out


def allocate(low: int, high: int, population: int, percent: int) -> tuple[int, int, int] | None:
    """(segments with v=1, segments with v=2, R) for sizes low..high-1; None if only equal sets link.

    The cost of a document is its signatures, the chance buckets it lands in and the partners it meets
    there: unrelated documents share a signature mostly where both subsets are empty. A document has
    about Poisson many empty segments, and leaves out R of them.
    """
    h = (high - 1) * (100 - percent) // percent
    if h < 1:
        return None
    size, best = (low + high) / 2, None
    for r in range(0, max(2, h // 8) + 1):
        units = h + 1 + 2 * r
        for two in sorted({0, 1, 2, units // 8, units // 4, units // 2}):
            one = units - 2 * two
            if one < r or two > units // 2:
                continue
            each = size / (one + two)
            share = math.exp(-each)
            mean, p, left = one * share, math.exp(-one * share), 0.0
            for k in range(1, r + 40 + int(3 * mean)):  # the mean of what exceeds r
                p *= mean / k
                left += p * max(0, k - r)
            left += two * share
            crowd = min(1.0, population * share)
            cost = one - r + two * (1 + each) + left * (MEMBER * crowd + PARTNER * population * share)
            if best is None or cost < best[0]:
                best = (cost, one, two, r)
        if r > 8 and best[3] < r - 8:
            break
    return best[1:]


def signatures(shingles: np.ndarray, band: int, plan: tuple[int, int, int]) -> np.ndarray:
    """The signatures of one set under a band's plan."""
    one, two, r = plan
    segments = one + two
    seg = ((shingles >> _U(32)) % _U(segments)).astype(np.int64)
    order = np.argsort(seg, kind="stable")
    values = mix(shingles[order], 3)
    counts = np.bincount(seg, minlength=segments)
    ends = np.cumsum(counts)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    sums = total[ends] - total[ends - counts]
    salt = mix(np.arange(segments, dtype=np.uint64) + _U(band << 32), 5)
    kept = np.arange(one)
    if r:
        kept = np.argsort(counts[:one], kind="stable")[r:]
    out = [mix(sums[kept] + salt[kept], 9)]
    if two:
        first = ends[one] - counts[one] if one < segments else len(values)
        out.append(mix(sums[one:] + salt[one:], 9))
        at = np.repeat(np.arange(one, segments), counts[one:])
        out.append(mix(sums[at] - values[first:] + salt[at], 9))
    return np.concatenate(out)


def sketch(shingles: np.ndarray) -> bytes:
    """Parities of hashed cells, at least two for each shingle (a power of two). Each element of a
    symmetric difference flips one cell, so the cells that differ never outnumber the difference."""
    cells = 64
    while cells < 2 * len(shingles):
        cells *= 2
    odd = np.bincount(((shingles >> _U(17)) & _U(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def first_by_hash(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Of a sorted set as many as a linked set may lack, and a SHARED-th of its size beside."""
    size = len(shingles)
    return shingles[: size * (100 - percent) // 100 + 1 + size // SHARED] if size else shingles


def least_shared(size, percent: int):
    """How many of first_by_hash a set of that size has in common with that of each set it links with
    (whose size is percent of its own at least)."""
    return (size * percent + 99) // 100 // SHARED + 1


def _fingerprints(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                w = Words(data, offsets)
                size, f1, f2, marks = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64), []
                first = []
                for i in range(hi - lo):
                    s = shingle_set(w.hashes[w.doc_first[i] : w.doc_first[i + 1]], n)
                    size[i] = len(s)
                    f1[i] = mix(s, 21).sum(dtype=np.uint64).astype(np.int64)
                    f2[i] = mix(s, 22).sum(dtype=np.uint64).astype(np.int64)
                    marks.append(sketch(s))
                    first.append(first_by_hash(s, percent))
                ends = pa.array(np.cumsum([0, *map(len, first)]), pa.int32())
                firsts = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(first).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(size), pa.array(f1), pa.array(f2), pa.array(marks, pa.binary()), batch.column(2)[lo:hi], firsts], ["doc_id", "n_shingles", "f1", "f2", "sketch", "h", "first"])

    return run


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Rows sorted by their first columns, as tables of whole groups, with the bounds of the groups of two or more."""

    def bounds(part: pa.Table) -> list[tuple[int, int]]:
        key = [part.column(i).to_numpy() for i in range(keys)]
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
        return [(int(lo), int(hi)) for lo, hi in zip(np.append(0, new), np.append(new, part.num_rows), strict=True) if hi - lo > 1]

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(i).to_numpy() for i in range(keys)]
        last = np.flatnonzero(np.any([k != k[-1] for k in key], axis=0))
        at = int(last[-1]) + 1 if len(last) else 0  # the last group may go on
        if at or (held and any(held[-1].column(i)[-1] != batch.column(i)[0] for i in range(keys))):
            part = pa.Table.from_batches([*held, *([batch.slice(0, at)] if at else [])]).combine_chunks()
            yield part, bounds(part)
            held = []
        held.append(batch.slice(at))
    if held:
        part = pa.Table.from_batches(held).combine_chunks()
        yield part, bounds(part)


def _folded(marks: list[bytes]) -> np.ndarray:
    least = min(map(len, marks))
    out = np.zeros((len(marks), least // 8), np.uint64)
    for i, m in enumerate(marks):
        v = np.frombuffer(m, np.uint64)
        while len(v) > least // 8:
            v = v[: len(v) // 2] ^ v[len(v) // 2 :]
        out[i] = v
    return out


def _coarse(x: np.ndarray) -> list[np.ndarray]:
    """Sketches, before them the same folded to a quarter: what that tells apart needs no look at the whole."""
    q = x.shape[1] // 4
    return [x] if q < 1 else [x[:, :q] ^ x[:, q : 2 * q] ^ x[:, 2 * q : 3 * q] ^ x[:, 3 * q :], x]


def _alike(sketches: list[np.ndarray], n: np.ndarray, i: int, k: np.ndarray, percent: int) -> np.ndarray:
    """Positions in k of the rows whose sketches allow a link with row i."""
    at = np.arange(len(k))
    for x in sketches:
        j = k[at]
        at = at[np.bitwise_count(x[i] ^ x[j]).sum(1, dtype=np.int64) <= (n[i] + n[j]) * (100 - percent) // (100 + percent)]
    return at


class _Sets:
    """Sets of whole numbers, one a row, for the sizes of their intersections. Numbers that one set alone
    holds are left out."""

    def __init__(self, owner: np.ndarray, values: np.ndarray, rows: int):
        u, code, count = np.unique(values, return_inverse=True, return_counts=True)
        keep = count[code] > 1
        self.code, self.at = code[keep], np.searchsorted(owner[keep], np.arange(rows + 1))
        self.mark = np.zeros(len(u), bool)

    def common(self, i: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of set i with others (rows in rising order)."""
        mine = self.code[self.at[i] : self.at[i + 1]]
        if not len(mine) or not len(others):
            return np.zeros(len(others), np.int64)
        self.mark[mine] = True
        size = self.at[others + 1] - self.at[others]
        end = np.cumsum(size)
        if others[-1] - others[0] + 1 == len(others):
            codes = self.code[self.at[others[0]] : self.at[others[-1] + 1]]
        else:
            codes = self.code[np.repeat(self.at[others] - end + size, size) + np.arange(end[-1])]
        hit = np.concatenate([[0], np.cumsum(self.mark[codes])])
        self.mark[mine] = False
        return hit[end] - hit[end - size]


def _earlier(lows: pa.Array, low: int) -> _Sets:
    """Each row's groups before group low: a pair that shares one has met there."""
    owner, v = np.repeat(np.arange(len(lows)), lows.value_lengths().to_numpy()), lows.flatten().to_numpy()
    return _Sets(owner[v < low], v[v < low], len(lows))


def _clusters(percent: int):
    """The rows of groups (low, t1, t2) that may link with a row of their group, with the lowest id that
    is reached by such pairs (cluster). Pairs that have met in an earlier group are not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, bounds in _whole_groups(batches, 3):
            low, t1, t2, ids, size, salt = (part.column(i).to_numpy() for i in range(6))
            rows, cluster = [], []
            for lo, hi in bounds:
                x, n, s, tile = _coarse(_folded(part.column(8)[lo:hi].to_pylist())), size[lo:hi].astype(np.int64), salt[lo:hi], t1[lo] != t2[lo]
                met = _earlier(part.column(7)[lo:hi].combine_chunks(), low[lo])
                rest = np.arange(hi - lo)
                while len(rest) > 1:
                    queue, rest = [int(rest[0])], rest[1:]
                    mine = list(queue)
                    while queue and len(rest):
                        i = queue.pop()
                        ok = np.minimum(n[i], n[rest]) * 100 >= np.maximum(n[i], n[rest]) * percent
                        if tile:
                            ok &= s[rest] != s[i]
                        k = np.flatnonzero(ok)
                        k = k[_alike(x, n, i, rest[k], percent)]
                        k = k[met.common(i, rest[k]) == 0]
                        queue += rest[k].tolist()
                        mine += rest[k].tolist()
                        rest = np.delete(rest, k)
                    if len(mine) > 1:
                        rows.append(lo + np.array(mine))
                        cluster.append(np.full(len(mine), ids[rows[-1]].min()))
            if rows:
                out = part.take(pa.array(np.concatenate(rows))).combine_chunks()
                own = [pa.array(np.concatenate(cluster)), *(out.column(i).combine_chunks() for i in range(8))]
                yield pa.RecordBatch.from_arrays(own, ["cluster", "low", "t1", "t2", "id", "n", "salt", "docs", "lows"])

    return run


def _linked(n: int, percent: int, counted: bool):
    """All links (a, b) of the rows of each block (cluster, low, t1, t2, u1, u2) that have not met in an
    earlier group, by their whole texts; tree marks links that are enough to connect the block. If counted, only the
    latter are written, and one row (a, null) for each row with links: the documents of its partners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, bounds in _whole_groups(batches, 6):
            _, low, t1, t2, u1, u2, ids, size, salt, turn, docs = (part.column(i).to_numpy() for i in range(11))
            for lo, hi in bounds:
                sets = []
                for first, last, data, offsets in text_chunks(part.column(12)[lo:hi]):
                    w = Words(data, offsets)
                    sets += [shingle_set(w.hashes[w.doc_first[k] : w.doc_first[k + 1]], n) for k in range(last - first)]
                own = _Sets(np.repeat(np.arange(hi - lo), [len(s) for s in sets]), np.concatenate(sets), hi - lo)
                met = _earlier(part.column(11)[lo:hi].combine_chunks(), low[lo])
                m, label, a, b, tree = size[lo:hi].astype(np.int64), np.arange(hi - lo), [], [], []
                total, own_docs = np.zeros(hi - lo, np.int64), docs[lo:hi]
                for i in range(hi - lo - 1):
                    k = np.arange(i + 1, hi - lo)
                    ok = np.minimum(m[i], m[k]) * 100 >= np.maximum(m[i], m[k]) * percent
                    if t1[lo] != t2[lo]:
                        ok &= salt[lo + k] != salt[lo + i]
                    if u1[lo] != u2[lo]:
                        ok &= turn[lo + k] != turn[lo + i]
                    k = k[ok]
                    both = own.common(i, k)
                    k = k[(100 * both >= percent * (m[i] + m[k] - both)) & (both > 0)]
                    k = k[met.common(i, k) == 0]
                    if not len(k):
                        continue
                    joined, at = np.unique(label[k], return_index=True)
                    new = np.zeros(len(k), bool)
                    new[at[joined != label[i]]] = True
                    if new.any():
                        label[np.isin(label, joined)] = label[i]
                    total[i] += own_docs[k].sum()
                    total[k] += own_docs[i]
                    if counted:
                        k, new = k[new], new[new]
                    a.append(np.full(len(k), ids[lo + i]))
                    b.append(ids[lo + k])
                    tree.append(new)
                if a:
                    x = [pa.array(np.concatenate(x)) for x in (a, b, tree)]
                    yield pa.RecordBatch.from_arrays([*x, pa.nulls(len(x[0]), pa.int64())], ["a", "b", "tree", "docs"])
                    if counted:
                        k = np.flatnonzero(total)
                        yield pa.RecordBatch.from_arrays([pa.array(ids[lo + k]), pa.nulls(len(k), pa.int64()), pa.array(np.zeros(len(k), bool)), pa.array(total[k])], ["a", "b", "tree", "docs"])

    return run


def _group_pairs(percent: int, leaders: bool):
    """Pairs (a, b) with different labels whose sketches and sizes allow a link, of the groups in rows
    sorted by low, t1, t2.

    With leaders, each member of a group meets the leaders before it until one may be its partner: at
    most a pair a member. A group in which members were left out so (or for their common label) is
    named in a row (low, null); of the others all pairs have been tried. Without leaders all pairs
    are, and in a tile of two salts those with different salts.
    """

    def group(ids: np.ndarray, n: np.ndarray, label: np.ndarray, salt: np.ndarray, tile: bool, marks: list[bytes]) -> tuple[list, list, bool]:
        x, a, b, skipped = _coarse(_folded(marks)), [], [], False

        def near(i: int, j: np.ndarray) -> np.ndarray:
            size = (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent) & (label[j] != label[i])
            k = np.flatnonzero(size)
            size[k] = False
            size[k[_alike(x, n, i, j[k], percent)]] = True
            return size

        rest = np.arange(len(ids))
        while len(rest) > 1:
            first, others = rest[0], rest[1:]
            ok = near(first, others)
            if tile:
                ok &= salt[others] != salt[first]
            a.append(np.full(int(ok.sum()), ids[first]))
            b.append(ids[others[ok]])
            rest = others[~ok & (label[others] != label[first])] if leaders else others
            skipped |= len(rest) < len(others)
        return a, b, skipped

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, bounds in _whole_groups(batches, 3):
            low, t1, t2, ids, n, label, salt = (part.column(i).to_numpy() for i in range(7))
            marks, a, b, left = part.column(7), [], [], []
            for lo, hi in bounds:
                x, y, skipped = group(ids[lo:hi], n[lo:hi].astype(np.int64), label[lo:hi], salt[lo:hi], bool(t1[lo] != t2[lo]), marks[lo:hi].to_pylist())
                a += x
                b += y
                if skipped:
                    left.append(int(low[lo]))
            if a:
                x, y = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.nulls(len(left), pa.int64())], ["a", "b"])

    return run


def _signature_rows(n: int, percent: int, edges: list[int], plans: list[tuple[int, int, int] | None]):
    edge = np.array(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in text_chunks(batch.column(1)):
                w = Words(data, offsets)
                sigs, owner, sizes = [], [], []
                for i in range(hi - lo):
                    s = shingle_set(w.hashes[w.doc_first[i] : w.doc_first[i + 1]], n)
                    if not len(s):
                        continue
                    top = int(np.searchsorted(edge, len(s), "right")) - 1
                    bottom = int(np.searchsorted(edge, -(-len(s) * percent // 100), "right")) - 1
                    for band in range(bottom, top + 1):
                        if plans[band] is not None:
                            x = signatures(s, band, plans[band])
                            sigs.append(x)
                            owner.append(np.full(len(x), ids[lo + i], np.int64))
                            sizes.append(np.full(len(x), len(s), np.int32))
                if sigs:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).astype(np.int64)), pa.array(np.concatenate(owner)), pa.array(np.concatenate(sizes))], ["sig", "id", "n"])

    return run


def _verify(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, np.ndarray] = {}

        def sets(ids: np.ndarray, column: pa.Array) -> list[np.ndarray]:
            out: list = [seen.get(x) for x in ids]
            missing = [i for i, x in enumerate(out) if x is None]
            for lo, hi, data, offsets in text_chunks(column.take(pa.array(missing, pa.int64()))) if missing else ():
                w = Words(data, offsets)
                for k in range(lo, hi):
                    out[missing[k]] = shingle_set(w.hashes[w.doc_first[k - lo] : w.doc_first[k - lo + 1]], n)
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                a, b = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                u, first, back = np.unique(a, return_index=True, return_inverse=True)
                left = sets(u, part.column(2).take(pa.array(first)))
                seen.clear()
                seen[int(u[-1])] = left[-1]  # rows come sorted by a, so the next slice may go on with it
                right = sets(b, part.column(3))
                keep = []
                for x, y in zip(back, right, strict=True):
                    s = left[x]
                    both = len(np.intersect1d(s, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(s) + len(y) - both) and both > 0)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keep, pa.bool_())], ["a", "b", "linked"])

    return run


#: Rows of a group that one task compares with leaders; what would be more is dealt out.
TILE = 20_000
#: Where all pairs are compared, a group of n rows is dealt to tiles of its root: sqrt(n x UNIT) rows on
#: either side, so that copies (n^1.5) and a tile's comparisons (n) both grow less than the pairs do.
UNIT = 200
#: One document in SAMPLE shows which signatures are common: those of COMMON_LEAST sampled documents and of
#: 1 / COMMON of them all. They number COMMON times the signatures of a document at most.
SAMPLE, COMMON, COMMON_LEAST = 64, 1_000, 64
#: A set must share one in SHARED of its shingles, beyond those that any linked set may lack, to go on.
SHARED = 20
#: Documents, and their shingles, that a block of whole texts takes from one cluster on either side.
BLOCK, BLOCK_SHINGLES = 500, 500_000


_FINGERPRINTS = "doc_id long, n_shingles long, f1 long, f2 long, sketch binary, h long, first array<long>"
_CLASS = ["f1", "f2", "n_shingles"]


class _Join:
    """rows: (doc_id, n_shingles, f1, f2, sketch, h, first) of all rows, h a hash of the text. classes: (f1, f2,
    n_shingles, rep, docs, id): smallest doc_id, number of documents, and the number the class goes by.
    texts: (doc_id, text), where doc_id is a class's number for all its representatives. ties: (a, b)
    between classes of which one document has texts, or None if there are no such documents."""

    def __init__(self, docs: DataFrame, n: int, percent: int, population: int | None = None):
        self.n, self.percent, self.population = n, percent, population
        self.texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
        hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
        self.rows = cut(hashed.mapInArrow(_fingerprints(n, percent), _FINGERPRINTS), "sets")
        filled = self.rows.where("n_shingles > 0")
        classes = filled.groupBy(*_CLASS).agg(F.min("doc_id").alias("rep"), F.count_distinct("doc_id").alias("docs"))
        self.classes = cut(classes.withColumn("id", F.col("rep")), "classes")
        own = F.struct(*_CLASS)  # equal for all texts without shingles
        several = self.rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(own).alias("lo"), F.max(own).alias("hi"), F.min(F.when(F.col("n_shingles") > 0, own)).alias("main"))
        self.several, self.ties = cut(several.where("lo <> hi").select("doc_id", "main"), "several"), None
        if not self.several.isEmpty():
            self._tell_apart()
        kept = self.rows.join(self.classes, _CLASS).where("doc_id = rep")
        self.marks = cut(kept.groupBy("id").agg(F.min("sketch").alias("sketch"), F.min("docs").alias("docs"), F.min("h").alias("h")), "marks")

    def _tell_apart(self) -> None:
        """Numbers, texts and ties where documents have texts of several classes."""
        own = F.struct(*_CLASS)
        shared = self.classes.join(self.several.withColumnRenamed("doc_id", "rep"), "rep")
        above = max(self.rows.agg(F.max("doc_id")).first()[0], 0) + 1
        extra = cut(shared.where(own != F.col("main")).select(*_CLASS, (F.lit(above) + F.monotonically_increasing_id()).alias("number")), "numbers")
        self.classes = cut(self.classes.drop("id").join(extra, _CLASS, "left").withColumn("id", F.coalesce("number", "rep")).drop("number"), "classes")
        ids = self.several.select("doc_id")
        theirs = self.texts.join(ids, "doc_id", "left_semi").withColumn("h", F.xxhash64("text"))
        seen = self.rows.join(ids, "doc_id", "left_semi").join(self.classes, _CLASS).select("doc_id", "h", "id", "rep")
        member = cut(seen.distinct(), "members")
        first = member.where("doc_id = rep").groupBy("doc_id", "id").agg(F.min("h").alias("h"))
        reps = theirs.join(first, ["doc_id", "h"]).select(F.col("id").alias("doc_id"), "text").dropDuplicates(["doc_id"])
        self.texts = self.texts.join(ids, "doc_id", "left_anti").union(cut(reps, "representatives"))
        lows = member.groupBy("doc_id").agg(F.min("id").alias("a"))
        self.ties = cut(member.join(lows, "doc_id").select("a", F.col("id").alias("b")).where("a <> b").distinct(), "ties")

    def connected(self, links: DataFrame, tied: bool) -> DataFrame:
        """(id, label) of the components of links(a, b), and of ties if asked for."""
        edges = links.select("a", "b")
        return components(edges if self.ties is None or not tied else edges.union(self.ties))

    def sharing(self) -> DataFrame:
        """(id, n_shingles) of the classes that may link with another by their first shingles. A shingle
        that a sample shows to be common counts as shared, so that no task gets all its rows."""
        some = self.rows.where(F.pmod(F.xxhash64(F.lit("some"), "doc_id"), F.lit(SAMPLE)) == 0).select(F.explode("first").alias("g"))
        least = max(COMMON_LEAST, self.classes.count() // (SAMPLE * COMMON))
        common = cut(some.groupBy("g").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least).select("g", F.lit(True).alias("often")), "often")
        # copies of one set do not share with each other: only representatives take part
        own = self.rows.join(self.classes, _CLASS).where("doc_id = rep").select("id", F.explode("first").alias("g"))
        own = own.join(F.broadcast(common), "g", "left").select("id", F.coalesce("often", F.lit(False)).alias("often"), "g")
        w = Window.partitionBy(F.when(F.col("often"), F.xxhash64("g", "id")).otherwise(F.col("g")))
        own = own.select("id", "often", F.min("id").over(w).alias("low"), F.max("id").over(w).alias("high"))
        found = own.where("often or low <> high").groupBy("id").agg(F.count(F.lit(1)).alias("shared"))
        enough = F.expr(f"shared >= (n_shingles * {self.percent} + 99) div 100 div {SHARED} + 1")  # least_shared
        return cut(self.classes.join(found, "id").where(enough).select("id", "n_shingles"), "sharing")

    def members(self) -> DataFrame:
        """(low, id, n): representatives that share a signature, grouped by the lowest id that shares it.
        A pair that shares a signature is in one group; buckets of one low id are one group, so a pair is
        compared about once, however many signatures it shares."""
        sharing = self.sharing()
        self.texts = cut(self.texts.join(sharing.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"), "sharing-texts")
        most = sharing.agg(F.max("n_shingles")).first()[0] or 1
        edges = bands(most)
        index = F.lit(-1)
        for e in edges:
            index = index + (F.col("n_shingles") >= e).cast("int")
        found = {r.band: r["count"] for r in sharing.groupBy(index.alias("band")).count().collect()}  # one row a band
        plans = [allocate(edges[k], edges[k + 1], self.population or found.get(k, 0) + found.get(k + 1, 0), self.percent) for k in range(len(edges) - 1)]
        sign = lambda df: df.mapInArrow(_signature_rows(self.n, self.percent, edges, plans), "sig long, id long, n int")
        some = sign(self.texts.where(F.pmod(F.xxhash64(F.lit("some"), "doc_id"), F.lit(SAMPLE)) == 0)).groupBy("sig").agg(F.count(F.lit(1)).alias("rows"))
        least = max(COMMON_LEAST, sum(found.values()) // (SAMPLE * COMMON))
        common = cut(some.where(F.col("rows") >= least).select("sig", F.ceil(F.col("rows") * SAMPLE / TILE).cast("int").alias("salts")), "common")
        # rows of a common signature are looked through in parts, whose lowest and highest ids then meet
        w, shown = Window.partitionBy("key"), F.col("salts").isNotNull()
        sigs = sign(self.texts).join(F.broadcast(common), "sig", "left")
        sigs = sigs.select("id", "n", F.when(shown, F.xxhash64("sig", F.pmod(F.xxhash64("id"), F.col("salts")))).otherwise(F.col("sig")).alias("key"), F.when(shown, F.col("sig")).alias("sig"))
        part = sigs.select("id", "n", F.min("id").over(w).alias("low"), F.max("id").over(w).alias("high"), "sig")
        part = cut(part.where("low <> high or sig is not null"), "buckets")
        whole = cut(part.where("sig is not null").groupBy("sig").agg(F.min("low").alias("low"), F.max("high").alias("high")), "whole")
        met = part.where("sig is not null").drop("low", "high").join(F.broadcast(whole), "sig").where("low <> high")
        shared = part.where("sig is null").select("low", "id", "n").union(met.select("low", "id", "n"))
        return cut(shared.dropDuplicates(["low", "id"]), "shared")

    def candidates(self, members: DataFrame, leaders: bool, turn: int = 0) -> tuple[DataFrame, DataFrame, bool]:
        """(pairs(a, b) of members(low, id, n, label) of one group that have different labels and may link;
        the groups (low) of which not all such pairs have been tried; whether any was split). Groups above
        TILE rows are split by salts of the ids, other ones at each turn (with leaders), or into tiles,
        which are pairs of salts."""
        counts = members.groupBy("low").agg(F.count(F.lit(1)).alias("rows"), F.min("label").alias("l1"), F.max("label").alias("l2"))
        salts = F.ceil(F.col("rows") / TILE) if leaders else F.ceil(F.sqrt(F.col("rows") / UNIT))
        counts = cut(counts.select("low", (F.col("l1") == F.col("l2")).alias("one"), salts.cast("int").alias("salts")).where("one or salts > 1"), "counts")
        chosen = counts.where("not one").select("low", "salts")
        x = members if leaders else members.join(cut(counts.where("one").select("low"), "one"), "low", "left_anti")
        # the groups above a tile are few, so the members need not be shuffled to them
        large = cut(chosen, "large")
        x = x.join(large, "low", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
        x = x.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(turn)), F.col("salts")).cast("int"))
        others = F.array("salt") if leaders else F.sequence(F.lit(0), F.col("salts") - 1)
        x = x.withColumn("other", F.explode(others)).withColumn("t1", F.least("salt", "other")).withColumn("t2", F.greatest("salt", "other"))
        x = x.join(self.marks.select("id", "sketch"), "id").select("low", "t1", "t2", "id", "n", "label", "salt", "sketch")
        x = x.repartition("low", "t1", "t2").sortWithinPartitions("low", "t1", "t2", "id")
        found = cut(x.mapInArrow(_group_pairs(self.percent, leaders), "a long, b long"), "found")
        left = found.where("b is null").select(F.col("a").alias("low")).union(large.select("low"))  # salts apart have not met
        return found.where("b is not null").distinct(), cut(left.distinct(), "unfinished"), leaders and not large.isEmpty()

    def verified(self, pairs: DataFrame) -> DataFrame:
        """pairs(a, b) with linked; both texts are fetched once more, only for documents in pairs."""
        ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
        texts, path = cut_at(self.texts.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
        full = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        full = full.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb").sortWithinPartitions("a")
        out = cut(full.mapInArrow(_verify(self.n, self.percent), "a long, b long, linked boolean"), "verified")
        discard(texts.sparkSession, path)
        return out

    def run(self, tied: bool = True) -> tuple[DataFrame, DataFrame]:
        """(links between representatives that connect the components, labels(id, label)). Pairs that
        already share a component are not tried. If tied, the texts of one document are in one component."""
        shared = self.members()
        rest, done, labels, turn = shared.withColumn("label", F.col("id")), None, None, 0
        leaders = split = True
        while leaders:
            # salts of a split group do not meet: it is dealt anew, with the labels so far, while that finds
            # links, so that copies by the million merge by one link each and not by all their pairs
            leaders = split
            pairs, unfinished, split = self.candidates(rest, leaders, turn)
            if done is not None:
                pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
            pairs, turn = cut(pairs, "pairs"), turn + 1
            if done is not None and pairs.isEmpty():
                split = False
                continue
            more = self.verified(pairs)
            done = more if done is None else done.union(more)
            if labels is None or not more.where("linked").isEmpty():
                labels = self.connected(done.where("linked"), tied)
            else:
                split = False
            own = labels.select("id", F.col("label").alias("l"))
            rest = shared.join(unfinished, "low", "left_semi").join(own, "id", "left").select("low", "id", "n", F.coalesce("l", "id").alias("label"))
        return done.where("linked").select("a", "b"), labels

    def links(self, counted: bool) -> DataFrame:
        """All links (a, b, tree) between representatives, each once with a < b; those with tree connect the
        components. If counted, the latter alone and rows (a, null, docs), whose sums are the documents that
        a's links lead to."""
        shared = self.members()
        lows = shared.groupBy("id").agg(F.collect_list("low").alias("lows"))
        sizes = shared.groupBy("low").agg(F.ceil(F.sqrt(F.count(F.lit(1)) / UNIT)).cast("int").alias("salts"))
        x = _tiles(shared, sizes, ["low"], F.xxhash64("id"), "salt", "t1", "t2").join(lows, "id").join(self.marks.drop("h"), "id")
        x = x.select("low", "t1", "t2", "id", "n", "salt", "docs", "lows", "sketch").repartition("low", "t1", "t2").sortWithinPartitions("low", "t1", "t2", "id")
        found = cut(x.mapInArrow(_clusters(self.percent), "cluster long, low long, t1 int, t2 int, id long, n int, salt int, docs long, lows array<long>"), "clusters")
        texts = cut(self.texts.join(found.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "id"), "texts")
        keys = ["cluster", "low", "t1", "t2"]
        sizes = found.groupBy(keys).agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("salts"))
        keys += ["u1", "u2"]
        x = _tiles(found, sizes, keys[:4], F.xxhash64("id", F.lit("block")), "turn", "u1", "u2").join(texts, "id")
        x = x.select(*keys, "id", "n", "salt", "turn", "docs", "lows", "text").repartition(*keys).sortWithinPartitions(*keys, "id")
        return cut(x.mapInArrow(_linked(self.n, self.percent, counted), "a long, b long, tree boolean, docs long"), "links")


def _tiles(rows: DataFrame, sizes: DataFrame, keys: list[str], value, salt: str, t1: str, t2: str) -> DataFrame:
    """rows in each pair (t1, t2) of salts (of a value, as many as sizes(*keys, salts) says) that holds their
    own salt. Only the few keys of more salts than one are joined."""
    x = rows.join(cut(sizes.where("salts > 1"), "large"), keys, "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    x = x.withColumn(salt, F.pmod(value, F.col("salts")).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    return x.withColumn(t1, F.least(salt, "other")).withColumn(t2, F.greatest(salt, "other")).drop("other", "salts")


def jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85, population: int | None = None) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_shingles, component_id.

    component_id is the smallest doc_id reachable by links. A null, empty or blank text has no
    shingles, links with nothing, and is its own component. Rows that repeat a doc_id are one
    document, whose texts are in one component (but for texts without shingles). A row with a null doc_id links with nothing and has a null component_id. An empty
    table gives an empty result; other columns are ignored. population is the number of documents in a
    size band that signatures are planned for (default: those counted); any plan gives the same result.
    """
    join = _Join(docs, n, percent, population)
    _, labels = join.run()
    return _labelled(join, labels).select("doc_id", "n_shingles", "component_id")


def _labelled(join: _Join, labels: DataFrame) -> DataFrame:
    """The rows with component_id and, of their class, id, rep, docs and label."""
    own = labels.withColumnRenamed("id", "__id")
    reps = join.classes.join(own, join.classes.id == own["__id"], "left").select(*_CLASS, "id", "rep", "docs", F.coalesce("label", "id").alias("label"))
    out = join.rows.join(reps, _CLASS, "left")
    return out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")))


def surplus(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What repeats in docs(doc_id, text): of each group of texts that links connect all but one text, and what
    occurs in several equal rows. Three tables: doc_id of documents all of whose rows are surplus; (doc_id, h)
    of the surplus rows of other documents, h being xxhash64 of the text; and (doc_id, h) of what occurs more
    than once. The text that stays is one of its group's smallest doc_id. Rows with a null doc_id and texts
    without shingles are in no group."""
    join = _Join(docs, n, percent)
    own = _labelled(join, join.run(tied=False)[1]).where("doc_id is not null")
    kept = join.marks.select(F.col("id").alias("__kept"), F.col("h").alias("__h"))
    best = (F.col("id") == F.col("label")) & (F.col("doc_id") == F.col("rep")) & (F.col("h") == F.col("__h"))
    # a text without shingles has no class, so its row is not surplus
    rows = cut(own.join(kept, F.col("id") == F.col("__kept"), "left").select("doc_id", "h", F.coalesce(~best, F.lit(False)).alias("gone")), "judged")
    each = rows.groupBy("doc_id").agg(F.min("gone").alias("whole"), F.max("gone").alias("some")).where("some")
    mixed = rows.where("gone").join(each.where("not whole").select("doc_id"), "doc_id", "left_semi").select("doc_id", "h").distinct()
    again = rows.groupBy("doc_id", "h").count().where("count > 1")
    return each.where("whole").select("doc_id"), mixed, again.select("doc_id", "h")


def jaccard_join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """jaccard_components with n_links: the number of other documents that the row links with, copies
    included. All links are found. Rows with a null doc_id have a null n_links and count for nobody;
    texts without shingles have 0. A doc_id with several texts counts once for each.
    """
    join = _Join(docs, n, percent)
    links = join.links(True)
    degrees = links.where("b is null").groupBy("a").agg(F.sum("docs").alias("linked"))
    out = _labelled(join, join.connected(links.where("tree"), True)).join(degrees, F.col("id") == F.col("a"), "left")
    count = F.coalesce(F.col("docs") - 1, F.lit(0)) + F.coalesce("linked", F.lit(0))
    return out.select("doc_id", "n_shingles", "component_id", F.when(F.col("doc_id").isNotNull(), count).alias("n_links"))


def jaccard_links(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """All links (a, b), a < b, between documents with different shingle sets; a class of documents with
    equal sets is named by its smallest id, so that texts of one id may link with each other (a = b)."""
    join = _Join(docs, n, percent)
    found = join.links(False).select("a", "b")
    if join.ties is None:
        return found
    names = cut(join.classes.where("id <> rep").select("id", "rep"), "names")
    for c in ("a", "b"):
        found = found.join(names, found[c] == names["id"], "left").withColumn(c, F.coalesce("rep", c)).drop("id", "rep")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


#: All pairs that share a shingle, for tables of a few thousand documents.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: hash(w[i], w[i + 1], w[i + 2], w[i + 3])) ELSE [hash(array_to_string(w, ' '))] END)) AS g FROM w WHERE len(w) > 0),
t AS (SELECT * FROM s WHERE g IN (SELECT g FROM s GROUP BY g HAVING count(*) > 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS other FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.other),
m AS (SELECT id, min(other) AS component_id FROM r GROUP BY id), d AS (SELECT a AS id, count(*) AS k FROM e GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id, coalesce(d.k, 0)::BIGINT AS n_links
FROM documents LEFT JOIN n USING (doc_id) JOIN m ON m.id = doc_id LEFT JOIN d ON d.id = doc_id
"""
