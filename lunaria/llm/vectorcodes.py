"""Vector code compression: a codebook for each part of the vectors, fitted by Elkan's Lloyd rounds.

Vectors become whole numbers and are cut into consecutive parts. Each part position has its own codebook.
A round assigns every part to the nearest entry of its codebook and moves the entries to the means. What
a round has learned about distances is kept beside each vector: one upper bound per part (to its own
entry) and one lower bound per part and entry. When entries move, bounds shift by the movement, and the
triangle inequality then shows for most entries that they are strictly farther than the own one. All
others are measured in whole numbers, so ties are exact and go to the lower index; bounds are rounded
away from the true distance wherever they are computed or stored.

A round is one pass over the table of the round before, which also writes the sums that the next
codebooks need (a row a task, read back by column). Nothing is shuffled but those sums; the driver holds
the codebooks alone. The last two tables are on disk at any time, so a lost executor repeats its tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import cut, cut_at, discard

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components that a kernel handles at once.
CELLS = 1 << 20
#: Relative slack of a computed bound, far above the error of double arithmetic.
SLACK = 1e-9
LONG = (1 << 63) - 1
_TOTALS = "array<struct<width int, part int, entry int, n long, sums array<long>>>"
_STATE = "width int, q binary, code binary, upper binary, lower binary, tried long, totals " + _TOTALS


def most(width: int) -> int:
    """The largest magnitude of a component: with it all squared distances of a vector fit a long."""
    return math.isqrt((1 << 60) // max(width, 1))


def edges(width: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end; they are equal where `parts` divides the width."""
    return [p * width // parts for p in range(parts + 1)]


def whole(flat: np.ndarray, width: int) -> np.ndarray:
    """floor(4096 x) of the vectors of a width, a row each, held at `most`."""
    m = float(most(width))
    with np.errstate(over="ignore"):
        return np.clip(np.floor(SCALE * flat.astype(np.float64)), -m, m).astype(np.int64).reshape(-1, width)


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows, in whole numbers."""
    d = x - c
    return (d * d).sum(1)


def above(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 + SLACK)


def below(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 - SLACK)


@dataclass
class Book:
    """The codebook of one part: its entries, and by how much each has moved from the round before."""

    entries: np.ndarray
    moved: np.ndarray | None = None

    def __post_init__(self):
        k = len(self.entries)
        gap = np.array([below(squares(np.broadcast_to(c, self.entries.shape), self.entries)) for c in self.entries]).reshape(k, k) / 2
        np.fill_diagonal(gap, np.inf)
        self.half, self.least = gap, gap.min(1) if k else np.zeros(0)

    def next(self, sums: dict[int, tuple[int, list[int]]]) -> Book:
        """The book after a round: floored means of what each entry was given; unused entries stay."""
        new = self.entries.copy()
        for j, (n, total) in sums.items():
            new[j] = [s // n for s in total]
        return Book(new, above(squares(self.entries, new)))


def first_assigned(x: np.ndarray, book: Book) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry, upper bound, lower bounds, distances computed) of rows without bounds."""
    d2 = np.stack([squares(x, c) for c in book.entries], 1)
    own = d2.argmin(1)
    return own, above(d2[np.arange(len(x)), own]), below(d2), d2.size


def assigned(x: np.ndarray, book: Book, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """first_assigned for rows with the bounds of the round before: an entry is measured only if it is not
    shown to be strictly farther than the row's own."""
    own, lower = own.copy(), np.maximum(lower - book.moved, 0) * (1 - SLACK)
    upper = (upper + book.moved[own]) * (1 + SLACK)
    rows = np.flatnonzero(upper >= book.least[own])
    tried = len(rows)
    if tried:
        at, mine = np.arange(len(rows)), own[rows]
        d_own = squares(x[rows], book.entries[mine])
        upper[rows], lower[rows, mine] = above(d_own), below(d_own)
        u = upper[rows][:, None]
        near = (u >= lower[rows]) & (u >= book.half[mine])
        near[at, mine] = False
        r, j = np.nonzero(near)
        d = squares(x[rows[r]], book.entries[j])
        lower[rows[r], j] = below(d)
        d2 = np.full(near.shape, LONG)
        d2[at, mine], d2[r, j] = d_own, d
        new = d2.argmin(1)  # the first of the least, and whatever ties with it has been measured
        own[rows], upper[rows] = new, above(d2[at, new])
        tried += len(r)
    return own, upper, lower, tried


# ---------------------------------------------------------------- how bounds are stored


def _up32(x: np.ndarray) -> np.ndarray:
    return np.nextafter(x.astype("<f4"), np.float32(np.inf))


def _down16(x: np.ndarray) -> np.ndarray:
    """The upper half of a single float's bits: at most the number itself, and 0.4 % below it."""
    return (np.maximum(np.nextafter(x.astype("<f4"), np.float32(-np.inf)), 0).view("<u4") >> 16).astype("<u2")


def _from16(x: np.ndarray) -> np.ndarray:
    return (x.astype("<u4") << 16).view("<f4").astype(np.float64)


def _rows(column: pa.Array, dtype: str, n: int) -> np.ndarray:
    """A binary column of equally long values as the rows of an array."""
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[off[0] : off[-1]] if off[-1] > off[0] else np.zeros(0, np.uint8)
    return data.view(dtype).reshape(n, -1)


def _binary(rows: np.ndarray) -> pa.Array:
    n, each = len(rows), rows.dtype.itemsize * (rows.shape[1] if rows.ndim > 1 else 1)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * each).astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def _narrow(q: np.ndarray) -> np.ndarray:
    m = max(int(q.max(initial=0)), -int(q.min(initial=0)) - 1)
    return q.astype("<i2" if m < 1 << 15 else "<i4" if m < 1 << 31 else "<i8")


Books = dict[int, list[Book]]


class _Sums:
    """Counts and sums of what a task's parts were assigned to."""

    def __init__(self):
        self.found: dict[tuple[int, int, int], tuple[int, np.ndarray]] = {}

    def add(self, width: int, part: int, x: np.ndarray, own: np.ndarray) -> None:
        for j in np.unique(own):
            mine = x[own == j]
            n, s = self.found.get((width, part, int(j)), (0, np.zeros(x.shape[1], np.int64)))
            self.found[width, part, int(j)] = n + len(mine), s + mine.sum(0)

    def rows(self) -> list[dict]:
        return [{"width": w, "part": p, "entry": j, "n": n, "sums": s.tolist()} for (w, p, j), (n, s) in self.found.items()]


_ARROW_TOTALS = pa.list_(pa.struct([("width", pa.int32()), ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]))
_NAMES = ["vec_id", "label", "width", "q", "code", "upper", "lower", "tried", "totals"]


def _total_row(kind: pa.DataType, tried: int, sums: _Sums) -> pa.RecordBatch:
    none = [pa.nulls(1, t) for t in (pa.int64(), kind, pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())]
    return pa.RecordBatch.from_arrays([*none, pa.array([tried]), pa.array([sums.rows()], _ARROW_TOTALS)], _NAMES)


def _state_rows(ids: pa.Array, labels: pa.Array, q: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> pa.RecordBatch:
    n = len(q)
    parts = [pa.array(np.full(n, q.shape[1], np.int32)), _binary(_narrow(q)), _binary(own.astype(np.uint8)), _binary(_up32(upper)), _binary(_down16(lower.reshape(n, -1)))]
    return pa.RecordBatch.from_arrays([ids, labels, *parts, pa.nulls(n, pa.int64()), pa.nulls(n, _ARROW_TOTALS)], _NAMES)


def _begin(books: Books, parts: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, tried = _Sums(), 0
        for batch in batches:
            size = batch.column(2).value_lengths().to_numpy()
            for width in np.unique(size):
                at = edges(int(width), parts)
                rows = np.flatnonzero(size == width)
                for some in np.array_split(rows, -(-len(rows) * max(int(width), 1) // CELLS)):
                    own_batch = batch.take(pa.array(some))
                    q = whole(own_batch.column(2).flatten().to_numpy(zero_copy_only=False), int(width)) if width else np.zeros((len(some), 0), np.int64)
                    own, upper, lower = [], [], []
                    for p, book in enumerate(books[int(width)]):
                        x = q[:, at[p] : at[p + 1]]
                        a, u, low, k = first_assigned(x, book)
                        sums.add(int(width), p, x, a)
                        tried += k
                        own.append(a)
                        upper.append(u)
                        lower.append(low)
                    yield _state_rows(own_batch.column(0), own_batch.column(1), q, np.stack(own, 1), np.stack(upper, 1), np.stack(lower, 1))
        yield _total_row(kind, tried, sums)

    return run


def _stored(batch: pa.RecordBatch, books: Books, parts: int) -> Iterator[tuple]:
    """(ids, labels, width, q, entries, upper and lower bounds) of the rows of a batch, width by width."""
    keep = np.flatnonzero(batch.column(2).is_valid().to_numpy(zero_copy_only=False))
    if not len(keep):
        return
    batch = batch.take(pa.array(keep))
    size = batch.column(2).to_numpy().astype(np.int64)
    each = np.diff(np.frombuffer(batch.column(3).buffers()[1], np.int32)[batch.column(3).offset : batch.column(3).offset + len(size) + 1])
    for width, length in sorted(set(zip(size.tolist(), each.tolist(), strict=True))):
        rows = np.flatnonzero((size == width) & (each == length))
        for some in np.array_split(rows, -(-len(rows) * max(width, 1) // CELLS)):
            own, n = batch.take(pa.array(some)), len(some)
            q = _rows(own.column(3), f"<i{length // width}", n).astype(np.int64) if width else np.zeros((n, 0), np.int64)
            code = _rows(own.column(4), "u1", n).astype(np.int64)
            upper = _rows(own.column(5), "<f4", n).astype(np.float64)
            lower = _from16(_rows(own.column(6), "<u2", n)).reshape(n, parts, -1)
            yield own.column(0), own.column(1), width, q, code, upper, lower


def _again(books: Books, parts: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, tried = _Sums(), 0
        for batch in batches:
            for ids, labels, width, q, code, upper, lower in _stored(batch, books, parts):
                at = edges(width, parts)
                for p, book in enumerate(books[width]):
                    x = q[:, at[p] : at[p + 1]]
                    code[:, p], upper[:, p], lower[:, p], k = assigned(x, book, code[:, p], upper[:, p], lower[:, p])
                    sums.add(width, p, x, code[:, p])
                    tried += k
                yield _state_rows(ids, labels, q, code, upper, lower)
        yield _total_row(kind, tried, sums)

    return run


def _finish(books: Books, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, width, q, code, upper, lower in _stored(batch, books, parts):
                at, error = edges(width, parts), np.zeros(len(q), np.int64)
                for p, book in enumerate(books[width]):
                    x = q[:, at[p] : at[p + 1]]
                    code[:, p], *_ = assigned(x, book, code[:, p], upper[:, p], lower[:, p])
                    error += squares(x, book.entries[code[:, p]])
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(np.full(len(q), width, np.int32)), _binary(code.astype(np.uint8)), pa.array(error)], ["vec_id", "label", "width", "code", "error"])

    return run


@dataclass
class Compressed:
    """codes(vec_id, label, width, code, error), the codebooks of each width, and for each round the
    distances that were measured and those that a plain search would have measured."""

    codes: DataFrame
    books: Books
    tried: list[tuple[int, int]]

    def digests(self) -> dict[int, str]:
        """For each width, sha256 of all components of its codebooks in order, comma-joined."""
        return {w: hashlib.sha256(",".join(str(v) for b in books for v in b.entries.ravel().tolist()).encode()).hexdigest() for w, books in self.books.items()}

    def decoded(self) -> DataFrame:
        """(vec_id, embedding): each code's entries as a vector again."""
        books, parts = {w: [b.entries for b in bs] for w, bs in self.books.items()}, len(next(iter(self.books.values()), []))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                width = batch.column(1).to_numpy()
                for w in np.unique(width):
                    own = batch.take(pa.array(np.flatnonzero(width == w)))
                    code = _rows(own.column(2), "u1", own.num_rows)
                    x = np.hstack([books[int(w)][p][code[:, p]] for p in range(parts)]).astype(np.float64) / SCALE
                    listed = pa.ListArray.from_arrays(pa.array((np.arange(len(x) + 1) * int(w)).astype(np.int32)), pa.array(x.ravel()))
                    yield pa.RecordBatch.from_arrays([own.column(0), listed], ["vec_id", "embedding"])

        return self.codes.select("vec_id", "width", "code").mapInArrow(run, "vec_id long, embedding array<double>")


def _moved(state: DataFrame, books: Books) -> tuple[Books, int, int]:
    """(the next codebooks, distances measured, parts assigned) from the sums that a round has written:
    the driver gets `ENTRIES` numbers for each component and width."""
    totals = state.where("totals is not null")
    tried = totals.agg(F.coalesce(F.sum("tried"), F.lit(0))).first()[0]
    each = totals.select(F.explode("totals").alias("t")).select("t.width", "t.part", "t.entry", "t.n", F.posexplode_outer("t.sums").alias("at", "s"))
    sums: dict[tuple[int, int], dict[int, tuple[int, dict]]] = {}
    for r in each.groupBy("width", "part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        n, s = sums.setdefault((r.width, r.part), {}).setdefault(r.entry, (r.n, {}))
        if r["at"] is not None:
            s[r["at"]] = r.s
    found = {k: {j: (n, [s[i] for i in range(len(s))]) for j, (n, s) in v.items()} for k, v in sums.items()}
    new = {w: [b.next(found.get((w, p), {})) for p, b in enumerate(bs)] for w, bs in books.items()}
    return new, tried, sum(n for v in found.values() for n, _ in v.values())


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, label: str | None = "label") -> Compressed:
    """Codebooks and codes of vectors(vec_id, embedding and, unless None, a label that is carried along).

    Rows whose vector is null or holds a null or non-finite component are dropped. A component x is
    floor(4096 x), held where squared distances would no longer fit a long (|x| above about 32,000 at 64
    components). A codebook starts with the parts of the vectors of the smallest ids (a null id is the
    largest, equal ids in order of their vectors), fewer if there are fewer. Vectors of each length have
    codebooks of their own, found by one job a length; where `parts` does not divide the length, parts
    differ by one component, and a part without components has distance 0. Repeated rows each count. An
    empty table gives no codes. Other columns are ignored. entries is at most 256, rounds at least 1.
    """
    if not 1 <= entries <= 256 or rounds < 1:
        raise ValueError(f"{entries} entries, {rounds} rounds")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), (F.lit(None).cast("int") if label is None else F.col(label)).alias("label"), F.col("embedding").alias("v"))
    v = v.where(F.col("v").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    books: Books = {}
    for r in v.groupBy(F.size("v").alias("width")).count().collect():  # one row for each length of a vector
        least = v.where(F.size("v") == r.width).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
        q, at = whole(np.array([x.v for x in least], np.float64).ravel(), r.width) if r.width else np.zeros((len(least), 0), np.int64), edges(r.width, parts)
        books[r.width] = [Book(q[:, at[p] : at[p + 1]]) for p in range(parts)]
    kind = v.schema["label"].dataType
    schema, arrow = f"vec_id long, label {kind.simpleString()}, {_STATE}", to_arrow_type(kind)
    state, path = cut_at(v.mapInArrow(_begin(books, parts, arrow), schema), "vectors")
    tried = []
    for k in range(rounds):
        books, measured, n = _moved(state, books)
        tried.append((measured, n * entries))
        if k + 1 < rounds:
            after, later = cut_at(state.mapInArrow(_again(books, parts, arrow), schema), "vectors")
            discard(vectors.sparkSession, path)
            state, path = after, later
    codes = state.mapInArrow(_finish(books, parts), f"vec_id long, label {kind.simpleString()}, width int, code binary, error long")
    return Compressed(codes, books, tried)


def encode(vectors: DataFrame) -> DataFrame:
    """vec_id, code (two hex digits a part), error (squared distance), label_error (errors summed over
    equal labels, nulls together, held at a long's end) and codebooks_sha256, one row per kept vector.
    Cases are those of `compress`."""
    done = compress(vectors)
    codes = cut(done.codes, "codes")
    total = codes.groupBy(F.col("label").alias("__label")).agg(F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    # one row a label: Spark sends the table to all tasks if it is small, and splits hot labels if not
    out = codes.join(cut(total, "labels"), F.col("label").eqNullSafe(F.col("__label")), "left")
    digest = F.lit(None).cast("string")
    for w, text in done.digests().items():
        digest = F.when(F.col("width") == w, text).otherwise(digest)
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))


def _oracle(rounds: int = ROUNDS) -> str:
    near = "arg_min(c.entry, list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT * 16 + c.entry)"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT p.vec_id, p.part, any_value(p.x) AS x, {near} AS entry FROM p JOIN c{k} c USING (part) GROUP BY 1, 2)")
        steps.append(f"""s{k} AS (SELECT part, entry, pos, sum(v) AS s, count(*) AS n FROM (SELECT part, entry, unnest(x) AS v, unnest(range(len(x))) AS pos FROM a{k}) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN
  (SELECT part, entry, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS x FROM s{k} GROUP BY 1, 2) m USING (part, entry))""")
    return f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT vec_id, part, e[part * (len(e) // 8) + 1 : (part + 1) * (len(e) // 8)] AS x FROM (SELECT *, unnest(range(8)) AS part FROM v)),
c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM p QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= 16),
{", ".join(steps[:-1])},
r AS (SELECT a.vec_id, string_agg(lpad(to_hex(a.entry), 2, '0'), '' ORDER BY part) AS code, sum(list_sum(list_transform(list_zip(a.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))))::BIGINT AS error
  FROM a{rounds} a JOIN c{rounds} c USING (part, entry) GROUP BY 1),
h AS (SELECT sha256(string_agg(t, ',' ORDER BY part, entry)) AS d FROM (SELECT part, entry, list_aggregate(x, 'string_agg', ',') AS t FROM c{rounds}))
SELECT r.vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY v.label))::BIGINT AS label_error, d AS codebooks_sha256 FROM r JOIN v USING (vec_id), h
"""


ORACLE_SQL = _oracle()
