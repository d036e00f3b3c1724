"""Exact top-k search: tiled matrix products, partial selection per tile, tree merge per query.

Queries and candidates are dealt to a grid of tiles (query block x candidate shard), each of bounded
size, so neither side is broadcast or gathered. A tile multiplies once, keeps the k best of each
query, and the lists of up to FAN shards are merged at a time until one is left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Rows of a tile at most (as expected from hashing): each side is copied once for every tile of the other,
#: so tiles are as large as a task's memory allows, and multiplied in slices of SLICE (queries, candidates).
QUERY_ROWS, SHARD_ROWS, SLICE = 65_536, 131_072, (512, 8_192)
#: Bytes of either side of a tile at most, at eight a component: wide vectors get tiles of fewer rows.
TILE_BYTES = 64 << 20
#: Candidates of a tile at least where tables are small and cores many; lists merged at a time.
SHARD_LEAST, FAN = 4_096, 32
SCALE = 256
LONG = (-(1 << 63), (1 << 63) - 1)


def quantised(column: pa.Array, width: int) -> np.ndarray:
    """floor(256 x) of vectors of a width, as doubles that hold whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).reshape(len(column), width)


def kept(row: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best of each row, best first, ties to smaller ids."""
    order = np.lexsort((ids, -score, row))
    r = row[order]
    first = np.flatnonzero(np.append(True, r[1:] != r[:-1])) if len(r) else np.zeros(0, np.int64)
    place = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
    return order[place < k]


def slice_best(q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate id, score) that hold the k best of each query among candidates in order of their ids."""
    bound = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if bound < 2**53:
        s = q @ x.T  # every partial sum is a whole number that a double holds
    else:  # very large components: whole-number arithmetic, held within a long
        a, b = ([[int(v) for v in r] for r in m] for m in (q, x))
        s = np.array([[min(max(sum(u * v for u, v in zip(r, c, strict=True)), LONG[0]), LONG[1]) for c in b] for r in a], dtype=object).reshape(len(q), len(x))
    lo, hi = np.searchsorted(x_ids, q_ids), np.searchsorted(x_ids, q_ids, "right")
    own = np.zeros(s.shape, bool)  # the query itself
    for i in np.flatnonzero(lo < hi):
        own[i, lo[i] : hi[i]] = True
    if bound < 2**53:
        s[own] = -np.inf
        if s.shape[1] > k:
            least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
            row, at = np.nonzero((s >= least[:, None]) & ~own)
        else:
            row, at = np.nonzero(~own)
        return row, x_ids[at], s[row, at].astype(np.int64)
    row, at = np.nonzero(~own)
    score = s[row, at]
    best = sorted(range(len(row)), key=lambda i: (row[i], -score[i], x_ids[at[i]]))
    row, at, score = row[best], at[best], score[best]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    row, at, score = (v[place < k] for v in (row, at, score))
    return row, x_ids[at], score.astype(np.int64)


def tile_best(q: pa.Array, q_ids: np.ndarray, x: pa.Array, x_ids: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, candidate id, score) of the k best candidates of each query, slice by slice."""
    order = np.argsort(x_ids, kind="stable")
    x, x_ids = x.take(pa.array(order)), x_ids[order]
    parts = []
    for a in range(0, len(q), SLICE[0]):
        own, ids = quantised(q[a : a + SLICE[0]], width), q_ids[a : a + SLICE[0]]
        found = [np.zeros(0, np.int64)] * 3
        for b in range(0, len(x), SLICE[1]):
            new = slice_best(own, ids, quantised(x[b : b + SLICE[1]], width), x_ids[b : b + SLICE[1]], k)
            found = [np.concatenate(v) for v in zip(found, new, strict=True)]
            keep = kept(*_ranked(*found), k)
            found = [v[keep] for v in found]
        parts.append((found[0] + a, found[1], found[2]))
    return tuple(np.concatenate(v) for v in zip(*parts, strict=True))


def _ranked(row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores as ranks, so that the least long can be negated as well."""
    return row, ids, np.unique(score, return_inverse=True)[1]


def _tiles(k: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        out = []
        is_query = t.column("is_query").to_numpy().astype(bool)
        width = pa.compute.list_value_length(t.column("v")).to_numpy()
        for d in np.unique(width):
            same = width == d
            q, x = (t.filter(pa.array(same & m)).combine_chunks() for m in (is_query, ~is_query))
            if not q.num_rows or not x.num_rows:
                continue
            qv, xv = (y.column("v").combine_chunks() for y in (q, x))
            r, ids, s = tile_best(qv, q.column("vec_id").to_numpy(), xv, x.column("vec_id").to_numpy(), int(d), k)
            out.append(pa.table({"query_id": q.column("vec_id").to_numpy()[r], "qv": q.column("qv").to_numpy()[r], "shard": np.full(len(r), t.column("shard")[0].as_py(), np.int64), "vec_id": ids, "score": s}))
        return pa.concat_tables(out) if out else pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "qv", "shard", "vec_id", "score")})

    return run


def search(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k best candidates of each row whose vec_id is divisible by `every`: query_id, rank, vec_id, score.

    vectors(vec_id, embedding). Rows whose id or vector is null or whose vector holds a null or
    non-finite component take no part. Vectors of different lengths do not meet; empty ones score 0. Rows with
    the query's own id are not its candidates; of several rows with one other id each is a
    candidate, and a query id with several different vectors is answered for each of them. Fewer
    than k candidates give fewer rows; scores beyond a long are held at its ends. Other columns are
    ignored.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    # a comparison with null is null, which forall does not take for true
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = v.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(F.coalesce(fine, F.lit(False)))
    v = v.withColumn("qv", F.xxhash64("v"))
    is_query = F.pmod("vec_id", F.lit(every)) == 0
    total = v.select(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q"), F.max(F.size("v")).alias("width")).first()
    most = max(1, TILE_BYTES // (8 * max(total.width or 1, 1)))
    blocks, shards = (max(1, -(-n // min(size, most))) for n, size in ((total.q, QUERY_ROWS), (total.n, SHARD_ROWS)))
    shards = max(shards, min(-(-total.n // SHARD_LEAST), 2 * vectors.sparkSession.sparkContext.defaultParallelism))
    queries = v.where(is_query).dropDuplicates(["vec_id", "qv"])
    deal = lambda m: F.pmod(F.xxhash64(F.lit("tile"), "vec_id"), F.lit(m))
    every_tile = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = queries.select(deal(blocks).alias("block"), every_tile(shards).alias("shard"), F.lit(True).alias("is_query"), "vec_id", "qv", "v")
    right = v.select(every_tile(blocks).alias("block"), deal(shards).alias("shard"), F.lit(False).alias("is_query"), "vec_id", "qv", "v")
    tiles = left.union(right).repartition(max(1, min(blocks * shards, 100_000)), "block", "shard")
    best = tiles.groupBy("block", "shard").applyInArrow(_tiles(k), "query_id long, qv long, shard long, vec_id long, score long")
    lists = best.groupBy("query_id", "qv", "shard").agg(F.collect_list(F.struct((-F.col("score").cast("decimal(20,0)")).alias("s"), "vec_id", "score")).alias("l"))
    merged = lambda df: df.groupBy("query_id", "qv", "shard").agg(F.slice(F.array_sort(F.flatten(F.collect_list("l"))), 1, k).alias("l"))
    left_over = shards
    while left_over > 1:
        lists, left_over = merged(lists.withColumn("shard", F.expr(f"shard div {FAN}"))), -(-left_over // FAN)
        if left_over > 1:
            lists = cut(lists, "lists")
    lists = lists.select("query_id", F.posexplode(F.slice(F.array_sort("l"), 1, k)).alias("p", "e"))
    return lists.select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score"))


ORACLE_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND vec_id IS NOT NULL),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
