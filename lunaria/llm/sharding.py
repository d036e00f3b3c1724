"""Sharding by minimax contiguous partition (DataFrame functions only).

Rows with equal texts form one atomic group. A group that is larger than a fair share of what is left for
the shards left is a shard by itself, the largest first, so that it does not set the others' size. The
other groups are ordered by 60 bits of the text's md5 (a null text comes first; texts whose hashes collide
form one group, so equal texts always stay together).
The smallest capacity C for which a greedy pass over the ordered group sizes needs at most K shards is
found by binary search, and the order is cut where that pass cuts.

No task and not the driver ever holds all group sizes. The driver works on segment sums (ranges of the
hash order; a group above a small share of a shard is a segment by itself). A greedy pass over segments
gives two bounds: taking segments whole reaches no farther than the true pass, taking them as divisible
reaches at least as far. Only segments in which a cut may still fall are split more finely (one narrow
aggregation over their groups for each level) until both bounds agree on C and on every cut.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Bits of the hash, bits of the first segments, and parts that a segment is split into.
HASH_BITS, FIRST_BITS, FAN = 60, 12, 16
#: Groups above 1 / HEAVY of a fair shard are segments by themselves: HEAVY x shards at most.
HEAVY = 64
#: Segments that are split at a level, the largest first: the bound of what the driver gets at once is FAN times that.
SPLIT = 4096
#: Slots of a shard are numbered in so many independent parts, so no task sorts a whole shard.
PARTS = 256
KEY = ["parent", "sub"]


class _Segments:
    """Ordered segments (lowest hash, highest hash, bytes, groups)."""

    def __init__(self, rows: list[tuple[int, int, int, int]]):
        self.rows = sorted(rows)
        self.edges = [0]
        for r in self.rows:
            self.edges.append(self.edges[-1] + r[2])
        self.total = self.edges[-1]

    def whole(self, capacity: int, shards: int) -> list[int]:
        """Ends (as segment indexes) of the shards when segments are not divided."""
        at, cuts = 0, []
        for _ in range(shards):
            at = bisect_right(self.edges, self.edges[at] + capacity) - 1
            cuts.append(at)
        return cuts

    def divided(self, capacity: int, shards: int) -> list[int]:
        """Upper bounds (in bytes) of the shards' ends; a segment of one group is never divided."""
        at, ends = 0, []
        for _ in range(shards):
            at = min(self.total, at + capacity)
            k = bisect_right(self.edges, at) - 1
            if k < len(self.rows) and self.rows[k][3] == 1:
                at = self.edges[k]
            ends.append(at)
        return ends

    def search(self, reach, low: int, high: int) -> int:
        while low < high:
            mid = (low + high) // 2
            low, high = (low, mid) if reach(mid) >= self.total else (mid + 1, high)
        return low

    def open(self, low: int, high: int, shards: int) -> list[int]:
        """Segments of several groups in which a pass with a capacity from low to high may cut."""
        found = set()
        for a, b in zip(self.whole(low, shards), self.divided(high, shards), strict=True):
            while a < len(self.rows) and self.edges[a] < b:
                if self.rows[a][3] > 1:
                    found.add(a)
                a += 1
        return sorted(found, key=lambda k: -self.rows[k][2])[:SPLIT]


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """(capacity, lowest hash of shards 1, 2, ...) for groups(h long, bytes long, one row a group), h from
    -1 to 2^60 - 1. Fewer groups than shards leave the last shards empty; no group gives (0, [])."""
    all_of = groups.agg(F.sum("bytes"), F.max("bytes")).first()
    if all_of[0] is None:
        return 0, []
    total, largest = all_of
    cell = F.shiftright("h", HASH_BITS - FIRST_BITS)
    heavy = F.col("bytes") > total // (HEAVY * shards)
    alone = groups.where(heavy)
    above = alone.groupBy(cell.alias("parent")).agg(F.collect_list("h").alias("heavy"))  # HEAVY x shards hashes at most
    rows = groups.where(~heavy).withColumn("parent", cell).join(F.broadcast(above), "parent", "left")
    below = F.coalesce(F.size(F.filter("heavy", lambda x: x < F.col("h"))), F.lit(0))
    rows = rows.select("parent", F.when(F.col("heavy").isNull(), 0).otherwise(below).cast("long").alias("sub"), "h", "bytes")

    levels: list[tuple[DataFrame, dict[int, tuple[int, int, int]]]] = []  # groups, and (parent, sub, highest hash) of segments by lowest hash

    def summed(rows: DataFrame) -> list[tuple[int, int, int, int]]:
        sums = rows.groupBy(KEY).agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
        levels.append((rows, {r.lo: (r.parent, r["sub"], r.hi) for r in sums}))
        return [(r.lo, r.hi, r.bytes, r.n) for r in sums]

    seg = _Segments(summed(rows) + [(r.h, r.h, r.bytes, 1) for r in alone.select("h", "bytes").collect()])
    while True:
        least = max(largest, -(-total // shards))
        high = seg.search(lambda c: seg.edges[seg.whole(c, shards)[-1]], least, total)
        low = seg.search(lambda c: seg.divided(c, shards)[-1], least, high)
        split = seg.open(low, high, shards)
        if not split:
            ends = seg.whole(high, shards)
            return high, [seg.rows[k][0] for k in ends[:-1] if k < len(seg.rows)]
        gone, more = {seg.rows[k][0] for k in split}, []
        for rows, own in list(levels):
            if not (mine := sorted(gone & own.keys())):
                continue
            parts = [(*own[lo][:2], lo, (own.pop(lo)[2] - lo) // FAN + 1) for lo in mine]
            values = ", ".join(f"({p}L, {s}L, {lo}L, {step}L)" for p, s, lo, step in parts)  # SPLIT rows at most
            chosen = groups.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(parent, sub, lo, step)")
            finer = rows.join(F.broadcast(chosen), KEY).select(F.col("lo").alias("parent"), F.expr("(h - lo) div step").alias("sub"), "h", "bytes")
            more += summed(cut(finer, "split"))
        seg = _Segments([r for k, r in enumerate(seg.rows) if k not in set(split)] + more)


def outsized(groups: DataFrame, shards: int) -> list[int]:
    """h of the groups that are shards by themselves, the largest first (ties by h), fewer than `shards`."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    out, left = [], shards
    for r in groups.orderBy(F.col("bytes").desc(), "h").limit(shards - 1).collect():
        if r.bytes * left <= total:
            break
        out.append(r.h)
        total, left = total - r.bytes, left - 1
    return out


def added(terms: list[Column]) -> Column:
    """The sum of terms as a balanced tree, so that many terms do not nest deeply."""
    while len(terms) > 1:
        terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + ([terms[-1]] if len(terms) % 2 else [])
    return terms[0]


def text_hash(text_col: str) -> Column:
    """60 bits of the text's md5; -1 for null."""
    return F.coalesce(F.conv(F.substring(F.md5(F.col(text_col).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long"), F.lit(-1))


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).

    size is the UTF-8 bytes of the text plus 1; a null text has size 1 and a null text_crc32 and
    forms a group of its own, apart from the empty text. Slots run from 0 without gaps in each shard.
    Repeated rows are equal texts, so they share a shard; the order of exact repeats is immaterial.
    Texts that outweigh a fair shard have the last shards to themselves; the others fill those before, whose
    sizes are near equal. An empty table gives an empty result; other columns are ignored.
    """
    narrow = cut(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32(F.col(text_col).cast("binary")).alias("text_crc32"),
            text_hash(text_col).alias("h"),
        ),
        "sizes",
    )
    groups = cut(narrow.groupBy("h").agg(F.sum("size").alias("bytes")), "groups")
    alone = outsized(groups, shards)
    _, cuts = minimax_cuts(groups.where(~F.col("h").isin(alone)) if alone else groups, shards - len(alone))
    number = added([F.lit(0), *((F.col("h") >= F.lit(c)).cast("int") for c in cuts)])
    for k, h in enumerate(alone):
        number = F.when(F.col("h") == F.lit(h), shards - len(alone) + k).otherwise(number)
    part = F.conv(F.substring(F.md5(F.concat(F.lit("part:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")), 1, 2), 16, 10).cast("int")
    placed = narrow.withColumn("shard", number.cast("int")).withColumn("part", part)
    counts = placed.groupBy("shard", "part").count()  # at most shards x PARTS rows
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("h", "doc_id")) - 1
    return (
        placed.withColumn("k", within)
        .join(F.broadcast(starts), ["shard", "part"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("start") + F.col("k")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )


def _crc_table() -> str:
    """The 256 values of the CRC-32 of the contract, as a list in SQL."""
    out = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return "[" + ", ".join(f"{n}::BIGINT" for n in out) + "]"


#: The same search over all groups: a recursion whose steps are the jumps of greedy passes.
ORACLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, text, coalesce(strlen(text), 0) + 1 AS size, CASE WHEN text IS NULL THEN -1 ELSE ('0x' || substr(md5(text), 1, {HASH_BITS // 4}))::BIGINT END AS h,
    ('0x' || substr(md5('part:' || coalesce(doc_id::VARCHAR, 'null')), 1, 2))::BIGINT AS part FROM documents),
crc AS (SELECT DISTINCT h, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda y: ('0x' || y)::BIGINT)),
  lambda c, y: xor(c >> 8, {_crc_table()}[(xor(c, y) & 255) + 1])), 4294967295)::BIGINT AS text_crc32 FROM (SELECT DISTINCT text, h FROM d WHERE text IS NOT NULL)),
g0 AS (SELECT h, sum(size)::BIGINT AS b FROM d GROUP BY h), g1 AS (SELECT *, row_number() OVER w AS r, sum(b) OVER () - coalesce(sum(b) OVER (ORDER BY b DESC, h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest FROM g0 WINDOW w AS (ORDER BY b DESC, h)),
g2 AS (SELECT *, bool_and(r < 16 AND b * (17 - r) > rest) OVER (ORDER BY r) AS alone FROM g1), sh AS (SELECT 16 - count(*) FILTER (WHERE alone) AS n FROM g2),
g AS (SELECT h, b FROM g2 WHERE NOT alone), c AS (SELECT h, b, sum(b) OVER (ORDER BY h)::BIGINT AS e FROM g),
total AS (SELECT sum(b)::BIGINT AS t, max(b)::BIGINT AS m, any_value(n)::BIGINT AS n FROM g, sh),
s AS (SELECT greatest(m, (t + n - 1) // n) AS lo, t AS hi, 0::BIGINT AS pos, 0 AS step, t, n FROM total
  UNION ALL SELECT CASE WHEN step = n AND pos < t THEN (lo + hi) // 2 + 1 ELSE lo END, CASE WHEN pos >= t THEN (lo + hi) // 2 ELSE hi END,
    CASE WHEN step = n OR pos >= t THEN 0 ELSE (SELECT coalesce(max(e), 0) FROM c WHERE e <= s.pos + (s.lo + s.hi) // 2) END,
    CASE WHEN step = n OR pos >= t THEN 0 ELSE step + 1 END, t, n FROM s WHERE lo < hi),
cap AS (SELECT max(lo) AS cap FROM s WHERE lo >= hi),
k AS (SELECT 0 AS step, 0::BIGINT AS pos UNION ALL SELECT step + 1, (SELECT coalesce(max(e), 0) FROM c WHERE e <= k.pos + (SELECT cap FROM cap)) FROM k WHERE step < (SELECT n FROM sh) - 1),
p AS (SELECT h, (SELECT count(*) FROM k WHERE step > 0 AND pos <= c.e - c.b)::INTEGER AS shard FROM c UNION ALL SELECT h, ((SELECT n FROM sh) + r - 1)::INTEGER FROM g2 WHERE alone)
SELECT d.doc_id, d.size::BIGINT AS size, crc.text_crc32, 'bytes' AS law, p.shard, row_number() OVER (PARTITION BY p.shard ORDER BY d.part, d.h, d.doc_id NULLS FIRST) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM d JOIN p USING (h) LEFT JOIN crc USING (h)
"""
