"""Target-distribution importance resampling over hashed n-grams, by a position table.

1. Words are exploded with their positions, and a window over each block of a document gives the words
   that follow, so the n-grams of every order are concatenations within a row. Texts are dealt out by row
   before that, so the window itself shuffles nothing; long documents are several blocks, each with the
   few words that its last n-grams reach into.
2. The table is written once, one row a word with the bucket of the n-gram of each order that begins there.
   Counts of the buckets in corpus and target give each bucket's gain; joined to the table, gains add up
   to a document's weight.
3. A Gumbel draw by a hash of the id turns weights into scores, and the highest are the sample. Ranks come
   from a range partition and the sizes of the parts before, not from one sorted task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

ORDERS, BUCKETS, SEED = 2, 10_000, 7
LEAST_WORDS, PERCENT = 20, 25
#: Words of a block, and bytes of text that a task gets (a longer text is one row until it is cut).
BLOCK, TASK_BYTES = 2_048, 8 << 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str) -> Column:
    """The words of a text, A-Z lower-cased; none of a null one."""
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def positions(docs: DataFrame, keep: list[str], orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """(keep, row, b1, b2, ...) of docs(keep, text): one row a word, with the bucket of the n-gram of each
    order that begins with it, null where the document ends before; one row without buckets for a document
    without words. row tells the rows of docs apart."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    # the number of a row within its task of the scan: a task that is repeated gives the same numbers
    rows = docs.select(*keep, "text", F.monotonically_increasing_id().alias("row")).repartition(n, "row")
    listed = rows.select(*keep, "row", words("text").alias("w"))
    at = F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)), F.lit(BLOCK))
    blocks = listed.withColumn("at", F.explode(at)).select(*keep, "row", "at", F.slice("w", F.col("at") + 1, F.lit(BLOCK + orders - 1)).alias("w"))
    each = blocks.select(*keep, "row", "at", F.posexplode_outer("w").alias("pos", "word"))
    by, gram = Window.partitionBy("row", "at").orderBy("pos"), F.col("word")
    out = each.select("*", *[F.lead("word", k).over(by).alias(f"next{k}") for k in range(1, orders)])
    grams = [gram := F.concat(gram, F.lit(" "), F.col(f"next{k}")) if k else gram for k in range(orders)]
    # words after the block's own are those that begin the next block
    out = out.where(F.col("pos").isNull() | (F.col("pos") < BLOCK))
    return out.select(*keep, "row", *[(F.crc32(g.cast("binary")) % buckets).cast("int").alias(f"b{k + 1}") for k, g in enumerate(grams)])


def counted(table: DataFrame, orders: int = ORDERS) -> DataFrame:
    """(bucket, n) over all orders: a row a bucket at most."""
    each = [table.select(F.col(f"b{k + 1}").alias("bucket")).where("bucket is not null").groupBy("bucket").agg(F.count(F.lit(1)).alias("n")) for k in range(orders)]
    return reduce(DataFrame.union, each).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of the buckets of the corpus: floor(1000 ln(share in the target / share in the corpus)),
    both smoothed by one count a bucket."""
    s, t = (cut(counted(x, orders), "counts") for x in (corpus, target))
    of_corpus, of_target = (x.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for x in (s, t))
    both = s.join(t.withColumnRenamed("n", "t"), "bucket", "left")
    above = (F.coalesce("t", F.lit(0)) + 1).cast("double") * F.lit(float(of_corpus + buckets))
    below = (F.col("n") + 1).cast("double") * F.lit(float(of_target + buckets))
    return cut(both.select("bucket", F.floor(1000 * F.log(above / below)).cast("long").alias("gain")), "gains")


def weighted(table: DataFrame, gain: DataFrame, keep: list[str], orders: int = ORDERS) -> DataFrame:
    """(keep, row, n_words, n_features, weight): the floored mean of the gains of a row's n-grams, 0 for none."""
    x = table
    for k in range(orders):  # the gains are two numbers a bucket: a proven bound
        x = x.join(F.broadcast(gain.select(F.col("bucket").alias(f"b{k + 1}"), F.col("gain").alias(f"g{k + 1}"))), f"b{k + 1}", "left")
    n = sum((F.count(f"b{k + 1}") for k in range(orders)), F.lit(0))
    total = sum((F.coalesce(F.sum(f"g{k + 1}"), F.lit(0)) for k in range(orders)), F.lit(0))
    own = x.groupBy("row", *keep).agg(F.count("b1").alias("n_words"), n.cast("long").alias("n_features"), total.cast("long").alias("total"))
    weight = F.when(F.col("n_features") > 0, F.expr("(total - pmod(total, n_features)) div n_features")).otherwise(0)
    return own.select(*keep, "row", "n_words", "n_features", weight.cast("long").alias("weight"))


def noise(doc_id: str, seed: int = SEED) -> Column:
    """floor(1000 x a Gumbel draw) by 32 bits of a hash of the id; a null id is an empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def ranked(scores: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """scores with rank: 1, 2, ... for the floor(percent / 100) of the rows with enough words, by falling
    score, ties to the smaller doc_id (null last) and to the earlier row; null for the others."""
    quota = scores.where(F.col("n_words") >= least).count() * percent // 100
    order = [(F.col("n_words") < least).asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    dealt = scores.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut(dealt.withColumn("m", F.monotonically_increasing_id()), "ranked").withColumns({"part": F.shiftright("m", 33), "at": F.expr("m & ((1L << 33) - 1)")})
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    base = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    place = F.col("base") + F.col("at") + 1
    out = placed.join(F.broadcast(base), "part")
    return out.withColumn("rank", F.when((F.col("n_words") >= least) & (place <= quota), place)).drop("m", "part", "at", "base")


def importance(docs: DataFrame, target: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS, percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_features, weight, score and, if it is drawn, rank.

    Texts of target(text) are what the sample should look like. A null, empty or wordless text has no
    features and weight 0, and is not drawn, as are texts of fewer than `least` words. Rows that repeat
    count and compete each by themselves. An empty corpus gives no rows; with an empty target only rarity
    in the corpus counts. Other columns are ignored.
    """
    out = _scores(docs, target, ["doc_id"], orders, buckets, seed)
    return ranked(out, percent, least).select("doc_id", "n_features", "weight", "score", "rank")


def _scores(docs: DataFrame, target: DataFrame, keep: list[str], orders: int, buckets: int, seed: int) -> DataFrame:
    corpus = cut(positions(docs.select(*keep, "text"), keep, orders, buckets), "positions")
    goal = cut(positions(target.select("text"), [], orders, buckets), "target")
    own = weighted(corpus, gains(corpus, goal, orders, buckets), keep, orders)
    return cut(own.withColumn("score", F.col("weight") + noise("doc_id", seed)), "weights")


def resample(docs: DataFrame, target: DataFrame, orders: int = ORDERS, buckets: int = BUCKETS, percent: int = PERCENT, least: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """The rows of docs(doc_id, text, ...) that are drawn, all columns kept; a row that repeats (id and text)
    stays as often as it is there if any copy is drawn."""
    mark = F.xxhash64("text")
    keyed = docs.select("doc_id", "text").withColumn("__mark", mark)
    drawn = ranked(_scores(keyed, target, ["doc_id", "__mark"], orders, buckets, seed), percent, least).where("rank is not null")
    own = cut(drawn.select(F.col("doc_id").alias("__id"), "__mark").distinct(), "drawn")
    return docs.join(own, docs["doc_id"].eqNullSafe(own["__id"]) & (mark == own["__mark"]), "left_semi")


#: crc32 by its definition: a table of 256 entries made by rule, then one step a byte.
ORACLE_SQL = r"""
WITH b AS (SELECT k, list_reduce(list_prepend(k, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM (SELECT unnest(range(256)) AS k)),
c AS (SELECT list(v ORDER BY k) AS t FROM b),
w AS (SELECT true AS own, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT false, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
g AS (SELECT own, doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM w),
n AS MATERIALIZED (SELECT own, doc_id, g, count(*) AS n FROM g GROUP BY ALL),
h AS (SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM n)),
k AS MATERIALIZED (SELECT g, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT)), lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM h, c),
f AS (SELECT own, doc_id, bucket, sum(n)::BIGINT AS n FROM n JOIN k USING (g) GROUP BY ALL),
z AS (SELECT coalesce(sum(n) FILTER (WHERE own), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE NOT own), 0)::DOUBLE AS t FROM f),
q AS (SELECT bucket, floor(1000 * ln(((coalesce(sum(n) FILTER (WHERE NOT own), 0) + 1)::DOUBLE * (z.s + 10000)) / ((coalesce(sum(n) FILTER (WHERE own), 0) + 1)::DOUBLE * (z.t + 10000))))::BIGINT AS gain FROM f, z GROUP BY bucket, z.s, z.t),
d AS (SELECT doc_id, sum(n)::BIGINT AS m, sum(n * gain)::BIGINT AS total FROM f JOIN q USING (bucket) WHERE own GROUP BY 1),
e AS (SELECT w.doc_id, len(w) AS words, coalesce(m, 0)::BIGINT AS n_features, CASE WHEN m > 0 THEN (total - ((total % m) + m) % m) // m ELSE 0 END::BIGINT AS weight,
  ('0x' || substr(sha256('7:' || w.doc_id), 1, 8))::BIGINT AS h FROM w LEFT JOIN d USING (doc_id) WHERE own),
r AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM e),
p AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (WHERE words >= 20) OVER () AS many FROM r)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= many * 25 // 100 THEN place END::BIGINT AS rank FROM p
"""
