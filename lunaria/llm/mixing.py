"""Mixing sources to target weights (DataFrame functions only).

Tokens are summed per source; targets share all tokens by weight, capped at a multiple of what a
source has; rate = target / source tokens. A document is emitted floor(rate) times, plus once more
if its draw falls below the fraction. A draw is a hash of the id, turned by one of TURNS fixed seeds; each
source takes the seed whose mix comes nearest to its target (one narrow aggregate tries them all), so
sources of few or long documents meet their targets too. Draws depend on the ids and sizes alone, so a
rerun, a retried task or another cluster gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh

#: Fixed values of the contract.
WEIGHTS = (5, 2, 1)
MOST = 3
SEED = "mix"
#: Seeds that are tried for each source.
TURNS = 32
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources ordered by code point (UTF-8 binary order), null last, take the weights in turn. Targets
    above most x source_size are held there and the excess is shared by weight among the others until
    none is above: in the order of cap / weight the held sources are a prefix, so running sums give
    the fixed point at once. The windows run over one row per source in one task: sources are corpora or
    hosts, up to some millions of short rows.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    k = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(k, F.lit(len(weights))) + 1).cast("int")).cast("long")
    w = per.select("source", "source_size", k.alias("k"), weight.alias("w"), (F.col("source_size") * most).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "k")
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    w = w.select(
        "*",
        (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0))).alias("w_left"),
        F.row_number().over(order).alias("at"),
    )
    held = F.col("cap") * F.col("w_left") < F.col("w") * F.col("left")
    w = w.withColumn("free_at", F.min(F.when(~held, F.col("at"))).over(every))
    w = w.withColumn("free_left", F.max(F.when(F.col("at") == F.col("free_at"), F.col("left"))).over(every)).withColumn("free_w", F.max(F.when(F.col("at") == F.col("free_at"), F.col("w_left"))).over(every))
    free = (F.col("w") * F.col("free_left")).cast("double") / F.col("free_w").cast("double")
    return w.select("source", "source_size", F.when(F.col("at") >= F.col("free_at"), free).otherwise(F.col("cap").cast("double")).alias("target"))


def draw(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """A value in [0, 1) from the first 32 bits of md5(seed:id); a null id counts as the word null."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def copies(drawn: Column, rate: Column, turn: Column) -> Column:
    """floor(rate), and one more if the draw, turned by turn / TURNS round the unit circle, is below the rest."""
    turned = drawn + turn.cast("double") / F.lit(float(TURNS))
    return F.floor(rate) + ((turned - F.floor(turned)) < (rate - F.floor(rate))).cast("long")


def plans(sized: DataFrame) -> DataFrame:
    """(source, source_size, target, rate, turn) of rows (source, size, drawn): one row a source."""
    t = cut(source_targets(sized), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size").cast("double")).otherwise(F.lit(0.0))
    t = t.select(F.col("source").alias("t_source"), "source_size", "target", rate.alias("rate"))
    met = sized.join(t, F.col("source").eqNullSafe(F.col("t_source")))
    tried = met.groupBy("t_source", "source_size", "target", "rate").agg(*[F.sum(F.col("size") * copies(F.col("drawn"), F.col("rate"), F.lit(k))).alias(f"n{k}") for k in range(TURNS)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"n{k}").cast("double") - F.col("target")).alias("off"), F.lit(k).alias("turn")) for k in range(TURNS)]))
    return cut(tried.select("t_source", "source_size", "target", "rate", best["turn"].alias("turn")), "plans")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The narrow table from which all is planned; words are counted once."""
    return cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), draw(id_col).alias("drawn")), "sized")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken = size x copies.

    A null or blank text has size 0; a null source is a source of its own. Rows that repeat an id
    repeat its draw. A source without words has target 0. An empty table gives an empty result.
    """
    sized = _sized(docs, id_col, text_col, source_col)
    joined = sized.join(plans(sized), F.col("source").eqNullSafe(F.col("t_source")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("drawn"), F.col("rate"), F.col("turn"))).cast("long").alias("taken"))


def emit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs with every row repeated as often as the mix takes it (not at all, if 0), columns unchanged.
    The second pass over docs reads only their sources' rates: texts are not shuffled."""
    source, plan, copy = (fresh(docs, x) for x in ("__source", "__plan", "__copy"))
    own = plans(_sized(docs, id_col, text_col, source_col)).select(F.col("t_source").alias(source), F.struct("rate", "turn").alias(plan))
    joined = docs.join(own, F.col(source_col).eqNullSafe(F.col(source)))
    n = copies(draw(id_col), F.col(f"{plan}.rate"), F.col(f"{plan}.turn")).cast("int")
    return joined.where(n > 0).select(*[docs[c] for c in docs.columns], F.explode(F.array_repeat(F.lit(0), n)).alias(copy)).drop(copy)


ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
num AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS k FROM per),
w AS (SELECT *, CASE k % 3 WHEN 0 THEN {WEIGHTS[0]} WHEN 1 THEN {WEIGHTS[1]} ELSE {WEIGHTS[2]} END::BIGINT AS w, {MOST} * source_size AS cap FROM num),
o AS (SELECT *, row_number() OVER (ORDER BY cap::DOUBLE / w, k) AS pos,
    sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap::DOUBLE / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wl FROM w),
f AS (SELECT min(pos) AS free_at FROM o WHERE NOT cap * wl < w * l),
g AS (SELECT free_at, l AS free_left, wl AS free_w FROM o, f WHERE pos = free_at),
t AS (SELECT source, source_size, CASE WHEN pos >= free_at THEN (w * free_left)::DOUBLE / free_w::DOUBLE ELSE cap::DOUBLE END AS target FROM o, g),
r AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, 'null')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM sized d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, u + turn::DOUBLE / {TURNS} AS v FROM r, (SELECT unnest(range({TURNS})) AS turn)),
e AS (SELECT *, size * (floor(rate)::BIGINT + CASE WHEN v - floor(v) < rate - floor(rate) THEN 1 ELSE 0 END) AS taken FROM c),
n AS (SELECT source, turn, abs(sum(taken)::DOUBLE - any_value(target)) AS off FROM e GROUP BY source, turn),
b AS (SELECT source, turn FROM n QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, turn) = 1)
SELECT e.doc_id, e.size, e.source_size, e.target, e.taken::BIGINT AS taken FROM e JOIN b ON e.source IS NOT DISTINCT FROM b.source AND e.turn = b.turn
"""
