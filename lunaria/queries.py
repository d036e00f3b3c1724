"""Registered queries: each operator over the stand-in views, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import fir
from .functions import resample as polyphase
from .operators import aggregate, align, annotate, boost, dsp, evaluate, features, merge, metrics, models, motion, pulse, scores, segment, select, split, timeline, train
from .plans.pipeline import bundled
from .plans.transforms import Signal, beside
from .schema import EPOCH_S, STAGES, UNKNOWN, UNSCORED, SHORT_LABELS
from .streaming import signals
from .streaming.replay import replay
from .views import ANN, EMB, IMU, LAB, SIG, ann, emb, imu, sig, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
EVENT_TYPES = ("view", "click", "signup", "purchase", "error")


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def labels(spark: SparkSession, d: str) -> DataFrame:
    return select.map_labels(ann(spark, d), STAGES, UNKNOWN).select("recording_id", "epoch_idx", "label")


# ------------------------------------------------------------------ selection


@query(f"WITH {SIG} SELECT recording_id, sample_idx, CAST(trunc(sample_idx * (1e9::DOUBLE / 256)) AS BIGINT) AS ts_ns FROM sig")
def time_index(spark, d):
    return select.with_time(sig(spark, d).select("recording_id", "sample_idx"), 256.0)


@query(f"WITH {IMU} SELECT recording_id, sample_idx, x, z FROM imu")
def select_channels(spark, d):
    return select.select_channels(imu(spark, d), ["x", "z"])


@query(f"WITH {IMU} SELECT recording_id, sample_idx, z FROM imu")
def select_positions(spark, d):
    return select.select_positions(imu(spark, d), [2])


@query(f"WITH {IMU} SELECT recording_id, sample_idx, x AS ACC_X, y AS ACC_Y, z FROM imu")
def rename_channels(spark, d):
    return select.rename_channels(imu(spark, d), {"x": "ACC_X", "y": "ACC_Y"})


@query(f"WITH {SIG} SELECT recording_id, sample_idx, value FROM sig WHERE sample_idx >= 10 AND sample_idx < 50")
def slice_samples(spark, d):
    return select.slice_samples(sig(spark, d).select("recording_id", "sample_idx", "value"), 10, 50)


@query(f"WITH {SIG} SELECT recording_id, sample_idx, value FROM sig WHERE value > 50 AND event_type <> 'error'")
def mask_samples(spark, d):
    return select.mask_samples(sig(spark, d), (F.col("value") > 50) & (F.col("event_type") != "error")).select("recording_id", "sample_idx", "value")


@query(f"WITH {IMU} SELECT recording_id, sample_idx, CASE WHEN z > 5 THEN 0.0 ELSE x END AS x, y, z FROM imu")
def assign_where(spark, d):
    return select.assign_where(imu(spark, d), F.col("z") > 5, ["x"], 0.0)


@query(f"WITH {SIG} SELECT recording_id, sample_idx, value, sample_idx * 1000000000 AS ts_ns FROM sig WHERE sample_idx * 1000000000 BETWEEN 10000000000 AND 40000000000")
def slice_by_time(spark, d):
    s = select.with_time(sig(spark, d).select("recording_id", "sample_idx", "value"), 1.0)
    return select.slice_by_time(s, 10_000_000_000, 40_000_000_000)


@query(f"WITH {SIG} SELECT recording_id, (sample_idx + 3) % count(*) OVER (PARTITION BY recording_id) AS sample_idx, value FROM sig")
def roll(spark, d):
    return select.roll(sig(spark, d).select("recording_id", "sample_idx", "value"), 3)


@query(f"""WITH {IMU}, q AS (SELECT recording_id, quantile_cont(y, 0.25) AS a, quantile_cont(y, 0.75) AS b FROM imu GROUP BY 1)
SELECT recording_id, sample_idx, round(least(greatest(y, a - 0.25 * (b - a)), b + 0.25 * (b - a)), 9) AS value FROM imu JOIN q USING (recording_id)""")
def clip_iqr(spark, d):
    s = imu(spark, d).select("recording_id", "sample_idx", F.col("y").alias("value"))
    return rounded(select.clip_iqr(s, 0.25), "value", digits=9)


@query(f"WITH {IMU} SELECT recording_id, round(quantile_cont(y, 0.25), 9) AS q25, round(quantile_cont(y, 0.75), 9) AS q75 FROM imu GROUP BY 1")
def channel_quartiles(spark, d):
    return rounded(select.quartiles(imu(spark, d), "y"), "q25", "q75", digits=9)


@query(f"WITH {SIG} SELECT recording_id, sample_idx, event_type AS channel, CASE WHEN event_type IN ('view', 'click') THEN value * 1e6::DOUBLE ELSE value END AS value FROM sig")
def unit_scale(spark, d):
    s = sig(spark, d).select("recording_id", "sample_idx", F.col("event_type").alias("channel"), "value")
    return select.scale_units(s, "EEG", 1e6, {"view": "EEG", "click": "EEG", "signup": "PPG", "purchase": "PPG", "error": "OTHER"})


@query(f"WITH {LAB} SELECT * FROM lab")
def map_labels(spark, d):
    return labels(spark, d)


@query(f"WITH {LAB} SELECT recording_id, epoch_idx, CASE label WHEN 'UNKNOWN' THEN 'Uns' WHEN 'REM' THEN 'R' ELSE label END AS label FROM lab")
def map_labels_composed(spark, d):
    both = select.composed(STAGES, SHORT_LABELS, UNSCORED)
    return select.map_labels(ann(spark, d), both, UNSCORED).select("recording_id", "epoch_idx", "label")


@query(f"WITH {LAB} SELECT recording_id, epoch_idx, label FROM lab WHERE label <> 'UNKNOWN'")
def drop_unscored(spark, d):
    return labels(spark, d).where(F.col("label") != UNKNOWN)


@query(f"WITH {IMU} SELECT 'ax' AS output, recording_id, sample_idx, x AS value FROM imu UNION ALL SELECT 'ay', recording_id, sample_idx, y FROM imu UNION ALL SELECT 'az', recording_id, sample_idx, z FROM imu")
def multi_output_split(spark, d):
    parts = select.split_outputs(imu(spark, d), ["ax", "ay", "az"])
    frames = [f.select(F.lit(o).alias("output"), "recording_id", "sample_idx", "value") for o, f in parts.items()]
    return frames[0].union(frames[1]).union(frames[2])


@query(f"WITH {SIG}, n AS (SELECT *, count(*) OVER (PARTITION BY recording_id) AS n FROM sig) SELECT recording_id, sample_idx, value FROM n WHERE sample_idx < n // 7 * 7")
def tail_drop(spark, d):
    return select.drop_tail(sig(spark, d).select("recording_id", "sample_idx", "value"), 7)


# ------------------------------------------------------------------ alignment and joins


@query(f"WITH {IMU} SELECT recording_id, sample_idx, x, y, z FROM imu")
def stack_channels(spark, d):
    long = align.to_long(imu(spark, d), ["x", "y", "z"])
    return align.stack_long(long, ["x", "y", "z"])


@query(f"WITH {IMU} SELECT recording_id, sample_idx, z, round(sqrt(x*x + y*y + z*z), 6) AS magnitude FROM imu")
def stack_join(spark, d):
    wide = imu(spark, d)
    return rounded(align.stack_wide([select.select_channels(wide, ["z"]), motion.dynamic(wide, 1.0).drop("derivative")]), "magnitude")


@query("""WITH e AS (SELECT user_id AS recording_id, ts, event_id, value, event_type FROM events),
a AS (SELECT recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY ts, event_id) - 1 AS sample_idx, value FROM e WHERE event_type = 'view'),
b AS (SELECT recording_id, row_number() OVER (PARTITION BY recording_id ORDER BY ts, event_id) - 1 AS sample_idx, value FROM e WHERE event_type = 'click'),
n AS (SELECT recording_id, count(*) AS n FROM a GROUP BY 1)
SELECT * FROM a UNION ALL SELECT recording_id, sample_idx + coalesce(n, 0), value FROM b LEFT JOIN n USING (recording_id)""")
def concatenate(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("recording_id"), "ts", "event_id", "value", "event_type")
    at = F.row_number().over(Window.partitionBy("recording_id").orderBy("ts", "event_id")).cast("long") - 1
    return align.concatenate([e.where(F.col("event_type") == t).select("recording_id", at.alias("sample_idx"), "value") for t in ("view", "click")])


@query("SELECT c_custkey AS recording_id, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def resume_anti_join(spark, d):
    recordings = table(spark, d, "customer").select(F.col("c_custkey").alias("recording_id"), "c_name")
    status = F.when(F.col("o_orderstatus") == "F", merge.SUCCESS).otherwise(merge.FAILED)
    return merge.pending(recordings, table(spark, d, "orders").select(F.col("o_custkey").alias("recording_id"), status.alias("export_status")))


@query("SELECT s_suppkey, s_nationkey, n_name, CASE WHEN n_name IS NULL THEN 'missing' ELSE 'found' END AS status FROM supplier LEFT JOIN (SELECT n_nationkey AS s_nationkey, n_name FROM nation WHERE n_regionkey < 3) USING (s_nationkey)")
def scoring_lookup(spark, d):
    files = table(spark, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    out = merge.attach_unique(table(spark, d, "supplier").select("s_suppkey", "s_nationkey"), files, ["s_nationkey"])
    return out.select("s_suppkey", "s_nationkey", "n_name", F.when(F.col("n_name").isNull(), "missing").otherwise("found").alias("status"))


@query("SELECT c_custkey AS recording_id, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def annotated_only(spark, d):
    recordings = table(spark, d, "customer").select(F.col("c_custkey").alias("recording_id"), "c_name")
    return select.with_annotations_only(recordings, table(spark, d, "orders").select(F.col("o_custkey").alias("recording_id")))


@query("""WITH n AS (SELECT o_custkey AS recording_id, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
o AS (SELECT c_custkey AS recording_id, c_acctbal AS total, c_mktsegment AS segment FROM customer WHERE c_acctbal > 0)
SELECT recording_id, coalesce(n.total, o.total) AS total, o.segment FROM n FULL OUTER JOIN o USING (recording_id)""")
def combine_first(spark, d):
    new = table(spark, d, "orders").where(F.col("o_orderstatus") == "O").groupBy(F.col("o_custkey").alias("recording_id")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    old = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("recording_id"), F.col("c_acctbal").alias("total"), F.col("c_mktsegment").alias("segment"))
    return merge.combine_first(new, old, ["recording_id"])


@query("""WITH u AS (SELECT o_custkey AS recording_id, o_orderkey AS version, o_orderstatus AS export_status, NULL AS error FROM orders WHERE o_orderpriority < '3'
UNION ALL SELECT o_custkey, o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority >= '3')
SELECT recording_id, version, export_status, error FROM u QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY version DESC) = 1""")
def catalog_upsert(spark, d):
    o = table(spark, d, "orders")
    base = [F.col("o_custkey").alias("recording_id"), F.col("o_orderkey").alias("version"), F.col("o_orderstatus").alias("export_status")]
    old = o.where("o_orderpriority < '3'").select(*base)
    return merge.upsert(old, o.where("o_orderpriority >= '3'").select(*base, F.col("o_orderpriority").alias("error")), ["recording_id"], ["version"])


# ------------------------------------------------------------------ annotations

_PPG = """ppg AS (SELECT recording_id, sample_idx, value * 10 AS ibi, (sample_idx * 37 % 101) / 100.0::DOUBLE AS quality FROM sig),
seg AS (SELECT recording_id, sample_idx // 5 AS epoch_idx, avg(CASE WHEN quality >= 0.3::DOUBLE AND ibi BETWEEN 100 AND 900 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS valid_ratio FROM ppg GROUP BY 1, 2)"""


def _segments(spark, d):
    ppg = sig(spark, d).select("recording_id", "sample_idx", (F.col("value") * 10).alias("ibi"), (F.pmod(F.col("sample_idx") * 37, F.lit(101)).cast("double") / F.lit(100.0)).alias("quality"))
    return segment.artifact_segments(ppg, 5, 0.3, (100.0, 900.0), 0.5)


@query(f"WITH {SIG}, {_PPG} SELECT recording_id, epoch_idx, round(valid_ratio, 6) AS valid_ratio, valid_ratio < 0.5 AS is_artifact FROM seg")
def ppg_artifact_segments(spark, d):
    return rounded(_segments(spark, d), "valid_ratio")


@query(f"WITH {LAB}, {_PPG} SELECT recording_id, l.epoch_idx, CASE WHEN valid_ratio < 0.5 THEN 'ARTIFACT' ELSE label END AS label FROM lab l LEFT JOIN seg USING (recording_id, epoch_idx)")
def merge_artifacts(spark, d):
    return annotate.merge_artifacts(labels(spark, d), _segments(spark, d))


@query(f"WITH {SIG}, {_PPG} SELECT recording_id, count(*) FILTER (WHERE valid_ratio < 0.5) AS n_artifacts FROM seg GROUP BY 1")
def artifact_count(spark, d):
    return aggregate.artifact_count(_segments(spark, d))


@query(f"""WITH {SIG}, i AS (SELECT recording_id, sample_idx * 7 AS a, sample_idx * 7 + CAST(trunc(value) AS BIGINT) % 60 AS b FROM sig WHERE event_type = 'signup')
SELECT DISTINCT recording_id, unnest(range(a // 30, b // 30 + 1)) AS epoch_idx FROM i""")
def interval_to_epoch(spark, d):
    s = sig(spark, d).where(F.col("event_type") == "signup")
    spans = s.select("recording_id", (F.col("sample_idx") * 7).alias("start_idx"), (F.col("sample_idx") * 7 + F.col("value").cast("long") % 60).alias("end_idx"))
    return annotate.intervals_to_epochs(spans, 30)


@query(f"""WITH {SIG}, i AS (SELECT recording_id, sample_idx * 7 AS a, sample_idx * 7 + CAST(trunc(value) AS BIGINT) % 60 AS b FROM sig WHERE event_type = 'signup'),
t AS (SELECT DISTINCT recording_id, unnest(range(a // 30, b // 30 + 1)) AS epoch_idx FROM i)
SELECT s.recording_id, s.sample_idx AS epoch_idx, CAST(CASE WHEN t.epoch_idx IS NULL THEN 0 ELSE 1 END AS INTEGER) AS flag FROM sig s LEFT JOIN t ON s.recording_id = t.recording_id AND s.sample_idx = t.epoch_idx""")
def epoch_flags(spark, d):
    epochs = sig(spark, d).select("recording_id", F.col("sample_idx").alias("epoch_idx"))
    return annotate.flag_epochs(epochs, interval_to_epoch(spark, d))


@query(f"""WITH {LAB}, r AS (SELECT recording_id, epoch_idx AS run_no, epoch_idx * 40 AS s, 25 + CASE WHEN label = 'W' THEN 60 ELSE 20 END AS t, label FROM lab),
n AS (SELECT recording_id, arg_max((s + t) // 30, run_no) AS n FROM r GROUP BY 1), spine AS (SELECT recording_id, unnest(range(n)) AS epoch_idx FROM n),
x AS (SELECT recording_id, run_no, label, unnest(range(s // 30, (s + t) // 30)) AS epoch_idx FROM r), w AS (SELECT recording_id, epoch_idx, arg_max(label, run_no) AS label FROM x GROUP BY 1, 2)
SELECT recording_id, epoch_idx, coalesce(label, 'UNKNOWN') AS label FROM spine LEFT JOIN w USING (recording_id, epoch_idx)""")
def expand_runs(spark, d):
    length = F.lit(25) + F.when(F.col("label") == "W", 60).otherwise(20)
    runs = labels(spark, d).select("recording_id", F.col("epoch_idx").alias("run_no"), (F.col("epoch_idx") * 40).alias("start_s"), length.cast("long").alias("duration_s"), "label")
    return annotate.expand_runs(runs)


_RUNS = f"""{LAB}, o AS (SELECT *, CASE WHEN label IS NOT DISTINCT FROM lag(label) OVER w AND epoch_idx > 0 THEN 0 ELSE 1 END AS opens FROM lab WINDOW w AS (PARTITION BY recording_id ORDER BY epoch_idx)),
g AS (SELECT *, sum(opens) OVER (PARTITION BY recording_id ORDER BY epoch_idx) AS g FROM o)"""


@query(f"WITH {_RUNS} SELECT recording_id, min(epoch_idx) * 30 AS start_s, count(*) * 30 AS duration_s, any_value(label) AS label FROM g GROUP BY recording_id, g")
def squeeze_runs(spark, d):
    return annotate.squeeze_runs(labels(spark, d))


@query(f"WITH {LAB} SELECT recording_id, epoch_idx, label FROM lab")
def run_roundtrip(spark, d):
    runs = annotate.squeeze_runs(labels(spark, d)).withColumn("run_no", F.col("start_s"))
    return annotate.expand_runs(runs)


# ------------------------------------------------------------------ aggregates and windows


@query(f"WITH {SIG} SELECT event_type AS channel, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM sig GROUP BY 1")
def channel_stats(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("channel"), "value")
    return rounded(aggregate.channel_stats(e), "mean", "std")


@query(f"WITH {LAB} SELECT recording_id, " + ", ".join(f"count(*) FILTER (WHERE label = '{n}') AS \"{n}_count\"" for n in ("W", "N1", "N2", "N3", "REM", "UNKNOWN")) + " FROM lab GROUP BY 1")
def label_counts(spark, d):
    return aggregate.label_counts(labels(spark, d), ("W", "N1", "N2", "N3", "REM", UNKNOWN))


@query("SELECT CASE WHEN user_id % 2 = 0 THEN 'L' ELSE 'R' END AS side, event_type AS label, count(*) AS n FROM events GROUP BY 1, 2")
def side_counts(spark, d):
    e = table(spark, d, "events").select(F.when(F.col("user_id") % 2 == 0, "L").otherwise("R").alias("side"), F.col("event_type").alias("label"))
    return aggregate.side_counts(e)


@query(f"WITH {SIG} SELECT recording_id, event_type AS channel, count(*) AS length, count(*) / 4.0::DOUBLE AS duration FROM sig GROUP BY 1, 2")
def channel_durations(spark, d):
    s = table(spark, d, "events").select(F.col("user_id").alias("recording_id"), F.col("event_type").alias("channel"))
    return aggregate.durations(s, 4.0)


@query(f"WITH {SIG} SELECT recording_id, CAST(trunc(avg(sample_idx * 1000000000)) AS BIGINT) AS ts_ns FROM sig WHERE sample_idx < 35 GROUP BY 1")
def first_window_time(spark, d):
    return aggregate.first_window_time(select.with_time(sig(spark, d).select("recording_id", "sample_idx"), 1.0), 35)


@query(f"WITH {SIG} SELECT recording_id, round(avg(CASE WHEN value < 40 THEN value END), 6) AS mean FROM sig GROUP BY 1")
def nan_mean(spark, d):
    s = table(spark, d, "events").select(F.col("user_id").alias("recording_id"), F.when(F.col("value") < 40, F.col("value")).otherwise(float("nan")).alias("value"))
    return rounded(aggregate.nan_mean(s), "mean")


@query(f"""WITH {SIG}, n AS (SELECT *, count(*) OVER (PARTITION BY recording_id) AS n FROM sig)
SELECT recording_id, sample_idx // 8 AS period_idx, count(*) AS n_samples, arg_min(value, sample_idx) AS first_value, arg_max(value, sample_idx) AS last_value FROM n WHERE sample_idx < n // 8 * 8 GROUP BY 1, 2""")
def epoch_framing(spark, d):
    p = segment.frame_periods(sig(spark, d), 8, strict=False, key=("recording_id",))
    return p.select("recording_id", "period_idx", F.size("samples").cast("long").alias("n_samples"), F.get("samples", F.lit(0)).alias("first_value"), F.element_at("samples", -1).alias("last_value"))


_MAG = "m AS (SELECT recording_id, sample_idx, sqrt(x*x + y*y + z*z) AS m FROM imu)"


@query(f"WITH {IMU}, {_MAG} SELECT recording_id, sample_idx, round(m, 6) AS magnitude, round(coalesce((m - lag(m) OVER (PARTITION BY recording_id ORDER BY sample_idx)) * 2, 0), 6) AS derivative FROM m")
def accel_dynamic(spark, d):
    return rounded(motion.dynamic(imu(spark, d), 2.0), "magnitude", "derivative")


@query(f"WITH {IMU} SELECT recording_id, sample_idx, round(atan2(-x, sqrt(y*y + z*z)) + 0.0, 6) AS pitch, round(atan2(y, z) + 0.0, 6) AS roll FROM imu")
def accel_gravity(spark, d):
    return rounded(motion.gravity(imu(spark, d)), "pitch", "roll")


# ------------------------------------------------------------------ scores and metrics


@query(f"WITH {EMB}, p AS (SELECT vec_id, e[1:5] AS p FROM emb) SELECT vec_id, CAST(list_position(p, list_max(p)) - 1 AS BIGINT) AS stage FROM p")
def argmax_stage(spark, d):
    return emb(spark, d).select("vec_id", scores.argmax(F.slice("e", 1, 5)).alias("stage"))


@query(f"WITH {EMB}, p AS (SELECT vec_id, e[1:5] AS p FROM emb) SELECT vec_id, CAST(CASE WHEN list_max(p) < 0.15::DOUBLE THEN -1 ELSE list_position(p, list_max(p)) - 1 END AS BIGINT) AS stage FROM p")
def confidence_threshold(spark, d):
    return emb(spark, d).select("vec_id", scores.confident(F.slice("e", 1, 5), 0.15).alias("stage"))


@query(f"""WITH {EMB} SELECT vec_id AS epoch_idx, i AS class_idx, round((e[i + 1] + e[i + 6]) / 2, 6) AS prob FROM (SELECT *, unnest(range(5))::INTEGER AS i FROM emb)""")
def mean_channel_groups(spark, d):
    e = emb(spark, d)
    both = e.select(F.col("vec_id").alias("epoch_idx"), F.slice("e", 1, 5).alias("probs")).union(e.select("vec_id", F.slice("e", 6, 5)))
    return rounded(scores.mean_groups(both, ("epoch_idx",)), "prob")


@query(f"""WITH {EMB}, v AS (SELECT vec_id, CASE WHEN list_max(e[1:5]) < 0.15::DOUBLE THEN -1 ELSE list_position(e[1:5], list_max(e[1:5])) - 1 END AS a,
CASE WHEN list_max(e[6:10]) < 0.15::DOUBLE THEN -1 ELSE list_position(e[6:10], list_max(e[6:10])) - 1 END AS b FROM emb)
SELECT vec_id, CAST(CASE WHEN a = b THEN a WHEN a = -1 THEN b WHEN b = -1 THEN a ELSE -1 END AS BIGINT) AS label FROM v""")
def consensus_vote(spark, d):
    v = emb(spark, d).select("vec_id", scores.confident(F.slice("e", 1, 5), 0.15).alias("a"), scores.confident(F.slice("e", 6, 5), 0.15).alias("b"))
    return v.select("vec_id", scores.consensus("a", "b").alias("label"))


@query("""WITH r AS (SELECT o_orderpriority AS "set", o_orderstatus AS dataset, o_custkey AS subj, o_custkey % 3 AS session FROM orders)
SELECT coalesce("set", 'TOTAL') AS "set", count(DISTINCT (dataset, subj)) AS n_subjects, count(DISTINCT (dataset, subj, session)) AS n_recordings, count(*) AS n_rows FROM r GROUP BY GROUPING SETS (("set"), ())""")
def dataset_summary(spark, d):
    o = table(spark, d, "orders")
    return metrics.dataset_summary(o.select(F.col("o_orderpriority").alias("set"), F.col("o_orderstatus").alias("dataset"), F.col("o_custkey").alias("subj"), (F.col("o_custkey") % 3).alias("session")))


_M = "m AS (SELECT l.doc_id, d.source AS recording_id, d.lang AS dataset, l.quality AS truth, l.toxic AS guess FROM labels l JOIN documents d USING (doc_id))"
_B = """count(*) FILTER (WHERE truth = 1 AND guess = 1) AS tp, count(*) FILTER (WHERE truth = 0 AND guess = 1) AS fp, count(*) FILTER (WHERE truth = 1 AND guess = 0) AS fn, count(*) FILTER (WHERE truth = 0 AND guess = 0) AS tn"""
_R = """round(CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fp) END, 6) AS precision, round(CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fn) END, 6) AS recall,
round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0::DOUBLE ELSE (2 * tp)::DOUBLE / (2 * tp + fp + fn) END, 6) AS f1, round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 6) AS accuracy"""


def _scored(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.col("source").alias("recording_id"), F.col("lang").alias("dataset"))
    return table(spark, d, "labels").select("doc_id", F.col("quality").alias("truth"), F.col("toxic").alias("guess")).join(docs, "doc_id")


@query(f"WITH m AS (SELECT quality AS truth, toxic AS guess FROM labels), c AS (SELECT {_B} FROM m) SELECT {_R} FROM c")
def binary_metrics(spark, d):
    m = metrics.scorable(table(spark, d, "labels").select(F.col("quality").alias("truth"), F.col("toxic").alias("guess")))
    return rounded(metrics.binary_metrics(m), "precision", "recall", "f1", "accuracy")


@query(f"""WITH {_M}, k AS (SELECT * FROM m WHERE (dataset, recording_id) IN (SELECT (dataset, recording_id) FROM m GROUP BY dataset, recording_id HAVING max(truth) > 0)),
c AS (SELECT dataset, recording_id, {_B} FROM k GROUP BY 1, 2), p AS (SELECT dataset, {_R} FROM c)
SELECT coalesce(dataset, 'TOTAL') AS dataset, round(avg(precision), 4) AS precision, round(avg(recall), 4) AS recall, round(avg(f1), 4) AS f1 FROM p GROUP BY ROLLUP (dataset)""")
def macro_metrics(spark, d):
    key = ("dataset", "recording_id")
    each = metrics.binary_metrics(metrics.without_empty(_scored(spark, d), key), key=key)
    each = rounded(each, "precision", "recall", "f1")
    return rounded(metrics.macro(each, ["precision", "recall", "f1"]), "precision", "recall", "f1", digits=4)


@query(f"WITH {ANN} SELECT recording_id, epoch_idx, CAST(value > 50 AS INTEGER) AS guess, CAST(code = 1 AS INTEGER) AS truth FROM ann JOIN sig USING (recording_id) WHERE sample_idx = epoch_idx AND epoch_idx < 40")
def truth_prediction_join(spark, d):
    """Truth cut to the length of the predictions."""
    guess = sig(spark, d).where("sample_idx < 40").select("recording_id", F.col("sample_idx").alias("epoch_idx"), (F.col("value") > 50).cast("int").alias("guess"))
    return scores.with_truth(guess, ann(spark, d).select("recording_id", "epoch_idx", (F.col("code") == 1).cast("int").alias("truth")))


@query(f"WITH {SIG} SELECT coalesce(p.recording_id, t.recording_id) AS recording_id, coalesce(a, 0) AS n_predicted, coalesce(b, 0) AS n_truth FROM (SELECT recording_id, count(*) AS a FROM sig WHERE sample_idx < 40 GROUP BY 1) p FULL JOIN (SELECT recording_id, count(*) AS b FROM sig WHERE value > 99 GROUP BY 1) t ON p.recording_id = t.recording_id")
def truth_lengths(spark, d):
    """How many epochs predictions and truth have, recording by recording."""
    s = sig(spark, d)
    return scores.lengths(s.where("sample_idx < 40"), s.where("value > 99"))


@query(f"WITH {ANN} SELECT recording_id, epoch_idx, code FROM ann WHERE code NOT IN (0, 1, -1)")
def deep_sleep_only(spark, d):
    return metrics.deep_sleep(ann(spark, d), "code")


@query(f"""WITH {ANN}, n AS (SELECT recording_id, (count(*) * 7 + 29) // 30 AS n FROM sig GROUP BY 1), spine AS (SELECT recording_id, unnest(range(n)) AS epoch_idx FROM n),
i AS (SELECT recording_id, sample_idx * 7 AS a, sample_idx * 7 + CAST(trunc(value) AS BIGINT) % 60 AS b FROM sig WHERE event_type = 'signup'),
t AS (SELECT DISTINCT recording_id, unnest(range(a // 30, b // 30 + 1)) AS epoch_idx FROM i),
m AS (SELECT s.recording_id, s.recording_id % 4 AS dataset, CAST(t.epoch_idx IS NOT NULL AS INTEGER) AS guess, CAST(a.code = 3 AS INTEGER) AS truth
  FROM spine s JOIN ann a USING (recording_id, epoch_idx) LEFT JOIN t ON s.recording_id = t.recording_id AND s.epoch_idx = t.epoch_idx WHERE a.code NOT IN (0, 1, -1)),
k AS (SELECT * FROM m WHERE recording_id IN (SELECT recording_id FROM m GROUP BY 1 HAVING max(truth) > 0)),
c AS (SELECT dataset, recording_id, {_B} FROM k GROUP BY 1, 2), p AS (SELECT dataset, {_R} FROM c)
SELECT coalesce(CAST(dataset AS VARCHAR), 'TOTAL') AS dataset, round(avg(precision), 4) AS precision, round(avg(recall), 4) AS recall, round(avg(f1), 4) AS f1, round(avg(accuracy), 4) AS accuracy, count(*) AS recording_count FROM p GROUP BY ROLLUP (dataset)""")
def event_evaluation(spark, d):
    """Intervals to epochs, truth and stages joined, deep sleep alone, measures per recording, means per dataset."""
    s = sig(spark, d)
    lengths = s.groupBy("recording_id").agg((F.count(F.lit(1)) * 7).alias("n_samples"))
    spans = s.where(F.col("event_type") == "signup").select("recording_id", (F.col("sample_idx") * 7).alias("start_idx"), (F.col("sample_idx") * 7 + F.col("value").cast("long") % 60).alias("end_idx"))
    a = ann(spark, d)
    truth = a.select("recording_id", "epoch_idx", (F.col("code") == 3).cast("int").alias("truth"))
    per = evaluate.evaluated(evaluate.predicted_epochs(lengths, spans, 30), truth, a.select("recording_id", "epoch_idx", F.col("code").alias("stage")))
    per = rounded(per, *evaluate.MEASURES).withColumn("dataset", (F.col("recording_id") % 4).cast("string"))
    return rounded(metrics.macro(per, evaluate.MEASURES, count="recording_count"), *evaluate.MEASURES, digits=4)


@query(f"WITH {SIG}, {LAB.replace(SIG + ', ', '')} SELECT recording_id, s.sample_idx AS epoch_idx, value AS feature, CASE label WHEN 'UNKNOWN' THEN 'Uns' WHEN 'REM' THEN 'R' ELSE label END AS stage FROM sig s JOIN lab l USING (recording_id) WHERE s.sample_idx = l.epoch_idx AND recording_id % 7 <> 0")
def features_hypnogram(spark, d):
    """Features with stages by position; recordings whose hypnogram is an epoch short are left out."""
    made = sig(spark, d).select("recording_id", F.col("sample_idx").alias("epoch_idx"), F.col("value").alias("feature"))
    stages = select.map_labels(ann(spark, d), select.composed(STAGES, SHORT_LABELS, UNSCORED), UNSCORED).select("recording_id", "epoch_idx", F.col("label").alias("stage"))
    return train.with_hypnogram(made, stages.where("recording_id % 7 <> 0 or epoch_idx > 0"), skip=True)


@query("""WITH r AS (SELECT 'a' AS dataset, user_id AS subj, event_id AS session, value AS eeg_mean, NULL::DOUBLE AS eog_mean FROM events WHERE event_type = 'view'
  UNION ALL SELECT 'b', user_id, event_id, value, value * 2 FROM events WHERE event_type = 'click'),
s AS (SELECT DISTINCT subj FROM r), n AS (SELECT CAST(trunc(count(*) * 0.2::DOUBLE) AS BIGINT) AS n FROM s),
k AS (SELECT subj, row_number() OVER (ORDER BY ((subj % 2147483647 + 4) * 48271 % 2147483647) * 69621 % 2147483647, subj) AS k FROM s)
SELECT dataset, subj, session, eeg_mean, eog_mean, CASE WHEN k <= n THEN 'test' ELSE 'train' END AS "set" FROM r JOIN k USING (subj), n""")
def feature_union(spark, d):
    """Feature tables of two datasets, one without EOG, as one table with a split by subject."""
    e = table(spark, d, "events")
    part = lambda t, name, *more: e.where(F.col("event_type") == t).select(F.lit(name).alias("dataset"), F.col("user_id").alias("subj"), F.col("event_id").alias("session"), F.col("value").alias("eeg_mean"), *more)
    return features.feature_table([part("view", "a"), part("click", "b", (F.col("value") * 2).alias("eog_mean"))], 0.2, seed=3)


@query(f"""WITH {SIG}, n AS (SELECT recording_id, count(*) FILTER (WHERE event_type = 'view') AS a, count(*) FILTER (WHERE event_type = 'click') AS b FROM sig GROUP BY 1)
SELECT recording_id, event_type AS channel, sample_idx, value FROM sig JOIN n USING (recording_id) WHERE event_type IN ('view', 'click') AND a = b AND a > 0""")
def combine_equal_channels(spark, d):
    """Two channels of the recordings in which they are equally long."""
    s = sig(spark, d).select("recording_id", F.col("event_type").alias("channel"), "sample_idx", "value")
    return features.combine_channels(s, ["view", "click"], skip=True)


@query(f"""WITH {IMU}, n AS (SELECT *, count(*) OVER (PARTITION BY recording_id) AS n FROM imu)
SELECT recording_id, sample_idx // 64 AS period_idx, arg_min(x, sample_idx) AS x_first, arg_max(z, sample_idx) AS z_last, round(sum(x), 6) AS x_sum FROM n WHERE sample_idx < n // 64 * 64 GROUP BY 1, 2""")
def frame_channels(spark, d):
    """Two channels framed side by side in one shuffle."""
    p = segment.frame_channels(align.to_long(imu(spark, d), ["x", "z"]), ["x", "z"], 64)
    total = F.aggregate("c0", F.lit(0.0), lambda a, x: a + x)
    return p.select("recording_id", "period_idx", F.get("c0", F.lit(0)).alias("x_first"), F.element_at("c1", -1).alias("z_last"), F.round(total, 6).alias("x_sum"))


@query("SELECT quality AS truth, toxic AS guess, count(*) AS n FROM labels GROUP BY 1, 2")
def confusion_matrix(spark, d):
    return metrics.confusion_matrix(table(spark, d, "labels").select(F.col("quality").alias("truth"), F.col("toxic").alias("guess")))


@query("""WITH m AS (SELECT quality AS truth, toxic AS guess FROM labels), l AS (SELECT DISTINCT unnest([truth, guess]) AS label FROM m),
c AS (SELECT label, (SELECT count(*) FROM m WHERE truth = label) AS s, (SELECT count(*) FROM m WHERE guess = label) AS g, (SELECT count(*) FROM m WHERE truth = label AND guess = label) AS h FROM l)
SELECT label, round(CASE WHEN g = 0 THEN 0.0::DOUBLE ELSE h::DOUBLE / g END, 6) AS precision, round(CASE WHEN s = 0 THEN 0.0::DOUBLE ELSE h::DOUBLE / s END, 6) AS recall, round((2 * h)::DOUBLE / (g + s), 6) AS f1, s AS support FROM c""")
def class_report(spark, d):
    m = table(spark, d, "labels").select(F.col("quality").alias("truth"), F.col("toxic").alias("guess"))
    return rounded(metrics.class_report(m), "precision", "recall", "f1")


@query("""WITH s AS (SELECT DISTINCT user_id AS subj FROM events), n AS (SELECT CAST(trunc(count(*) * 0.2::DOUBLE) AS BIGINT) AS n FROM s),
r AS (SELECT subj, row_number() OVER (ORDER BY ((subj % 2147483647 + 8) * 48271 % 2147483647) * 69621 % 2147483647, subj) AS r FROM s)
SELECT event_id, e.user_id AS subj, CASE WHEN r <= n THEN 'test' ELSE 'train' END AS "set" FROM events e JOIN r ON e.user_id = r.subj, n""")
def subject_split(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("user_id").alias("subj"))
    return split.split_subjects(e, 0.2, seed=7).select("event_id", "subj", "set")


# ------------------------------------------------------------------ pulse and signal processing

_PULSE = f"{SIG}, x AS (SELECT recording_id, sample_idx, CAST(trunc(value) AS BIGINT) % 100 - 40 AS value FROM sig)"
_PEAKS = f"""{_PULSE}, q AS (SELECT *, greatest(value, 0) * greatest(value, 0) AS sq FROM x), v AS (SELECT recording_id, sum(sq)::DOUBLE / count(*) AS level FROM q GROUP BY 1),
m AS (SELECT *, sum(sq) OVER s::DOUBLE / count(sq) OVER s AS s, sum(sq) OVER l::DOUBLE / count(sq) OVER l AS l FROM q
  WINDOW s AS (PARTITION BY recording_id ORDER BY sample_idx ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), l AS (PARTITION BY recording_id ORDER BY sample_idx ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)),
b AS (SELECT recording_id, sample_idx, value, sample_idx - row_number() OVER (PARTITION BY recording_id ORDER BY sample_idx) AS g FROM m JOIN v USING (recording_id) WHERE s > l + level * 0.02::DOUBLE),
pk AS (SELECT recording_id, arg_max(sample_idx, value * 1000000 - sample_idx) AS sample_idx, max(value) AS value FROM b GROUP BY recording_id, g HAVING count(*) >= 2)"""


def _pulse(spark, d):
    return sig(spark, d).select("recording_id", "sample_idx", (F.col("value").cast("long") % 100 - 40).alias("value"))


def _peaks(spark, d):
    return pulse.elgendi_peaks(_pulse(spark, d), 3, 11, 0.02, least=2)


@query(f"WITH {_PEAKS} SELECT recording_id, sample_idx, value FROM pk")
def elgendi_peaks(spark, d):
    return _peaks(spark, d)


@query(f"""WITH {_PEAKS}, i AS (SELECT recording_id, sample_idx, (sample_idx - lag(sample_idx) OVER (PARTITION BY recording_id ORDER BY sample_idx))::DOUBLE AS d FROM pk)
SELECT recording_id, sample_idx, round(d / 4 * 1000, 6) AS ibi, round(240 / d, 6) AS rate FROM i WHERE d IS NOT NULL""")
def beat_interval(spark, d):
    return rounded(pulse.beat_intervals(_peaks(spark, d), 4.0), "ibi", "rate")


@query(f"""WITH {_PEAKS}, i AS (SELECT recording_id, sample_idx, (sample_idx - lag(sample_idx) OVER (PARTITION BY recording_id ORDER BY sample_idx))::DOUBLE AS d FROM pk)
SELECT recording_id, sample_idx, round(d / 4 * 1000 - 1000, 6) AS ibi FROM i WHERE d / 4 * 1000 - 1000 > 0""")
def positive_ibi(spark, d):
    beats = pulse.beat_intervals(_peaks(spark, d), 4.0).select("recording_id", "sample_idx", (F.col("ibi") - 1000).alias("ibi"))
    return rounded(pulse.positive_intervals(beats), "ibi")


_KINDS = f"""{_PEAKS}, b0 AS (SELECT recording_id, sample_idx AS p, lag(sample_idx) OVER w AS p0, lead(sample_idx) OVER w AS p1 FROM pk WINDOW w AS (PARTITION BY recording_id ORDER BY sample_idx)),
b1 AS (SELECT *, coalesce(p - p0, p1 - p) * 250::DOUBLE AS rr FROM b0),
b2 AS (SELECT *, coalesce(rr - lag(rr) OVER w, 0) AS d, lead(rr) OVER w AS nx, quantile_cont(rr, 0.5) OVER (PARTITION BY recording_id ORDER BY p ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS med FROM b1 WINDOW w AS (PARTITION BY recording_id ORDER BY p)),
b3 AS (SELECT *, (rr - med) * CASE WHEN rr < med THEN 2 ELSE 1 END AS m FROM b2),
b4 AS (SELECT *, greatest(2.6::DOUBLE * (quantile_cont(abs(d), 0.75) OVER w - quantile_cont(abs(d), 0.25) OVER w), 20) AS td, greatest(2.6::DOUBLE * (quantile_cont(abs(m), 0.75) OVER w - quantile_cont(abs(m), 0.25) OVER w), 20) AS tm
  FROM b3 WINDOW w AS (PARTITION BY recording_id ORDER BY p ROWS BETWEEN 45 PRECEDING AND 45 FOLLOWING)),
b5 AS (SELECT *, d / td AS x, m / tm AS y FROM b4),
b6 AS (SELECT *, coalesce(lag(x) OVER w, 0) AS x0, coalesce(lead(x) OVER w, 0) AS x1, coalesce(lead(x, 2) OVER w, 0) AS x2 FROM b5 WINDOW w AS (PARTITION BY recording_id ORDER BY p)),
b7 AS (SELECT *, (x > 1 AND least(x1, x2) < -1) OR y > 3 AS long, (x < -1 AND greatest(x1, x2) > 1) OR y < -3 AS short,
  (x > 1 AND greatest(x0, x1) < -0.13::DOUBLE * x - 0.17::DOUBLE) OR (x < -1 AND least(x0, x1) > -0.13::DOUBLE * x + 0.17::DOUBLE) AS ectopic FROM b6),
b8 AS (SELECT *, CASE WHEN p0 IS NULL THEN 'normal' WHEN ectopic THEN 'ectopic' WHEN long AND abs(rr / 2 - med) < tm THEN 'missed' WHEN short AND coalesce(abs(rr + nx - med) < tm, false) THEN 'extra'
  WHEN long THEN 'long' WHEN short THEN 'short' ELSE 'normal' END AS k FROM b7),
b9 AS (SELECT *, CASE WHEN coalesce(lag(k) OVER w = 'extra', false) OR (k IN ('long', 'short') AND coalesce(lead(k) OVER w = 'ectopic', false)) THEN 'normal' ELSE k END AS kind FROM b8 WINDOW w AS (PARTITION BY recording_id ORDER BY p)),
kd AS (SELECT *, lead(kind) OVER (PARTITION BY recording_id ORDER BY p) AS follows, p0 IS NOT NULL AND p1 IS NOT NULL AND (coalesce(lead(kind) OVER (PARTITION BY recording_id ORDER BY p) = 'ectopic', false) OR kind IN ('long', 'short')) AS moved FROM b9)"""


@query(f"WITH {_KINDS} SELECT recording_id, p AS sample_idx, kind, round(rr, 6) AS rr FROM kd")
def beat_kinds(spark, d):
    """Each interval's place among normal, ectopic, missed, extra, long and short ones."""
    return rounded(pulse.classify_beats(_peaks(spark, d), 4.0).select("recording_id", "sample_idx", "kind", "rr"), "rr")


@query(f"""WITH {_KINDS} SELECT recording_id, CASE WHEN moved THEN p0 + (p1 - p0) // 2 ELSE p END AS sample_idx, CASE WHEN moved THEN 'moved' ELSE 'normal' END AS kind FROM kd WHERE kind <> 'extra'
UNION ALL SELECT recording_id, p0 + (p - p0) // 2, 'missed' FROM kd WHERE kind = 'missed'""")
def interval_correction(spark, d):
    """Beats after correction: extra ones gone, missed ones put in, those out of place moved."""
    return pulse.correct_beats(_peaks(spark, d), 4.0)


def _long_y(spark, d):
    return imu(spark, d).select("recording_id", F.lit("y").alias("channel"), "sample_idx", F.col("y").alias("value"))


def _listed(values) -> str:
    return "[" + ", ".join(f"'{float(v)!r}'::DOUBLE" for v in values) + "]"


_RATE, _LOW, _HIGH, _TARGET = 64.0, 2.0, 16.0, 40.0
_Y = f"{IMU}, y AS (SELECT recording_id, sample_idx, y AS v, count(*) OVER (PARTITION BY recording_id) AS n FROM imu)"
_TAPS = fir.design(_RATE, _LOW, _HIGH)
_PAD = len(_TAPS) // 2
_UP, _DOWN = polyphase.factors(_RATE, _TARGET)
_KERNEL = polyphase.kernel(_UP, _DOWN)


_FILTER = f"""WITH {_Y}, e AS (SELECT recording_id, max(n) AS n, arg_min(v, sample_idx) AS a, arg_max(v, sample_idx) AS b FROM y GROUP BY 1),
p AS (SELECT recording_id, sample_idx AS i, v FROM y UNION ALL SELECT recording_id, -sample_idx, 2 * a - v FROM y JOIN e USING (recording_id) WHERE sample_idx BETWEEN 1 AND {_PAD}
  UNION ALL SELECT recording_id, 2 * (e.n - 1) - sample_idx, 2 * b - v FROM y JOIN e USING (recording_id) WHERE sample_idx BETWEEN e.n - 1 - {_PAD} AND e.n - 2),
x AS (SELECT recording_id, sample_idx AS j, unnest(range(sample_idx - {_PAD}, sample_idx + {_PAD} + 1)) AS i FROM y)
SELECT recording_id, 'y' AS channel, j AS sample_idx, round(sum(p.v * {_listed(_TAPS)}[i - j + {_PAD} + 1]), 6) + 0.0 AS value FROM x JOIN p USING (recording_id, i) GROUP BY recording_id, j"""


@query(_FILTER)
def fir_filter(spark, d):
    """The taps, which depend on the design alone, are literals in the SQL."""
    return dsp.fir_filter(_long_y(spark, d), _RATE, _LOW, _HIGH).withColumn("value", F.round("value", 6) + F.lit(0.0))


def _sampled(df, rate: float):
    """df with the times of its samples from 2024 on."""
    return df.withColumn("ts", F.timestamp_micros(F.expr(f"1704067200000000L + sample_idx * {round(1e6 / rate)}L")))


@query(_FILTER)
def streamed_filter(spark, d):
    """The filter as a stream with state: the rows of the batch."""
    out = replay(_sampled(_long_y(spark, d), _RATE), lambda s, late: signals.fir_filter(s, _RATE, _LOW, _HIGH, late))
    return out.withColumn("value", F.round("value", 6) + F.lit(0.0))


@query(f"""WITH {_PEAKS.replace("level * 0.02::DOUBLE", "0")}, i AS (SELECT *, (sample_idx - lag(sample_idx) OVER (PARTITION BY recording_id ORDER BY sample_idx))::DOUBLE AS d FROM pk)
SELECT recording_id, sample_idx, value::DOUBLE AS value, round(d / 4 * 1000, 6) AS ibi, round(240 / d, 6) AS rate FROM i""")
def streamed_beats(spark, d):
    """Pulse peaks and their intervals as a stream with state."""
    samples = _sampled(_pulse(spark, d).withColumn("channel", F.lit("pulse")), 4.0)
    out = replay(samples, lambda s, late: signals.beats(s, 4.0, 3, 11, least=2, lateness=late))
    return rounded(out.drop("channel"), "ibi", "rate")


@query(f"""WITH {_Y}, n AS (SELECT recording_id, max(n) AS n FROM y GROUP BY 1),
o AS (SELECT recording_id, unnest(range((n * {_UP} + {_DOWN - 1}) // {_DOWN})) AS j FROM n),
x AS (SELECT recording_id, j, unnest(range((j * {_DOWN} - {len(_KERNEL) // 2}) // {_UP} - 1, (j * {_DOWN} + {len(_KERNEL) // 2}) // {_UP} + 1)) AS i FROM o),
k AS (SELECT x.*, j * {_DOWN} + {len(_KERNEL) // 2} - i * {_UP} AS k FROM x)
SELECT k.recording_id, 'y' AS channel, j AS sample_idx, round(sum(v * {_listed(_KERNEL)}[k + 1]), 6) + 0.0 AS value FROM k JOIN y ON k.recording_id = y.recording_id AND k.i = y.sample_idx WHERE k BETWEEN 0 AND {len(_KERNEL) - 1} GROUP BY k.recording_id, j""")
def resample(spark, d):
    """The kernel, which depends on the rates alone, is a literal in the SQL."""
    return dsp.resample_signal(_long_y(spark, d), _RATE, _TARGET).withColumn("value", F.round("value", 6) + F.lit(0.0))


# block-wise peaks, then beats in order (a step to the first peak that is far enough), the monotone curve
# through their intervals, and the correlation of each beat with the mean beat
_WAVE = f"""{_Y}, sq AS (SELECT *, CASE WHEN v > 0 THEN v * v ELSE 0 END AS q FROM y),
m AS (SELECT *, avg(q) OVER (PARTITION BY recording_id) AS level, avg(q) OVER (PARTITION BY recording_id ORDER BY sample_idx ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS l FROM sq),
r AS (SELECT recording_id, sample_idx, v, sample_idx - row_number() OVER (PARTITION BY recording_id ORDER BY sample_idx) AS g FROM m WHERE q > l + 0.02::DOUBLE * level),
c AS (SELECT recording_id, arg_min(sample_idx, (-v, sample_idx)) AS p FROM r GROUP BY recording_id, g),
nx AS (SELECT *, min(p) OVER (PARTITION BY recording_id ORDER BY p RANGE BETWEEN 5 FOLLOWING AND UNBOUNDED FOLLOWING) AS nx FROM c),
b0 AS (SELECT recording_id, min(p) AS p FROM c GROUP BY 1 UNION ALL SELECT b0.recording_id, nx FROM b0 JOIN nx USING (recording_id, p) WHERE nx IS NOT NULL),
b1 AS (SELECT recording_id, p, row_number() OVER w - 1 AS j, count(*) OVER (PARTITION BY recording_id) AS many, (p - lag(p) OVER w) / 16::DOUBLE AS d, lead(p) OVER w AS p1 FROM b0 WINDOW w AS (PARTITION BY recording_id ORDER BY p)),
b2 AS (SELECT *, coalesce(d, lead(d) OVER w) AS t FROM b1 WINDOW w AS (PARTITION BY recording_id ORDER BY j)),
b3 AS (SELECT *, (p1 - p)::DOUBLE AS h, (lead(t) OVER w - t) / (p1 - p) AS s FROM b2 WINDOW w AS (PARTITION BY recording_id ORDER BY j)),
b4 AS (SELECT *, lag(h) OVER w AS h0, lag(s) OVER w AS s0, lag(h, 2) OVER w AS h00, lag(s, 2) OVER w AS s00, lead(h) OVER w AS h1, lead(s) OVER w AS s1 FROM b3 WINDOW w AS (PARTITION BY recording_id ORDER BY j)),
b5 AS (SELECT *, CASE WHEN many < 3 THEN s WHEN j = 0 THEN ((2 * h + h1) * s - h * s1) / (h + h1) WHEN j = many - 1 THEN ((2 * h0 + h00) * s0 - h0 * s00) / (h0 + h00) END AS e,
  CASE WHEN j = 0 THEN s ELSE s0 END AS u, CASE WHEN j = 0 THEN s1 ELSE s00 END AS u1 FROM b4),
b6 AS (SELECT *, CASE WHEN many < 3 THEN e WHEN j IN (0, many - 1) THEN CASE WHEN e * u <= 0 THEN 0 WHEN u * u1 <= 0 AND abs(e) > 3 * abs(u) THEN 3 * u ELSE e END
  WHEN s0 * s > 0 THEN (3 * h + 3 * h0) / ((2 * h + h0) / s0 + (h + 2 * h0) / s) ELSE 0 END AS m FROM b5),
b AS (SELECT recording_id, p, j, many, t, h, m, p1, lead(t) OVER w AS t1, lead(m) OVER w AS m1, lag(p) OVER w AS p0 FROM b6 WINDOW w AS (PARTITION BY recording_id ORDER BY j)),
a AS (SELECT y.recording_id, sample_idx, v, p, p1, h, t, t1, m, m1, CASE WHEN p IS NULL THEN NULL ELSE (sample_idx - p) / h END AS z,
  first_value(t) OVER (PARTITION BY y.recording_id ORDER BY p NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first FROM y ASOF LEFT JOIN b ON y.recording_id = b.recording_id AND y.sample_idx >= b.p),
i AS (SELECT recording_id, sample_idx, v, CAST(coalesce(sample_idx = p, false) AS INTEGER) AS peak, CASE WHEN p IS NULL THEN first WHEN p1 IS NULL THEN t
  ELSE (1 + 2 * z) * (1 - z) * (1 - z) * t + z * (1 - z) * (1 - z) * h * m + z * z * (3 - 2 * z) * t1 + z * z * (z - 1) * h * m1 END AS ibi FROM a),
f AS (SELECT recording_id, greatest(2, CAST(trunc(quantile_cont(p1 - p, 0.5) / 2) AS BIGINT)) AS half, any_value(many) AS many FROM b WHERE p1 IS NOT NULL GROUP BY 1),
w0 AS (SELECT b.recording_id, j, p, o FROM b JOIN (SELECT recording_id, unnest(range(-half, half + 1)) AS o FROM f) USING (recording_id)),
w1 AS (SELECT w0.*, y.v - avg(y.v) OVER (PARTITION BY w0.recording_id, j) AS v FROM w0 JOIN y ON y.recording_id = w0.recording_id AND y.sample_idx = least(greatest(p + o, 0), y.n - 1)),
w2 AS (SELECT *, avg(v) OVER (PARTITION BY recording_id, o) AS k FROM w1),
q AS (SELECT recording_id, j, any_value(p) AS p, CASE WHEN sum(v * v) * sum(k * k) > 0 THEN sum(v * k) / sqrt(sum(v * v) * sum(k * k)) ELSE 0 END AS q FROM w2 GROUP BY 1, 2),
z AS (SELECT recording_id, q, coalesce(lag(p) OVER w + (p - lag(p) OVER w) // 2, 0) AS lo FROM q WINDOW w AS (PARTITION BY recording_id ORDER BY j))"""


@query(f"""WITH RECURSIVE {_WAVE} SELECT i.recording_id, sample_idx, v AS clean, peak::DOUBLE AS peaks, round(ibi * 1000, 6) AS ibi, round(60 / ibi, 6) AS rate, round(q, 6) AS quality
FROM i ASOF JOIN z ON i.recording_id = z.recording_id AND i.sample_idx >= z.lo""")
def process_ppg(spark, d):
    return rounded(dsp.process_ppg(_long_y(spark, d), 16.0, "elgendi"), "ibi", "rate", "quality")


def _epochs(spark, d):
    return segment.frame_periods(_long_y(spark, d), 512, strict=False, key=("recording_id",))


# density of a segment of 256 samples of an epoch of 512: mean removed, tapered, a plain Fourier sum
_SPECTRUM = f"""x AS (SELECT recording_id, sample_idx // 512 AS period_idx, sample_idx % 512 AS i, v FROM y WHERE sample_idx < n // 512 * 512),
c AS (SELECT 0 AS part, * FROM x UNION ALL SELECT 1, recording_id, period_idx, 511 - i, v FROM x),
s AS (SELECT part, recording_id, period_idx, b, i - b * 224 AS i, (v - avg(v) OVER (PARTITION BY part, recording_id, period_idx, b)) * {_listed(dsp.spectro.tukey(256))}[i - b * 224 + 1] AS v
  FROM c, (SELECT unnest([0, 1]) AS b) WHERE i - b * 224 BETWEEN 0 AND 255),
f AS (SELECT part, recording_id, period_idx, b, k, sum(v * cos(2 * pi() * (i * k % 256) / 256)) AS re, sum(v * sin(2 * pi() * (i * k % 256) / 256)) AS im FROM s, (SELECT unnest(range(129)) AS k) GROUP BY ALL),
r AS (SELECT recording_id, period_idx, part * 258 + b * 129 + k AS place, round((re * re + im * im) * CASE WHEN k IN (0, 128) THEN 1 ELSE 2 END / ({_RATE!r}::DOUBLE * {float((dsp.spectro.tukey(256) ** 2).sum())!r}::DOUBLE), 5) + 0.0 AS density FROM f)"""


def _placed(df, column: str):
    """Rounded: densities to 5 places, statistics to 7, off the ties that means of few decimals
    have, and the energy, a large sum, to 3."""
    out = df.select("recording_id", "period_idx", F.posexplode(column).alias("place", "density"))
    energy = 258 + dsp.spectro.FEATURES.index("abs_energy")
    value = F.round("density", 5) if column == "density" else F.when(F.col("place") < 258, F.round("density", 5)).when(F.col("place") == energy, F.round(F.col("density") + F.lit(1.23e-8), 3)).otherwise(F.round(F.col("density") + F.lit(1.23e-8), 7))
    return out.select("recording_id", "period_idx", F.col("place").cast("long").alias("place"), (value + F.lit(0.0)).alias("density"))


@query(f"WITH {_Y}, {_SPECTRUM} SELECT * FROM r WHERE place < 258")
def spectrogram(spark, d):
    return _placed(dsp.spectrograms(_epochs(spark, d), _RATE), "density")


@query(f"WITH {_Y}, {_SPECTRUM} SELECT * FROM r")
def lite_features(spark, d):
    e = _epochs(spark, d).withColumn("other", F.reverse("samples"))
    return _placed(dsp.lite_features(e, _RATE, ("samples", "other")).withColumnRenamed("features", "density"), "density")


_STATS = """u AS (SELECT *, v - avg(v) OVER (PARTITION BY recording_id, period_idx) AS c, i - 255.5::DOUBLE AS t, lag(v) OVER o AS b FROM x WINDOW o AS (PARTITION BY recording_id, period_idx ORDER BY i)),
z AS (SELECT *, lag(c) OVER (PARTITION BY recording_id, period_idx ORDER BY i) AS cb FROM u),
a AS (SELECT recording_id, period_idx, avg(v) AS m, var_pop(v) AS var, [avg(v), sqrt(var_pop(v)), var_pop(v), min(v), max(v), quantile_cont(v, 0.5), quantile_cont(v, 0.25), quantile_cont(v, 0.75), sqrt(avg(v * v)),
  avg(c * c * c) / pow(var_pop(v), 1.5), avg(c * c * c * c) / pow(var_pop(v), 2) - 3, sum(v * v), avg(abs(v - b)), avg(v - b), sum(CASE WHEN (v < 0) <> (b < 0) THEN 1 ELSE 0 END), max(v) - min(v),
  sum(c * cb) / sum(c * c), sum(c * t) / sum(t * t)]::DOUBLE[] AS one FROM z GROUP BY ALL),
g AS (SELECT recording_id, period_idx, k, k * 64 / 512::DOUBLE AS f, pow(sum(c * cos(2 * pi() * (i * k % 512) / 512)), 2) + pow(sum(c * sin(2 * pi() * (i * k % 512) / 512)), 2) AS p FROM u, (SELECT unnest(range(257)) AS k) GROUP BY ALL),
h AS (SELECT *, p / sum(p) OVER (PARTITION BY recording_id, period_idx) AS s, sum(p) OVER (PARTITION BY recording_id, period_idx ORDER BY k) / sum(p) OVER (PARTITION BY recording_id, period_idx) AS run FROM g),
j AS (SELECT *, sum(s * f) OVER (PARTITION BY recording_id, period_idx) AS middle FROM h),
q AS (SELECT recording_id, period_idx, [any_value(middle), sqrt(sum(s * (f - middle) * (f - middle))), least(count(*) FILTER (WHERE run < 0.95::DOUBLE), 256) / 8::DOUBLE, least(count(*) FILTER (WHERE run < 0.5::DOUBLE), 256) / 8::DOUBLE,
  -sum(CASE WHEN s > 0 THEN s * log2(s) ELSE 0 END) / log2(257), """ + ", ".join(f"coalesce(sum(s) FILTER (WHERE f >= {low} AND f < {high}), 0)" for low, high in dsp.spectro.BANDS.values()) + """]::DOUBLE[] AS two FROM j GROUP BY ALL),
w AS (SELECT recording_id, period_idx, list_concat(one, two) AS l FROM a JOIN q USING (recording_id, period_idx))"""


@query(f"WITH {_Y}, {_SPECTRUM}, {_STATS} SELECT recording_id, period_idx, place, density FROM r WHERE place < 258 UNION ALL SELECT recording_id, period_idx, 257 + n AS place, round(l[n] + 1.23e-8::DOUBLE, CASE n WHEN 12 THEN 3 ELSE 7 END) + 0.0 AS density FROM w, (SELECT unnest(range(1, 29)) AS n)")
def full_features(spark, d):
    return _placed(dsp.full_features(_epochs(spark, d), _RATE, ("samples",)), "features")


@query("SELECT c_mktsegment AS dataset, count(DISTINCT c_custkey) AS n FROM customer GROUP BY 1")
def recording_count(spark, d):
    c = table(spark, d, "customer").select(F.col("c_mktsegment").alias("dataset"), F.col("c_custkey").alias("recording_id"))
    return aggregate.recording_ids(c).select("dataset", "n")


@query("""WITH v AS (SELECT vec_id % 10 AS recording_id, vec_id * 1000 AS ts_ns, list_transform(embedding[1:3], lambda x: x::DOUBLE) AS e FROM embeddings),
s AS (SELECT *, row_number() OVER (PARTITION BY recording_id ORDER BY ts_ns) - 1 AS sample_idx FROM v)
SELECT recording_id, 'channel_' || (i - 1) AS channel, sample_idx, ts_ns, round(e[i], 6) AS value FROM s, (SELECT unnest([1, 2, 3]) AS i)""")
def samples_to_signal(spark, d):
    v = emb(spark, d).select((F.col("vec_id") % 10).alias("recording_id"), (F.col("vec_id") * 1000).alias("ts_ns"), F.slice("e", 1, 3).alias("values"))
    return rounded(align.samples_to_signal(v), "value")


@query(f"""WITH {EMB}, v AS (SELECT vec_id, unnest([CASE WHEN list_max(e[1:5]) < 0.2::DOUBLE THEN -1 ELSE list_position(e[1:5], list_max(e[1:5])) - 1 END,
CASE WHEN list_max(e[6:10]) < 0.2::DOUBLE THEN -1 ELSE list_position(e[6:10], list_max(e[6:10])) - 1 END, CASE WHEN list_max(e[11:15]) < 0.2::DOUBLE THEN -1 ELSE list_position(e[11:15], list_max(e[11:15])) - 1 END]) AS l FROM emb)
SELECT vec_id, CAST(CASE WHEN count(DISTINCT l) FILTER (WHERE l <> -1) = 1 THEN max(l) ELSE -1 END AS BIGINT) AS label FROM v GROUP BY 1""")
def consensus_many(spark, d):
    e = emb(spark, d)
    votes = [e.select("vec_id", scores.confident(F.slice("e", at, 5), 0.2).alias("label")) for at in (1, 6, 11)]
    return scores.consensus_many(votes[0].union(votes[1]).union(votes[2]), ("vec_id",))


@query(f"""WITH {IMU}, q AS (SELECT recording_id, quantile_cont(y, 0.25) AS a, quantile_cont(y, 0.5) AS m, quantile_cont(y, 0.75) AS b FROM imu GROUP BY 1)
SELECT recording_id, sample_idx, round((least(greatest(y, a - 0.5 * (b - a)), b + 0.5 * (b - a)) - m) / (b - a), 6) AS value FROM imu JOIN q USING (recording_id)""")
def quality_control(spark, d):
    s = imu(spark, d).select("recording_id", "sample_idx", F.col("y").alias("value"))
    return rounded(models.quality_control(s, 1, 0.5, ("recording_id",)), "value")


@query(f"""WITH {IMU}, q AS (SELECT recording_id, quantile_cont(y, 0.25) AS a, quantile_cont(y, 0.75) AS b FROM imu GROUP BY 1)
SELECT recording_id, sample_idx // 50 AS period_idx, count(*) AS n_clipped FROM imu JOIN q USING (recording_id) WHERE y < a - 0.5 * (b - a) OR y > b + 0.5 * (b - a) GROUP BY 1, 2""")
def affected_periods(spark, d):
    s = imu(spark, d).select("recording_id", "sample_idx", F.col("y").alias("value"))
    return models.affected_periods(s, 50, 0.5, ("recording_id",))


@query(f"""WITH {IMU}, q AS (SELECT recording_id, quantile_cont(y, 0.25) AS a, quantile_cont(y, 0.75) AS b FROM imu GROUP BY 1),
c AS (SELECT recording_id, sample_idx, least(greatest(y, a - 0.5 * (b - a)), b + 0.5 * (b - a)) AS v, y < a - 0.5 * (b - a) OR y > b + 0.5 * (b - a) AS hit FROM imu JOIN q USING (recording_id))
SELECT recording_id, sample_idx, round((v - avg(v) OVER r) / stddev_pop(v) OVER r, 6) + 0.0 AS value, bool_or(hit) OVER (PARTITION BY recording_id, sample_idx // 50) AS affected FROM c WINDOW r AS (PARTITION BY recording_id)""")
def quality_control_standard(spark, d):
    """Clipped, scaled by mean and deviation, with the periods that were clipped marked."""
    s = imu(spark, d).select("recording_id", "sample_idx", F.col("y").alias("value"))
    made = models.quality_control(s, 50, 0.5, ("recording_id",), "StandardScaler", affected=True)
    return made.withColumn("value", F.round("value", 6) + F.lit(0.0))


@query(f"""WITH {_PEAKS}, i AS (SELECT recording_id, sample_idx, (sample_idx - lag(sample_idx) OVER (PARTITION BY recording_id ORDER BY sample_idx))::DOUBLE / 4 * 1000 AS ibi FROM pk),
k AS (SELECT *, ibi - lag(ibi) OVER (PARTITION BY recording_id ORDER BY sample_idx) AS step FROM i WHERE ibi > 0)
SELECT recording_id, count(*) AS n_beats, round(avg(ibi), 4) AS mean_ibi, round(stddev_samp(ibi), 4) AS sdnn, round(sqrt(avg(step * step)), 4) AS rmssd,
round(avg(CASE WHEN step IS NULL THEN NULL WHEN abs(step) > 50 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 4) AS pnn50, round(60000 / avg(ibi), 4) AS bpm FROM k GROUP BY 1""")
def beat_measures(spark, d):
    beats = pulse.beat_intervals(_peaks(spark, d), 4.0).select("recording_id", "sample_idx", "ibi")
    return rounded(aggregate.beat_measures(beats), "mean_ibi", "sdnn", "rmssd", "pnn50", "bpm", digits=4)


@query()
def accelerometer_pipeline(spark, d):
    """The bundled accelerometer pipeline: a fork into dynamic and gravity parts."""
    names = {a: f"ACCELEROMETER_{a.upper()}" for a in ("x", "y", "z")}
    axes = beside(imu(spark, d).withColumnsRenamed(names), names.values(), 64.0)
    made = bundled("accelerometer").run(dict.fromkeys(names.values(), axes), ["ACCELEROMETER_magnitude", "ACCELEROMETER_pitch"])
    return rounded(made["ACCELEROMETER_magnitude"].df.unionByName(made["ACCELEROMETER_pitch"].df), "value")


@query()
def ppg_pipeline(spark, d):
    """The bundled pulse-wave pipeline."""
    (made,) = bundled("ppg").together({"PPG": Signal(_long_y(spark, d), ("y",), 64.0)}, ["PPG_ibi", "PPG_quality"])
    return rounded(made.df, "value")


# ------------------------------------------------------------------ epochs and intervals

# ordinal patterns, curve lengths at ten lags, turns and variances of epochs of 64 samples
_COMPLEX = f"""{_Y}, x AS (SELECT recording_id, sample_idx // 64 AS epoch_idx, sample_idx % 64 AS i, v FROM y WHERE sample_idx < n // 64 * 64),
l AS (SELECT *, lead(v) OVER w AS b, lead(v, 2) OVER w AS c, lag(v) OVER w AS a FROM x WINDOW w AS (PARTITION BY recording_id, epoch_idx ORDER BY i)),
o AS (SELECT recording_id, epoch_idx, -sum(p * log2(p)) / log2(6) AS perm_entropy FROM (SELECT recording_id, epoch_idx, v <= b, b <= c, v <= c, count(*) / 62::DOUBLE AS p FROM l WHERE c IS NOT NULL GROUP BY ALL) GROUP BY ALL),
h AS (SELECT recording_id, epoch_idx, k, m, sum(abs(nx - v)) * 63 / (((63 - m) // k) * k * k)::DOUBLE AS len FROM
  (SELECT recording_id, epoch_idx, v, k, i % k AS m, lead(v) OVER (PARTITION BY recording_id, epoch_idx, k, i % k ORDER BY i) AS nx FROM x, (SELECT unnest(range(1, 11)) AS k)) WHERE nx IS NOT NULL GROUP BY recording_id, epoch_idx, k, m),
g AS (SELECT recording_id, epoch_idx, regr_slope(ln(len), ln(1 / k::DOUBLE)) AS higuchi FROM (SELECT recording_id, epoch_idx, k, avg(len) AS len FROM h GROUP BY ALL) GROUP BY ALL),
d AS (SELECT recording_id, epoch_idx, count(*) FILTER (WHERE (b - v) * (v - a) < 0) AS turns, var_pop(v) AS v0, var_pop(b - v) AS v1, var_pop(b - 2 * v + a) AS v2 FROM l GROUP BY ALL)"""


@query(f"""WITH {_COMPLEX} SELECT recording_id, epoch_idx, round(perm_entropy, 8) AS y_perm_entropy, round(higuchi, 8) AS y_higuchi, round(log10(64) / (log10(64) + log10(64 / (64 + 0.4::DOUBLE * turns))), 8) AS y_petrosian,
round(sqrt(v1 / v0), 8) AS y_mobility, round(sqrt(v2 / v1) / sqrt(v1 / v0), 8) AS y_complexity FROM o JOIN g USING (recording_id, epoch_idx) JOIN d USING (recording_id, epoch_idx)""")
def epoch_complexity(spark, d):
    made = features.epoch_complexity(_long_y(spark, d), _RATE, {"y": "y"}, 1.0)
    return rounded(made, *[c for c in made.columns if c.startswith("y_")], digits=8)


_HAAR = ", ".join(f"round(sum(CASE WHEN k = {k} THEN e END), 6) AS y_wavelet_{k}" for k in range(1, 7))


@query(f"""WITH {_Y}, x AS (SELECT recording_id, sample_idx // 64 AS epoch_idx, sample_idx % 64 AS i, v FROM y WHERE sample_idx < n // 64 * 64),
w AS (SELECT recording_id, epoch_idx, k, pow(sum(CASE WHEN i % (1 << k) < (1 << (k - 1)) THEN v ELSE -v END), 2) / pow(2, k) AS e FROM x, (SELECT unnest(range(1, 7)) AS k) GROUP BY recording_id, epoch_idx, k, i // (1 << k))
SELECT recording_id, epoch_idx, {_HAAR} FROM w GROUP BY ALL""")
def epoch_wavelets(spark, d):
    """Haar wavelet energies of epochs; the other model features have unit tests."""
    made = features.epoch_models(_long_y(spark, d), _RATE, {"y": "y"}, 1.0)
    return made.select("recording_id", "epoch_idx", *[F.round(f"y_wavelet_{k}", 6).alias(f"y_wavelet_{k}") for k in range(1, 7)])


_NEAR = " + ".join(f"{8 - abs(k)} * coalesce({'lag' if k > 0 else 'lead'}(value, {abs(k)}) OVER w, 0)" for k in range(-7, 8))
_WEIGHTS = " + ".join(f"CASE WHEN {'lag' if k > 0 else 'lead'}(value, {abs(k)}) OVER w IS NULL THEN 0 ELSE {8 - abs(k)} END" for k in range(-7, 8))


@query(f"""WITH {SIG}, s AS (SELECT recording_id, sample_idx AS epoch_idx, value, ({_NEAR}) / ({_WEIGHTS})::DOUBLE AS c, avg(value) OVER (PARTITION BY recording_id ORDER BY sample_idx ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS p
  FROM sig WINDOW w AS (PARTITION BY recording_id ORDER BY sample_idx)),
q AS (SELECT recording_id, quantile_cont(c, [0.05, 0.5, 0.95]) AS qc, quantile_cont(p, [0.05, 0.5, 0.95]) AS qp FROM s GROUP BY 1)
SELECT recording_id, epoch_idx, value, round((c - qc[2]) / (qc[3] - qc[1]), 7) + 0.0 AS value_centred, round((p - qp[2]) / (qp[3] - qp[1]), 7) + 0.0 AS value_past FROM s JOIN q USING (recording_id)""")
def smoothed_features(spark, d):
    """Centred and past means over epochs, scaled by each recording's quantiles."""
    own = sig(spark, d).select("recording_id", F.col("sample_idx").alias("epoch_idx"), "value")
    made = features.smoothed(own, ["value"])
    return made.withColumns({c: F.round(c, 7) + F.lit(0.0) for c in ("value_centred", "value_past")})


_IBI = f"""{_PEAKS}, ib AS (SELECT * FROM (SELECT recording_id, sample_idx, (sample_idx - lag(sample_idx) OVER (PARTITION BY recording_id ORDER BY sample_idx)) * 250::DOUBLE AS ibi FROM pk) WHERE ibi > 0)"""


def _lomb(first: float, step: float, n: int) -> str:
    return f"""fr AS (SELECT unnest(list_transform(range({n}), lambda k: round({first!r}::DOUBLE + k * {step!r}::DOUBLE, 9))) AS frequency),
lx AS (SELECT recording_id, frequency, ibi - avg(ibi) OVER (PARTITION BY recording_id, frequency) AS y, 2 * pi() * frequency * (sample_idx / 4::DOUBLE) AS a, count(*) OVER (PARTITION BY recording_id, frequency) AS k FROM ib, fr),
ls AS (SELECT recording_id, frequency, sum(y * cos(a)) AS yc, sum(y * sin(a)) AS ys, sum(cos(a) * cos(a)) AS cc, sum(sin(a) * sin(a)) AS ss, sum(cos(a) * sin(a)) AS cs FROM lx WHERE k > 1 GROUP BY 1, 2),
lt AS (SELECT *, cos(atan2(2 * cs, cc - ss) / 2) AS c, sin(atan2(2 * cs, cc - ss) / 2) AS s FROM ls),
lu AS (SELECT recording_id, frequency, pow(c * yc + s * ys, 2) AS e, c * c * cc + 2 * c * s * cs + s * s * ss AS ew, pow(c * ys - s * yc, 2) AS o, c * c * ss - 2 * c * s * cs + s * s * cc AS ow FROM lt),
lomb AS (SELECT recording_id, frequency, (CASE WHEN ew > 1e-9::DOUBLE THEN e / ew ELSE 0 END + CASE WHEN ow > 1e-9::DOUBLE THEN o / ow ELSE 0 END) / 2 AS power FROM lu)"""


def _beats(spark, d):
    return pulse.beat_intervals(_peaks(spark, d), 4.0).select("recording_id", "sample_idx", "ibi")


@query(f"WITH {_IBI}, {_lomb(0.02, 0.02, 20)} SELECT recording_id, frequency, round(power, 3) AS power FROM lomb")
def ibi_spectrum(spark, d):
    """Power of beat intervals at uneven times, 0.02 to 0.4 Hz."""
    return rounded(aggregate.interval_spectrum(_beats(spark, d), 4.0, [round(0.02 + k * 0.02, 9) for k in range(20)]), "power", digits=3)


@query(f"""WITH {_IBI}, {_lomb(0.1, 0.01, 31)}, st AS (SELECT *, lead(ibi) OVER (PARTITION BY recording_id ORDER BY sample_idx) AS nx FROM ib),
md AS (SELECT recording_id, median(abs(ibi - mid)) AS hr_mad FROM ib JOIN (SELECT recording_id, median(ibi) AS mid FROM ib GROUP BY 1) USING (recording_id) GROUP BY 1),
br AS (SELECT recording_id, arg_max(frequency, (round(power, 3), -frequency)) AS breathingrate FROM lomb GROUP BY 1),
me AS (SELECT recording_id, 60000 / avg(ibi) AS bpm, avg(ibi) AS ibi, stddev_pop(ibi) AS sdnn, stddev_pop(abs(nx - ibi)) AS sdsd, sqrt(avg((nx - ibi) * (nx - ibi))) AS rmssd,
  avg(CASE WHEN abs(nx - ibi) > 20 THEN 1.0::DOUBLE WHEN nx IS NOT NULL THEN 0.0::DOUBLE END) AS pnn20, avg(CASE WHEN abs(nx - ibi) > 50 THEN 1.0::DOUBLE WHEN nx IS NOT NULL THEN 0.0::DOUBLE END) AS pnn50,
  stddev_pop((nx - ibi) / sqrt(2)) AS sd1, stddev_pop((nx + ibi) / sqrt(2)) AS sd2 FROM st GROUP BY 1)
SELECT recording_id, {", ".join(f"round({c}, 4) AS {c}" for c in ("bpm", "ibi", "sdnn", "sdsd", "rmssd", "pnn20", "pnn50", "hr_mad", "sd1", "sd2"))}, round(pi() * sd1 * sd2, 4) AS s, round(CASE WHEN sd2 <> 0 THEN sd1 / sd2 END, 4) AS sd1_sd2, round(breathingrate, 4) AS breathingrate
FROM me JOIN md USING (recording_id) LEFT JOIN br USING (recording_id)""")
def interval_measures(spark, d):
    """All declared measures of beat intervals."""
    made = aggregate.interval_measures(_beats(spark, d), 4.0)
    return rounded(made, *made.columns[1:], digits=4)


# ------------------------------------------------------------------ by time


@query("""WITH v AS (SELECT user_id AS recording_id, ts, event_id FROM events WHERE event_type = 'view'),
c AS (SELECT user_id AS recording_id, ts, max(event_id) AS label_id, arg_max(value, event_id) AS label_value FROM events WHERE event_type = 'click' GROUP BY ALL)
SELECT v.recording_id, v.event_id, coalesce(label_id, -1) AS label_id, label_value FROM v ASOF LEFT JOIN c ON v.recording_id = c.recording_id AND v.ts >= c.ts""")
def asof_labels(spark, d):
    """Each score (view) with the last label (click) of its recording at or before its time, -1 for none; slices of a day."""
    e = table(spark, d, "events").select(F.col("user_id").alias("recording_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_id", "event_type", "value")
    labels = e.where("event_type = 'click'").select("recording_id", "ts_us", F.col("event_id").alias("label_id"), F.col("value").alias("label_value"))
    views = e.where("event_type = 'view'").select("recording_id", "ts_us", "event_id")
    return timeline.asof_join(views, labels, ["label_id", "label_value"], at="ts_us", size=86_400_000_000).drop("ts_us").fillna(-1, ["label_id"])


@query("""WITH p AS (SELECT o_custkey AS recording_id, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS a, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) + o_orderkey % 120 AS b FROM orders),
e AS (SELECT recording_id, a AS day, 1 AS d FROM p WHERE a < b UNION ALL SELECT recording_id, b, -1 FROM p WHERE a < b),
t AS (SELECT recording_id, day, sum(d) AS d FROM e GROUP BY recording_id, day HAVING sum(d) <> 0)
SELECT recording_id, day AS start_day, nx AS end_day, depth::BIGINT AS depth FROM (SELECT *, lead(day) OVER w AS nx, sum(d) OVER w AS depth FROM t WINDOW w AS (PARTITION BY recording_id ORDER BY day)) WHERE nx IS NOT NULL""")
def part_overlaps(spark, d):
    """Orders as parts of some days: gaps between and overlaps of each customer's parts."""
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("long")
    parts = table(spark, d, "orders").select(F.col("o_custkey").alias("recording_id"), day.alias("start_day"), (day + F.col("o_orderkey") % 120).alias("end_day"))
    return timeline.covered(parts, start="start_day", end="end_day", size=90)


# ------------------------------------------------------------------ boosted trees


def _columns(spark, d):
    e = emb(spark, d)
    return e.select("vec_id", "label", *[F.get("e", F.lit(i)).alias(f"v{i}") for i in range(64)])


_VALUES = [f"v{i}" for i in range(64)]


@query("""WITH x AS (SELECT label::BIGINT AS label, unnest(range(64)) AS f, unnest(embedding)::DOUBLE AS x FROM embeddings),
q AS (SELECT f, list_sort(list_distinct(quantile_cont(x, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]))) AS e FROM x GROUP BY f),
b AS (SELECT label, f, len(list_filter(e, lambda v: v < x)) AS bin, count(*) AS n FROM x JOIN q USING (f) GROUP BY ALL),
z AS (SELECT f, unnest(range(len(e)))::INTEGER AS s FROM q), k AS (SELECT DISTINCT label FROM x), m AS (SELECT count(*)::DOUBLE AS m FROM k),
c AS (SELECT z.f, s, k.label, m, sum(n)::DOUBLE AS n, coalesce(sum(n) FILTER (WHERE b.label = k.label), 0)::DOUBLE AS y, coalesce(sum(n) FILTER (WHERE bin <= s), 0)::DOUBLE AS nl, coalesce(sum(n) FILTER (WHERE bin <= s AND b.label = k.label), 0)::DOUBLE AS yl
  FROM z JOIN b USING (f), k, m GROUP BY ALL),
g AS (SELECT *, n / m - y AS g, nl / m - yl AS gl, n * (m - 1) / (m * m) AS h, nl * (m - 1) / (m * m) AS hl FROM c)
SELECT label, 'v' || f AS feature, s AS bin, round(gl * gl / (hl + 1) + (g - gl) * (g - gl) / (h - hl + 1) - g * g / (h + 1), 6) + 0.0 AS gain FROM g""")
def boosted_gains(spark, d):
    """The gains of all first splits of a booster over embeddings, by label, feature and bin."""
    return boost.root_gains(_columns(spark, d), _VALUES, "label", 8).withColumn("gain", F.round("gain", 6) + F.lit(0.0))


@query()
def boosted_labels(spark, d):
    """A booster over embeddings with early stopping, and the labels that it gives to all of them."""
    rows = _columns(spark, d)
    model = boost.train(rows, _VALUES, "label", "vec_id", trees=6, depth=3, rate=0.3, bins=16, patience=2)
    return model.predicted(rows).select("vec_id", "guess")


# ------------------------------------------------------------------ flagship

_FLAG = f"""{LAB}, {_PPG}, a AS (SELECT recording_id, l.epoch_idx, CASE WHEN valid_ratio < 0.5 THEN 'ARTIFACT' ELSE label END AS label FROM lab l LEFT JOIN seg USING (recording_id, epoch_idx)),
o AS (SELECT *, CASE WHEN label IS NOT DISTINCT FROM lag(label) OVER w AND epoch_idx > 0 THEN 0 ELSE 1 END AS opens FROM a WINDOW w AS (PARTITION BY recording_id ORDER BY epoch_idx)),
g AS (SELECT *, sum(opens) OVER (PARTITION BY recording_id ORDER BY epoch_idx) AS g FROM o)"""


@query(f"WITH {_FLAG} SELECT recording_id, min(epoch_idx) * 30 AS start_s, count(*) * 30 AS duration_s, any_value(label) AS label FROM g GROUP BY recording_id, g")
def artifact_runs(spark, d):
    """Scan, segment, valid ratio, artifact label, join to the annotations, run-length encoding."""
    return annotate.squeeze_runs(annotate.merge_artifacts(labels(spark, d), _segments(spark, d)), EPOCH_S)
