"""Tables of the data model and the fixed registries that describe channels and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

L, D, S = T.LongType(), T.DoubleType(), T.StringType()


def _of(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


RECORDINGS = _of(dataset=S, recording_id=S, subject_id=S, session_id=S, has_annotations=T.BooleanType())
SIGNAL_META = _of(dataset=S, recording_id=S, channel=S, device=S, sample_rate=D, unit=S, n_samples=L)
SIGNAL = _of(dataset=S, recording_id=S, channel=S, sample_idx=L, ts_ns=L, value=D)
SIGNAL_BLOCK = _of(dataset=S, recording_id=S, channel=S, block_idx=L, start_idx=L, sample_rate=D, samples=T.ArrayType(D))
ANNOTATIONS = _of(dataset=S, recording_id=S, annotation_type=S, epoch_idx=L, label=S)
ANNOTATION_RUNS = _of(dataset=S, recording_id=S, run_no=L, start_s=L, duration_s=L, label=S)
SCORES = _of(recording_id=S, channel_group=S, epoch_idx=L, ts_ns=L, probs=T.ArrayType(D))

# Fixed values of the data format.
EPOCH_S = 30
HEADBAND_RATE = 256.0
STAGES = {0: "W", 1: "N1", 2: "N2", 3: "N3", 4: "REM", 5: "REM"}
STAGE_CLASSES = ("W", "N1", "N2", "N3", "REM")
UNKNOWN, ARTIFACT, UNSCORED = "UNKNOWN", "ARTIFACT", "Uns"
SHORT_LABELS = {"W": "W", "N1": "N1", "N2": "N2", "N3": "N3", "REM": "R", "ARTIFACT": "Art", "UNKNOWN": "Uns"}
HEADBAND_CHANNELS = {
    "EEG R": "EEG", "EEG L": "EEG", "dX": "ACCELEROMETER", "dY": "ACCELEROMETER", "dZ": "ACCELEROMETER", "BODY TEMP": "BODY", "BATT": "BATTERY",
    "NOISE": "NOISE", "LIGHT": "LIGHT", "NASAL L": "NASAL", "NASAL R": "NASAL", "OXY_IR_AC": "OXIMETER", "OXY_R_AC": "OXIMETER",
    "OXY_DARK_AC": "OXIMETER", "OXY_IR_DC": "OXIMETER", "OXY_R_DC": "OXIMETER", "OXY_DARK_DC": "OXIMETER",
}


def channel_label(channel: str, device: str | None = None) -> str:
    """The name under which a channel is stored: blanks become underscores, a device goes first."""
    name = channel.replace(" ", "_")
    return f"{device}-{name}" if device else name


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
