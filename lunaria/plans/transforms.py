"""Transforms of pipelines: named, parametrised functions from signal to signal.

A Signal is a lazy long table (recording_id, channel, sample_idx, value) with the metadata that
validation needs: channel order and rate. Nothing runs while a pipeline is built, but that ProcessPPG asks for
the longest recording (known sizes, or a count).
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from enum import Enum
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import BadConfig, ChannelCountMismatch, RateMismatch, UnknownName
from ..functions import ppg, resample
from ..operators import align, annotate, dsp, motion, segment

KEY = ("recording_id",)


@dataclass(frozen=True)
class Signal:
    """sizes (recording_id, channel, n), where known, spare later steps a count. side, where at hand, holds the
    same samples side by side, a column a channel. What filters and resampling make remembers the signal it was
    made from (given) and the steps, so that one more step is one more in the same pass over that signal."""

    df: DataFrame
    channels: tuple[str, ...]
    rate: float
    sizes: DataFrame | None = None
    side: DataFrame | None = None
    given: Signal | None = None
    steps: tuple[dsp.Step, ...] = ()

    def _with(self, change: Callable[[DataFrame], DataFrame], beside: Callable[[DataFrame], DataFrame], again: Callable[[Signal], Signal], names: tuple[str, ...]) -> Signal:
        side, sizes = (None if x is None else f(x) for f, x in ((beside, self.side), (change, self.sizes)))
        df = change(self.df) if side is None else align.to_long(side, names, KEY)
        return Signal(df, names, self.rate, sizes, side, self.given and again(self.given), self.steps)

    def select(self, *channels: str) -> Signal:
        return self._with(lambda df: df.where(F.col("channel").isin(*channels)), lambda w: w.select(*KEY, "sample_idx", *channels), lambda s: s.select(*channels), channels)

    def renamed(self, names: tuple[str, ...]) -> Signal:
        if names == self.channels:
            return self
        table = F.create_map(*[F.lit(x) for pair in zip(self.channels, names, strict=True) for x in pair])
        name = F.lit(names[0]) if len(names) == 1 else F.element_at(table, F.col("channel"))
        beside = lambda w: w.select(*KEY, "sample_idx", *[F.col(a).alias(b) for a, b in zip(self.channels, names, strict=True)])
        return self._with(lambda df: df.withColumn("channel", name), beside, lambda s: s.renamed(names), names)

    def ordered(self, names: tuple[str, ...]) -> Signal:
        """The same channels in another order."""
        return replace(self, channels=names, given=self.given and self.given.ordered(names))

    def stepped(self, step: dsp.Step, rate: float) -> Signal:
        """After one more step of filtering or resampling, in one pass with those before it."""
        base, steps = (self, (step,)) if self.given is None else (self.given, (*self.steps, step))
        if base.side is not None:
            out = beside(dsp.chain(base.side, steps, KEY, values=base.channels), self.channels, rate)
        else:
            out = Signal(dsp.chain(base.df, steps, (*KEY, "channel")), self.channels, rate)
        sizes = None if self.sizes is None else self.sizes.withColumn("n", F.expr(dsp.length_after("n", (step,))))
        return replace(out, sizes=sizes, given=base, steps=steps)

    def wide(self) -> DataFrame:
        return align.stack_long(self.df, self.channels) if self.side is None else self.side.dropna(subset=list(self.channels))


def beside(wide: DataFrame, channels: Iterable[str], rate: float) -> Signal:
    """The signal of a wide table (recording_id, sample_idx, a column a channel)."""
    return Signal(align.to_long(wide, tuple(channels), KEY), tuple(channels), rate, side=wide)


def stacked(signals: list[Signal]) -> Signal:
    """Several signals as one. Long tables are put together without a join; a transform that needs the
    channels side by side aligns them itself, so renaming does not require equal rates."""
    if len(signals) == 1:
        return signals[0]
    frames = [s.df.select(*KEY, "channel", "sample_idx", "value") for s in signals]
    if len({f.schema["value"].dataType.simpleString() for f in frames}) > 1:  # labels beside numbers: all as text
        frames = [f.withColumn("value", F.col("value").cast("string")) for f in frames]
    out = reduce(DataFrame.unionByName, frames)
    rates = {s.rate for s in signals}
    sizes = None if any(s.sizes is None for s in signals) else reduce(DataFrame.unionByName, [s.sizes for s in signals])
    return Signal(out, tuple(c for s in signals for c in s.channels), rates.pop() if len(rates) == 1 else float("nan"), sizes)


def one_rate(s: Signal, name: str) -> float:
    if s.rate != s.rate:
        raise RateMismatch(f"{name} needs channels of one rate")
    return s.rate


def needs(s: Signal, n: int, name: str) -> None:
    if len(s.channels) != n:
        raise ChannelCountMismatch(f"{name} takes {n} channels, not {len(s.channels)}")


def plain(value):
    return value.value if isinstance(value, Enum) else value


def resample_to(s: Signal, new_sample_rate: float) -> Signal:
    up, down = resample.factors(one_rate(s, "Resample"), new_sample_rate)
    if up == down:
        return Signal(dsp.resample_signal(s.df, s.rate, new_sample_rate), s.channels, float(new_sample_rate), s.sizes)
    return s.stepped(dsp.resample_step(s.rate, new_sample_rate), float(new_sample_rate))


def fir(s: Signal, low_cutoff: float | None = None, high_cutoff: float | None = None) -> Signal:
    return s.stepped(dsp.fir_step(one_rate(s, "FIRFilter"), low_cutoff, high_cutoff), s.rate)


def process_ppg(s: Signal, peak_detection_method: str = "elgendi", quality_method: str = "templatematch", interpolation_method: str = "monotone_cubic", correct_artifacts: bool = False) -> Signal:
    needs(s, 1, "ProcessPPG")
    peak, quality, inter = (str(plain(x)) for x in (peak_detection_method, quality_method, interpolation_method))
    for value, known in ((peak, ppg.PEAK_METHODS), (quality, ppg.QUALITY_METHODS), (inter, ppg.INTERPOLATIONS)):
        if value not in known:
            raise BadConfig(f"{value} is none of {', '.join(known)}")
    base = s if s.given is None else s.given
    out = dsp.process_ppg(base.df, one_rate(s, "ProcessPPG"), peak, quality, inter, correct_artifacts, KEY, steps=s.steps, sizes=base.sizes)
    made = ("peaks", "ibi", "rate", "quality")
    n = None if s.sizes is None else s.sizes.select(*KEY, F.explode(F.array(*map(F.lit, made))).alias("channel"), "n")
    return replace(beside(out.select(*KEY, "sample_idx", *made), made, s.rate), sizes=n)


def ppg_artifacts(s: Signal, segment_duration: float = 30.0, quality_threshold: float = 0.8, ibi_range: tuple[float, float] = (300, 2000), min_valid_ratio: float = 0.5) -> Signal:
    """Inputs: beat intervals (ms) and quality, in this order. Output: 1 for an artifact, per segment."""
    needs(s, 2, "PPGArtifactLabels")
    length = segment.segment_length(segment_duration, one_rate(s, "PPGArtifactLabels"))
    ibi, quality = s.channels
    out = segment.artifact_segments(s.wide(), length, quality_threshold, tuple(map(float, ibi_range)), min_valid_ratio, quality, ibi, KEY)
    long = out.select(*KEY, F.lit("artifact").alias("channel"), F.col("epoch_idx").alias("sample_idx"), F.col("is_artifact").cast("double").alias("value"))
    return Signal(long, ("artifact",), 1.0 / segment_duration)


def merge_artifacts(s: Signal) -> Signal:
    """Inputs: labels, then an artifact mask; rows of both may be text. Output: labels."""
    needs(s, 2, "MergeArtifactLabels")
    a, b = s.channels
    labels = s.df.where(F.col("channel") == a).select(*KEY, F.col("sample_idx").alias("epoch_idx"), F.col("value").cast("string").alias("label"))
    mask = s.df.where(F.col("channel") == b).select(*KEY, F.col("sample_idx").alias("epoch_idx"), (F.col("value").try_cast("double") > 0).alias("is_artifact"))
    out = annotate.merge_artifacts(labels, mask, KEY)
    return Signal(out.select(*KEY, F.lit(a).alias("channel"), F.col("epoch_idx").alias("sample_idx"), F.col("label").alias("value")), (a,), s.rate)


def dynamic(s: Signal) -> Signal:
    needs(s, 3, "ProcessDynamicAccelerometer")
    return beside(motion.dynamic(s.wide(), one_rate(s, "ProcessDynamicAccelerometer"), s.channels, KEY), ("magnitude", "derivative"), s.rate)


def gravity(s: Signal) -> Signal:
    needs(s, 3, "ProcessGravityAccelerometer")
    one_rate(s, "ProcessGravityAccelerometer")
    return beside(motion.gravity(s.wide(), s.channels, KEY), ("pitch", "roll"), s.rate)


TRANSFORMS: dict[str, Callable[..., Signal]] = {
    "Resample": resample_to,
    "FIRFilter": fir,
    "ProcessPPG": process_ppg,
    "PPGArtifactLabels": ppg_artifacts,
    "MergeArtifactLabels": merge_artifacts,
    "ProcessDynamicAccelerometer": dynamic,
    "ProcessGravityAccelerometer": gravity,
}


def register(name: str, transform: Callable[..., Signal]) -> None:
    """Adds a transform of one's own: a function of a Signal and keyword parameters."""
    TRANSFORMS[name] = transform


def find(name: str, config: dict) -> Callable[[Signal], Signal]:
    """The transform with its parameters bound; unknown names and parameters are errors at once."""
    if name not in TRANSFORMS:
        raise UnknownName(f"transform {name}; known: {', '.join(sorted(TRANSFORMS))}")
    f = TRANSFORMS[name]
    try:
        inspect.signature(f).bind(None, **config)
    except TypeError as e:
        raise BadConfig(f"{name}: {e}") from e
    return lambda s: f(s, **config)
