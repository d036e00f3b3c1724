"""Filters and beats over streams (an extension): state per channel, equal to the batch's results.

Samples arrive as (recording_id, channel, sample_idx, ts, value), in any order within the watermark. A stretch
is a run of indexes without a gap. A sample that is lacking is given up when the watermark has passed the one
before it by `grace`: there the stretch ends, as a recording ends in a batch, and another begins. What a task
keeps of a channel is what its kernel reaches back, and what came before its turn; so state is bounded by the
kernel, the lateness and the sampling rate, and any split into micro-batches gives the same rows.

Rows without key, index, time or value are ignored. Of rows that repeat an index the first to come counts, of
those of one micro-batch the one with the smallest value. Indexes are not negative. Rows at or behind the
watermark are dropped by Spark, whose first watermark is 1970: clocks that start there lose their first sample.
The last samples of a recording wait until others move the watermark (`replay` adds one that does).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import fir
from ..operators.select import INDEX, KEY

_STATE = "at binary, x binary, ms binary, start long, done long, more binary"


def _none(kind: type = np.int64) -> np.ndarray:
    return np.zeros(0, kind)


@dataclass
class Channel:
    """What is kept of a channel: samples by index with their times, where the stretch begins (None: not yet
    known), the next index to give out (None: any), and what a kernel carries on."""

    at: np.ndarray = field(default_factory=_none)
    x: np.ndarray = field(default_factory=lambda: _none(np.float64))
    ms: np.ndarray = field(default_factory=_none)
    start: int | None = None
    done: int | None = None
    more: np.ndarray = field(default_factory=lambda: _none(np.float64))

    def add(self, at: np.ndarray, x: np.ndarray, ms: np.ndarray) -> None:
        order = np.lexsort((x, at))
        if self.done is not None:
            order = order[at[order] >= self.done]
        at, x, ms = (np.concatenate([mine, new[order]]) for mine, new in ((self.at, at), (self.x, x), (self.ms, ms)))
        self.at, first = np.unique(at, return_index=True)  # the first of equal ones: what is kept stands before what comes
        self.x, self.ms = x[first], ms[first]

    def cut(self, n: int) -> None:
        self.at, self.x, self.ms = self.at[n:], self.x[n:], self.ms[n:]

    def length(self) -> int:
        """Samples before the first gap."""
        gaps = np.flatnonzero(np.diff(self.at) != 1)
        return int(gaps[0]) + 1 if len(gaps) else len(self.at)

    def settles(self, grace: int) -> int:
        """The watermark (ms) at which something is decided that no further sample decides."""
        return int(self.ms[0]) if self.start is None else int(self.ms[self.length() - 1]) + grace


#: (samples from `first` on, first, the stretch's start, the next index to give out, whether the stretch ends
#: with them, what was carried on) to (the next index to give out, rows, what to carry on).
Kernel = Callable[[np.ndarray, int, int, int, bool, np.ndarray], tuple[int, np.ndarray, np.ndarray]]


def advance(c: Channel, watermark: int, grace: int, reach: int, kernel: Kernel) -> list[np.ndarray]:
    """The rows that c's samples decide at this watermark; c then holds what later ones need."""
    out = []
    while len(c.at):
        if c.start is None:
            if c.at[0] != 0 and watermark < c.ms[0]:
                break  # an earlier sample may still come
            c.start = c.done = int(c.at[0])
            c.more = _none(np.float64)
        n = c.length()
        ended = bool(watermark >= c.ms[n - 1] + grace)
        c.done, rows, c.more = kernel(c.x[:n], int(c.at[0]), c.start, c.done, ended, c.more)
        out.append(rows)
        if not ended:
            c.cut(max(0, max(c.start, c.done - reach) - int(c.at[0])))
            break
        c.cut(n)
        c.start = None
    return out


def filter_kernel(taps: np.ndarray) -> Kernel:
    """Rows (index, value); reaches len(taps) // 2 to either side."""
    pad = len(taps) // 2

    def run(x: np.ndarray, first: int, start: int, done: int, ended: bool, more: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        padded, _ = fir.reflected(x, pad)
        if first > start:  # samples before it stand where the padding would
            padded, first = padded[pad:], first + pad
        if not ended:
            padded = padded[: len(padded) - pad]
        y = fir.convolve(padded, taps)[done - first :]
        return done + len(y), np.column_stack([np.arange(done, done + len(y)), y]), more

    return run


def _mean(sq: np.ndarray, half: int) -> np.ndarray:
    """Means over what there is of a window; each window is summed by itself, whatever stands around it."""
    wide = np.lib.stride_tricks.sliding_window_view
    sums = lambda v: wide(np.pad(v, half), 2 * half + 1).sum(axis=1)
    return sums(sq) / sums(np.ones(len(sq)))


def peak_kernel(short: int, long: int, floor: float, least: int) -> Kernel:
    """Rows (index, value, samples since the stretch's peak before or NaN); reaches long // 2 to either side.
    Carried on: samples of the open block, its highest value and where that is, and the last peak."""
    half = long // 2

    def run(x: np.ndarray, first: int, start: int, done: int, ended: bool, more: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        to = first + len(x) - (0 if ended else half)
        if to < done:
            return done, np.zeros((0, 3)), more
        n, best, place, last = more if len(more) else (0.0, np.nan, np.nan, np.nan)
        sq = np.square(np.maximum(x, 0))
        inside = (_mean(sq, short // 2) > _mean(sq, half) + floor)[done - first : to - first]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        rows = []

        def close() -> None:
            nonlocal n, last
            if n >= least:
                rows.append((place, best, place - last))
                last = place
            n = 0.0

        if n and len(inside) and not inside[0]:
            close()
        for lo, hi in edges.reshape(-1, 2):
            block = x[done - first + lo : done - first + hi]
            k = int(np.argmax(block))
            if not n or block[k] > best:
                best, place = float(block[k]), float(done + lo + k)
            n += hi - lo
            if hi < len(inside):
                close()
        if ended and n:
            close()
        return to, np.array(rows, np.float64).reshape(-1, 3), np.array([n, best, place, last])

    return run


def _stateful(samples: DataFrame, kernel: Kernel, reach: int, names: list[str], lateness: str, grace: int) -> DataFrame:
    """(recording_id, channel, index, names) of the kernel's rows, as soon as they are decided."""
    key = [*KEY, "channel"]
    # a watermark needs a timestamp with time zone; the long beside it does not depend on the session's
    timed = samples.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    timed = timed.select(*key, F.col(INDEX).cast("long").alias(INDEX), "ts", F.unix_millis("ts").alias("__ms"), F.col("value").cast("double").alias("value"))
    out = [*key, INDEX, *names]

    def run(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        c = Channel()
        if state.exists:
            at, x, ms, start, done, more = state.get
            c.start, c.done = (None if v < 0 else v for v in (start, done))
            c.at, c.x, c.ms, c.more = np.frombuffer(at, np.int64), np.frombuffer(x), np.frombuffer(ms, np.int64), np.frombuffer(more)
        new = [(b[INDEX].to_numpy(np.int64), b["value"].to_numpy(np.float64), b["__ms"].to_numpy(np.int64)) for b in batches]
        if new:
            c.add(*(np.concatenate(v) for v in zip(*new, strict=True)))
        watermark = state.getCurrentWatermarkMs()
        rows = [r for r in advance(c, watermark, grace, reach, kernel) if len(r)]
        if len(c.at):
            state.update((c.at.tobytes(), c.x.tobytes(), c.ms.tobytes(), *(-1 if v is None else v for v in (c.start, c.done)), c.more.tobytes()))
            state.setTimeoutTimestamp(max(c.settles(grace), watermark + 1))
        elif state.exists:
            state.remove()
        if rows:
            r = np.vstack(rows)
            yield pd.DataFrame({**{name: [v] * len(r) for name, v in zip(key, k, strict=True)}, INDEX: r[:, 0].astype(np.int64), **{name: r[:, 1 + i] for i, name in enumerate(names)}})[out]

    kinds = ", ".join(f"{c} {samples.schema[c].dataType.simpleString()}" for c in key)
    whole = timed.dropna(subset=[*key, INDEX, "ts", "value"])
    return whole.groupBy(*key).applyInPandasWithState(run, f"{kinds}, {INDEX} long, " + ", ".join(f"{n} double" for n in names), _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def fir_filter(samples: DataFrame, rate: float, low: float | None = None, high: float | None = None, lateness: str = "2 minutes", grace_ms: int = 1000) -> DataFrame:
    """(recording_id, channel, index, value): the zero-phase filter of `operators.dsp.fir_filter`, half a filter
    behind the stream. grace_ms is at least a sample's time."""
    taps = fir.design(rate, low, high)
    return _stateful(samples, filter_kernel(taps), len(taps) // 2, ["value"], lateness, max(grace_ms, int(np.ceil(1000 / rate))))


def beats(samples: DataFrame, rate: float, short: int, long: int, floor: float = 0.0, least: int | None = None, lateness: str = "2 minutes", grace_ms: int = 1000) -> DataFrame:
    """(recording_id, channel, index, value, ibi in ms, rate per minute) of each pulse peak, as
    `operators.pulse.elgendi_peaks` and `beat_intervals` find them; ibi and rate are null for a stretch's first.
    `floor` stands for the batch's offset times the recording's mean, which a stream cannot know."""
    found = _stateful(samples, peak_kernel(short, long, floor, short if least is None else least), long // 2, ["value", "__d"], lateness, max(grace_ms, int(np.ceil(1000 / rate))))
    d = F.when(~F.isnan("__d"), F.col("__d"))
    return found.select(*KEY, "channel", INDEX, "value", (d / F.lit(float(rate)) * 1000).alias("ibi"), F.try_divide(F.lit(60.0) * rate, d).alias("rate"))
