"""Signal processing over long signals: numpy kernels in Arrow batches, block by block.

A long night is not one task: filters and resampling run on blocks of BLOCK samples, to which the
edge samples of their neighbours are copied (the halo is as wide as the kernel reaches), so a block
gives exactly what the whole signal would. Only true ends are padded. Pulse waves are processed in blocks
as well; only what has a row a beat is grouped by recording.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..errors import LunariaError
from ..functions import fir, ppg, resample, spectro
from . import pulse
from .select import INDEX, KEY

BLOCK = 1 << 18


def _kinds(df: DataFrame, key: Sequence[str]) -> str:
    return ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in key)


def sizes_of(signal: DataFrame, key: Sequence[str] = (*KEY, "channel")) -> DataFrame:
    """(key, n): samples of each channel. Where a signal is itself computed, give its sizes instead of
    counting it: counting would run the computation once more."""
    return signal.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))


@dataclass(frozen=True)
class Step:
    """A step of a chain: up / down is the change of rate, reach the input samples on either side that a result
    depends on. apply(x, first, starts, ends) takes a stretch of a signal that begins with sample `first` (and
    is its start or its end) and gives the results that depend on nothing beyond the stretch, and the index of
    the first of them."""

    up: int
    down: int
    reach: int
    apply: Callable[[np.ndarray, int, bool, bool], tuple[np.ndarray, int]]


def fir_step(rate: float, low: float | None = None, high: float | None = None) -> Step:
    """Zero-phase FIR filter."""
    taps = fir.design(rate, low, high)
    pad = len(taps) // 2

    def apply(x: np.ndarray, first: int, starts: bool, ends: bool) -> tuple[np.ndarray, int]:
        padded, _ = fir.reflected(x, pad)
        if not starts:  # real samples stand where the padding would
            padded = padded[pad:]
        if not ends:
            padded = padded[: len(padded) - pad]
        return fir.convolve(padded, taps), first if starts else first + pad

    return Step(1, 1, pad, apply)


def resample_step(rate: float, target: float) -> Step:
    """Another rate."""
    up, down = resample.factors(rate, target)
    reach = -(-10 * max(up, down) // up) + 2
    edge = -(-reach * up // down)

    def apply(x: np.ndarray, first: int, starts: bool, ends: bool) -> tuple[np.ndarray, int]:
        skip = -first % down  # start on the output grid
        y = resample.resampled(x[skip:], up, down)
        lo, hi = 0 if starts else edge, len(y) if ends else len(y) - edge
        return y[lo : max(hi, lo)], (first + skip) * up // down + lo

    return Step(up, down, reach, apply)


def stepped(x: np.ndarray, steps: Sequence[Step], first: int = 0, starts: bool = True, ends: bool = True) -> tuple[np.ndarray, int]:
    """A stretch after all steps, and the index of its first sample."""
    for s in steps:
        if len(x):
            x, first = s.apply(x, first, starts, ends)
    return x, first


def length_after(n, steps: Sequence[Step]):
    """Samples (a number, or a column's SQL) of a signal after all steps."""
    for s in steps:
        n = f"({n} * {s.up} + {s.down - 1}) div {s.down}" if isinstance(n, str) else -(-n * s.up // s.down)
    return n


def chain(signal: DataFrame, steps: Sequence[Step], key: Sequence[str] = (*KEY, "channel"), block: int = BLOCK, values: Sequence[str] = ("value",)) -> DataFrame:
    """(key, index, values) after all steps, in one pass: a block and what the steps reach beyond it is one
    group, whatever the number of steps, so nothing between them is written or shuffled. With several columns
    of values, the channels of a wide signal, they stay side by side. Indexes are 0..n-1 of each recording."""
    up, down, halo = prod(s.up for s in steps), prod(s.down for s in steps), 0
    for s in reversed(steps):
        halo = -(-halo * s.down // s.up) + s.reach + 2 * s.down
    block = -(-max(block, halo) // down) * down
    names = [*key, INDEX, *values]

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by(INDEX)
        at, b = t.column(INDEX).to_numpy(), t.column("__block")[0].as_py()
        lo, hi = b * block, (b + 1) * block
        first, made = 0, []
        for v in values if at[-1] >= lo else ():  # else the signal ends before this block
            # a halo that lacks samples tells that the signal ends in it
            y, first = stepped(t.column(v).to_numpy().astype(np.float64), steps, int(at[0]), at[0] == 0, at[-1] < hi + halo - 1)
            made.append(y[lo * up // down - first : hi * up // down - first])
        n = len(made[0]) if made else 0
        same = [pa.repeat(t.column(k)[0], n) for k in key]
        return pa.table([*same, pa.array(np.arange(n, dtype=np.int64) + lo * up // down), *(pa.array(y) for y in made or [np.zeros(0)] * len(values))], names=names)

    reach = F.array_distinct(F.array(F.expr(f"greatest({INDEX} - {halo}, 0) div {block}"), F.expr(f"{INDEX} div {block}"), F.expr(f"({INDEX} + {halo}) div {block}")))
    dealt = signal.select(*names).withColumn("__block", F.explode(reach))
    columns = ", ".join(f"`{v}` double" for v in values)
    return dealt.groupBy(*key, "__block").applyInArrow(run, f"{_kinds(signal, key)}, {INDEX} long, {columns}")


def fir_filter(signal: DataFrame, rate: float, low: float | None = None, high: float | None = None, key: Sequence[str] = (*KEY, "channel"), block: int = BLOCK, sizes: DataFrame | None = None) -> DataFrame:
    """Zero-phase FIR filter of each channel. Indexes are 0..n-1 of each recording; sizes are not needed."""
    return chain(signal, (fir_step(rate, low, high),), key, block)


def resample_signal(signal: DataFrame, rate: float, target: float, key: Sequence[str] = (*KEY, "channel"), block: int = BLOCK, sizes: DataFrame | None = None) -> DataFrame:
    """Each channel at another rate, indexes anew from 0; equal rates give the signal back. Sizes are not needed."""
    up, down = resample.factors(rate, target)
    if up == down:
        return signal.select(*key, INDEX, F.col("value").cast("double").alias("value"))
    return chain(signal, (resample_step(rate, target),), key, block)


def _halo(rate: float, method: str) -> int:
    """Samples beyond a block that peaks within it can depend on."""
    if method == "elgendi":
        return ppg.elgendi_widths(rate)[1] // 2 + 1
    thin = ppg.thinning(rate) if method == "charlton" else 1
    return (ppg.bishop_windows(rate / thin)[0] + 2) * thin


def _peaks_within(x: np.ndarray, first: int, lo: int, hi: int, n: int, level: float, rate: float, method: str) -> np.ndarray:
    """Rows (first, after the last, place, value) of a block's candidates for peaks, lo to hi - 1 being the
    block and x the signal from sample `first` to its halo's end."""
    if n < 3:
        return np.zeros((0, 4))
    if method == "elgendi":
        rows = ppg.elgendi_blocks(x, rate, level, lo - first, hi - first)
        return rows + np.array([first, first, first, 0]) if len(rows) else rows
    thin = ppg.thinning(rate) if method == "charlton" else 1
    step, up = ppg.bishop_windows(rate / thin)[1], lambda v, by: -(-v // by)
    start = up(up(lo, thin), step) * step  # the first window that begins in the block, in thinned samples
    found = ppg.bishop(x[start * thin - first :: thin], rate / thin, start, up(hi, thin), up(n, thin)) * thin if start * thin < hi else np.zeros(0, np.int64)
    if method == "charlton":
        found = ppg.refined(x, found, thin, first)
    return np.column_stack([found, found + 1, found, x[found - first]]) if len(found) else np.zeros((0, 4))


def _layout(at: np.ndarray, n: int, rate: float, interpolation: str) -> np.ndarray:
    """What a recording's beats say about its samples, as rows (kind, lo, hi, x0, c0, c1, c2, c3): 0 a
    polynomial of the interval, 1 the samples of beat x0, 2 a peak, 3 the window of beat x0 (c0: samples)."""
    k = np.arange(len(at), dtype=np.float64)
    row = lambda kind, lo, hi, x0, c0: np.column_stack([np.full(len(at), kind), lo, hi, x0, np.full(len(at), c0), *[np.zeros(len(at))] * 3])
    peaks = row(2, at, at + 1, k, 0)
    if len(at) < 2:
        return peaks
    period = np.diff(at) / rate
    curve = ppg.pieces(at, np.append(period[0], period), n, interpolation)
    ends, half = ppg.beat_ends(at, n), ppg.window_half(at)
    return np.vstack([np.column_stack([np.zeros(len(curve)), curve]), row(1, np.append(0, ends[:-1]), ends, k, 0), peaks, row(3, at - half, at + half + 1, k, n)])


def _whole(key: Sequence[str], rate: float, peak_method: str, quality_method: str, interpolation: str, steps: Sequence[Step]) -> Callable[[pa.Table], pa.Table]:
    """What process_ppg gives of a recording that is one group."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by(INDEX)
        x, _ = stepped(t.column("value").to_numpy().astype(np.float64), steps)
        made = ppg.process(x, rate, peak_method, quality_method, interpolation)
        same = [pa.repeat(t.column(k)[0], len(x)) for k in key]
        at = pa.array(np.arange(len(x), dtype=np.int64)) if steps else t.column(INDEX)
        return pa.table([*same, at, *(pa.array(v) for v in made.values())], names=[*key, INDEX, *made])

    return run


def process_ppg(
    signal: DataFrame, rate: float, peak_method: str = "elgendi", quality_method: str = "templatematch", interpolation: str = "monotone_cubic", correct: bool = False,
    key: Sequence[str] = KEY, block: int = BLOCK, steps: Sequence[Step] = (), sizes: DataFrame | None = None,
) -> DataFrame:
    """(key, index, clean, peaks, ibi, rate, quality) of each recording's pulse wave, after steps of filtering
    and resampling (rate is the rate after them).

    A recording of no more than `block` samples is one group, steps included: one pass. Longer ones, and all if
    beats are to be corrected, go block by block. Which there are is asked when the plan is made, by sizes (key,
    n) of the signal as given: without them its rows are counted.

    Block by block, samples are dealt to blocks once. Blocks tell their neighbours their edge samples, and find peaks (runs
    that end at an edge go on in the next block). What is in order or concerns the whole recording, that is
    which peaks are beats, the curve through them and the mean beat, has a row a beat; then each block takes
    the part of it that its samples need. Any block size gives what the whole signal would. Tables of a row a
    recording or beat stay cached in the session (`spark.catalog.clearCache()` drops them).
    """
    for value, known, name in ((peak_method, ppg.PEAK_METHODS, "peak method"), (quality_method, ppg.QUALITY_METHODS, "quality method"), (interpolation, ppg.INTERPOLATIONS, "interpolation")):
        if value not in known:
            raise LunariaError(f"{name} {value}")
    key, halo = list(key), _halo(rate, peak_method)
    block, kinds = max(block, halo), _kinds(signal, key)
    out = f"{kinds}, {INDEX} long, clean double, peaks double, ibi double, rate double, quality double"
    if not correct:
        sizes = (sizes_of(signal, key) if sizes is None else sizes).select(*key, F.expr(length_after("n", steps)).alias("n"))
        least, most = sizes.agg(F.min("n"), F.max("n")).first()
        short = lambda df: df.groupBy(*key).applyInArrow(_whole(key, rate, peak_method, quality_method, interpolation, steps), out)
        if most is None or most <= block:
            return short(signal.select(*key, INDEX, "value"))
        if least <= block:
            part = lambda kept: signal.join(sizes.where(kept).select(*key), key, "left_semi")
            rest = _in_blocks(part(f"n > {block}"), rate, peak_method, quality_method, interpolation, False, key, block, steps)
            return short(part(f"n <= {block}").select(*key, INDEX, "value")).unionByName(rest)
    return _in_blocks(signal, rate, peak_method, quality_method, interpolation, correct, key, block, steps)


def _in_blocks(signal: DataFrame, rate: float, peak_method: str, quality_method: str, interpolation: str, correct: bool, key: list[str], block: int, steps: Sequence[Step]) -> DataFrame:
    """process_ppg block by block."""
    halo, on, kinds = _halo(rate, peak_method), [*key, "__block"], _kinds(signal, key)
    x = (chain(signal, steps, key, block) if steps else signal).select(*key, INDEX, F.col("value").cast("double").alias("value")).withColumn("__block", F.expr(f"{INDEX} div {block}"))
    same = lambda t, n: [pa.repeat(t.column(k)[0], n) for k in key]
    long = lambda v: pa.array(np.asarray(v).astype(np.int64))

    def told(t: pa.Table) -> pa.Table:
        t = t.sort_by(INDEX)
        at, v, b = t.column(INDEX).to_numpy(), t.column("value").to_numpy(), t.column("__block")[0].as_py()
        right, left = at >= (b + 1) * block - halo, (at < b * block + halo) & (b > 0)
        to = np.concatenate([np.full(right.sum(), b + 1), np.full(left.sum(), b - 1), [b]])
        kind = np.append(np.zeros(len(to) - 1, np.int32), np.int32(1))
        columns = [long(to), pa.array(kind), long(np.concatenate([at[right], at[left], [len(at)]])), pa.array(np.concatenate([v[right], v[left], [np.square(np.maximum(v, 0)).sum()]]))]
        return pa.table([*same(t, len(to)), *columns], names=[*on, "kind", "at", "v"])

    parts = x.groupBy(*on).applyInArrow(told, f"{kinds}, __block long, kind int, at long, v double")
    # what has a row a recording or a beat is kept: several later steps read it, and plans stay short
    whole = parts.where("kind = 1").groupBy(*key).agg(F.sum("at").alias("n"), (F.sum("v") / F.sum("at")).alias("level")).persist()
    info = whole.select(*key, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {block}"))).alias("__block"), F.lit(1).alias("kind"), F.col("n").alias("at"), F.col("level").alias("v"))

    def found(t: pa.Table, near: pa.Table) -> pa.Table:
        if not t.num_rows:
            return pa.table([*(pa.array([], t.schema.field(k).type) for k in key), *[long([])] * 3, pa.array([], pa.float64())], names=[*key, "a", "b", "at", "v"])
        about = near.column("kind").to_numpy() == 1
        n, level = near.column("at").to_numpy()[about][0], near.column("v").to_numpy()[about][0]
        at = np.concatenate([t.column(INDEX).to_numpy(), near.column("at").to_numpy()[~about]])
        v = np.concatenate([t.column("value").to_numpy(), near.column("v").to_numpy()[~about]])
        order, lo = np.argsort(at), t.column("__block")[0].as_py() * block
        rows = _peaks_within(v[order], int(at.min()), lo, min(lo + block, int(n)), int(n), level, rate, peak_method)
        return pa.table([*same(t, len(rows)), *(long(rows[:, i]) for i in range(3)), pa.array(rows[:, 3])], names=[*key, "a", "b", "at", "v"])

    near = parts.where("kind = 0").unionByName(info)
    candidates = x.groupBy(*on).cogroup(near.groupBy(*on)).applyInArrow(found, f"{kinds}, a long, b long, at long, v double")

    def chosen(t: pa.Table) -> pa.Table:
        t = t.sort_by("a")
        rows = np.column_stack([t.column(c).to_numpy() for c in ("a", "b", "at", "v")])
        at = ppg.elgendi_beats(rows, rate) if peak_method == "elgendi" else np.unique(rows[:, 2])
        return pa.table([*same(t, len(at)), long(at)], names=[*key, INDEX])

    beats = candidates.groupBy(*key).applyInArrow(chosen, f"{kinds}, {INDEX} long")
    if correct:
        beats = pulse.correct_beats(beats, rate, key).select(*key, INDEX)
    names = ["kind", "lo", "hi", "x0", "c0", "c1", "c2", "c3"]

    def laid(t: pa.Table) -> pa.Table:
        rows = _layout(np.unique(t.column(INDEX).to_numpy()), t.column("n")[0].as_py(), rate, interpolation)
        return pa.table([*same(t, len(rows)), *(long(rows[:, i]) for i in range(3)), *(pa.array(rows[:, i]) for i in range(3, 8))], names=[*key, *names])

    kind = ", ".join(f"{c} {'long' if i < 3 else 'double'}" for i, c in enumerate(names))
    layout = beats.join(whole.select(*key, "n"), key).groupBy(*key).applyInArrow(laid, f"{kinds}, {kind}").persist()
    spread = lambda df, lo, hi: df.withColumn("__block", F.explode(F.sequence(F.expr(f"{lo} div {block}"), F.expr(f"({hi} - 1) div {block}"))))

    def windows(t: pa.Table, near: pa.Table) -> pa.Table:
        k, off, values = [], [], []
        if t.num_rows and near.num_rows:
            t = t.sort_by(INDEX)
            v, first, last = t.column("value").to_numpy(), t.column(INDEX)[0].as_py(), t.column(INDEX)[-1].as_py()
            for lo, hi, beat, n in zip(*(near.column(c).to_pylist() for c in ("lo", "hi", "x0", "c0")), strict=True):
                at = np.clip(np.arange(lo, hi), 0, int(n) - 1)  # beyond its ends the signal stays as it is there
                mine = np.flatnonzero((at >= first) & (at <= last))
                if len(mine):
                    k.append(int(beat))
                    off.append(int(mine[0]))
                    values.append(v[at[mine] - first])
        own = t if t.num_rows else near
        columns = [*same(own, len(k))] if own.num_rows else [pa.array([], t.schema.field(c).type) for c in key]
        return pa.table([*columns, long(k), long(off), pa.array(values, pa.list_(pa.float64()))], names=[*key, "k", "off", "values"])

    cut = x.groupBy(*on).cogroup(spread(layout.where("kind = 3"), "greatest(lo, 0)", "least(hi, cast(c0 as long))").groupBy(*on)).applyInArrow(windows, f"{kinds}, k long, off long, values array<double>")
    waves = cut.groupBy(*key, "k").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("off", "values"))), lambda s: s["values"])).alias("w"))
    centre = F.aggregate("w", F.lit(0.0), lambda a, v: a + v) / F.size("w")
    waves = waves.withColumn("m", centre).select(*key, "k", F.transform("w", lambda v: v - F.col("m")).alias("w"))
    mean = waves.select(*key, F.posexplode("w").alias("p", "v")).groupBy(*key, "p").agg(F.avg("v").alias("v"))
    mean = mean.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "v"))), lambda s: s["v"]).alias("mean"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, m = (batch.column(len(key) + i).to_pylist() for i in (1, 2))
            q = np.array([ppg.likeness(np.array([a]), np.array(b), quality_method)[0] for a, b in zip(w, m, strict=True)], np.float64)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(key) + 1)), pa.array(q)], [*key, "x0", "q"])

    quality = waves.join(mean, key).select(*key, F.col("k").cast("double").alias("x0"), "w", "mean").mapInArrow(judged, f"{kinds}, x0 double, q double").persist()
    cells = layout.where("kind = 1").join(quality, [*key, "x0"]).withColumn("c0", F.col("q")).select(*layout.columns)
    rows = layout.where("kind in (0, 2)").unionByName(cells).where("lo < hi")

    def filled(t: pa.Table, near: pa.Table) -> pa.Table:
        t = t.sort_by(INDEX)
        at = t.column(INDEX).to_numpy()
        rows = np.column_stack([near.column(c).to_numpy().astype(np.float64) for c in names]) if near.num_rows else np.zeros((0, 8))
        rows = rows[np.argsort(rows[:, 1], kind="stable")]
        of = lambda k: rows[rows[:, 0] == k, 1:]
        period, peaks = ppg.on_pieces(of(0), at), np.isin(at, of(2)[:, 0]).astype(np.float64)
        columns = [t.column("value").combine_chunks(), pa.array(peaks), pa.array(period * 1000), pa.array(60 / period), pa.array(ppg.on_pieces(of(1), at))]
        return pa.table([*(t.column(k) for k in key), t.column(INDEX), *columns], names=[*key, INDEX, "clean", "peaks", "ibi", "rate", "quality"])

    out = f"{kinds}, {INDEX} long, clean double, peaks double, ibi double, rate double, quality double"
    return x.groupBy(*on).cogroup(spread(rows, "lo", "hi").groupBy(*on)).applyInArrow(filled, out)


def _per_epoch(periods: DataFrame, rows: Callable[[np.ndarray], np.ndarray], out: str, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Applies rows((epochs, channels, samples)) to array columns of equal lengths; others are an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = []
            for c in columns:
                a = batch.column(batch.schema.get_field_index(c))
                if pc.count_distinct(pc.list_value_length(a)).as_py() != 1:
                    raise ValueError(f"epochs of {c} differ in length")
                parts.append(a.flatten().to_numpy(zero_copy_only=False).reshape(len(a), -1))
            y = np.ascontiguousarray(rows(np.stack(parts, 1)), np.float64)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1]), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(k)) for k in key), listed], [*key, out])

    return periods.select(*key, *columns).mapInArrow(run, f"{_kinds(periods, key)}, {out} array<double>")


def spectrograms(periods: DataFrame, rate: float, key: Sequence[str] = (*KEY, "period_idx"), columns: Sequence[str] = ("samples",)) -> DataFrame:
    """(key, density): each epoch's spectrogram, time-major, column after column."""
    return _per_epoch(periods, lambda x: spectro.lite_row(x, rate), "density", key, columns)


def lite_features(periods: DataFrame, rate: float, columns: Sequence[str], key: Sequence[str] = (*KEY, "period_idx")) -> DataFrame:
    """(key, features): spectrograms of the columns."""
    return _per_epoch(periods, lambda x: spectro.lite_row(x, rate), "features", key, columns)


def full_features(periods: DataFrame, rate: float, columns: Sequence[str], key: Sequence[str] = (*KEY, "period_idx")) -> DataFrame:
    """(key, features): spectrograms, then statistics, of the columns."""
    return _per_epoch(periods, lambda x: spectro.full_row(x, rate), "features", key, columns)
