"""YAML pipelines: steps over named signals, compiled to lazy plans.

Each output is one plan; outputs that nobody asks for are never run. A resample to the rate that a
signal has already is dropped. A signal that several later steps read can be kept (`cache`).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

import yaml

from ..errors import BadConfig, ChannelCountMismatch, MissingChannel, UnknownName
from ..sources.recordings import ID_RULES, DatasetConfig
from .transforms import Signal, find, stacked

FOLDER = Path(__file__).parent / "configs"


@dataclass(frozen=True)
class Step:
    inputs: tuple[str, ...]
    outputs: tuple[str, ...]
    transforms: tuple[tuple[str, dict], ...] = ()


@dataclass(frozen=True)
class Pipeline:
    name: str
    steps: tuple[Step, ...]
    description: str = ""

    def missing(self, given: Iterable[str]) -> set[str]:
        """Inputs that neither the caller nor an earlier step provides."""
        have, lost = set(given), set()
        for s in self.steps:
            lost |= set(s.inputs) - have
            have |= set(s.outputs)
        return lost

    def needed(self, outputs: Iterable[str]) -> list[Step]:
        """The steps that the outputs depend on, in order."""
        want, kept = set(outputs), []
        for s in reversed(self.steps):
            if want & set(s.outputs):
                want = (want - set(s.outputs)) | set(s.inputs)
                kept.append(s)
        return kept[::-1]

    def shared(self) -> set[str]:
        """Names that more than one step reads after they are computed."""
        reads = [n for s in self.steps for n in s.inputs]
        made = {n for s in self.steps for n in s.outputs}
        return {n for n in made if reads.count(n) > 1}

    def run(self, signals: Mapping[str, Signal], outputs: Iterable[str] | None = None, cache: bool = False) -> dict[str, Signal]:
        """The asked-for outputs (all signals, given and made, by default). Names that no step makes are
        left out, with those given passed through."""
        store = self.made(signals, outputs, cache)
        return {n: _only(store[n], n) for n in (store if outputs is None else outputs) if n in store}

    def together(self, signals: Mapping[str, Signal], outputs: Iterable[str], cache: bool = False) -> list[Signal]:
        """The asked-for outputs, those that one step makes in one signal: written together they are
        computed once."""
        store, groups = self.made(signals, outputs, cache), {}
        for n in dict.fromkeys(outputs):
            if n in store:
                groups.setdefault(id(store[n]), (store[n], []))[1].append(n)
        return [s.select(*names) if len(names) < len(s.channels) else s for s, names in groups.values()]

    def made(self, signals: Mapping[str, Signal], outputs: Iterable[str] | None = None, cache: bool = False) -> dict[str, Signal]:
        """All signals by name after the steps that the outputs need; a signal may hold several names."""
        if lost := self.missing(signals):
            raise MissingChannel(f"pipeline {self.name} needs {', '.join(sorted(lost))}")
        # a name stands for a channel of a signal; channels that one step makes stay in one signal, so
        # that a later step which reads them all has one plan below it, not one for each channel
        store = {n: s.renamed((n,)) if len(s.channels) == 1 else s for n, s in signals.items()}
        steps = self.steps if outputs is None else self.needed(outputs)
        keep = self.shared() if cache else set()
        for step in steps:
            if not step.transforms and len(step.inputs) == len(step.outputs):
                store |= {o: _only(store[i], i).renamed((o,)) for i, o in zip(step.inputs, step.outputs, strict=True)}
                continue
            s = _together([(n, store[n]) for n in step.inputs])
            for name, config in step.transforms:
                if name == "Resample" and config.get("new_sample_rate") == s.rate:
                    continue
                s = find(name, config)(s)
            if len(s.channels) != len(step.outputs):
                raise ChannelCountMismatch(f"{len(step.outputs)} outputs for {len(s.channels)} channels")
            s = s.renamed(step.outputs)
            if keep & set(step.outputs):
                s = Signal(s.df.cache(), s.channels, s.rate, s.sizes)
            store |= dict.fromkeys(step.outputs, s)
        return store


def _only(s: Signal, name: str) -> Signal:
    return s.select(name) if len(s.channels) > 1 and name in s.channels else s


def _together(inputs: list[tuple[str, Signal]]) -> Signal:
    """The inputs, in order, as one signal; those that lie in one signal are taken from it at once."""
    groups: dict[int, tuple[Signal, list[str]]] = {}
    for name, s in inputs:
        groups.setdefault(id(s), (s, []))[1].append(name)
    parts = []
    for s, names in groups.values():
        if set(names) == set(s.channels) or len(s.channels) == 1 or not set(names) <= set(s.channels):
            parts.append(s)
        else:
            parts.append(s.select(*names))
    whole = stacked(parts)
    order = tuple(n for n, _ in inputs)
    return whole.ordered(order) if set(order) == set(whole.channels) else whole


def parse(config: Mapping) -> Pipeline:
    """A pipeline from its YAML mapping; every name and parameter is checked here."""
    if not isinstance(config, Mapping) or not config.get("name") or not isinstance(config.get("steps"), list):
        raise BadConfig("a pipeline has a name and a list of steps")
    steps = []
    for k, s in enumerate(config["steps"]):
        ins, outs = (tuple(s.get(n) or s.get(o) or ()) for n, o in (("input_data_types", "inputs"), ("output_data_types", "outputs")))
        if not ins or not outs:
            raise BadConfig(f"step {k} of {config['name']} needs an input and an output")
        transforms = tuple((t["transform"], dict(t.get("config") or {})) for t in s.get("transforms") or ())
        for name, c in transforms:
            find(name, c)
        steps.append(Step(ins, outs, transforms))
    return Pipeline(config["name"], tuple(steps), config.get("description", ""))


def load(path: str | Path) -> Pipeline:
    try:
        return parse(yaml.safe_load(Path(path).read_text()))
    except yaml.YAMLError as e:
        raise BadConfig(f"{path}: {e}") from e


def bundled(name: str) -> Pipeline:
    path = FOLDER / f"{name}.yaml"
    if not path.exists():
        raise UnknownName(f"pipeline {name}; bundled: {', '.join(sorted(p.stem for p in FOLDER.glob('*.yaml')))}")
    return load(path)


@dataclass(frozen=True)
class Datasets:
    configs: dict[str, DatasetConfig] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | Path) -> Datasets:
        """Datasets of a YAML list: name, data_dir, pattern, id_rule, scoring_pattern, mapping."""
        found: dict[str, DatasetConfig] = {}
        for entry in yaml.safe_load(Path(path).read_text()):
            try:
                c = DatasetConfig(**entry)
            except TypeError as e:
                raise BadConfig(f"{path}: {e}") from e
            if c.id_rule not in ID_RULES:
                raise UnknownName(f"id rule {c.id_rule}")
            found[c.name] = c
        return cls(found)

    def choose(self, names: Iterable[str]) -> list[DatasetConfig]:
        if unknown := set(names) - self.configs.keys():
            raise UnknownName(f"datasets {', '.join(sorted(unknown))}")
        return [self.configs[n] for n in names]


def rename_only(name: str, names: Mapping[str, str], rate: float | None = None) -> Pipeline:
    """A pipeline that only renames channels, and resamples them if a rate is given."""
    t = (("Resample", {"new_sample_rate": rate}),) if rate else ()
    return Pipeline(name, tuple(Step((a,), (b,), t) for a, b in names.items()))
