"""Errors raised on the driver before or while a plan is built."""


class LunariaError(Exception):
    """Base of all errors of this package."""


class MissingChannel(LunariaError):
    """A requested channel is not in the signal's metadata."""


class DuplicateChannel(LunariaError):
    """Signals to be stacked share channel names."""


class RateMismatch(LunariaError):
    """Signals to be combined have different sample rates."""


class RateNotFound(LunariaError):
    """Neither the channel nor its file states a sample rate."""


class ChannelCountMismatch(LunariaError):
    """A step has more or fewer outputs than channels."""


class NotAMultiple(LunariaError):
    """A recording's length is no multiple of the period."""


class NoSamples(LunariaError):
    """Nothing to build an array from."""


class UnknownName(LunariaError):
    """No transform, pipeline or dataset of that name is registered."""


class BadConfig(LunariaError):
    """A configuration file cannot be used."""


class AnnotationsMissing(LunariaError):
    """A recording has no annotations of the requested type."""


class DurationMismatch(LunariaError):
    """Channels that belong together differ in length."""


class HypnogramMismatch(LunariaError):
    """A recording has other epochs in its features than in its hypnogram."""


class AmbiguousLookup(LunariaError):
    """A lookup has several rows for one key."""


class ExistingOutput(LunariaError):
    """The output is there and must not be replaced."""


class ModelUnavailable(LunariaError):
    """An optional model library or file is missing."""


class StoreConflict(LunariaError):
    """Another job has written to the store since this one read its version."""
