"""Structured Streaming versions of the intake and staging plans."""

from .intake import ENVELOPE_SCHEMA, read_envelopes, start_flatten, start_intake  # noqa: F401
from .newest import NewestHours, hour_buckets, newest_hours  # noqa: F401
