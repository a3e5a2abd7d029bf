"""Registered queries and their SQL oracles."""

from . import customers, io, nested, operators, quality, scalars, streaming, weather  # noqa: F401
from .registry import oracles, queries  # noqa: F401
