"""Structured Streaming versions of the incremental operators."""

from finloom.streaming import incremental, timers  # noqa: F401  they register their queries
