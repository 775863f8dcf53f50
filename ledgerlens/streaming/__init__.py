"""Structured Streaming: the loader run incrementally over arriving files."""

from ledgerlens.streaming.incremental_load import run_incremental_load, start_incremental_load

__all__ = ["run_incremental_load", "start_incremental_load"]
