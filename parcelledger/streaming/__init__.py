"""Continuous feeds into the marts."""

from parcelledger.streaming.upsert_stream import start_upsert

__all__ = ["start_upsert"]
