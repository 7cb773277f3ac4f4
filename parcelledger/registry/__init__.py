"""Named queries over the sample tables, each with the same result stated as SQL."""

from parcelledger.registry.core import oracles, runners

__all__ = ["oracles", "runners"]
