"""Every operator bound to the driver's tables, with an independent SQL check."""

from wayline.suite.base import ORACLES, QUERIES
from wayline.suite import documents, joins, plans, quality, scalars, sources, streams, trend  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
