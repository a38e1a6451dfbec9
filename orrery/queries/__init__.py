"""The registered queries over the driver's tables, each next to its SQL where SQL can say it."""

from orrery.queries import catalog, dates, documents, quality, sources, star, streams  # noqa: F401
from orrery.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
