"""Every query by name, each next to the SQL that must give the same rows."""

from rentlens.registry import (  # noqa: F401  (importing registers)
    aggregates,
    filters,
    joins,
    loads,
    models,
    quality,
    scalars,
    sources,
    streams,
    windows,
)
from rentlens.registry.base import ORACLES, QUERIES  # noqa: F401
