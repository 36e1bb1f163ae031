"""Registered queries. Importing this package fills the registry."""

from tidewater.plans import (  # noqa: F401
    aggregates,
    distributions,
    joins,
    models,
    projections,
    quality,
    reports,
    scalars,
    sources,
    studies,
    windows,
)
