"""All queries, grouped by family; importing this module fills the registry."""

from . import (  # noqa: F401
    aggregates,
    columns,
    incremental,
    joins,
    loads,
    marts,
    nested,
    quality,
    reloads,
    scans,
    static,
)
