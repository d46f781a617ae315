"""The registered queries: Spark plan and, where SQL can say it, the same answer in SQL."""

from __future__ import annotations

from medloom.plans.catalog import aggregates, files, ingest, quality, searches, staged, streams
from medloom.plans.catalog.base import Query

CATALOG: dict[str, Query] = {
    **staged.QUERIES,
    **searches.QUERIES,
    **aggregates.QUERIES,
    **quality.QUERIES,
    **ingest.QUERIES,
    **files.QUERIES,
    **streams.QUERIES,
}
