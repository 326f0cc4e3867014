"""All registered queries: importing this module imports every operator of the reference's inventory."""

from storyloom.operators import addresses, enrichment, ingest, languages, lifecycle, metrics, native, parsing, relational, relational_more, stories, streams  # noqa: F401
from storyloom.plans.registry import FLAGSHIP, QUERIES, SQL

__all__ = ["FLAGSHIP", "QUERIES", "SQL"]
