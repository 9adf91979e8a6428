"""All registered queries and their SQL twins."""

from __future__ import annotations

from hyphalake.plans import aggregates, compositions, files, joins, scalars, scans, statistics, windows  # noqa: F401
from hyphalake.plans.base import ORACLE_SQL, QUERIES  # noqa: F401

FLAGSHIP = "t4_class_enrichment"
