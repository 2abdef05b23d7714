"""Queries over the given tables, and the SQL each must agree with."""

from __future__ import annotations

from . import ingest, models, oracles, partials, reports, streams

QUERIES = {**models.QUERIES, **reports.QUERIES, **ingest.QUERIES, **streams.QUERIES, **partials.QUERIES}
ORACLES = oracles.ORACLES
