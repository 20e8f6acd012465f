"""Queries of the linkage part by name, and the DuckDB SQL they are held against."""

from __future__ import annotations

from rosterline.plans import layout_queries
from rosterline.plans.oracles import ORACLES
from rosterline.plans.queries import QUERIES
from rosterline.streaming.events import STREAM_ORACLES, STREAM_QUERIES

QUERIES = QUERIES | layout_queries.QUERIES | STREAM_QUERIES
ORACLES = {name: sql for name, sql in (ORACLES | layout_queries.ORACLES | STREAM_ORACLES).items() if name in QUERIES}
