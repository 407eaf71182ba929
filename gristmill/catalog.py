"""Names of the registered queries and their oracles."""

from __future__ import annotations

from . import plans
from .plans import curation_plans, detail_plans, record_plans, selection_plans, stream_plans, text_plans  # noqa: F401  (they register themselves)


def queries():
    return dict(plans.QUERIES)


def oracle_sql():
    return dict(plans.ORACLES)
