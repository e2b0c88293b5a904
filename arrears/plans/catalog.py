"""All registered queries."""

from __future__ import annotations

from arrears.plans import (  # noqa: F401
    evaluation_queries,
    feature_queries,
    ingest_queries,
    relational,
    sampling_queries,
    smote_queries,
    training_queries,
)
from arrears.plans.registry import ORACLES, QUERIES  # noqa: F401
from arrears.plans.training_queries import flagship  # noqa: F401
