"""The registered queries, one module per part of the inventory."""

from loamwork.plans import (  # noqa: F401  (importing a module registers its queries)
    aggregates, checked, columns, computed, evaluation, features, filed, filters, joins, models, recommending, ruled, scans, sorts, stored, tuning,
)
from loamwork.plans.registry import ORACLES, QUERIES  # noqa: F401
