"""The catalogue of registered queries (driver data -> resume concepts)."""

from cvlens.plans.registry import ORACLES, QUERIES, register  # noqa: F401
from cvlens.plans import text_queries, mining_queries, skill_queries, eval_queries, model_queries, io_queries  # noqa: F401  (registration)


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
