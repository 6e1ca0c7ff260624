"""Query catalog on the driver's tables (stand-ins, Spark plans, SQL twins)."""

from slicewarden.plans import q_csv, q_gates, q_history, q_lineage, q_stores, q_validate  # noqa: F401  (registers queries)
from slicewarden.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
