"""lodestar: a Spark-native star-schema warehouse.

Cleans HR, finance and operations extracts with built-in Spark expressions,
loads dimensions and facts incrementally with stable surrogate keys, keeps
SCD type 1 and type 2 history, records an audit trail and serves KPI queries
and role views. Every operator is a lazy DataFrame transformation that takes
table and column names, so it fits other star schemas too.
"""

from lodestar.session import get_session, checkpoint_root

__all__ = ["get_session", "checkpoint_root"]
