"""starloom: a PySpark-native retail / library / enrollment warehouse.

Every pipeline and report is a lazy DataFrame plan: sources adapt the
supplied parquet tables (or read tables already in the role shapes) into
the warehouse roles, operators hold the few custom building blocks (dense
surrogate keys, type-2 dimensions, quality checks, de-duplication), and
plans compose them into the dimensions, facts and business reports.
"""

from starloom.session import ensure_checkpoint_dir, get_session
from starloom.sources.roles import RoleWarehouse
from starloom.sources.tables import Warehouse

__all__ = ["RoleWarehouse", "Warehouse", "ensure_checkpoint_dir", "get_session"]
