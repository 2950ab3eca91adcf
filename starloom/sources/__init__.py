"""Sources and sinks: parquet tables, warehouse-role adapters, table writes."""

from starloom.sources.roles import RoleWarehouse, export_roles
from starloom.sources.tables import Warehouse

__all__ = ["RoleWarehouse", "Warehouse", "export_roles"]
