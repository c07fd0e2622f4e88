from orderlens.sources.roles import RoleTables
from orderlens.sources.tables import read_table

__all__ = ["RoleTables", "read_table"]
