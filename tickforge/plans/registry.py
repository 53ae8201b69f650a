"""Every registered market-bar query and the SQL it is checked against."""

from tickforge.plans.oracles import ORACLE_SQL
from tickforge.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
