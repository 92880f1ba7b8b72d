"""Every query over the driver tables, and the SQL each must agree with."""

from tickloom.registry.oracles import ORACLES
from tickloom.registry.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
