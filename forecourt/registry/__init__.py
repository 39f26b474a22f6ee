"""Named queries over the driver's tables and the SQL each must agree with."""

from forecourt.registry.oracles import ORACLES
from forecourt.registry.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
