"""What the driver's entry module registers for this subpackage."""

from quoteflow.llm.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
