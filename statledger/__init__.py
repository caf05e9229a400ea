"""Analytics over published statistical tables, as PySpark DataFrame operators."""

from statledger.spec import EDUCATION_HEADLINE, STATUSES, TableSpec

__all__ = ["EDUCATION_HEADLINE", "STATUSES", "TableSpec"]
