"""Column functions for published measures, keys and periods."""

from statledger.functions.keys import academic_year, aggregation_depth, fingerprint, natural_key
from statledger.functions.measures import measure_status, measure_value, per_mille, safe_divide

__all__ = [
    "academic_year",
    "aggregation_depth",
    "fingerprint",
    "measure_status",
    "measure_value",
    "natural_key",
    "per_mille",
    "safe_divide",
]
