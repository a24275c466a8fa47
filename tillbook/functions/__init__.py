from tillbook.functions.evidence import AmbiguousDatesError, date_evidence, date_pattern_of, decimals_needed
from tillbook.functions.money import average, money, percentage
from tillbook.functions.parsing import (
    exact_decimal, lossy, missing_to_null, numbers_fit, sale_date, sale_time, whole_number,
)

__all__ = [
    "AmbiguousDatesError", "average", "date_evidence", "date_pattern_of", "decimals_needed", "exact_decimal", "lossy", "missing_to_null", "money", "numbers_fit", "percentage", "sale_date", "sale_time",
    "whole_number",
]
