"""Column expressions (JVM-side, codegen-friendly) shared by the operators."""

from casewatch.functions.text import (
    blank_to_null,
    clean_text,
    is_in_set,
    lower_strip,
    normalize_string,
    split_packed,
    strip,
)
from casewatch.functions.dates import month_of, parse_date
from casewatch.functions.numeric import age_band, age_in_years, percentage
from casewatch.functions.numbers import extract_numbers, number_value

__all__ = [
    "age_band",
    "age_in_years",
    "blank_to_null",
    "clean_text",
    "extract_numbers",
    "is_in_set",
    "lower_strip",
    "month_of",
    "normalize_string",
    "number_value",
    "parse_date",
    "percentage",
    "split_packed",
    "strip",
]
