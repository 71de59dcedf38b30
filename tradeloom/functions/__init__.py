"""Column-level helpers. Everything here is a built-in expression, so it stays inside codegen."""

from tradeloom.functions.dates import date_from_parts, months_before, strict_us_date, tolerant_date, whole_years
from tradeloom.functions.numbers import decimal_from_text, percent_of, rounded_mean, summed_product
from tradeloom.functions.text import blank_to_null, map_values, rename_values, title_with_year

__all__ = [
    "blank_to_null", "date_from_parts", "decimal_from_text", "map_values", "months_before", "percent_of",
    "rename_values", "rounded_mean", "strict_us_date", "summed_product", "title_with_year", "tolerant_date", "whole_years",
]
