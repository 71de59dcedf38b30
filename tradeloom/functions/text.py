"""Text clean-up and value maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tradeloom.constants import NA_TOKENS, NO_YEAR_LABEL


def blank_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn the missing-value spellings of CSV files into NULL (default: in every text column)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.when(is_present(F.col(c)), F.col(c)) for c in columns})


def is_present(text: Column) -> Column:
    """Not a missing-value spelling; NULL for NULL."""
    return ~text.isin(*NA_TOKENS)


def map_values(column: Column, mapping: Mapping[str, object], default: object) -> Column:
    """Replace known values; everything else, NULL included, becomes `default`."""
    (first, value), *rest = mapping.items()
    chosen = F.when(column == first, F.lit(value))
    for key, value in rest:
        chosen = chosen.when(column == key, F.lit(value))
    return chosen.otherwise(F.lit(default))


def rename_values(df: DataFrame, column: str, mapping: Mapping[str, str]) -> DataFrame:
    """Replace known values and leave all others as they are."""
    return df.replace(dict(mapping), subset=[column])


def title_with_year(title: Column, year: Column) -> Column:
    return F.concat(title, F.lit(" ("), F.coalesce(year.cast("string"), F.lit(NO_YEAR_LABEL)), F.lit(")"))
