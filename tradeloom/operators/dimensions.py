"""Dimension loads: simple name lists, the location hierarchy, the unknown member."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.constants import STATE_ALIASES, UNKNOWN_ID, UNKNOWN_NAME
from tradeloom.functions import rename_values
from tradeloom.operators.matching import new_rows
from tradeloom.operators.numbering import number_members


def distinct_members(
    df: DataFrame, columns: Mapping[str, str], without_na_text: Collection[str] = ()
) -> DataFrame:
    """(dimension, name) pairs of several columns, in one scan and one shuffle.

    `columns` maps the dimension to its source column. Missing names drop out, and for the dimensions
    in `without_na_text` the text "n/a" in any case as well.
    """
    wide = df.select(*(F.col(c).cast("string").alias(d) for d, c in columns.items()))
    pairs = wide.unpivot([], list(columns), "dimension", "name").filter(F.col("name").isNotNull())
    if without_na_text:
        is_na_text = F.col("dimension").isin(*without_na_text) & (F.lower("name") == "n/a")
        pairs = pairs.filter(~is_na_text)
    return pairs.distinct()


def new_members(found: DataFrame, existing: DataFrame) -> DataFrame:
    """Members of `found` that `existing` (dimension, id, name) lacks, with their new ids."""
    fresh = new_rows(found, existing, ["dimension", "name"])
    return number_members(fresh, existing, names=["name"], within=["dimension"])


def missing_unknown_members(members: DataFrame, dimensions: Collection[str]) -> DataFrame:
    """The member 0, "Unknown", of each of `dimensions` that has no member 0 yet."""
    unknown = members.sparkSession.range(1).select(
        F.explode(F.array(*(F.lit(d) for d in dimensions))).alias("dimension"),
        F.lit(UNKNOWN_ID).cast("bigint").alias("id"),
        F.lit(UNKNOWN_NAME).alias("name"),
    )
    return new_rows(unknown, members.filter(F.col("id") == UNKNOWN_ID), ["dimension", "id"])


def with_unknown_members(members: DataFrame, dimensions: Collection[str]) -> DataFrame:
    return members.unionByName(missing_unknown_members(members, dimensions))


@dataclass(frozen=True)
class Locations:
    """Tables of the location hierarchy: country, state within country, postcode within state."""

    countries: DataFrame
    states: DataFrame
    postcodes: DataFrame


def distinct_places(customers: DataFrame, aliases: Mapping[str, str] = STATE_ALIASES) -> DataFrame:
    """Distinct (country, state, postcode) with one spelling per state and postcodes as text."""
    places = customers.select("country", "state", F.col("postcode").cast("string").alias("postcode"))
    return rename_values(places, "state", aliases).distinct()


def new_countries(places: DataFrame, existing: DataFrame) -> DataFrame:
    found = places.select(F.col("country").alias("country_name")).filter("country_name IS NOT NULL").distinct()
    return number_members(new_rows(found, existing, ["country_name"]), existing, ["country_name"])


def new_states(places: DataFrame, countries: DataFrame, existing: DataFrame) -> DataFrame:
    """States under their country's id; the same name in two countries is two states."""
    found = (
        places.select(F.col("state").alias("state_name"), F.col("country").alias("country_name"))
        .na.drop()
        .distinct()
        .join(countries, "country_name")
        .select("state_name", F.col("id").alias("country_id"))
    )
    keys = ["state_name", "country_id"]
    return number_members(new_rows(found, existing, keys), existing, keys)


def new_postcodes(
    places: DataFrame, countries: DataFrame, states: DataFrame, existing: DataFrame
) -> DataFrame:
    """Postcodes with their state; one that occurs in several states goes to the smallest state id."""
    owners = states.join(countries.select(F.col("id").alias("country_id"), "country_name"), "country_id").select(
        F.col("state_name").alias("state"), F.col("country_name").alias("country"), F.col("id").alias("state_id")
    )
    found = (
        places.filter(F.col("postcode").isNotNull())
        .join(owners, ["country", "state"])
        .groupBy("postcode")
        .agg(F.min("state_id").alias("state_id"))
    )
    return new_rows(found, existing, ["postcode"])


def new_locations(
    places: DataFrame, existing: Locations, settle: Callable[[DataFrame, str], DataFrame]
) -> Locations:
    """The rows to add to all three levels.

    Every level refers to the ids of the one above, so each is passed through `settle` (write and
    read back, given the table name) before the next is built on it.
    """
    countries = settle(new_countries(places, existing.countries), "countries")
    all_countries = existing.countries.unionByName(countries)
    states = settle(new_states(places, all_countries, existing.states), "states")
    all_states = existing.states.unionByName(states)
    postcodes = settle(new_postcodes(places, all_countries, all_states, existing.postcodes), "postcodes")
    return Locations(countries, states, postcodes)
