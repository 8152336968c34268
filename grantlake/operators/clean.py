"""Cleaning of grants: dates, codes, names.  One projection, and counters from the same conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.functions.columns import COUNTRY_CODES, CURRENCY_CODES, bare_name, institution_name, is_upper, mapped

FIRST_YEAR, LAST_YEAR = 1950, 2040


def _inverted() -> Column:
    return F.coalesce(F.col("start_date") > F.col("end_date"), F.lit(False))


def clean_dates(df: DataFrame) -> DataFrame:
    """Swap inverted dates, then drop placeholders and years that can't be."""
    start = F.when(_inverted(), F.col("end_date")).otherwise(F.col("start_date"))
    end = F.when(_inverted(), F.col("start_date")).otherwise(F.col("end_date"))
    fits_start = (start != F.lit("1900-01-01").cast("date")) & (F.year(start) >= FIRST_YEAR)
    fits_end = (end != F.lit("9999-12-31").cast("date")) & F.year(end).between(FIRST_YEAR, LAST_YEAR)
    return df.withColumns({"start_date": F.when(fits_start, start), "end_date": F.when(fits_end, end)})


def date_fixes() -> dict[str, Column]:
    """Counters of the steps of clean_dates over the rows before it; each step sees what the ones before left."""
    start = F.when(_inverted(), F.col("end_date")).otherwise(F.col("start_date"))
    end = F.when(_inverted(), F.col("start_date")).otherwise(F.col("end_date"))
    first, last = F.lit("1900-01-01").cast("date"), F.lit("9999-12-31").cast("date")
    return {
        "swapped": F.count_if(_inverted()),
        "sentinel_start": F.count_if(start == first),
        "sentinel_end": F.count_if(end == last),
        "ancient_start": F.count_if((start != first) & (F.year(start) < FIRST_YEAR)),
        "ancient_end": F.count_if((end != last) & (F.year(end) < FIRST_YEAR)),
        "future_end": F.count_if((end != last) & (F.year(end) > LAST_YEAR)),
    }


def clean_codes(df: DataFrame) -> DataFrame:
    """ISO country and currency codes; 'EU' is no country."""
    country = mapped(F.col("pi_country"), COUNTRY_CODES)
    return df.withColumns({"pi_country": F.when(country != "EU", country), "currency": mapped(F.col("currency"), CURRENCY_CODES)})


def code_fixes() -> dict[str, Column]:
    return {
        "countries_fixed": F.count_if(F.col("pi_country").isin(*COUNTRY_CODES)),
        "eu_country_fixed": F.count_if(F.col("pi_country") == "EU"),
        "currencies_fixed": F.count_if(F.col("currency").isin(*CURRENCY_CODES)),
    }


def clean_names(df: DataFrame) -> DataFrame:
    """Names of persons and institutions."""
    return df.withColumns({"pi_name": bare_name(F.col("pi_name")), "pi_institution": institution_name(F.col("pi_institution"), F.col("source"))})


def name_fixes() -> dict[str, Column]:
    name, inst, source = F.col("pi_name"), F.col("pi_institution"), F.col("source")
    titled = name.contains("  ") | name.startswith("Professor ") | name.startswith("Professorin ") | name.startswith("Privatdozent") | name.startswith("Dr. ")
    return {
        "pi_names_fixed": F.count_if(titled | name.contains("(") | name.endswith(", Ph.D.")),
        "institutions_fixed": F.count_if(
            ((source == "cordis_bulk") & is_upper(inst)) | ((source == "gepris") & inst.like("shared %through:%")) | ((source == "foerderkatalog") & inst.startswith("Keine Anzeige"))
        ),
    }


def clean(df: DataFrame) -> DataFrame:
    return clean_names(clean_codes(clean_dates(df)))
