"""Grants from landed API pages, whose values are wrapped as {"$": value} and whose funding tree may be one or many."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.functions.columns import iso_date, looked_up, status_by_dates
from grantlake.operators.dedup import keep_first

#: Countries of funders.
FUNDER_COUNTRIES = {
    "DFG": "DE", "BMBF": "DE", "UKRI": "GB", "EPSRC": "GB", "NSF": "US", "DOE": "US", "NIH": "US", "SNSF": "CH", "ANR": "FR", "FWF": "AT", "NWO": "NL", "ARC": "AU", "FCT": "PT", "SFI": "IE",
}

PROJECT = "$.metadata['oaf:entity']['oaf:project']"


def funder_country(code: Column) -> Column:
    return looked_up(code, FUNDER_COUNTRIES)


def api_grants(pages: DataFrame, as_of: str, source: str = "openaire") -> DataFrame:
    """Grants of pages (keyword, page, record as JSON text); records that are no JSON or have no title are left out."""
    # a record without a brace is no object and has no title; a failed parse costs more than one that succeeds
    v = F.when(F.contains(F.col("record"), F.lit("{")), F.try_parse_json("record"))
    at = lambda path: F.try_variant_get("__v", path, "string")
    inside = lambda name: at(f"{PROJECT}['{name}']['$']")
    # columns of their own, so that a record is parsed once and a value read once, however often it is used
    own = {n: inside(n) for n in ("title", "code", "summary", "startdate", "enddate", "fundedamount", "totalcost", "currency")}
    own["funder"] = F.coalesce(at(f"{PROJECT}['fundingtree']['funder']['shortname']['$']"), at(f"{PROJECT}['fundingtree'][0]['funder']['shortname']['$']"), F.lit(""))
    own |= {"name": F.coalesce(at(f"{PROJECT}['collectedfrom']['@name']"), F.lit("")), "object": F.coalesce(at("$.header['dri:objIdentifier']['$']"), F.lit(""))}
    kept = [c for c in ("keyword", "page", "position") if c in pages.columns]
    read = pages.select(*kept, F.explode(F.array(v)).alias("__v")).select(*kept, *(c.alias(f"__{n}") for n, c in own.items()))
    value = lambda name: F.col(f"__{name}")
    read = read.withColumns({"__start": iso_date(value("startdate")), "__end": iso_date(value("enddate")), "__funded": value("fundedamount").try_cast("double"), "__total": value("totalcost").try_cast("double")})
    money = lambda name: F.when(value(name) != 0, value(name))
    start, end, funder, name = value("start"), value("end"), value("funder"), value("name")
    code, object_id = F.coalesce(value("code"), F.lit("")), value("object")
    rows = read.select(
        value("title").alias("project_title"), code.alias("project_id"), F.substring(F.coalesce(value("summary"), F.lit("")), 1, 10_000).alias("abstract"), funder_country(funder).alias("pi_country"),
        start.alias("start_date"), end.alias("end_date"), F.coalesce(money("funded"), money("total")).alias("total_funding"),
        F.coalesce(F.nullif(value("currency"), F.lit("")), F.lit("EUR")).alias("currency"), status_by_dates(start, end, as_of).alias("status"),
        F.when(funder != "", F.array(funder, name)).otherwise(F.array().cast("array<string>")).alias("topic_keywords"), F.lit(source).alias("source"),
        F.when(funder != "", F.concat(F.lit("openaire_"), funder, F.lit("_"), code)).otherwise(F.concat(F.lit("openaire_"), F.substring(object_id, 1, 20))).alias("source_id"),
        *kept,
    )
    return rows.where(F.coalesce(F.col("project_title") != "", F.lit(False)))


def first_by_source_id(grants: DataFrame, order: list[str]) -> DataFrame:
    """The first of the rows of each source_id, by the order in which keywords and pages were asked for."""
    return keep_first(grants, ["source_id"], order).drop(*order)
