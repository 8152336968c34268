"""Column functions for dates, amounts, names, codes and text conditions.  All of them run inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Codes that stand for an ISO code.
COUNTRY_CODES = {"UK": "GB", "EL": "GR"}
CURRENCY_CODES = {"$": "AUD"}

#: Titles before a name, in the order in which they are taken off.
NAME_TITLES = [
    "Professorin Dr. ",
    "Professor Dr. ",
    "Privatdozentin Dr. ",
    "Privatdozent Dr. ",
    "Professorin ",
    "Professor ",
    "Privatdozentin ",
    "Privatdozent ",
    "Dr. ",
]

#: The pattern that finds a programme in a project description, and the one for what stands behind its kind.
PROGRAMME = (
    r"DFG Programme\s*(.+?)(?:Subject Area|Subproject of|Participating|Term |International Connection|Applicant|"
    r"Spokesperson|Major|Project Identifier|Co-Applicant|Further|Instrumentation Group)"
)
PROGRAMME_KIND = r"(Grants|Programmes|Centres|Units|Groups|Schools|Fellowships).*"


def filled(c: Column) -> Column:
    """The value, or null if it is blank."""
    return F.when(F.trim(c) != "", c)


def mapped(c: Column, codes: dict[str, str]) -> Column:
    """The value with some codes replaced."""
    if not codes:
        return c
    table = F.create_map(*(F.lit(x) for pair in codes.items() for x in pair))
    return F.coalesce(table[c], c)


def looked_up(c: Column, codes: dict[str, str]) -> Column:
    """What a code stands for; null for others."""
    return F.create_map(*(F.lit(x) for pair in codes.items() for x in pair))[c]


def iso_date(c: Column) -> Column:
    """Date of the first ten characters; null if they are none."""
    head = F.substring(c, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(head, "yyyy-MM-dd"))


def german_date(c: Column) -> Column:
    """Date of a text that begins with DD.MM.YYYY."""
    head = F.regexp_extract(F.trim(c), r"^\d{2}\.\d{2}\.\d{4}", 0)
    return F.when(head != "", F.try_to_date(head, "dd.MM.yyyy"))


def german_amount(c: Column) -> Column:
    """Number of a text such as '1.250.000,00 €'."""
    bare = F.regexp_replace(F.regexp_replace(c, r"\s*[€$]\s*", ""), r"(?i)\s*(EUR|Euro)\s*", "")
    return F.trim(F.replace(F.replace(bare, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).try_cast("double")


def epoch_ms_date(c: Column) -> Column:
    """UTC date of milliseconds since 1970, in any session time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(c / F.lit(86_400_000)).cast("int"))


def decimal(c: Column) -> Column:
    """Decimal number of a text; null if it is blank or none."""
    return F.nullif(F.trim(c), F.lit("")).try_cast("decimal(18,2)")


def squashed(c: Column, length: int) -> Column:
    """White space collapsed, cut to a length."""
    return F.substring(F.trim(F.regexp_replace(c, r"\s+", " ")), 1, length)


def any_ilike(columns: Iterable[Column], patterns: Iterable[str]) -> Column:
    """Whether a column is like a pattern, without regard to case; null columns are like none."""
    tests = [F.coalesce(c.ilike(p), F.lit(False)) for c in columns for p in patterns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def month_borders(a: Column, b: Column) -> Column:
    """How many month borders lie between two dates."""
    return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a))


def status_by_dates(start: Column, end: Column, as_of: str, open_from: int | None = None, open_counts: bool = True) -> Column:
    """'active' while the end isn't over.  Without an end: if it started, in ``open_from`` or later where that is given."""
    today = F.lit(as_of).cast("date")
    begun = F.lit(False) if not open_counts else start.isNotNull() if open_from is None else F.year(start) >= open_from
    return F.when(F.coalesce(F.when(end.isNotNull(), end >= today).otherwise(begun), F.lit(False)), "active").otherwise("completed")


def bare_name(c: Column) -> Column:
    """A person's name without titles, degree, mark of death and double spaces.

    Every step names its input once: conditions on it would double the expression with each step.
    """
    for title in NAME_TITLES:  # one name may lose several, in this order
        c = F.regexp_replace(c, "^" + title.replace(".", r"\."), "")
    c = F.regexp_replace(F.regexp_replace(c, r", Ph\.D\.$", ""), r"\s*\([†+]\)\s*$", "")
    return F.trim(F.regexp_replace(c, r"\s\s+", " "))


def title_case(c: Column) -> Column:
    """Words of a text in lower case with a capital first letter."""
    return F.array_join(F.transform(F.split(F.lower(c), " "), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 10_000))), " ")


def is_upper(c: Column) -> Column:
    return (c == F.upper(c)) & (F.length(c) > 1)


def institution_name(c: Column, source: Column) -> Column:
    """An institution's name as its source needs it: capitals, lead-in, privacy notice and spaces."""
    return F.trim(
        F.when((source == "cordis_bulk") & is_upper(c), title_case(c))
        .when((source == "gepris") & c.like("shared %through:%"), F.regexp_replace(c, r"(?s)^[^:]*:", ""))
        .when((source == "foerderkatalog") & c.startswith("Keine Anzeige"), F.lit(None))
        .otherwise(c)
    )


#: How listings state their number of entries.
PAGE_INDEX, PAGE_SIZE, STATED = r"index=(\d+)", r"hitsPerPage=(\d+)", r"([\d,.\s]+)\s*(?:results|Treffer|Projects)"


def programme_type(c: Column) -> Column:
    """The programme that a project description names, or null."""
    return F.nullif(F.regexp_replace(F.trim(F.regexp_extract(c, PROGRAMME, 1)), PROGRAMME_KIND, "$1"), F.lit(""))


def keywords(c: Column, by: str) -> Column:
    """Trimmed parts of a text that aren't blank; none of a null text."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), by), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def percent(n: Column, total: Column) -> Column:
    """Share as text with one digit, 'n/a' of nothing."""
    return F.when(total == 0, "n/a").otherwise(F.format_string("%.1f%%", F.lit(100.0) * n / F.nullif(total, F.lit(0))))


def snippet(c: Column, length: int) -> Column:
    """The beginning of a text, with dots if it goes on."""
    return F.when(F.length(c) > length, F.concat(F.substring(c, 1, length), F.lit("..."))).otherwise(c)


def bracketed_count(html: Column) -> Column:
    """n of '(n Treffer)', 0 if there is none."""
    plain = F.regexp_replace(html, " |&nbsp;", " ")
    return F.coalesce(F.regexp_extract(plain, r"\((\d+)\s*Treffer\)", 1).try_cast("int"), F.lit(0))


def listing_total(html: Column) -> Column:
    """Entries of a listing: last page's index plus page size, else a stated number, else 0."""
    last = F.array_max(F.transform(F.regexp_extract_all(html, F.lit(PAGE_INDEX), 1), lambda x: x.cast("int")))
    size = F.coalesce(F.regexp_extract(html, PAGE_SIZE, 1).try_cast("int"), F.lit(50))
    stated = F.regexp_replace(F.regexp_extract(html, STATED, 1), r"[,. ]", "").try_cast("int")
    return F.coalesce(last + size, stated, F.lit(0))
