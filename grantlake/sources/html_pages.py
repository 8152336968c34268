"""Records from landed web pages (page_id, url, html).

Tasks turn each page into a flat table of its parts (``page_parts``) with the standard parser; everything after that,
which part is what and how its text is read, is columns.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.functions.columns import filled, german_amount, german_date, status_by_dates

#: Keys of project pages, and of detail and person pages, in the order in which they are asked.
APPLICANT = ["Applicant", "Spokesperson", "Spokespersons", "Antragsteller", "Sprecher"]
TERM = ["Term", "Förderung"]
AMOUNT = ["Gesamtförderung", "Overall Funding", "Funding", "DFG Programme"]
AREA = ["Subject Area", "Fachgebiet"]
INSTITUTION = [
    "Applicant Institution", "Institution", "Einrichtung", "Antragstellende Institution", "Co-Applicant Institution", "Host", "Participating Institution", "Participating University", "Partner Organisation",
]
THEME = ["Thema des geförderten Vorhabens", "Thema"]
PLAN = "Leistungsplansystematik"
DESCRIPTION = ["Kurzbeschreibung", "Projektbeschreibung"]
ADDRESS = ["Institution", "Address", "Einrichtung", "Adresse"]

PARSED = "page_id long, url string, parts array<struct<at: int, kind: string, key: string, value: string, path: string>>"
#: Plain tags and texts, which most pages consist of, and elements whose content isn't read as tags.
TOKEN = r'<([a-zA-Z][a-zA-Z0-9]*)((?:[ \n\t]+[a-zA-Z][a-zA-Z-]*="[^"<>&]*")*)>|</([a-zA-Z][a-zA-Z0-9]*)>|([^<]+)'
TOKENS, PLAIN, ATTRIBUTE = re.compile(TOKEN), re.compile(f"(?:{re.sub('[(](?![?])', '(?:', TOKEN)})*+"), re.compile(r'([a-zA-Z-]+)="([^"]*)"')
OPAQUE = re.compile("<(?:script|style|textarea|title|xmp|iframe|noembed|noframes|noscript|plaintext|svg|math)", re.IGNORECASE)
#: Parts of a batch that is sent on.
PARTS = 20_000
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class Parts(HTMLParser):
    """Links, pairs, cells, headings and text blocks of one page as (kind, key, value, path)."""

    BLOCKS = frozenset("content_frame abstract description".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, str, str, str]] = []
        self.open: list[tuple[str, dict, int]] = []  # with the place in ``texts`` where the element begins
        self.texts: list[str] = []
        self.standing: Counter[str] = Counter()  # open elements by tag
        self.label: tuple[str, int] | None = None  # key and depth of a pair whose value comes next
        self.row: list[str] | None = None
        self.table, self.rows, self.skip = "", 0, 0

    def read(self, html: str) -> list[tuple[str, str, str, str]]:
        """The parts of a page.  Plain pages need no more than their tags and texts in order; others go through the standard parser."""
        if html.endswith(">") and PLAIN.fullmatch(html) and not OPAQUE.search(html):
            for start, attributes, end, text in TOKENS.findall(html):
                if text:
                    self.handle_data(unescape(text) if "&" in text else text)
                elif start:
                    self.handle_starttag(start.lower(), [(k.lower(), v) for k, v in ATTRIBUTE.findall(attributes)] if attributes else [])
                else:
                    self.handle_endtag(end.lower())
        else:
            self.feed(html)
        return self.finish()

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            return
        if tag in ("td", "th", "tr", "li", "p", "dt", "dd") and self.open and self.open[-1][0] == tag:
            self.handle_endtag(tag)
        attributes = {k: v or "" for k, v in attrs}
        if tag == "table":
            self.table, self.rows = attributes.get("aria-label", ""), 0
        if tag == "tr":
            self.row = []
        self.open.append((tag, attributes, len(self.texts)))
        self.standing[tag] += 1

    def handle_data(self, data: str) -> None:
        if not self.standing["script"] and not self.standing["style"] and data.strip():
            self.texts.append(data.strip())

    def handle_endtag(self, tag: str) -> None:
        while self.standing[tag]:
            if self._close() == tag:
                break

    def _close(self) -> str:
        tag, attributes, start = self.open.pop()
        self.standing[tag] -= 1
        classes = attributes.get("class", "").split()
        told = tag in ("a", "h1", "h2", "h3", "title", "td", "dt", "tr") or tag == "span" and "name" in classes or self.BLOCKS & set(classes) or attributes.get("id") == "projektbeschreibung"
        if told or self.label and len(self.open) == self.label[1]:  # text and path of other elements aren't needed
            path = " ".join(f"{t}.{a.get('class', '')}#{a.get('id', '')}" for t, a, _ in self.open)
            self._closed(tag, attributes, classes, "".join(self.texts[start:]), path)
        return tag

    def _closed(self, tag: str, attributes: dict, classes: list[str], bare: str, path: str) -> None:
        depth = len(self.open)
        if self.label and depth == self.label[1] and tag != "dt" and "name" not in classes:
            self.out.append(("pair", self.label[0], bare, path))
            self.label = None
        if tag == "span" and "name" in classes or tag == "dt":
            self.label = (bare.rstrip(":"), depth)
        if tag == "a":
            self.out.append(("link", attributes.get("href", ""), bare, path))
        if tag in ("h1", "h2", "h3", "title"):
            self.out.append((tag, " ".join(classes), bare, path))
        if self.BLOCKS & set(classes) or attributes.get("id") == "projektbeschreibung":
            self.out.append(("block", " ".join(classes), bare, path))
        if tag in ("td",) and self.row is not None:
            self.row.append(bare)
        if tag == "tr" and self.row is not None:
            for i, cell in enumerate(self.row):
                self.out.append(("cell", f"{self.rows}:{i}", cell, self.table))
            self.row, self.rows = None, self.rows + 1

    def finish(self) -> list[tuple[str, str, str, str]]:
        while self.open:
            self._close()
        return self.out


def parsed_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, parts): the parts (at, kind, key, value, path) of every page, in page order.  A null page has none.

    Pages are taken out of a batch one by one and parts are sent on by thousands, so memory doesn't grow with the batch.
    """
    fields = [("at", pa.int32()), *((n, pa.string()) for n in ("kind", "key", "value", "path"))]

    def sent(heads: list[list], ends: list[int], out: list[list]) -> pa.RecordBatch:
        parts = pa.StructArray.from_arrays([pa.array(c, t) for c, (_, t) in zip(out, fields)], [n for n, _ in fields])
        return pa.RecordBatch.from_arrays([pa.array(heads[0], pa.int64()), pa.array(heads[1], pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)], ["page_id", "url", "parts"])

    def split(batches):
        for batch in batches:
            heads, ends, out = [[], []], [0], [[] for _ in fields]
            for page_id, url, html in zip(*batch.columns):
                heads[0].append(page_id.as_py()), heads[1].append(url.as_py())
                for at, part in enumerate(Parts().read(html.as_py() or "")):
                    for column, v in zip(out, (at, *part)):
                        column.append(v)
                ends.append(len(out[0]))
                if ends[-1] >= PARTS:
                    yield sent(heads, ends, out)
                    heads, ends, out = [[], []], [0], [[] for _ in fields]
            yield sent(heads, ends, out)

    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    return pages.select(F.col("page_id").cast("long"), url, F.col("html").cast("string")).mapInArrow(split, PARSED)


def page_parts(pages: DataFrame) -> DataFrame:
    """(page_id, at, kind, key, value, path) of the parts of every page, in page order."""
    return parsed_pages(pages).select("page_id", F.inline("parts"))


def result_links(parts: DataFrame) -> DataFrame:
    """(page_id, id, title) of the entries of a result list; entries without a link aren't there."""
    rows = parts.where("kind = 'link' AND path LIKE '%div.results#%' AND path LIKE '%h2.%'").withColumn("id", F.regexp_extract("key", r"/gepris/projekt/(\d+)", 1))
    return rows.where("id <> ''").select("page_id", "at", "id", F.col("value").alias("title"))


def details(parts: DataFrame) -> DataFrame:
    """(page_id, details map): the pairs of each page; the first of equal keys counts."""
    rows = parts.where("kind = 'pair' AND key <> ''").groupBy("page_id", "key").agg(F.min_by("value", "at").alias("value"))
    return rows.groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("details"))


def project_pages(pages: DataFrame, as_of: str, source: str = "gepris") -> DataFrame:
    """Grants of project pages; the project's number is in the address."""
    first = lambda test: F.get(F.filter("parts", test), F.lit(0))["value"]
    pairs = F.filter("parts", lambda x: (x["kind"] == "pair") & (x["key"] != ""))
    keys = F.array_distinct(F.transform("pairs", lambda x: x["key"]))
    # a page's parts are in one row, so nothing is grouped or joined; of equal keys the first counts
    df = parsed_pages(pages).select(
        F.regexp_extract("url", r"/gepris/projekt/(\d+)", 1).alias("project_id"),
        first(lambda x: (x["kind"] == "h1") & F.array_contains(F.split(x["key"], " "), "facelift")).alias("first"),
        first(lambda x: (x["kind"] == "h1") & x["path"].contains("#detailseite") & ~F.array_contains(F.split(x["key"], " "), "hidden")).alias("second"),
        first(lambda x: (x["kind"] == "h3") & x["path"].contains("detail_head")).alias("third"),
        first(lambda x: (x["kind"] == "block") & (F.length(x["value"]) > 50)).alias("abstract"), pairs.alias("pairs"),
    )
    df = df.withColumn("details", F.map_from_arrays(keys, F.transform(keys, lambda k: F.get(F.filter("pairs", lambda x: x["key"] == k), F.lit(0))["value"])))
    d = lambda *keys: F.coalesce(*(filled(F.col("details")[k]) for k in keys))
    amounts = [german_amount(F.nullif(F.regexp_extract(F.col("details")[k], r"([\d.,]+)\s*(?:EUR|€)", 1), F.lit(""))) for k in AMOUNT]
    name = d(*APPLICANT)
    for mark in (";", ", since ", ", until "):
        name = F.trim(F.split_part(name, F.lit(mark), F.lit(1)))
    term = d(*TERM)
    years = [F.nullif(F.regexp_extract(term, r"(\d{4})\s*(?:to|-)\s*(\d{4})", i), F.lit("")).cast("int") for i in (1, 2)]
    start, end = F.make_date(years[0], F.lit(1), F.lit(1)), F.make_date(years[1], F.lit(12), F.lit(31))
    areas = F.filter(F.transform(F.split(F.coalesce(d(*AREA), F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    institution = d(*INSTITUTION)
    return df.select(
        F.coalesce(filled(F.col("first")), filled(F.col("second")), filled(F.col("third")), F.concat(F.lit("GEPRIS Project "), "project_id")).alias("project_title"), "project_id", "abstract",
        name.alias("pi_name"), institution.alias("pi_institution"), F.lit("DE").alias("pi_country"), start.alias("start_date"), end.alias("end_date"), F.coalesce(*amounts).alias("total_funding"),
        status_by_dates(start, end, as_of, open_counts=False).alias("status"), areas.alias("topic_keywords"), F.lit(source).alias("source"), F.concat(F.lit("gepris_"), "project_id").alias("source_id"),
    )


def result_table(parts: DataFrame, label: str = "Suchergebnis") -> DataFrame:
    """Rows of the labelled result table: number, ministry, institutions, title, dates, amount, flag.  The header row and short rows go."""
    cells = parts.where((F.col("kind") == "cell") & (F.col("path") == label)).withColumn("row", F.split_part("key", F.lit(":"), F.lit(1)).cast("int"))
    rows = cells.groupBy("page_id", "row").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("c"))
    rows = rows.where((F.col("row") > 0) & (F.size("c") >= 7) & (F.col("c")[0] != ""))
    dates = F.col("c")[5]
    return rows.select(
        "page_id", F.col("c")[0].alias("fkz"), F.col("c")[1].alias("ministry"), F.col("c")[2].alias("institution"), F.col("c")[3].alias("executing_institution"), F.col("c")[4].alias("title"),
        F.when(F.length(dates) >= 10, german_date(F.substring(dates, 1, 10))).alias("start_date"), F.when(F.length(dates) >= 20, german_date(F.substring(dates, 11, 1000))).alias("end_date"),
        german_amount(F.col("c")[6]).alias("total_funding"), F.coalesce(F.get("c", F.lit(7)) == "J", F.lit(False)).alias("is_verbund"),
    )


def table_details(pages: DataFrame) -> DataFrame:
    """(page_id, details map) of pages with two-column tables; pages without any are read as 'key: value' lines."""
    parts = page_parts(pages)
    cells = parts.where("kind = 'cell'").select("page_id", F.split("key", ":").alias("k"), "value", "path", "at")
    pair = cells.groupBy("page_id", "path", F.col("k")[0].alias("row"), (F.col("at") - F.col("k")[1].cast("int")).alias("start"))
    pair = pair.agg(F.min_by("value", "at").alias("key"), F.max(F.when(F.col("k")[1] == "1", F.col("value"))).alias("value"), F.min("at").alias("at"))
    pair = pair.select("page_id", F.regexp_replace("key", ":+$", "").alias("key"), "value", "at")
    lines = pages.select("page_id", F.posexplode(F.split(F.regexp_replace("html", r"(?s)<[^>]*>", ""), "\n")).alias("at", "line")).withColumn("line", F.trim("line"))
    lines = lines.where((F.instr("line", ":") > 0) & (F.length("line") < 200))
    lines = lines.select("page_id", F.trim(F.split_part("line", F.lit(":"), F.lit(1))).alias("key"), F.trim(F.regexp_replace("line", "^[^:]*:", "")).alias("value"), "at")
    given = pair.where("key <> '' AND value <> ''")
    rest = lines.where("key <> '' AND value <> ''").join(given.select("page_id").distinct(), "page_id", "left_anti")
    last = given.unionByName(rest).groupBy("page_id", "key").agg(F.max_by("value", "at").alias("value"))
    return last.groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("details"))


def catalogue_grants(results: DataFrame, detail: DataFrame, as_of: str, source: str = "foerderkatalog") -> DataFrame:
    """Grants of result rows with their detail pages (fkz, details) where there are any: the longer title counts."""
    df = results.join(detail, "fkz", "left")
    full = F.coalesce(*(F.col("details")[k] for k in THEME))
    title = F.when(F.length(full) > F.length("title"), full).otherwise(F.col("title"))
    plan = F.filter(F.transform(F.split(F.coalesce(F.col("details")[PLAN], F.lit("")), ":"), lambda x: F.trim(x)), lambda x: x != "")
    return df.select(
        title.alias("project_title"), F.col("fkz").alias("project_id"), F.coalesce(*(F.col("details")[k] for k in DESCRIPTION)).alias("abstract"),
        F.coalesce(filled(F.col("executing_institution")), F.col("institution")).alias("pi_institution"), F.lit("DE").alias("pi_country"), "start_date", "end_date", "total_funding", F.lit("EUR").alias("currency"),
        status_by_dates(F.col("start_date"), F.col("end_date"), as_of, open_counts=False).alias("status"), plan.alias("topic_keywords"), F.lit(source).alias("source"), F.concat(F.lit("foekat_"), "fkz").alias("source_id"),
    )


def person_edges(pages: DataFrame) -> DataFrame:
    """(person_id, project_id) of the people that project pages link to."""
    rows = pages.select(F.regexp_extract("url", r"/gepris/projekt/(\d+)", 1).alias("project_id"), F.explode(F.regexp_extract_all("html", F.lit(r'href="/gepris/person/(\d+)"'), 1)).alias("person_id"))
    return rows.where("project_id <> ''").select("person_id", "project_id").distinct()


def person_institutions(pages: DataFrame) -> DataFrame:
    """(person_id, institution) of person pages: the first long link to an institution, else a labelled value."""
    parts = page_parts(pages)
    linked = (F.col("kind") == "link") & F.col("key").contains("/gepris/institution/") & (F.length("value") > 3)
    labelled = (F.col("kind") == "pair") & F.col("key").isin(*ADDRESS) & (F.length("value") > 3)
    found = parts.groupBy("page_id").agg(F.min_by("value", F.when(linked, F.col("at"))).alias("a"), F.min_by("value", F.when(labelled, F.col("at"))).alias("b"))
    ids = pages.select("page_id", F.regexp_extract("url", r"/gepris/person/(\d+)", 1).alias("person_id"))
    return ids.join(found, "page_id").select("person_id", F.coalesce("a", "b").alias("institution")).where("institution IS NOT NULL")


def page_summary(pages: DataFrame) -> DataFrame:
    """(page_id, title, heading, n_links, block): title, first heading, links and first long paragraph, by expressions alone."""
    inner = lambda tag: F.regexp_extract("html", rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1)
    blocks = F.filter(F.regexp_extract_all("html", F.lit(r"(?s)<p>([^<]*)</p>"), 1), lambda x: F.length(x) > 50)
    return pages.select("page_id", inner("title").alias("title"), inner("h1").alias("heading"), F.size(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), 1)).alias("n_links"), F.get(blocks, F.lit(0)).alias("block"))
