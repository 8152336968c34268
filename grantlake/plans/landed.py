"""Queries of the source readers: files are written from the given tables, read back as a source and compared.

What is written is derived by Spark from whole tables, in the form of each source; the SQL says from the tables alone what
must come back.
"""

from __future__ import annotations

import uuid
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.functions import columns as c
from grantlake.operators import dedup, enrich, entity, merge
from grantlake.plans import binding
from grantlake.sources import api_json, archives, bulk_json, calls_json, delimited, html_pages, seeds
from grantlake.sources.landing import land_documents, new_folder

QUERIES, ORACLE = {}, {}
#: Sources that fill gaps do so from these dates on.
AS_OF = binding.AS_OF
NL = "chr(10)"


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def joined(array: str | Column) -> Column:
    return F.array_join(array, "|")


#: Rows of a landed list's file, which one task reads.
LIST_ROWS = 100_000


def land_delimited(df: DataFrame, path: str, order: list[str], columns: list[str], rows: int = LIST_ROWS) -> str:
    """Quoted files of about so many rows, three at least, whose names and lines follow the order."""
    files = max(3, -(-df.count() // rows))
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).select(*columns).write.csv(path, header=True, sep=";", quoteAll=True, escape='"', emptyValue="")
    return path


def land_archives(files: DataFrame, member: str, path: str) -> str:
    """Write one archive of one member for each row (name, text); each appears under its name as a whole."""

    def pack(batches):
        system, at = fs.FileSystem.from_uri(path)
        system.create_dir(at, recursive=True)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                draft = f"{at}/{uuid.uuid4().hex}.part"
                with system.open_output_stream(draft) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(member, text)
                system.move(draft, f"{at}/{name}.zip")
            yield pa.RecordBatch.from_arrays([batch.column(0)], ["name"])

    files.select(F.col("name").cast("string"), "text").mapInArrow(pack, "name string").write.format("noop").mode("overwrite").save()
    return path


# delimited lists (A1 to A4, A8, A20)

PROJECTS = f"""
SELECT o_orderkey AS at, CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE CAST(o_orderkey AS STRING) END AS id, 'ACR' || CAST(o_custkey AS STRING) AS acronym,
  CASE o_orderstatus WHEN 'F' THEN 'CLOSED' WHEN 'O' THEN 'SIGNED' ELSE 'TERMINATED' END AS status,
  CASE WHEN o_orderkey % 11 = 0 THEN 'A "quoted"; title' || {NL} || 'of two lines' ELSE o_orderpriority END AS title,
  CASE WHEN o_orderkey % 13 = 0 THEN 'bad' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS startDate,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS totalCost,
  o_orderpriority || ', ,' || o_orderstatus AS keywords, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'TOPIC' END AS topics
FROM {{orders}}"""
ORGANISATIONS = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(l_orderkey AS STRING) AS projectID, s_name AS name, substr(n_name, 1, 2) AS country,
  CASE WHEN l_linenumber % 2 = 1 THEN 'coordinator' ELSE 'participant' END AS role
FROM {lineitem} JOIN {supplier} ON s_suppkey = l_suppkey JOIN {nation} ON n_nationkey = s_nationkey"""


def _project_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "projects")
    return delimited.read_delimited(spark, land_delimited(binding.view(spark, sf_dir, PROJECTS), path, ["at"], ["id", "acronym", "status", "title", "startDate", "totalCost", "keywords", "topics"]))


@query
def source_projects(spark, sf_dir):
    grants = delimited.project_grants(_project_rows(spark, sf_dir), "horizon")
    path = new_folder(spark, "organisations")
    lines = binding.view(spark, sf_dir, ORGANISATIONS)
    land_delimited(lines, path, ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"], ["projectID", "name", "country", "role"])
    whole = delimited.with_coordinators(grants, delimited.read_delimited(spark, path))
    return whole.select("source_id", "project_title", "acronym", "status", "start_date", F.round("total_funding", 2).alias("total_funding"), joined("topic_keywords").alias("keywords"), "pi_institution", "pi_country")


ORACLE["source_projects"] = f"""WITH p AS ({binding.plain(PROJECTS)}), o AS ({binding.plain(ORGANISATIONS)}),
    last AS (SELECT projectID, arg_max(name, (l_linenumber, l_suppkey, l_partkey)) AS pi_institution, arg_max(country, (l_linenumber, l_suppkey, l_partkey)) AS pi_country FROM o WHERE role = 'coordinator' GROUP BY projectID)
    SELECT 'horizon_' || id AS source_id, title AS project_title, acronym, CASE status WHEN 'SIGNED' THEN 'active' WHEN 'CLOSED' THEN 'completed' ELSE 'terminated' END AS status,
    TRY_CAST(startDate AS DATE) AS start_date, round(TRY_CAST(nullif(totalCost, '') AS DOUBLE), 2) AS total_funding,
    replace(keywords, ', ,', '|') || CASE WHEN topics <> '' THEN '|' || topics ELSE '' END AS keywords, pi_institution, pi_country
    FROM p LEFT JOIN last ON projectID = id WHERE id <> ''"""


@query
def source_archive(spark, sf_dir):
    """The project list again, zipped: one archive for a range of orders."""
    lines = binding.view(spark, sf_dir, PROJECTS).where("id <> ''").withColumn("block", F.floor(F.col("at") / 4000))
    quoted = lambda name: F.concat(F.lit('"'), F.replace(F.col(name), F.lit('"'), F.lit('""')), F.lit('"'))
    names = ["id", "acronym", "status", "title", "startDate"]
    row = F.struct("at", F.array_join(F.array(*map(quoted, names)), ";").alias("line"))
    files = lines.groupBy("block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["line"]), "\n").alias("body"))
    path = land_archives(files.select(F.col("block").alias("name"), F.concat(F.lit(";".join(names) + "\n"), "body").alias("text")), "project.csv", new_folder(spark, "archives"))
    grants = delimited.project_grants(archives.read_archives(spark, path, "project.csv", names), "horizon")
    return grants.select("source_id", "project_title", "acronym", "status", "start_date")


ORACLE["source_archive"] = f"""SELECT 'horizon_' || id AS source_id, title AS project_title, acronym, CASE status WHEN 'SIGNED' THEN 'active' WHEN 'CLOSED' THEN 'completed' ELSE 'terminated' END AS status,
    TRY_CAST(startDate AS DATE) AS start_date FROM ({binding.plain(PROJECTS)}) WHERE id <> ''"""

STAGED = """
SELECT 'oaire_X_' || CAST(o_orderkey AS STRING) AS source_id, o_orderpriority AS project_title, CAST(o_orderkey AS STRING) AS project_id, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'A' END AS acronym,
  'DE' AS pi_country, substr(CAST(o_orderdate AS STRING), 1, 10) AS start_date, CASE WHEN o_orderkey % 5 = 0 THEN 'never' ELSE '' END AS end_date,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS total_funding, 'EUR' AS currency, 'active' AS status, 'X' AS funder_short, '' AS funder_name, '' AS funding_stream, 'X;' || o_orderpriority AS keywords, '' AS abstract
FROM {orders}"""


@query
def source_staged(spark, sf_dir):
    path = new_folder(spark, "staged")
    lines = binding.view(spark, sf_dir, STAGED)
    lines.select(F.array_join(F.array(*lines.columns), "\t").alias("value")).write.text(path)
    rows = delimited.read_staged(spark, path, header=False)
    return rows.select("source_id", "project_title", "acronym", "start_date", "end_date", F.round("total_funding", 2).alias("total_funding"), joined("topic_keywords").alias("keywords"), "abstract")


ORACLE["source_staged"] = f"""SELECT source_id, project_title, nullif(acronym, '') AS acronym, CAST(start_date AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date, round(CAST(total_funding AS DOUBLE), 2) AS total_funding,
    replace(keywords, ';', '|') AS keywords, nullif(abstract, '') AS abstract FROM ({binding.plain(STAGED)})"""

PEOPLE = """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CASE WHEN l_linenumber % 2 = 0 THEN CAST(o_custkey AS STRING) || '.0' ELSE CAST(o_custkey AS STRING) END AS project_id,
  CASE WHEN l_linenumber % 3 = 0 THEN ' ' ELSE 'First' || CAST(l_linenumber AS STRING) END AS first_name, s_name AS last_name
FROM {lineitem} JOIN {orders} ON o_orderkey = l_orderkey JOIN {supplier} ON s_suppkey = l_suppkey"""


@query
def source_investigators(spark, sf_dir):
    """Investigators of a landed list fill the names that one source's grants lack."""
    path = new_folder(spark, "people")
    land_delimited(binding.view(spark, sf_dir, PEOPLE), path, ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"], ["project_id", "first_name", "last_name"])
    people = delimited.investigators(delimited.read_delimited(spark, path))
    return enrich.fill_investigators(binding.grants(spark, sf_dir), people).where("source = 'cordis_bulk'").select("id", "pi_name")


ORACLE["source_investigators"] = f"""WITH raw AS ({binding.plain(binding.GRANTS)}), people AS ({binding.plain(PEOPLE)}),
    last AS (SELECT replace(project_id, '.0', '') AS k, arg_max(trim(trim(first_name) || ' ' || trim(last_name)), (l_orderkey, l_linenumber, l_suppkey, l_partkey)) AS name FROM people GROUP BY 1)
    SELECT id, coalesce(nullif(pi_name, ''), name) AS pi_name FROM raw LEFT JOIN last ON k = project_id WHERE source = 'cordis_bulk'"""

# JSON (A5 to A7, A9 to A11, A19, A21, A24, A25)

CALLS = """
SELECT o_orderkey, o_orderdate, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey * 2 END AS ccm, 'HORIZON-' || CAST(o_orderkey AS STRING) AS identifier,
  CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderpriority END AS title, CASE o_custkey % 5 WHEN 0 THEN 'HORIZON' WHEN 1 THEN 'erc-x' WHEN 2 THEN 'OTHER' WHEN 3 THEN NULL ELSE 'MSCA' END AS programme,
  CASE o_orderkey % 5 WHEN 0 THEN 'Open' WHEN 1 THEN 'Closed' WHEN 2 THEN 'Forthcoming' WHEN 3 THEN 'Under Evaluation' ELSE 'odd' END AS status
FROM {orders}"""


@query
def source_calls(spark, sf_dir):
    rows = binding.view(spark, sf_dir, CALLS)
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    dates = F.when(F.col("o_orderkey") % 23 != 0, F.array((day + 30) * 86_400_000 + 5, day * 86_400_000))
    entry = F.struct(
        "identifier", "title", F.col("ccm").alias("ccm2Id"), dates.alias("deadlineDatesLong"), F.struct(F.col("programme").alias("abbreviation")).alias("frameworkProgramme"),
        F.struct(F.col("status").alias("abbreviation")).alias("status"), F.array(F.lit("a"), F.lit(None).cast("string"), F.lit("b")).alias("tags"), (F.col("o_orderkey") % 2 == 0).alias("sme"),
    )
    files = rows.groupBy(F.floor(F.col("o_orderkey") / 5000).alias("block")).agg(F.to_json(F.struct(F.struct(F.collect_list(entry).alias("GrantTenderObj")).alias("fundingData"))).alias("text"))
    calls = calls_json.in_programmes(calls_json.read_calls(spark, land_documents(files, "block", "text", new_folder(spark, "calls"))))
    return calls.select("call_identifier", "title", "deadline", "status", "source_id", "framework_programme", joined("topic_keywords").alias("keywords"), "sme_eligible")


ORACLE["source_calls"] = f"""SELECT identifier AS call_identifier, coalesce(title, 'Untitled') AS title, CASE WHEN o_orderkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) + 30 END AS deadline,
    CASE status WHEN 'Open' THEN 'open' WHEN 'Forthcoming' THEN 'forthcoming' WHEN 'Under Evaluation' THEN 'under_evaluation' ELSE 'closed' END AS status,
    coalesce(CAST(ccm AS VARCHAR), identifier) AS source_id, programme AS framework_programme, 'a|b' AS keywords, o_orderkey % 2 = 0 AS sme_eligible
    FROM ({binding.plain(CALLS)}) WHERE programme IN ('HORIZON', 'erc-x', 'MSCA')"""

RECORDS = """
SELECT o_orderkey, 'id' || CAST(o_orderkey AS STRING) AS id, CASE o_orderkey % 13 WHEN 0 THEN 'unidentified' WHEN 1 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS code,
  CASE o_orderkey % 17 WHEN 0 THEN 'unidentified' WHEN 1 THEN '' ELSE 'Title' || chr(9) || o_orderpriority END AS title,
  CASE WHEN o_orderkey % 5 = 0 THEN 'soon' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) || 'T00:00' END AS startDate, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS endDate,
  CASE o_custkey % 3 WHEN 0 THEN 'EC' WHEN 1 THEN 'NIH' ELSE NULL END AS funder, CASE o_custkey % 3 WHEN 0 THEN 'EU' ELSE 'US' END AS jurisdiction,
  CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_totalprice END AS funded, o_totalprice AS total, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'USD' END AS currency,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus || ',' || o_orderpriority END AS keywords, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE ' some ' || chr(10) || ' text ' END AS summary
FROM {orders}"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = binding.view(spark, sf_dir, RECORDS)
    fundings = F.when(F.col("funder").isNotNull(), F.array(F.struct(F.col("funder").alias("shortName"), "jurisdiction"))).otherwise(F.array().cast("array<struct<shortName: string, jurisdiction: string>>"))
    granted = F.struct("currency", F.col("total").alias("totalCost"), F.col("funded").cast("double").alias("fundedAmount"))
    record = F.struct("id", "code", "title", "startDate", "endDate", "keywords", "summary", F.array(F.lit("s1"), F.lit("s2")).alias("subjects"), fundings.alias("fundings"), granted.alias("granted"))
    path = new_folder(spark, "records")
    rows.select(F.to_json(record).alias("value")).write.option("compression", "gzip").text(path)
    return bulk_json.read_projects(spark, path)


@query
def source_bulk_projects(spark, sf_dir):
    rows = bulk_json.bulk_grants(_records(spark, sf_dir), AS_OF)
    return rows.select("source_id", "project_title", "project_id", "abstract", "pi_country", "start_date", "end_date", F.round("total_funding", 2).alias("total_funding"), "currency", "status", joined("topic_keywords").alias("keywords"))


ORACLE["source_bulk_projects"] = f"""SELECT CASE WHEN code <> 'unidentified' THEN 'oaire_' || coalesce(funder, '') || '_' || code ELSE 'oaire_' || substr(id, 1, 24) END AS source_id, replace(title, chr(9), ' ') AS project_title,
    coalesce(code, '') AS project_id, CASE WHEN summary IS NOT NULL THEN 'some text' END AS abstract, CASE WHEN funder IS NOT NULL AND jurisdiction <> 'EU' THEN jurisdiction END AS pi_country,
    TRY_CAST(substr(startDate, 1, 10) AS DATE) AS start_date, TRY_CAST(endDate AS DATE) AS end_date, round(CASE WHEN funded > 0 THEN funded WHEN total > 0 THEN total END, 2) AS total_funding,
    CASE WHEN currency = '' THEN 'EUR' ELSE currency END AS currency, CASE WHEN TRY_CAST(endDate AS DATE) >= DATE '{AS_OF}' THEN 'active' ELSE 'completed' END AS status,
    coalesce(funder, '') || CASE WHEN keywords <> '' THEN '|' || keywords ELSE '' END AS keywords FROM ({binding.plain(RECORDS)}) WHERE title NOT IN ('', 'unidentified')"""


@query
def source_abstracts(spark, sf_dir):
    """Abstracts of the records by key, as they fill the grants of the same records that have none."""
    records = _records(spark, sf_dir)
    grants = bulk_json.bulk_grants(records, AS_OF).withColumn("id", F.xxhash64("source_id"))
    filled = enrich.fill_from(grants, bulk_json.abstracts(records).select("source_id", "abstract"), "source_id", ["abstract"])
    return filled.select("source_id", "abstract")


ORACLE["source_abstracts"] = f"""SELECT CASE WHEN code <> 'unidentified' THEN 'oaire_' || coalesce(funder, '') || '_' || code ELSE 'oaire_' || substr(id, 1, 24) END AS source_id,
    CASE WHEN summary IS NOT NULL THEN 'some text' WHEN code <> 'unidentified' THEN CASE WHEN keywords <> '' THEN keywords || ' | ' ELSE '' END || 's1; s2' END AS abstract
    FROM ({binding.plain(RECORDS)}) WHERE title NOT IN ('', 'unidentified')"""


@query
def extraction_counts(spark, sf_dir):
    return bulk_json.extraction_counts(bulk_json.abstracts(_records(spark, sf_dir)))


ORACLE["extraction_counts"] = f"SELECT coalesce(funder, '') AS funder, count(*) AS n FROM ({binding.plain(RECORDS)}) WHERE code <> '' GROUP BY 1"

API = """
SELECT o_orderkey, 'k' || CAST(o_custkey % 7 AS STRING) AS keyword, CAST(o_orderkey % 5 AS INT) AS page, CAST(o_custkey AS STRING) AS code, CASE WHEN o_orderkey % 29 = 0 THEN '' ELSE o_orderpriority || CAST(o_orderkey AS STRING) END AS title,
  CASE o_custkey % 4 WHEN 0 THEN 'DFG' WHEN 1 THEN 'UKRI' WHEN 2 THEN 'ZZZ' ELSE '' END AS funder, substr(CAST(o_orderdate AS STRING), 1, 10) AS startdate, CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_totalprice END AS funded, o_totalprice AS total,
  CASE WHEN o_orderkey % 3 = 0 THEN 'GBP' ELSE '' END AS currency FROM {orders}"""


@query
def source_api_records(spark, sf_dir):
    rows = binding.view(spark, sf_dir, API)
    wrap = lambda x: F.struct(F.col(x).alias("$"))
    project = [wrap(n).alias(n) for n in ("code", "title", "startdate", "currency")] + [wrap("funded").alias("fundedamount"), wrap("total").alias("totalcost"), F.struct(F.lit("from").alias("@name")).alias("collectedfrom")]
    tree = F.struct(F.struct(wrap("funder").alias("shortname")).alias("funder"))
    record = lambda funding: F.to_json(F.struct(F.struct(F.struct(F.col("o_orderkey").cast("string").alias("$")).alias("dri:objIdentifier")).alias("header"), F.struct(F.struct(F.struct(*project, funding.alias("fundingtree")).alias("oaf:project")).alias("oaf:entity")).alias("metadata")))
    path = new_folder(spark, "api")
    text = F.when(F.col("o_orderkey") % 2 == 0, record(tree)).otherwise(record(F.array(tree)))
    rows.select("keyword", "page", "o_orderkey", text.alias("record")).unionByName(rows.select("keyword", "page", "o_orderkey", F.lit("no json").alias("record"))).write.parquet(path)
    landed = spark.read.parquet(path).withColumnRenamed("o_orderkey", "position")
    first = api_json.first_by_source_id(api_json.api_grants(landed, AS_OF), ["keyword", "page", "position"])
    return first.select("source_id", "project_title", "project_id", "pi_country", "start_date", F.round("total_funding", 2).alias("total_funding"), "currency", "status", joined("topic_keywords").alias("keywords"))


ORACLE["source_api_records"] = f"""SELECT source_id, project_title, project_id, pi_country, start_date, round(total_funding, 2) AS total_funding, currency, 'active' AS status, keywords FROM (
    SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY keyword, page, o_orderkey) AS n FROM (SELECT *, CASE WHEN funder <> '' THEN 'openaire_' || funder || '_' || code ELSE 'openaire_' || CAST(o_orderkey AS VARCHAR) END AS source_id,
      title AS project_title, code AS project_id, CASE funder WHEN 'DFG' THEN 'DE' WHEN 'UKRI' THEN 'GB' END AS pi_country, CAST(startdate AS DATE) AS start_date, CASE WHEN funded <> 0 THEN funded ELSE total END AS total_funding,
      CASE WHEN currency = '' THEN 'EUR' ELSE currency END AS currency0, CASE WHEN funder <> '' THEN funder || '|from' ELSE '' END AS keywords FROM ({binding.plain(API)}) WHERE title <> '')) WHERE n = 1""".replace("round(total_funding, 2) AS total_funding, currency, 'active'", "round(total_funding, 2) AS total_funding, currency0 AS currency, 'active'")

CURATED = """
SELECT CASE WHEN o_orderkey % 31 = 0 THEN '' ELSE CAST(o_orderkey AS STRING) END AS id, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderpriority END AS title, substr(CAST(o_orderdate AS STRING), 1, 10) AS deadline,
  CASE o_orderkey % 4 WHEN 0 THEN 'open' WHEN 1 THEN 'closed' WHEN 2 THEN NULL ELSE 'odd' END AS status, o_totalprice AS budget FROM {orders}"""


@query
def source_curated(spark, sf_dir):
    path = new_folder(spark, "curated")
    binding.view(spark, sf_dir, CURATED).write.json(path)
    good, bad = seeds.read_curated(spark, path)
    return good.select("source_id", "title", "deadline", "status", F.lit(None).cast("string").alias("broken")).unionByName(bad.select(F.col("id").alias("source_id"), "title", "deadline", "status", joined("broken_rules").alias("broken")))


ORACLE["source_curated"] = f"""WITH r AS (SELECT *, concat_ws('|', CASE WHEN id = '' THEN 'has_id' END, CASE WHEN title IS NULL THEN 'has_title' END, CASE WHEN status = 'odd' THEN 'known_status' END) AS broken FROM ({binding.plain(CURATED)}))
    SELECT id AS source_id, title, CAST(deadline AS DATE) AS deadline, CASE WHEN broken = '' THEN coalesce(status, 'open') ELSE status END AS status, nullif(broken, '') AS broken FROM r"""


@query
def source_registry(spark, sf_dir):
    """Customers as organisations of a registry, read back, and their names with accents and signs matched to it."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name", "c_mktsegment")
    name = lambda value, *types: F.struct(value.alias("value"), F.array(*map(F.lit, types)).cast("array<string>").alias("types"))
    org = F.struct(
        F.concat(F.lit("org"), F.col("k").cast("string")).alias("id"), F.array(name(F.concat(F.lit("Alias "), "c_name")), name(F.col("c_name"), "ror_display", "label")).alias("names"),
        F.array(F.struct(F.struct(F.substring("c_mktsegment", 1, 2).alias("country_code")).alias("geonames_details"))).alias("locations"),
    )
    files = rows.groupBy(F.floor(F.col("k") / 1000).alias("block")).agg(F.to_json(F.collect_list(org)).alias("text"))
    registry = entity.registry_names(seeds.read_registry(spark, land_documents(files, "block", "text", new_folder(spark, "registry"))))
    asked = rows.select(F.when(F.col("k") % 2 == 0, F.concat(F.lit("ÁLIAS, "), F.upper("c_name"))).otherwise(F.concat(F.lit(" "), "c_name", F.lit("!"))).alias("name"))
    return entity.exact_matches(asked, registry).select("name", "ror_id", "display_name", "country")


ORACLE["source_registry"] = """SELECT CASE WHEN c_custkey % 2 = 0 THEN 'ÁLIAS, ' || upper(c_name) ELSE ' ' || c_name || '!' END AS name, 'org' || CAST(c_custkey AS VARCHAR) AS ror_id, c_name AS display_name,
    substr(c_mktsegment, 1, 2) AS country FROM customer"""


@query
def source_seeds(spark, sf_dir):
    """Funders seeded twice from nations; what is there stays."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"), F.substring("n_name", 1, 9).alias("short_name"))
    regions = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 100).cast("long").alias("id"), F.col("r_name").alias("name"), F.col("r_name").alias("short_name"))
    return seeds.seed(seeds.seed(regions, nations, "short_name"), nations, "short_name").select("id", "name", "short_name")


ORACLE["source_seeds"] = """SELECT CAST(r_regionkey + 100 AS BIGINT) AS id, r_name AS name, r_name AS short_name FROM region
    UNION ALL SELECT CAST(n_nationkey AS BIGINT), n_name, substr(n_name, 1, 9) FROM nation WHERE substr(n_name, 1, 9) NOT IN (SELECT r_name FROM region)"""

# web pages (A12 to A18)

TITLE = "o_orderpriority || ' & ' || CAST(o_orderkey AS STRING)"


#: Pages of a file, and such that hold a block of orders.
PAGE_ROWS, BLOCKS = 10_000, 100


def _pages(rows: DataFrame, kind: str, html: Column, url: Column | None = None, most: int = PAGE_ROWS) -> DataFrame:
    """Landed pages of one kind, an order each or a block of a hundred keys.

    Pages are small when compressed and slow to parse, and tasks are dealt by bytes: so files hold few of them.
    """
    path = new_folder(rows.sparkSession, kind)
    rows.select("page_id", (url if url is not None else F.lit(f"https://x.example/{kind}")).alias("url"), html.alias("html")).write.option("maxRecordsPerFile", most).parquet(path)
    return rows.sparkSession.read.parquet(path)


def _blocks(rows: DataFrame, part: Column) -> DataFrame:
    """(page_id, body): the parts of the orders of a block, in order."""
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", part.alias("part")))), lambda x: x["part"]), "\n")
    return rows.groupBy(F.floor(F.col("o_orderkey") / 400).alias("page_id")).agg(body.alias("body"))


def _escaped(name: str) -> Column:
    return F.replace(F.col(name), F.lit("&"), F.lit("&amp;"))


@query
def source_result_list(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("title", F.expr(TITLE))
    link = F.format_string('<div class="results"><h2><a href="/gepris/projekt/%d?x=1">%s</a></h2></div><div class="results"><h2>no link</h2></div>', "o_orderkey", _escaped("title"))
    pages = _pages(_blocks(orders, link), "list", F.concat(F.lit("<html><body>"), "body"), most=BLOCKS)
    return html_pages.result_links(html_pages.page_parts(pages)).select("id", "title")


ORACLE["source_result_list"] = f"SELECT CAST(o_orderkey AS VARCHAR) AS id, {TITLE} AS title FROM orders"

PROJECT_PAGE = """<html><body><h1 class="facelift">%s</h1><div><span class="name">Applicant:</span><span class="value">%s; since 2020</span></div><div><span class="name">Term</span><span class="value">from %d to %d</span></div>
<div><span class="name">Gesamtförderung</span><span>%s EUR</span></div><div><span class="name">Subject Area</span><span>A; %s</span></div><div><dl><dt>Institution</dt><dd>%s</dd></dl></div>
<div class="content_frame">short</div><div class="content_frame">%s</div><a href="/gepris/person/%d">person</a></body></html>"""


def _project_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey")).withColumn("title", F.expr(TITLE)).withColumn("page_id", F.col("o_orderkey"))
    year = F.year(F.col("o_orderdate").cast("date"))
    whole = F.floor("o_totalprice").cast("long")
    amount = F.concat(F.floor(whole / 1000).cast("string"), F.lit("."), F.lpad((whole % 1000).cast("string"), 3, "0"))
    html = F.format_string(PROJECT_PAGE, _escaped("title"), "c_name", year, year + 3, amount, "o_orderpriority", F.concat(F.lit("Institute "), "c_mktsegment"), F.repeat(F.concat("o_orderpriority", F.lit(" text ")), 8), "o_custkey")
    return _pages(orders, "projects", html, F.format_string("https://x.example/gepris/projekt/%d?l=en", "o_orderkey"))


@query
def source_project_pages(spark, sf_dir):
    rows = html_pages.project_pages(_project_pages(spark, sf_dir), AS_OF)
    return rows.select("project_id", "project_title", "abstract", "pi_name", "pi_institution", "start_date", "end_date", "total_funding", "status", joined("topic_keywords").alias("keywords"))


ORACLE["source_project_pages"] = f"""SELECT CAST(o_orderkey AS VARCHAR) AS project_id, {TITLE} AS project_title, trim(repeat(o_orderpriority || ' text ', 8)) AS abstract, c_name AS pi_name, 'Institute ' || c_mktsegment AS pi_institution,
    make_date(year(o_orderdate), 1, 1) AS start_date, make_date(year(o_orderdate) + 3, 12, 31) AS end_date, floor(o_totalprice) AS total_funding,
    CASE WHEN make_date(year(o_orderdate) + 3, 12, 31) >= DATE '{AS_OF}' THEN 'active' ELSE 'completed' END AS status, 'A|' || o_orderpriority AS keywords FROM orders JOIN customer ON c_custkey = o_custkey"""

TABLE_ROW = "<tr><td>FKZ%d</td><td>M</td><td>I %s</td><td>%s</td><td>%s</td><td>%s</td><td>%s,50 €</td><td>%s</td></tr><tr><td>short row</td></tr>"


@query
def source_catalogue(spark, sf_dir):
    """Rows of result tables with the details of their pages."""
    orders = table(spark, sf_dir, "orders").withColumn("title", F.expr(TITLE))
    start = F.col("o_orderdate").cast("date")
    dates = F.concat(F.date_format(start, "dd.MM.yyyy"), F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.date_format(F.date_add(start, 500), "dd.MM.yyyy")))
    row = F.format_string(TABLE_ROW, "o_orderkey", "o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, F.lit("")).otherwise(F.lit("Executing")), _escaped("title"), dates, F.floor("o_totalprice").cast("string"), F.when(F.col("o_orderkey") % 5 == 0, "J").otherwise("N"))
    html = F.concat(F.lit('<table aria-label="Suchergebnis"><tr><th>h</th></tr>'), "body", F.lit("</table><table><tr><td>FKZ0</td><td>other</td></tr></table>"))
    results = html_pages.result_table(html_pages.page_parts(_pages(_blocks(orders, row), "tables", html, most=BLOCKS)))
    detail = F.format_string("<table><tr><td>Thema:</td><td>The longer title of %s</td></tr><tr><td>Leistungsplansystematik:</td><td>AB : %s</td></tr></table>", _escaped("title"), "o_orderpriority")
    lines = F.format_string("<p>Thema: T</p>\nLeistungsplansystematik: CD\nKurzbeschreibung: Described in lines %d", "o_orderkey")
    pages = _pages(orders.withColumn("page_id", F.col("o_orderkey")), "details", F.when(F.col("o_orderkey") % 2 == 0, detail).otherwise(lines))
    details = html_pages.table_details(pages).select(F.format_string("FKZ%d", "page_id").alias("fkz"), "details")
    grants = html_pages.catalogue_grants(results, details, AS_OF)
    return grants.select("source_id", "project_title", "abstract", "pi_institution", "start_date", "end_date", "total_funding", "status", joined("topic_keywords").alias("keywords"))


ORACLE["source_catalogue"] = f"""SELECT 'foekat_FKZ' || CAST(o_orderkey AS VARCHAR) AS source_id, CASE WHEN o_orderkey % 2 = 0 THEN 'The longer title of ' || {TITLE} ELSE {TITLE} END AS project_title,
    CASE WHEN o_orderkey % 2 = 1 THEN 'Described in lines ' || CAST(o_orderkey AS VARCHAR) END AS abstract, CASE WHEN o_orderkey % 2 = 0 THEN 'I ' || o_orderstatus ELSE 'Executing' END AS pi_institution,
    CAST(o_orderdate AS DATE) AS start_date, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 500 END AS end_date, floor(o_totalprice) + 0.5 AS total_funding,
    CASE WHEN o_orderkey % 3 <> 0 AND CAST(o_orderdate AS DATE) + 500 >= DATE '{AS_OF}' THEN 'active' ELSE 'completed' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN 'AB|' || o_orderpriority ELSE 'CD' END AS keywords FROM orders"""


@query
def source_people(spark, sf_dir):
    """Institutions of projects from the pages of the people that they link to."""
    edges = html_pages.person_edges(_project_pages(spark, sf_dir))
    customers = table(spark, sf_dir, "customer").withColumn("page_id", F.col("c_custkey"))
    linked = F.format_string('<a href="/gepris/institution/1">x</a><a href="/gepris/institution/2">Institute &amp; %s</a>', "c_name")
    labelled = F.format_string('<span class="name">Address:</span><span class="value">Street of %s</span>', "c_name")
    html = F.when(F.col("c_custkey") % 3 == 0, linked).when(F.col("c_custkey") % 3 == 1, labelled).otherwise(F.lit("<p>nothing</p>"))
    people = html_pages.person_institutions(_pages(customers, "people", html, F.format_string("https://x.example/gepris/person/%d", "c_custkey")))
    grants = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("project_id"), F.lit("gepris").alias("source"), F.when(F.col("o_orderkey") % 4 == 0, "Given").alias("pi_institution"))
    return enrich.fill_institutions_from_people(grants, edges, people).select("id", "pi_institution")


ORACLE["source_people"] = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN 'Given' WHEN o_custkey % 3 = 0 THEN 'Institute & ' || c_name WHEN o_custkey % 3 = 1 THEN 'Street of ' || c_name END AS pi_institution
    FROM orders JOIN customer ON c_custkey = o_custkey"""


@query
def detail_abstracts(spark, sf_dir):
    """Abstracts of one source from detail pages, of the first entry that is given."""
    orders = table(spark, sf_dir, "orders").withColumn("page_id", F.col("o_orderkey"))
    entry = F.when(F.col("o_orderkey") % 3 == 0, "Projektbeschreibung").when(F.col("o_orderkey") % 3 == 1, "Kurzbeschreibung").otherwise("Anderes")
    pages = _pages(orders, "abstracts", F.format_string("<table><tr><td>%s:</td><td>Description of %s number %d</td></tr></table>", entry, "o_orderpriority", "o_orderkey"))
    details = html_pages.table_details(pages).select(F.col("page_id").cast("string").alias("project_id"), "details")
    grants = orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderkey").cast("string").alias("project_id"), F.when(F.col("o_orderkey") % 2 == 0, "foerderkatalog").otherwise("gepris").alias("source"), F.lit("").alias("abstract"))
    return enrich.fill_abstracts(grants, details, "foerderkatalog").select("id", "abstract")


ORACLE["detail_abstracts"] = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 IN (0, 1) THEN 'Description of ' || o_orderpriority || ' number ' || CAST(o_orderkey AS VARCHAR) ELSE '' END AS abstract FROM orders"""

# tables and columns (B3, B7, B8; F11 to F27)


@query
def load_status(spark, sf_dir):
    """Load status by source after a batch of loads of which some failed."""
    sources = binding.grants(spark, sf_dir).groupBy(F.col("source").alias("id")).agg(F.count("*").alias("n"), F.min("start_date").cast("timestamp").alias("first"), F.max("start_date").cast("timestamp").alias("last"))
    old = sources.where("id <> 'gepris'").select("id", F.col("id").alias("name"), F.col("first").alias("last_fetch"), F.col("first").alias("last_success"), F.lit(1).cast("long").alias("records_count"), F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error_message"))
    failed = F.col("id").startswith("openaire")
    new = sources.where("id <> 'foerderkatalog'").select("id", F.col("id").alias("name"), F.col("last").alias("last_fetch"), F.col("last").alias("last_success"), F.col("n").alias("records_count"), F.when(failed, "error").otherwise("ok").alias("status"), F.when(failed, "no answer").alias("error_message"))
    out = merge.update_load_status(old, new)
    return out.select("id", F.col("last_fetch").cast("date").alias("last_fetch"), F.col("last_success").cast("date").alias("last_success"), "records_count", "status", "error_message")


ORACLE["load_status"] = f"""SELECT source AS id, CASE WHEN source = 'foerderkatalog' THEN min(start_date) ELSE max(start_date) END AS last_fetch, CASE WHEN source IN ('cordis_bulk', 'gepris') THEN max(start_date) ELSE min(start_date) END AS last_success,
    CASE WHEN source = 'foerderkatalog' THEN 1 ELSE count(*) END AS records_count, CASE WHEN starts_with(source, 'openaire') THEN 'error' ELSE 'ok' END AS status, CASE WHEN starts_with(source, 'openaire') THEN 'no answer' END AS error_message
    FROM ({binding.plain(binding.GRANTS)}) GROUP BY source"""


@query
def appended_ids(spark, sf_dir):
    """Customers appended to suppliers with ids that go on after the largest."""
    target = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return merge.append_with_ids(target, table(spark, sf_dir, "customer").select(F.col("c_name").alias("name")), ["name"])


ORACLE["appended_ids"] = """SELECT s_suppkey AS id, s_name AS name FROM supplier
    UNION ALL SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY c_name), c_name FROM customer"""


@query
def replaced_sources(spark, sf_dir):
    """A table by source of which two sources are replaced by a later load."""
    rows = binding.grants(spark, sf_dir).select("id", "source", "status")
    path = new_folder(spark, "by-source")
    merge.replace_source(rows, path)
    merge.replace_source(rows.where("source IN ('gepris', 'openaire')").withColumn("status", F.concat(F.lit("new "), "status")), path)
    return spark.read.parquet(path).select("id", "source", "status")


ORACLE["replaced_sources"] = f"SELECT id, source, CASE WHEN source IN ('gepris', 'openaire') THEN 'new ' || status ELSE status END AS status FROM ({binding.plain(binding.GRANTS)})"


@query
def parsed_columns(spark, sf_dir):
    """Texts of amounts, dates, counts and shares, written from orders and read by the column functions."""
    o = table(spark, sf_dir, "orders")
    day, whole = F.col("o_orderdate").cast("date"), F.floor("o_totalprice").cast("long")
    dotted = F.concat(F.floor(whole / 1000).cast("string"), F.lit("."), F.lpad((whole % 1000).cast("string"), 3, "0"), F.lit(",25 €"))
    pages = (F.col("o_orderkey") % 9).cast("string")
    text = {
        "iso": F.when(F.col("o_orderkey") % 5 == 0, "2020-13-45").otherwise(F.concat(day.cast("string"), F.lit("T10:00"))), "german": F.concat(F.date_format(day, "dd.MM.yyyy"), F.lit(" bis")), "amount": dotted,
        "ms": F.datediff(day, F.lit("1970-01-01").cast("date")).cast("long") * 86_400_000 + 7, "number": F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.concat(F.lit(" "), whole.cast("string"), F.lit(".5 "))),
        "spaces": F.concat(F.lit("  a \n "), "o_orderpriority", F.lit("\tz ")), "hits": F.concat(F.lit("<b>("), pages, F.lit("&nbsp;Treffer)</b>")), "list": F.concat(F.lit("index=0 index="), pages, F.lit("0 hitsPerPage=20")),
    }
    path = new_folder(spark, "texts")
    o.select("o_orderkey", "o_custkey", *(v.alias(k) for k, v in text.items())).write.parquet(path)
    t = spark.read.parquet(path)
    return t.select(
        "o_orderkey", c.iso_date(F.col("iso")).alias("iso"), c.german_date(F.col("german")).alias("german"), c.german_amount(F.col("amount")).alias("amount"), c.epoch_ms_date(F.col("ms")).alias("ms"),
        c.decimal(F.col("number")).cast("double").alias("number"), c.squashed(F.col("spaces"), 8).alias("spaces"), c.bracketed_count(F.col("hits")).alias("hits"), c.listing_total(F.col("list")).alias("entries"),
        c.percent(F.col("o_orderkey") % 4, F.col("o_custkey") % 3).alias("share"), c.snippet(F.col("spaces"), 6).alias("head"), joined(c.keywords(F.col("number"), r"\.")).alias("parts"),
        c.status_by_dates(c.iso_date(F.col("iso")), c.german_date(F.col("german")), AS_OF).alias("status"),
    )


ORACLE["parsed_columns"] = f"""SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS iso, CAST(o_orderdate AS DATE) AS german, floor(o_totalprice) + 0.25 AS amount, CAST(o_orderdate AS DATE) AS ms,
    CASE WHEN o_orderkey % 3 <> 0 THEN floor(o_totalprice) + 0.5 END AS number, substr('a ' || o_orderpriority || ' z', 1, 8) AS spaces, CAST(o_orderkey % 9 AS INTEGER) AS hits, CAST((o_orderkey % 9) * 10 + 20 AS INTEGER) AS entries,
    CASE WHEN o_custkey % 3 = 0 THEN 'n/a' ELSE format('{{:.1f}}%', 100.0 * (o_orderkey % 4) / (o_custkey % 3)) END AS share, substr('  a ' || chr(10) || ' ' || o_orderpriority, 1, 6) || '...' AS head,
    CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '|5' ELSE '' END AS parts, CASE WHEN CAST(o_orderdate AS DATE) >= DATE '{AS_OF}' THEN 'active' ELSE 'completed' END AS status FROM orders"""
