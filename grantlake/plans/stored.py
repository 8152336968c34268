"""Queries over tables that loads change: upserts by key, sources loaded anew, a stream and its load status.

The loads are derived by Spark from whole tables; the SQL says from the tables alone what the stored table must hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake import schemas
from grantlake.operators import parted, refresh
from grantlake.plans import binding
from grantlake.sources.landing import new_folder
from grantlake.streaming import ingest

QUERIES, ORACLE = {}, {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loaded(spark: SparkSession, name: str, schema, keys: list[str], updates: list[str], *loads: DataFrame) -> DataFrame:
    """The table after some loads, each one a commit."""
    path = new_folder(spark, name)
    for batch in loads:
        parted.upsert(batch, path, schema, keys, updates)
    return parted.read_table(spark, path, schema)


# upserts (B2, B4 to B6)


@query
def upserted_calls(spark, sf_dir):
    """Two thirds of the calls, then every second call with other values; a load changes a call's few columns alone."""
    calls = binding.calls(spark, sf_dir).withColumn("source_id", F.col("id").cast("string")).drop("id")
    later = {"title": F.concat(F.lit("New "), "call_identifier"), "deadline": F.date_add("deadline", 1), "status": F.lit("closed"), "budget_total": F.col("budget_total") * 2, "url": F.lit("https://new"), "currency": F.lit("USD")}
    number = F.col("source_id").cast("long")
    rows = loaded(spark, "calls", schemas.CALL, schemas.CALL_KEY, schemas.CALL_UPDATES, calls.where(number % 3 != 0), calls.where(number % 2 == 0).withColumns(later))
    return rows.select("source_id", F.md5("title").alias("title"), "deadline", "status", F.round("budget_total", 2).alias("budget_total"), "url", "currency", F.array_join("topic_keywords", "|").alias("keywords"))


ORACLE["upserted_calls"] = f"""SELECT CAST(id AS VARCHAR) AS source_id, md5(CASE WHEN id % 2 = 0 THEN 'New ' || call_identifier ELSE title END) AS title, CASE WHEN id % 2 = 0 THEN CAST(deadline + INTERVAL 1 DAY AS DATE) ELSE deadline END AS deadline,
    CASE WHEN id % 2 = 0 THEN 'closed' ELSE status END AS status, round(CASE WHEN id % 2 = 0 THEN budget_total * 2 ELSE budget_total END, 2) AS budget_total, CASE WHEN id % 3 = 0 THEN 'https://new' ELSE url END AS url,
    CASE WHEN id % 3 = 0 THEN 'USD' ELSE currency END AS currency, array_to_string(topic_keywords, '|') AS keywords FROM ({binding.plain(binding.CALLS)}) WHERE id % 3 <> 0 OR id % 2 = 0"""


@query
def upserted_applications(spark, sf_dir):
    """Applications by name: every field is the later load's, where it is empty too."""
    apps = binding.applications(spark, sf_dir)
    odd = F.col("name").like("%1")
    later = apps.where(F.col("name").like("%1") | F.col("name").like("%2")).withColumns({"maturity": F.lit("production"), "year_first_proposed": F.lit(None).cast("int")})
    rows = loaded(spark, "applications", schemas.APPLICATION, schemas.APPLICATION_KEY, schemas.APPLICATION_UPDATES, apps.where(~odd), later)
    return rows.select("name", "domain", "subdomain", "advantage_type", "advantage_status", "maturity", "year_first_proposed")


ORACLE["upserted_applications"] = f"""SELECT name, domain, subdomain, advantage_type, advantage_status, CASE WHEN name LIKE '%1' OR name LIKE '%2' THEN 'production' ELSE maturity END AS maturity,
    CASE WHEN name LIKE '%1' OR name LIKE '%2' THEN NULL ELSE year_first_proposed END AS year_first_proposed FROM ({binding.plain(binding.APPLICATIONS)})"""


@query
def upserted_links(spark, sf_dir):
    """Funding links (customers and their orders) computed over finished orders, then over all of them for every second customer."""
    orders = table(spark, sf_dir, "orders")

    def links(rows: DataFrame, day: str) -> DataFrame:
        amounts = rows.groupBy(F.col("o_custkey").alias("application_id")).agg(F.count("*").alias("grant_count"), F.sum("o_totalprice").alias("total_funding_eur"), F.min("o_orderpriority").alias("top_funders"))
        return amounts.withColumns({"query_pattern": F.format_string("%%%d%%", "application_id"), "last_computed": F.lit(day).cast("timestamp")})

    later = links(orders.where("o_custkey % 2 = 0"), "2024-02-02")
    rows = loaded(spark, "links", schemas.FUNDING_LINK, schemas.LINK_KEY, schemas.LINK_UPDATES, links(orders.where("o_orderstatus = 'F'"), "2024-01-01"), later)
    return rows.select("application_id", "query_pattern", "grant_count", F.round(F.col("total_funding_eur") + 1e-4, 2).alias("total_funding_eur"), "top_funders", F.col("last_computed").cast("date").alias("last_computed"))


ORACLE["upserted_links"] = """SELECT o_custkey AS application_id, '%' || CAST(o_custkey AS VARCHAR) || '%' AS query_pattern, count(*) AS grant_count, round(sum(o_totalprice) + 1e-4, 2) AS total_funding_eur, min(o_orderpriority) AS top_funders,
    CASE WHEN o_custkey % 2 = 0 THEN DATE '2024-02-02' ELSE DATE '2024-01-01' END AS last_computed FROM orders WHERE o_custkey % 2 = 0 OR o_orderstatus = 'F' GROUP BY o_custkey"""


@query
def upserted_sectors(spark, sf_dir):
    """Sectors of customers (order priorities) with a note, of which a later load has others for open orders."""
    orders = table(spark, sf_dir, "orders")
    notes = lambda rows, f: rows.groupBy(F.col("o_custkey").alias("application_id"), F.col("o_orderpriority").alias("sector")).agg(f("o_orderdate").cast("date").cast("string").alias("relevance_notes"))
    rows = loaded(spark, "sectors", schemas.SECTOR, schemas.SECTOR_KEY, schemas.SECTOR_UPDATES, notes(orders, F.min), notes(orders.where("o_orderstatus = 'O'"), F.max))
    return rows.select("application_id", "sector", "relevance_notes")


ORACLE["upserted_sectors"] = """SELECT o_custkey AS application_id, o_orderpriority AS sector, CAST(CAST(coalesce(max(o_orderdate) FILTER (WHERE o_orderstatus = 'O'), min(o_orderdate)) AS DATE) AS VARCHAR) AS relevance_notes
    FROM orders GROUP BY o_custkey, o_orderpriority"""


# sources loaded anew (M10)


@query
def refreshed_sources(spark, sf_dir):
    """Grants loaded by source, then loaded anew: one source can't be read to its end, one has fewer rows, one is new."""
    home = new_folder(spark, "sources")  # made once for all loads
    binding.grants(spark, sf_dir).groupBy("source", "source_id").agg(F.min("status").alias("status")).write.parquet(home)
    of = lambda name: spark.read.parquet(home).where(F.col("source") == name)
    path = new_folder(spark, "grants")
    first = ("cordis_bulk", "openaire", "openaire_bulk", "gepris")
    refresh.load_sources(spark, path, {name: lambda name=name: of(name) for name in first})
    torn = lambda: of("openaire").withColumn("status", F.when(F.col("source_id").endswith("7"), F.raise_error(F.lit("not there"))).otherwise(F.lit("torn")))
    states = refresh.load_sources(spark, path, {
        "cordis_bulk": lambda: of("cordis_bulk").where("source_id LIKE '%1'").withColumn("status", F.lit("again")), "openaire": torn, "gepris": lambda: of("gepris").withColumn("status", F.lit("again")),
        "foerderkatalog": lambda: of("foerderkatalog"),
    })
    state = F.create_map(*(F.lit(x) for name, text in states.items() for x in (name, text.split(":")[0])))
    return parted.read_table(spark, path, schemas.GRANT).select("source", "source_id", "status", F.coalesce(state[F.col("source")], F.lit("kept")).alias("state"))


ORACLE["refreshed_sources"] = f"""SELECT source, source_id, CASE WHEN source = 'gepris' OR source = 'cordis_bulk' AND source_id LIKE '%1' THEN 'again' ELSE min(status) END AS status,
    CASE source WHEN 'openaire' THEN 'error' WHEN 'openaire_bulk' THEN 'kept' ELSE 'ok' END AS state FROM ({binding.plain(binding.GRANTS)}) GROUP BY source, source_id"""


# streams (ST1 to ST3)

EVENTS = "id long, user_id long, event_type string, event_id long, ts timestamp"


def events_home(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the events merged by key from a stream of landed files, with their load status."""
    home = new_folder(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    shaped = lambda df: df.select("user_id", "event_type", "event_id", "ts", F.struct("ts", "event_id").alias("position"))
    run = ingest.upsert_batch(f"{home}/events", schemas.table(EVENTS), ["user_id", "event_type"], ["event_id", "ts"], f"{home}/status", "events")
    ingest.ingest(stream, shaped, run, f"{home}/checkpoint")
    return home


@query
def stream_latest_events(spark, sf_dir):
    """The events as a stream of landed files, merged by key; the table and its checkpoint are in the shared folder."""
    return parted.read_table(spark, f"{events_home(spark, sf_dir)}/events", schemas.table(EVENTS)).select("user_id", "event_type", "event_id")


ORACLE["stream_latest_events"] = "SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id FROM events GROUP BY user_id, event_type"


@query
def stream_load_status(spark, sf_dir):
    """The status row that the stream of events leaves."""
    status = ingest.read_snapshot(spark, f"{events_home(spark, sf_dir)}/status", schemas.DATA_SOURCE)
    return status.select("id", "name", "records_count", "status", (F.col("last_success") == F.col("last_fetch")).alias("up_to_date"), F.col("error_message").isNull().alias("clean"))


ORACLE["stream_load_status"] = "SELECT 'events' AS id, 'events' AS name, count(*) AS records_count, 'ok' AS status, true AS up_to_date, true AS clean FROM events"
