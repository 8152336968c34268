"""The queries as plain SQL over the given tables, written from the description of each operator."""

from __future__ import annotations

from grantlake.functions.columns import NAME_TITLES, PROGRAMME, PROGRAMME_KIND
from grantlake.operators.enrich import FUNDERS, OTHER_RATE, PROGRAMME_RATES
from grantlake.operators.fx import RATES
from grantlake.plans import binding

Q = "'"
#: Added before rounding to cents, because sums of half cents would be rounded by the order of their terms.
OFF = 0.0013


def rows(values) -> str:
    """A VALUES list."""
    one = lambda v: "NULL" if v is None else str(v) if isinstance(v, int | float) else Q + str(v).replace(Q, Q + Q) + Q
    return "VALUES " + ", ".join("(" + ", ".join(map(one, r)) + ")" for r in values)


def _names(column: str) -> str:
    for title in NAME_TITLES:
        column = f"regexp_replace({column}, '^{title.replace('.', chr(92) + '.')}', '')"
    return rf"trim(regexp_replace(regexp_replace(regexp_replace({column}, ',\s*Ph\.D\.\s*$', ''), '\s*\([†+]\)\s*$', ''), '\s+', ' ', 'g'))"


all_funders = [f[:1] + f[2:4] for f in binding.FUNDERS] + [(4 + i, code, FUNDERS[code][1]) for i, code in enumerate(sorted(FUNDERS))]
programme = rf"regexp_replace(trim(regexp_extract(abstract, '{PROGRAMME}', 1)), '{PROGRAMME_KIND}', '\1')"
has_project = "coalesce(project_id <> '', false)"


def _point(before: str, rows_: str, targets: str) -> str:
    return f"""SELECT a.* REPLACE (CASE WHEN a.dedup_of IS NULL AND ({rows_}) AND a.project_id <> '' THEN b.first_id ELSE a.dedup_of END AS dedup_of)
    FROM {before} a LEFT JOIN (SELECT project_id, min(id) AS first_id FROM {before} WHERE ({targets}) AND project_id <> '' GROUP BY project_id) b ON a.project_id = b.project_id"""


PIPELINE = f"""
raw AS ({binding.plain(binding.GRANTS)}),
funder AS (SELECT * FROM ({rows(all_funders)}) AS t(fid, short_name, fcountry)),
rate AS (SELECT * FROM ({rows([(c, y, r) for c, of in RATES.items() for y, r in of.items()])}) AS t(cur, yr, rate)),
programme_rate AS (SELECT * FROM ({rows(PROGRAMME_RATES.items())}) AS t(prog, yearly)),
swapped AS (SELECT * REPLACE (CASE WHEN start_date > end_date THEN end_date ELSE start_date END AS start_date, CASE WHEN start_date > end_date THEN start_date ELSE end_date END AS end_date) FROM raw),
dated AS (SELECT * REPLACE (CASE WHEN year(start_date) < 1950 THEN NULL ELSE start_date END AS start_date,
                            CASE WHEN year(end_date) < 1950 OR year(end_date) > 2040 THEN NULL ELSE end_date END AS end_date) FROM swapped),
coded AS (SELECT * REPLACE (CASE pi_country WHEN 'UK' THEN 'GB' WHEN 'EL' THEN 'GR' WHEN 'EU' THEN NULL ELSE pi_country END AS pi_country, CASE currency WHEN '$' THEN 'AUD' ELSE currency END AS currency) FROM dated),
named AS (SELECT * REPLACE ({_names('pi_name')} AS pi_name,
   trim(CASE WHEN source = 'cordis_bulk' AND pi_institution = upper(pi_institution) AND length(pi_institution) > 1
             THEN array_to_string(list_transform(string_split(lower(pi_institution), ' '), lambda x: upper(substr(x, 1, 1)) || substr(x, 2)), ' ')
             WHEN source = 'gepris' AND pi_institution LIKE 'shared %through:%' THEN trim(substr(pi_institution, position(':' IN pi_institution) + 1))
             WHEN source = 'foerderkatalog' AND pi_institution LIKE 'Keine Anzeige%' THEN NULL ELSE pi_institution END) AS pi_institution) FROM coded),
linked AS (SELECT named.*, f.fid AS funder_id, CAST(NULL AS BIGINT) AS dedup_of FROM named LEFT JOIN funder f ON f.short_name =
   CASE source WHEN 'cordis_bulk' THEN 'EC' WHEN 'gepris' THEN 'DFG' WHEN 'foerderkatalog' THEN 'BMBF' ELSE split_part(source_id, '_', 2) END),
enriched AS (SELECT a.* REPLACE (CASE WHEN a.source = 'cordis_bulk' AND a.project_id <> '' THEN coalesce(a.total_funding, b.tf) ELSE a.total_funding END AS total_funding,
                                CASE WHEN a.source = 'cordis_bulk' AND a.project_id <> '' THEN coalesce(a.pi_country, b.pc) ELSE a.pi_country END AS pi_country)
   FROM linked a LEFT JOIN (SELECT project_id, arg_min(total_funding, id) FILTER (WHERE total_funding IS NOT NULL) AS tf, arg_min(pi_country, id) FILTER (WHERE pi_country IS NOT NULL) AS pc
                            FROM linked WHERE source = 'openaire_bulk' AND project_id <> '' GROUP BY project_id) b ON a.project_id = b.project_id),
flag1 AS ({_point('enriched', "a.source = 'openaire_bulk' AND starts_with(a.source_id, 'oaire_EC_') OR a.source = 'openaire' AND starts_with(a.source_id, 'openaire_EC_')", "source = 'cordis_bulk'")}),
flag2 AS ({_point('flag1', "a.source = 'openaire'", "source = 'openaire_bulk' AND dedup_of IS NULL")}),
flag3 AS ({_point('flag2', "a.source = 'openaire_bulk' AND starts_with(a.source_id, 'oaire_DFG_') OR a.source = 'openaire' AND starts_with(a.source_id, 'openaire_DFG_')", "source = 'gepris'")}),
flag4 AS (SELECT a.* REPLACE (coalesce(a.dedup_of, CASE WHEN a.id <> b.first_id THEN b.first_id END) AS dedup_of)
   FROM flag3 a LEFT JOIN (SELECT source, source_id, min(id) AS first_id FROM flag3 GROUP BY source, source_id) b ON a.source = b.source AND a.source_id = b.source_id),
aggregated AS (SELECT *, coalesce(source = 'foerderkatalog' AND total_funding > 50000000 OR total_funding < 0, false) AS is_aggregate, nullif({programme}, '') AS prog FROM flag4),
estimated AS (SELECT a.*, CASE WHEN source = 'gepris' AND coalesce(total_funding, 0) = 0 AND a.prog IS NOT NULL THEN coalesce(p.yearly, {OTHER_RATE})
                * CASE WHEN start_date IS NULL OR end_date IS NULL THEN 3.0 ELSE greatest((end_date - start_date) / 365.25, 1.0) END END AS total_funding_estimated
   FROM aggregated a LEFT JOIN programme_rate p ON a.prog = p.prog),
g AS (SELECT e.* EXCLUDE (prog), CASE WHEN e.currency = 'EUR' OR e.currency IS NULL OR e.currency = '' THEN e.total_funding ELSE e.total_funding / r.rate END AS total_funding_eur
   FROM estimated e LEFT JOIN (
     SELECT w.currency, w.y, arg_min(rate, abs(w.y - yr) * 10000 - yr) AS rate FROM (SELECT DISTINCT currency, coalesce(year(start_date), year(end_date), 2024) AS y FROM estimated WHERE total_funding IS NOT NULL) w
     JOIN rate ON rate.cur = w.currency GROUP BY w.currency, w.y) r ON e.currency = r.currency AND r.y = coalesce(year(e.start_date), year(e.end_date), 2024)),
canonical AS (SELECT * FROM g WHERE dedup_of IS NULL AND NOT is_aggregate),
calls AS ({binding.plain(binding.CALLS)}),
application AS ({binding.plain(binding.APPLICATIONS)}),
pattern AS (SELECT DISTINCT * FROM ({binding.plain(binding.PATTERNS)})),
matched AS (SELECT DISTINCT p.application, c.id, c.funder_id, coalesce(c.total_funding_eur, c.total_funding_estimated, 0) AS amount FROM canonical c JOIN pattern p ON c.project_title ILIKE p.pattern OR c.abstract ILIKE p.pattern),
by_funder AS (SELECT m.application, coalesce(f.short_name, 'Unknown') AS name, count(*) AS c, row_number() OVER (PARTITION BY m.application ORDER BY count(*) DESC, coalesce(f.short_name, 'Unknown'), m.funder_id) AS n
   FROM matched m LEFT JOIN funder f ON f.fid = m.funder_id GROUP BY m.application, m.funder_id, f.short_name),
links AS (SELECT a.name AS application, coalesce(t.c, 0) AS grant_count, coalesce(t.s, 0.0) AS total_funding_eur, coalesce(b.top, '') AS top_funders FROM application a
   SEMI JOIN pattern p ON a.name = p.application
   LEFT JOIN (SELECT application, count(*) AS c, sum(amount) AS s FROM matched GROUP BY application) t ON t.application = a.name
   LEFT JOIN (SELECT application, string_agg(name || '(' || CAST(c AS VARCHAR) || ')', ', ' ORDER BY n) AS top FROM by_funder WHERE n <= 5 GROUP BY application) b ON b.application = a.name),
linked_apps AS (SELECT * FROM application a JOIN links l ON l.application = a.name)
"""


def over(select: str) -> str:
    """A query over the views above."""
    return f"WITH {PIPELINE}\n{select}"


as_of = f"DATE '{binding.AS_OF}'"
inst = f"pi_institution ILIKE '{binding.INSTITUTION}'"
best = lambda names, column, last: "CASE " + " ".join(f"WHEN bool_or({column} = '{n}') THEN '{n}'" for n in names) + f" ELSE '{last}' END"
ADV = ["exponential", "superpolynomial", "polynomial", "quadratic", "subquadratic", "constant"]
EVI = ["proven", "proven_with_caveats", "conjectured", "heuristic_only"]
FIELDS = ["pi_name", "pi_institution", "pi_country", "start_date", "end_date", "total_funding", "abstract", "ror_id", "funder_id"]
call_line = "concat_ws('|', call_identifier, coalesce(CAST(deadline AS VARCHAR), ''), status, coalesce(framework_programme, ''))"
RELEVANT = " OR ".join([
    *(f"title ILIKE '{p}'" for p in ("%quantum%", "%ERC%", "%topolog%", "%many-body%", "%entangle%")), *(f"array_to_string(topic_keywords, ' ') ILIKE '{p}'" for p in ("%quantum%", "%physics%", "%computing%")),
    *(f"call_identifier ILIKE '{p}'" for p in ("%ERC%", "%MSCA%", "%quantum%")),
])

ORACLE = {
    "clean_dates": "SELECT id, start_date, end_date FROM dated",
    "date_fixes": """SELECT (SELECT count(*) FROM raw WHERE start_date > end_date) AS swapped, count(*) FILTER (WHERE start_date = DATE '1900-01-01') AS sentinel_start,
        count(*) FILTER (WHERE end_date = DATE '9999-12-31') AS sentinel_end, count(*) FILTER (WHERE start_date <> DATE '1900-01-01' AND year(start_date) < 1950) AS ancient_start,
        count(*) FILTER (WHERE year(end_date) < 1950) AS ancient_end, count(*) FILTER (WHERE end_date <> DATE '9999-12-31' AND year(end_date) > 2040) AS future_end FROM swapped""",
    "clean_codes": "SELECT id, pi_country, currency FROM coded",
    "clean_names": "SELECT id, pi_name, pi_institution FROM named",
    "link_funders": "SELECT id, funder_id FROM linked",
    "enrich_between_sources": "SELECT id, round(total_funding, 2) AS total_funding, pi_country FROM enriched",
    "flag_source_duplicates": "SELECT id, dedup_of FROM flag3",
    "flag_within_source": "SELECT id, dedup_of FROM flag4",
    "flag_aggregates": "SELECT id, is_aggregate FROM aggregated",
    "estimate_funding": "SELECT id, round(total_funding_estimated, 2) AS total_funding_estimated FROM estimated WHERE total_funding_estimated IS NOT NULL",
    "integrity_pipeline": """SELECT id, source, source_id, pi_name, pi_institution, pi_country, start_date, end_date, round(total_funding, 2) AS total_funding, currency, funder_id, dedup_of, is_aggregate,
        round(total_funding_estimated, 2) AS total_funding_estimated FROM g""",
    "stored_projects": "SELECT project_id, count(*) AS grants, count(DISTINCT source) AS sources, round(sum(total_funding), 2) AS total_funding FROM canonical WHERE project_id <> '' GROUP BY project_id",
    "stored_superseded": "SELECT a.id, a.dedup_of, a.source, b.source AS kept_source FROM g a JOIN g b ON a.dedup_of = b.id AND a.project_id = b.project_id WHERE a.project_id <> ''",
    "canonical_view": "SELECT source, count(*) AS n, sum(id) AS ids FROM canonical GROUP BY source",
    "within_source_pointers": "SELECT count(*) AS within_source_flagged FROM g a JOIN g b ON a.dedup_of = b.id WHERE a.source = b.source AND a.source_id = b.source_id",
    "integrity_counts": """SELECT d.*, (SELECT count(*) FROM raw WHERE pi_country IN ('UK', 'EL')) AS countries_fixed,
        (SELECT count(*) FROM raw WHERE pi_country = 'EU') AS eu_country_fixed, (SELECT count(*) FROM raw WHERE currency = '$') AS currencies_fixed,
        (SELECT count(*) FROM raw WHERE regexp_matches(pi_name, '  |^Professor |^Professorin |^Privatdozent|^Dr[.] |[(]|, Ph[.]D[.]$')) AS pi_names_fixed,
        (SELECT count(*) FROM raw WHERE source = 'cordis_bulk' AND pi_institution = upper(pi_institution) AND length(pi_institution) > 1 OR source = 'gepris' AND pi_institution LIKE 'shared %through:%'
           OR source = 'foerderkatalog' AND pi_institution LIKE 'Keine Anzeige%') AS institutions_fixed,
        g.*, (SELECT count(*) FROM g a JOIN g b ON a.dedup_of = b.id WHERE a.source = b.source AND a.source_id = b.source_id) AS within_source_flagged,
        (SELECT count(*) FROM raw WHERE source = 'cordis_bulk' AND project_id <> '' AND (total_funding IS NULL OR pi_country IS NULL)
           AND project_id IN (SELECT project_id FROM raw WHERE source = 'openaire_bulk' AND project_id <> '')) AS enriched
        FROM (SELECT (SELECT count(*) FROM raw WHERE start_date > end_date) AS swapped, count(*) FILTER (WHERE start_date = DATE '1900-01-01') AS sentinel_start,
          count(*) FILTER (WHERE end_date = DATE '9999-12-31') AS sentinel_end, count(*) FILTER (WHERE start_date <> DATE '1900-01-01' AND year(start_date) < 1950) AS ancient_start,
          count(*) FILTER (WHERE year(end_date) < 1950) AS ancient_end, count(*) FILTER (WHERE end_date <> DATE '9999-12-31' AND year(end_date) > 2040) AS future_end FROM swapped) d,
        (SELECT count(funder_id) AS funders_linked, count(*) FILTER (WHERE dedup_of IS NOT NULL AND source IN ('openaire_bulk', 'openaire') AND regexp_matches(source_id, '^(oaire|openaire)_EC_')) AS ec_duplicates_flagged,
          count(*) FILTER (WHERE dedup_of IS NOT NULL AND source = 'openaire') AS api_duplicates_flagged,
          count(*) FILTER (WHERE dedup_of IS NOT NULL AND (source = 'openaire_bulk' AND starts_with(source_id, 'oaire_DFG_') OR source = 'openaire' AND starts_with(source_id, 'openaire_DFG_'))) AS gepris_duplicates_flagged,
          count(*) FILTER (WHERE is_aggregate) AS aggregates_flagged, count(total_funding_estimated) AS funding_estimated, CAST(0 AS BIGINT) AS ror_matched FROM g) g""",
    "missing_funders": f"""SELECT short_name, fcountry AS country FROM funder WHERE fid > {len(binding.FUNDERS)}
        AND short_name IN (SELECT split_part(source_id, '_', 2) FROM raw WHERE source IN ('openaire_bulk', 'openaire'))""",
    "to_eur": "SELECT id, round(total_funding_eur, 2) AS total_funding_eur FROM g",
    "to_eur_earlier": """WITH bounds AS (SELECT min(yr) AS a, max(yr) AS b FROM rate),
        e AS (SELECT *, upper(trim(currency)) AS code, greatest(a, least(b, coalesce(year(start_date), year(end_date), 9999))) AS y FROM estimated, bounds),
        r AS (SELECT code, y, arg_min(rate, abs(y - yr) * 10000 + yr) AS rate FROM (SELECT DISTINCT code, y FROM e) JOIN rate ON cur = code GROUP BY code, y)
        SELECT id, round(CASE WHEN e.code IS NULL OR e.code = 'EUR' THEN total_funding ELSE total_funding / r.rate END, 2) AS total_funding_eur FROM e LEFT JOIN r ON r.code = e.code AND r.y = e.y""",
    "conversion_counts": """SELECT count(total_funding) AS total_funded, count(total_funding_eur) FILTER (WHERE currency IS NULL OR currency IN ('EUR', '')) AS eur_copied,
        count(total_funding_eur) FILTER (WHERE currency NOT IN ('EUR', '')) AS converted, count(total_funding_eur) AS eur_set,
        count(*) FILTER (WHERE total_funding IS NOT NULL AND total_funding_eur IS NULL) AS unmapped FROM g""",
    "unmapped_currencies": "SELECT currency, count(*) AS n, round(sum(total_funding), 2) AS total FROM g WHERE total_funding IS NOT NULL AND total_funding_eur IS NULL GROUP BY currency",
    "currency_summary": """SELECT currency, count(total_funding) AS n, round(sum(total_funding) / 1e9, 2) AS orig_total_b, round(sum(total_funding_eur) / 1e9, 2) AS eur_total_b
        FROM canonical WHERE currency IS NOT NULL GROUP BY currency ORDER BY n DESC, currency LIMIT 20""",
    "open_calls": f"""SELECT id_text AS call_identifier, deadline, status FROM (SELECT call_identifier AS id_text, * FROM calls) WHERE status IN ('open', 'forthcoming')
        AND (deadline >= {as_of} OR deadline IS NULL) AND (deadline <= {as_of} + INTERVAL 180 DAY OR deadline IS NULL)
        AND (title ILIKE '%quantum%' OR title ILIKE '%ERC%' OR title ILIKE '%topolog%' OR title ILIKE '%many-body%' OR title ILIKE '%entangle%'
          OR array_to_string(topic_keywords, ' ') ILIKE '%quantum%' OR array_to_string(topic_keywords, ' ') ILIKE '%physics%' OR array_to_string(topic_keywords, ' ') ILIKE '%computing%'
          OR call_identifier ILIKE '%ERC%' OR call_identifier ILIKE '%MSCA%' OR call_identifier ILIKE '%quantum%')""",
    "open_calls_all": f"""SELECT call_identifier, deadline, status FROM calls WHERE status IN ('open', 'forthcoming') AND (deadline >= {as_of} OR deadline IS NULL)
        AND (deadline <= {as_of} + INTERVAL 360 DAY OR deadline IS NULL)""",
    "funding_landscape": """SELECT source, count(*) AS num_grants, round(sum(total_funding), 2) AS total_funding, round(sum(eu_contribution), 2) AS total_eu, min(start_date) AS earliest, max(end_date) AS latest
        FROM canonical WHERE status = 'active' GROUP BY source""",
    "income_projection": f"""WITH t AS (SELECT acronym, start_date, end_date, total_funding / nullif(date_diff('month', start_date, end_date), 0) AS rate FROM canonical
          WHERE {inst} AND status = 'active' AND start_date IS NOT NULL AND end_date IS NOT NULL AND total_funding > 0)
        SELECT y AS year, count(DISTINCT acronym) AS active_grants, round(sum(rate * least(12, greatest(0, date_diff('month', greatest(start_date, make_date(y, 1, 1)), least(end_date, make_date(y, 12, 31)))))), 2) AS projected_income
        FROM t, (SELECT CAST(unnest(generate_series(1994, 2004)) AS INTEGER) AS y) WHERE y BETWEEN year(start_date) AND year(end_date) GROUP BY y""",
    "top_institutions": """SELECT pi_institution, pi_country, count(*) AS num_grants, round(sum(total_funding), 2) AS total_funding, array_to_string(list_sort(list(DISTINCT acronym)), ',') AS projects
        FROM canonical WHERE (project_title ILIKE '%ion%' OR array_to_string(topic_keywords, ' ') ILIKE '%ion%') AND pi_institution IS NOT NULL
        GROUP BY pi_institution, pi_country ORDER BY sum(total_funding) DESC NULLS LAST, pi_institution, pi_country LIMIT 20""",
    "historical_trends": """SELECT year(start_date) AS start_year, count(*) AS num_grants, round(sum(total_funding), 2) AS total_funding, round(sum(eu_contribution), 2) AS total_eu
        FROM canonical WHERE (project_title ILIKE '%ion%' OR array_to_string(topic_keywords, ' ') ILIKE '%ion%') AND start_date IS NOT NULL GROUP BY 1""",
    "programme_availability": f"SELECT framework_programme, count(*) AS open_calls, min(deadline) AS next_deadline FROM calls WHERE status IN ('open', 'forthcoming') AND deadline >= {as_of} GROUP BY framework_programme",
    "programme_gaps": f"""SELECT p.framework_programme, p.open_calls, p.next_deadline, CASE WHEN EXISTS (SELECT 1 FROM canonical WHERE {inst} AND contains(source_id, lower(coalesce(p.framework_programme, '')))) THEN 'Applied' ELSE 'Never applied' END AS our_status
        FROM (SELECT framework_programme, count(*) AS open_calls, min(deadline) AS next_deadline FROM calls WHERE status IN ('open', 'forthcoming') AND deadline >= {as_of} GROUP BY framework_programme) p""",
    "sources_used": f"""SELECT DISTINCT source, framework_programme FROM (SELECT source, NULL AS framework_programme FROM canonical WHERE {inst}
        UNION ALL SELECT 'ft_portal', framework_programme FROM calls WHERE call_identifier IN (SELECT call_identifier FROM calls WHERE status = 'open'))""",
    "sme_calls": """SELECT call_identifier, deadline, status FROM calls WHERE (array_to_string(topic_keywords, ' ') ILIKE '%sme%' OR title ILIKE '%SME%' OR title ILIKE '%accelerator%' OR title ILIKE '%innovation%'
        OR array_to_string(topic_keywords, ' ') ILIKE '%company%' OR array_to_string(topic_keywords, ' ') ILIKE '%tax_credit%' OR call_identifier ILIKE '%EIC%') AND status IN ('open', 'forthcoming')""",
    "open_within_months": f"SELECT call_identifier, deadline FROM calls WHERE status IN ('open', 'forthcoming') AND deadline BETWEEN {as_of} AND {as_of} + INTERVAL 6 MONTH",
    "top_by_title": """SELECT pi_institution, count(*) AS grants, round(sum(total_funding), 2) AS total FROM canonical WHERE project_title ILIKE '%th%ion%' AND pi_institution IS NOT NULL
        GROUP BY pi_institution ORDER BY sum(total_funding) DESC NULLS LAST, pi_institution LIMIT 10""",
    "active_by_period": """SELECT CAST(year(start_date) AS VARCHAR) || '-' || CAST(year(end_date) AS VARCHAR) AS period, count(*) AS grants, round(sum(total_funding), 2) AS total
        FROM canonical WHERE status = 'active' AND start_date IS NOT NULL AND end_date IS NOT NULL GROUP BY 1""",
    "pattern_matches": "SELECT application, id FROM matched",
    "pattern_fields": """SELECT DISTINCT id, pattern, 'project_title' AS field FROM canonical JOIN pattern ON project_title ILIKE pattern.pattern
        UNION ALL SELECT DISTINCT id, pattern, 'abstract' FROM canonical JOIN pattern ON abstract ILIKE pattern.pattern""",
    "funding_links": "SELECT application, grant_count, round(total_funding_eur, 2) AS total_funding_eur, top_funders FROM links",
    "distinct_total": "SELECT count(*) AS grant_count, round(sum(amount), 2) AS total_funding_eur FROM (SELECT DISTINCT id, amount FROM matched)",
    "subdomain_summary": f"""SELECT domain, subdomain, count(*) AS application_count, string_agg(name, '|' ORDER BY name) AS applications, {best(ADV, 'advantage_type', 'unknown')} AS best_advantage_type,
        {best(EVI, 'advantage_status', 'unknown')} AS strongest_evidence, min(year_first_proposed) AS earliest_year, sum(grant_count) AS grants FROM linked_apps GROUP BY domain, subdomain""",
    "domain_summary": f"""SELECT domain, count(*) AS application_count, count(DISTINCT subdomain) AS subdomain_count, string_agg(DISTINCT subdomain, '|' ORDER BY subdomain) AS subdomains,
        {best(ADV[:4], 'advantage_type', 'unknown')} AS best_advantage_type, min(year_first_proposed) AS earliest_year, sum(grant_count) AS grants FROM linked_apps GROUP BY domain""",
    "domain_funding": f"""SELECT domain, count(*) AS apps, sum(grant_count) AS grants, round(sum(total_funding_eur) / 1e6, 2) AS funding_m, {best(ADV[:4], 'advantage_type', 'unknown')} AS best_adv,
        replace(replace({best(EVI, 'advantage_status', 'unknown')}, 'proven_with_caveats', 'proven (caveats)'), 'heuristic_only', 'heuristic only') AS best_status FROM linked_apps GROUP BY domain""",
    "application_table": """SELECT domain, name, grant_count, round(total_funding_eur / 1e6, 2) AS funding_m, year_first_proposed,
        array_to_string(list_slice(string_split(top_funders, ', '), 1, 3), ', ') AS top_funders FROM linked_apps""",
    "grand_totals": "SELECT sum(grant_count) AS grants, round(sum(total_funding_eur) / 1e9, 4) AS funding_b FROM linked_apps",
    "advantage_matrix": """SELECT advantage_type, count(*) FILTER (WHERE advantage_status = 'proven') AS proven, count(*) FILTER (WHERE advantage_status = 'conjectured') AS conjectured,
        count(*) FILTER (WHERE advantage_status = 'debated') AS debated FROM linked_apps GROUP BY advantage_type""",
    "maturity_distribution": "SELECT maturity, count(*) AS apps, round(sum(total_funding_eur) / 1e6, 2) AS funding_m FROM linked_apps GROUP BY maturity",
    "decades": "SELECT (year_first_proposed // 10) * 10 AS decade, string_agg(name, '|' ORDER BY year_first_proposed, name) AS applications FROM linked_apps WHERE year_first_proposed IS NOT NULL GROUP BY 1",
    "funding_chart": "SELECT name, grant_count, round(total_funding_eur, 2) AS total_funding_eur FROM linked_apps WHERE total_funding_eur > 0 ORDER BY total_funding_eur DESC, name LIMIT 30",
    "match_bands": """SELECT CASE WHEN coalesce(grant_count, 0) = 0 THEN 'unmatched' WHEN grant_count < 5 THEN 'under' WHEN grant_count > 200 THEN 'over' ELSE 'normal' END AS band, count(*) AS apps,
        sum(coalesce(grant_count, 0)) AS grants FROM application a LEFT JOIN links l ON l.application = a.name GROUP BY 1""",
    "status_counts": """SELECT attribute, value, count(*) AS n FROM (SELECT unnest(['domain', 'advantage_type', 'advantage_status', 'maturity']) AS attribute,
        unnest([domain, advantage_type, advantage_status, maturity]) AS value FROM linked_apps) GROUP BY ALL""",
    "duplicate_totals": "SELECT count(*) AS total, count(dedup_of) AS duplicates, count(*) FILTER (WHERE is_aggregate) AS aggregates FROM g",
    "residual_keys": "SELECT source, source_id, count(*) AS c FROM linked WHERE source_id IS NOT NULL AND dedup_of IS NULL GROUP BY source, source_id HAVING count(*) > 1",
    "residual_titles": """SELECT md5(lower(trim(project_title))) AS title, year(start_date) AS y, funder_id, count(*) AS c FROM canonical WHERE project_title IS NOT NULL AND start_date IS NOT NULL AND length(project_title) > 20
        GROUP BY lower(trim(project_title)), year(start_date), funder_id HAVING count(*) > 1""",
    "missing_data": "SELECT source, count(*) AS n, " + ", ".join(f"round(100.0 * count(*) FILTER (WHERE {f} IS NULL" + ("" if f == "pi_country" else f" OR CAST({f} AS VARCHAR) = ''") + f") / count(*), 6) AS {f}" for f in FIELDS)
        + " FROM (SELECT *, CAST(NULL AS VARCHAR) AS ror_id FROM canonical) GROUP BY source HAVING count(*) >= 100",
    "funding_split": """SELECT count(total_funding) AS real_funding, count(*) FILTER (WHERE total_funding IS NULL AND total_funding_estimated IS NOT NULL) AS estimated_only,
        count(*) FILTER (WHERE total_funding IS NULL AND total_funding_estimated IS NULL) AS missing, count(*) AS total FROM canonical""",
    "anomalies": f"""SELECT count(*) FILTER (WHERE start_date < DATE '1900-01-01') AS ancient_start, count(*) FILTER (WHERE start_date > {as_of} + INTERVAL 5 YEAR) AS far_future_start,
        count(*) FILTER (WHERE end_date < start_date) AS end_before_start, count(*) FILTER (WHERE year(end_date) - year(start_date) > 30) AS too_long, count(*) FILTER (WHERE total_funding_eur < 0) AS negative,
        count(*) FILTER (WHERE total_funding_eur = 0) AS zero, count(*) FILTER (WHERE total_funding_eur > 1e9) AS gt_1b, count(*) FILTER (WHERE total_funding_eur > 1e8 AND total_funding_eur <= 1e9) AS gt_100m,
        count(DISTINCT pi_country) FILTER (WHERE NOT regexp_matches(pi_country, '^[A-Z]{{2}}$')) AS suspicious_countries FROM canonical""",
    "largest_grants": "SELECT id, source, round(total_funding_eur, 2) AS total_funding_eur FROM canonical WHERE total_funding_eur > 400000 ORDER BY canonical.total_funding_eur DESC, id LIMIT 5",
    "currency_distribution": "SELECT currency, count(*) AS n FROM canonical WHERE total_funding IS NOT NULL GROUP BY currency ORDER BY n DESC, currency NULLS FIRST LIMIT 15",
    "country_distribution": "SELECT pi_country, count(*) AS n, NOT regexp_matches(pi_country, '^[A-Z]{2}$') AS non_iso FROM canonical WHERE pi_country IS NOT NULL GROUP BY pi_country ORDER BY n DESC, pi_country LIMIT 20",
    "linkage": "SELECT count(*) AS total, count(funder_id) AS linked FROM canonical",
    "top_funders": """SELECT f.short_name, f.fcountry AS country, count(*) AS cnt, round(sum(coalesce(total_funding, total_funding_estimated, 0)), 2) AS funding FROM canonical c LEFT JOIN funder f ON f.fid = c.funder_id
        GROUP BY f.short_name, f.fcountry ORDER BY cnt DESC, f.short_name LIMIT 15""",
    "language_coverage": """SELECT count(*) FILTER (WHERE source IN ('gepris', 'foerderkatalog') OR project_title ILIKE '%quanten%' OR project_title ILIKE '%forschung%' OR project_title ILIKE '%verfahren%') AS german,
        count(*) FILTER (WHERE project_title ILIKE '%quantum%') AS english_quantum, count(*) FILTER (WHERE project_title ILIKE '%quanten%' OR abstract ILIKE '%quanten%') AS german_quantum FROM canonical""",
    "abstract_coverage": "SELECT source, count(*) AS n, count(*) FILTER (WHERE abstract <> '') AS with_abstract FROM g GROUP BY source",
    "work_list": "SELECT id, project_id FROM g WHERE source = 'gepris' AND coalesce(abstract, '') = '' AND project_id IS NOT NULL",
    "load_progress": "SELECT source, count(*) AS rows, count(*) FILTER (WHERE coalesce(pi_name, '') <> '' OR coalesce(abstract, '') <> '') AS with_details FROM g GROUP BY source",
    "executive_summary": f"""SELECT count(*) AS total_grants, count(*) FILTER (WHERE status = 'active') AS active_grants, round(coalesce(sum(total_funding), 0), 2) AS total_funding, count(*) FILTER (WHERE {inst}) AS own_grants,
        round(coalesce(sum(total_funding) FILTER (WHERE {inst}), 0), 2) AS own_funding, count(DISTINCT source) AS sources, (SELECT count(*) FROM calls) AS total_calls,
        (SELECT count(*) FROM calls WHERE status IN ('open', 'forthcoming')) AS open_calls FROM canonical""",
    "report_quality": """SELECT source, count(*) AS n, count(total_funding) AS with_total_funding, count(*) FILTER (WHERE coalesce(pi_institution, '') <> '') AS with_pi_institution, count(start_date) AS with_start_date
        FROM canonical GROUP BY source""",
    "merge_upsert": """WITH old AS (SELECT source, source_id, min(id) AS id, min(pi_name) AS pi_name, min(pi_country) AS pi_country, min(currency) AS currency FROM raw GROUP BY source, source_id),
        keyed AS (SELECT id, source, CASE WHEN id % 4 = 0 THEN source_id || '_b' ELSE source_id END AS source_id, coalesce(pi_name, '#') AS pi_name, coalesce(pi_country, '#') AS pi_country, coalesce(currency, '#') AS currency FROM named),
        new AS (SELECT source, source_id, nullif(arg_max(pi_name, id), '#') AS pi_name, nullif(arg_max(pi_country, id), '#') AS pi_country, nullif(arg_max(currency, id), '#') AS currency FROM keyed GROUP BY source, source_id)
        SELECT coalesce(o.source, n.source) AS source, coalesce(o.source_id, n.source_id) AS source_id, CASE WHEN n.source IS NULL THEN o.pi_name ELSE n.pi_name END AS pi_name,
        CASE WHEN n.source IS NULL THEN o.pi_country ELSE n.pi_country END AS pi_country, CASE WHEN o.source IS NULL THEN n.currency ELSE o.currency END AS currency
        FROM old o FULL JOIN new n ON o.source = n.source AND o.source_id = n.source_id""",
    "snapshot_diff": """SELECT o.id, 'updated' AS change, 'pi_name' AS field FROM raw o JOIN g ON o.id = g.id WHERE o.pi_name IS DISTINCT FROM g.pi_name
        UNION ALL SELECT o.id, 'updated', 'currency' FROM raw o JOIN g ON o.id = g.id WHERE o.currency IS DISTINCT FROM g.currency""",
    "validate_grants": """SELECT id, CASE WHEN status NOT IN ('active', 'completed', 'terminated') THEN 'known_status,' ELSE '' END || CASE WHEN start_date > end_date THEN 'dates_in_order' ELSE '' END AS broken
        FROM raw WHERE start_date > end_date OR status NOT IN ('active', 'completed', 'terminated')""",
    "co_participation": """WITH p AS (SELECT DISTINCT project_id, pi_institution FROM g WHERE project_id <> '' AND pi_institution <> '')
        SELECT x.pi_institution AS a, y.pi_institution AS b, count(*) AS projects FROM p x JOIN p y ON x.project_id = y.project_id AND x.pi_institution < y.pi_institution GROUP BY 1, 2""",
    "relevance": "SELECT id, call_identifier, 1 AS relevance FROM calls WHERE list_has_any(list_transform(topic_keywords, lambda x: lower(x)), ['urgent', 'high', 'low'])",
    "review_sample": """WITH m AS (SELECT application, id, pattern, 'project_title' AS field FROM canonical JOIN pattern ON project_title ILIKE pattern.pattern
          UNION ALL SELECT application, id, pattern, 'abstract' FROM canonical JOIN pattern ON abstract ILIKE pattern.pattern),
        per AS (SELECT application, id, string_agg(DISTINCT pattern, '|' ORDER BY pattern) AS patterns, string_agg(DISTINCT field, '|' ORDER BY field) AS fields FROM m GROUP BY application, id),
        drawn AS (SELECT *, count(*) OVER (PARTITION BY application) AS n, row_number() OVER (PARTITION BY application ORDER BY md5('0:' || CAST(id AS VARCHAR)), id) AS draw FROM per)
        SELECT application, draw, d.id, source, md5(project_title) AS title, pi_institution, patterns, fields FROM drawn d JOIN canonical c ON c.id = d.id WHERE n > 2 AND draw <= 10""",
    "similar_institutions": """WITH names AS (SELECT DISTINCT pi_institution FROM g WHERE source IN ('cordis_bulk', 'gepris') AND pi_institution <> '')
        SELECT id, g.pi_institution, 'org' || CAST(n_nationkey AS VARCHAR) AS ror_id FROM g JOIN names ON names.pi_institution = g.pi_institution JOIN nation ON lower(g.pi_institution) = 'university of ' || lower(n_name)""",
    "report_sections": f"""WITH due AS (SELECT * FROM calls WHERE status IN ('open', 'forthcoming') AND (deadline IS NULL OR deadline BETWEEN {as_of} AND {as_of} + INTERVAL 360 DAY)),
        gaps AS (SELECT p.framework_programme, p.open_calls, p.next_deadline, CASE WHEN EXISTS (SELECT 1 FROM canonical WHERE {inst} AND contains(source_id, lower(coalesce(p.framework_programme, '')))) THEN 'Applied' ELSE 'Never applied' END AS our_status
          FROM (SELECT framework_programme, count(*) AS open_calls, min(deadline) AS next_deadline FROM calls WHERE status IN ('open', 'forthcoming') AND deadline >= {as_of} GROUP BY framework_programme) p)
        SELECT section, CAST(place AS INT) AS place, line FROM (
        {" UNION ALL ".join(f"SELECT '{title}' AS section, row_number() OVER (ORDER BY deadline IS NULL, deadline, call_identifier) AS place, {call_line} AS line FROM due WHERE {test} QUALIFY place <= {n}" for title, test, n in (("Deadlines", "true", 30), ("Recommended calls", RELEVANT, 15)))}
        UNION ALL SELECT 'Gaps', row_number() OVER (ORDER BY open_calls DESC, framework_programme NULLS FIRST) AS place, concat_ws('|', coalesce(framework_programme, ''), open_calls, coalesce(CAST(next_deadline AS VARCHAR), ''), our_status) FROM gaps QUALIFY place <= 20
        UNION ALL SELECT 'Data quality', row_number() OVER (ORDER BY n DESC, source), concat_ws('|', source, n, f, i, d) FROM (SELECT source, count(*) AS n, count(total_funding) AS f, count(nullif(pi_institution, '')) AS i, count(start_date) AS d FROM canonical GROUP BY source))""",
    "totals": "SELECT count(*) AS grants, count(*) FILTER (WHERE dedup_of IS NULL AND NOT is_aggregate) AS canonical, (SELECT count(*) FROM calls) AS calls FROM g",
    "exact_entities": """SELECT DISTINCT c.pi_institution AS name, 'org' || CAST(n.n_nationkey AS VARCHAR) AS ror_id FROM g c JOIN nation n ON lower(c.pi_institution) = 'university of ' || lower(n.n_name)""",
}

ORACLE = {name: text if name == "currency_summary" else text.replace(", 2) AS ", f" + {OFF}, 2) AS ") for name, text in ORACLE.items()}
ORACLE = {name: over(text) if not text.startswith("WITH") else f"WITH {PIPELINE}, {text[4:].lstrip()}" for name, text in ORACLE.items()}

ORACLE |= {
    "latest_events": "SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id, round(arg_max(value, (ts, event_id)), 6) AS value FROM events GROUP BY user_id, event_type",
    "page_summary": r"""SELECT page_id, regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1) AS title, regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS heading,
        CAST(len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS INTEGER) AS n_links, list_filter(regexp_extract_all(html, '(?s)<p>([^<]*)</p>', 1), lambda x: length(x) > 50)[1] AS block FROM pages""",
    "page_links": r"""SELECT page_id, href AS link, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages) GROUP BY page_id, href""",
    "keep_first_documents": "SELECT text_key, min(doc_id) AS doc_id FROM (SELECT md5(text) AS text_key, doc_id FROM documents) GROUP BY text_key",
    "similar_names": f"""WITH n AS (SELECT DISTINCT lower(replace(pattern, '%', '')) AS name FROM ({binding.plain(binding.PATTERNS)}))
        SELECT name AS a, 'x' || name AS b, round(200.0 * length(name) / (2 * length(name) + 1), 4) AS score FROM n WHERE length(name) >= 40""",
}
