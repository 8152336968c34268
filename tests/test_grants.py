"""Cleaning, flags, enrichment, currencies and analytical queries on small hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from grantlake import schemas
from grantlake.functions import columns as c
from grantlake.operators import analytics, audit, clean, dedup, enrich, entity, fx, integrity, match, merge, parted, refresh, report, rollups, substring_join
from grantlake.plans import binding

D = dt.date


def grants(spark, rows):
    """Grants from dictionaries under the whole schema."""
    names = schemas.GRANT.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.GRANT)


def row(i, source, project=None, key=None, **more):
    form = {"cordis_bulk": "cordis_{}", "openaire_bulk": "oaire_EC_{}", "openaire": "openaire_EC_{}", "gepris": "gepris_{}", "foerderkatalog": "fk_{}"}[source]
    return {"id": i, "source": source, "project_id": project, "source_id": key or form.format(project), "project_title": f"Title {i}", "status": "active", **more}


def test_column_functions(spark):
    df = spark.createDataFrame(
        [("2024-05-01T10:00", "01.05.2021 x", "1.250.000,00 €", "Professorin Dr. Anna  Fischer (†)", "12.50", "<a>(132&nbsp;Treffer)</a> index=50 index=150700 hitsPerPage=50"),
         ("2024-13-01", "31.02.2021", "7.142.500 EUR", "Dr. Dr. Max Mustermann, Ph.D.", "x", "152.700 Treffer"), (None, None, None, None, None, None), ("bad", "", "", "", "", "")],
        "iso string, de string, amount string, name string, num string, html string",
    )
    got = df.select(c.iso_date(F.col("iso")), c.german_date(F.col("de")), c.german_amount(F.col("amount")), c.bare_name(F.col("name")), c.decimal(F.col("num")).cast("double"), c.bracketed_count(F.col("html")), c.listing_total(F.col("html"))).collect()
    assert tuple(got[0]) == (D(2024, 5, 1), D(2021, 5, 1), 1250000.0, "Anna Fischer", 12.5, 132, 150750)
    # one pass over the titles takes a doubled one off once
    assert tuple(got[1]) == (None, None, 7142500.0, "Dr. Max Mustermann", None, 0, 152700)
    assert tuple(got[2][:5]) == (None,) * 5
    odd = spark.range(1).select(
        c.month_borders(F.lit(D(2024, 1, 31)), F.lit(D(2024, 2, 1))), c.epoch_ms_date(F.lit(1700000000000)), c.title_case(F.lit("UNIVERSITY OF X")), c.programme_type(F.lit("DFG Programme Research GrantsMore Subject Area y")),
        c.programme_type(F.lit("none")), c.snippet(F.lit("abcdef"), 3), c.percent(F.lit(1), F.lit(0)), c.squashed(F.lit(" a \n b "), 9), c.mapped(F.lit("UK"), c.COUNTRY_CODES),
    ).first()
    assert tuple(odd) == (1, D(2023, 11, 14), "University Of X", "Research Grants", None, "abc...", "n/a", "a b", "GB")


def test_dates_codes_and_names_are_cleaned(spark):
    df = grants(spark, [
        row(1, "cordis_bulk", "1", start_date=D(2025, 1, 1), end_date=D(2020, 1, 1), pi_country="UK", currency="$", pi_institution="LEIBNIZ UNIVERSITAET"),
        row(2, "gepris", "2", start_date=D(1900, 1, 1), end_date=D(9999, 12, 31), pi_country="EU", pi_institution="shared A and B through: Institute "),
        row(3, "foerderkatalog", "3", start_date=D(1940, 1, 1), end_date=D(2041, 1, 1), pi_country="EL", pi_institution="Keine Anzeige aufgrund"),
    ])
    got = {r.id: r for r in clean.clean(df).collect()}
    assert (got[1].start_date, got[1].end_date, got[1].pi_country, got[1].currency, got[1].pi_institution) == (D(2020, 1, 1), D(2025, 1, 1), "GB", "AUD", "Leibniz Universitaet")
    assert (got[2].start_date, got[2].end_date, got[2].pi_country, got[2].pi_institution) == (None, None, None, "Institute")
    assert (got[3].start_date, got[3].end_date, got[3].pi_country, got[3].pi_institution) == (None, None, "GR", None)
    fixes = df.agg(*(v.alias(k) for k, v in clean.date_fixes().items())).first()
    assert tuple(fixes) == (1, 1, 1, 1, 0, 1)


def scenario(spark):
    return grants(spark, [
        row(1, "cordis_bulk", "100", total_funding=None, pi_country="DE"), row(2, "openaire_bulk", "100", total_funding=1_200_000.0, pi_country="EU"), row(3, "openaire", "100", total_funding=5.0),
        row(4, "openaire_bulk", "200", key="oaire_DFG_200"), row(5, "gepris", "200", abstract="DFG Programme Emmy NoetherSubject Area x", start_date=D(2020, 1, 1), end_date=D(2026, 1, 1)),
        row(6, "openaire", "300", key="openaire_NIH_300"), row(7, "openaire_bulk", "300", key="oaire_NIH_300"), row(8, "foerderkatalog", "9", total_funding=6e7), row(9, "cordis_bulk", "100"),
        row(10, "foerderkatalog", None, key="fk_x", total_funding=-1.0), row(11, "foerderkatalog", "", key="fk_x"),
    ])


def test_integrity_scenario_is_idempotent(spark):
    funders = binding.funders(spark)
    once = integrity.run_integrity(scenario(spark), funders)
    got = {r.id: r for r in once.collect()}
    assert {i: r.dedup_of for i, r in got.items()} == {1: None, 2: 1, 3: 1, 4: 5, 5: None, 6: 7, 7: None, 8: None, 9: 1, 10: None, 11: 10}
    assert got[1].total_funding == 1_200_000 and got[1].pi_country == "DE" and got[8].is_aggregate and got[10].is_aggregate and not got[1].is_aggregate
    assert got[5].total_funding_estimated == pytest.approx(250_000 * 2192 / 365.25) and got[5].funding_estimate_method == "programme_type"
    codes = {r.id: r.short_name for r in enrich.with_missing_funders(funders).collect()}
    assert [codes[got[i].funder_id] for i in (1, 2, 4, 5, 6, 8)] == ["EC", "EC", "DFG", "DFG", "NIH", "BMBF"]
    again = integrity.run_integrity(once, funders)
    assert sorted(map(str, again.collect())) == sorted(map(str, once.collect()))
    counts = integrity.integrity_counts(scenario(spark), once).first()
    assert counts.ec_duplicates_flagged == 2 and counts.gepris_duplicates_flagged == 1 and counts.within_source_flagged == 2 and counts.aggregates_flagged == 2
    # each step by itself agrees with the fused one
    steps = dedup.flag_within_source(dedup.flag_source_duplicates(enrich.enrich_between_sources(enrich.link_funders(clean.clean(scenario(spark)), enrich.with_missing_funders(funders)))))
    assert {r.id: (r.dedup_of, r.total_funding) for r in steps.collect()} == {i: (r.dedup_of, r.total_funding) for i, r in got.items()}


def test_rates_of_the_nearest_year(spark):
    rows = [(1, 1142.0, "USD", D(2020, 5, 1)), (2, 3.64e9, "INR", D(2020, 1, 1)), (3, 10.0, "XXX", D(2020, 1, 1)), (4, 10.0, None, None), (5, 131.0, "USD", D(1990, 1, 1)), (6, 109.0, "USD", D(2035, 1, 1)), (7, None, "USD", D(2020, 1, 1)), (8, 5.0, "", None), (9, 10.0, " usd ", D(2020, 1, 1)), (10, 1.482, "CAD", D(2007, 7, 1))]
    df = grants(spark, [{"id": i, "total_funding": a, "currency": k, "start_date": s} for i, a, k, s in rows])
    rates = fx.rate_table(spark)
    got = {r.id: r.total_funding_eur for r in fx.to_eur(df, rates).collect()}
    assert got[1] == pytest.approx(1000) and got[2] == pytest.approx(43_005_671, abs=1) and got[3] is None and got[4] == 10 and got[5] == pytest.approx(100) and got[6] == pytest.approx(100) and got[7] is None and got[8] == 5 and got[9] is None
    assert {r.id: r.total_funding_eur for r in fx.to_eur(df, rates, normalise=True).collect()}[9] == pytest.approx(10 / 1.142)
    assert fx.conversion_counts(fx.to_eur(df, rates)).first().unmapped == 2


def test_queries_on_small_tables(spark):
    df = grants(spark, [
        row(1, "cordis_bulk", "1", project_title="Quantum gates", pi_institution="HANNOVER U", total_funding=1200.0, start_date=D(2024, 1, 1), end_date=D(2025, 1, 1), acronym="A"),
        row(2, "cordis_bulk", "2", project_title="Other", topic_keywords=["quantum"], pi_institution="HANNOVER U", total_funding=100.0, start_date=D(2023, 5, 1), end_date=D(2028, 5, 1), acronym="B"),
        row(3, "gepris", "3", project_title="Nothing", pi_institution="Else", total_funding=5.0, start_date=D(2040, 1, 1), end_date=D(2041, 1, 1)),
    ])
    calls = spark.createDataFrame([(1, "ERC-1", "x", D(2024, 2, 1), "open", 1.0, "EUR", "CORDIS", "s", "u", ["sme"]), (2, "C-2", "x", None, "open", 1.0, "EUR", None, "s", "u", None), (3, "C-3", "quantum", D(2025, 2, 1), "forthcoming", 1.0, "EUR", "H", "s", "u", []), (4, "EIC-4", "x", D(2024, 1, 5), "closed", 1.0, "EUR", "H", "s", "u", [])],
                                  "id long, call_identifier string, title string, deadline date, status string, budget_total double, currency string, framework_programme string, source string, url string, topic_keywords array<string>")
    ids = lambda d: [r.call_identifier for r in d.collect()]
    assert ids(analytics.open_calls(calls, "2024-01-01")) == ["ERC-1"] and ids(analytics.open_calls(calls, "2024-01-01", 6, False)) == ["ERC-1", "C-2"] and ids(analytics.sme_calls(calls)) == ["ERC-1"]
    assert [tuple(r) for r in analytics.income_projection(df, "%HANNOVER%").select("year", "active_grants").collect()] == [(2024, 2), (2025, 2), (2026, 1), (2027, 1), (2028, 1)]
    full = analytics.income_projection(df.where("id = 1"), "%HANNOVER%").collect()
    assert full[0].projected_income == pytest.approx(1200 / 12 * 11)
    assert [tuple(r) for r in analytics.top_institutions(df).collect()] == [("HANNOVER U", None, 2, 1300.0, ["A", "B"])]
    gaps = {r.framework_programme: r.our_status for r in analytics.programme_gaps(calls, df, "%HANNOVER%", "2024-01-01").collect()}
    assert gaps == {"CORDIS": "Applied", "H": "Never applied"}
    assert "Funding landscape" in report.landscape_report(df.withColumn("dedup_of", F.lit(None).cast("long")), calls, "2024-01-01")
    assert audit.missing_data(df, 1).count() == 2 and audit.anomalies(df, "2024-01-01").first().far_future_start == 1


def test_patterns_match_in_order_without_overlap(spark):
    df = grants(spark, [{"id": 1, "project_title": "A QUANTUM thing", "abstract": "shor then grover search"}, {"id": 2, "project_title": None, "abstract": "search, grover"}, {"id": 3, "project_title": "search", "abstract": "grover"}, {"id": 4, "project_title": "aba", "abstract": ""}])
    patterns = spark.createDataFrame([("x", "%grover%search%"), ("x", "%quantum%"), ("y", "%ab%ba%"), ("z", "%"), ("y", "%(a|b)%")], "application string, pattern string")
    got = {(r.application, r.id) for r in match.matches(df, patterns).collect()}
    assert got == {("x", 1), ("z", 1), ("z", 2), ("z", 3), ("z", 4)}
    apps = spark.createDataFrame([("d", "s", "x", "unknown", "proven", "theoretical", 1994), ("d", "s", "y", "quadratic", "debated", "production", 1999)], "domain string, subdomain string, name string, advantage_type string, advantage_status string, maturity string, year_first_proposed int")
    links = match.funding_links(df.withColumn("funder_id", F.lit(1)), patterns, apps, binding.funders(spark))
    assert {r.application: (r.grant_count, r.top_funders) for r in links.collect()} == {"x": (1, "EC(1)"), "y": (0, "")}
    assert rollups.subdomain_summary(apps).first().best_advantage_type == "quadratic" and rollups.decades(apps).first().applications == ["x", "y"]
    assert "Domains" in report.catalogue_report(apps, links)
    assert match.review_sample(df, patterns, over=3, k=2, seed=1).count() == 2
    with pytest.raises(ValueError):
        match.pieces("no wildcards")


def test_institutions_match_exactly_and_by_similarity(spark):
    organisations = spark.createDataFrame(
        [("r1", [("Universität Müncheberg", ["ror_display"]), ("Univ. Muencheberg", ["alias"])], [(("DE",),)], 0), ("r2", [("Delft Institute of Things", ["label"])], [(("NL",),)], 1), ("r3", [("Universitat Muncheberg", ["label"])], [], 2)],
        "id string, names array<struct<value: string, types: array<string>>>, locations array<struct<geonames_details: struct<country_code: string>>>, position long",
    )
    registry = entity.registry_names(organisations)
    df = grants(spark, [row(i, s, str(i), pi_institution=n) for i, (s, n) in enumerate([("cordis_bulk", "universitat MUNCHEBERG!"), ("gepris", "Institute of Things Delfts"), ("foerderkatalog", "Delft Institute of Thing"), ("gepris", "abcd"), ("gepris", None)])])
    got = {r.id: r.ror_id for r in entity.match_institutions(df, registry).collect()}
    assert got == {0: "r3", 1: "r2", 2: None, 3: None, 4: None}
    names = ["alpha beta university", "beta alpha universty", "gamma institute", "gama institut", "delta"]
    df1, df2 = (spark.createDataFrame([(" ".join(sorted(n.split())),) for n in ns], "t string") for ns in (names, names))
    pairs = {(r.a, r.b) for r in entity.similar_pairs(df1, df2, 85).collect()}
    sorted_names = [" ".join(sorted(n.split())) for n in names]
    assert pairs == {(a, b) for a in sorted_names for b in sorted_names if 200 * entity.common_subsequence(a, b) / (len(a) + len(b)) >= 85}
    assert entity.common_subsequence("abcbdab", "bdcaba") == 4


def test_merging_rows(spark):
    target = spark.createDataFrame([(1, "s", "a", "old", "EUR"), (2, "s", "b", "old", "EUR")], "id long, source string, source_id string, title string, currency string")
    batch = spark.createDataFrame([("s", "a", "first", "USD", 1), ("s", "a", "new", "USD", 2), ("s", "c", "new", "USD", 3), (None, "d", "x", "y", 4)], "source string, source_id string, title string, currency string, position long")
    out = merge.merge_upsert(target, batch, ["source", "source_id"], ["title"])
    got = {r.source_id: r for r in out.collect()}
    assert {k: (r.title, r.currency) for k, r in got.items()} == {"a": ("new", "EUR"), "b": ("old", "EUR"), "c": ("new", "USD")} and got["a"].id == 1 and got["c"].id is not None
    again = merge.merge_upsert(out, batch, ["source", "source_id"], ["title"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    more = merge.append_with_ids(target, spark.createDataFrame([("s", f"n{i}", "t", "EUR") for i in range(20)], "source string, source_id string, title string, currency string"), ["source_id"])
    assert sorted(r.id for r in more.collect()) == list(range(1, 23))
    diff = {(r.source_id, r.change, r.field) for r in merge.snapshot_diff(target, out, ["source_id"], ["title", "currency"]).collect()}
    assert diff == {("a", "updated", "title"), ("c", "new", None)}
    good, bad = schemas.validate(spark.createDataFrame([(1, "a"), (2, "zz")], "id long, v string"), {"known": F.col("v").isin("a")})
    assert [r.id for r in good.collect()] == [1] and [r.broken_rules for r in bad.collect()] == [["known"]]


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_appended_ids_are_gapless_at_any_size(spark, adaptive):
    old = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        target = spark.range(1, 6).select("id", F.lit("t").alias("name"), F.lit(0).cast("long").alias("k"))
        # a third of the rows has the same name
        batch = spark.range(0, 2_000_000, 1, 20).select(F.when(F.col("id") % 3 == 0, "same").otherwise(F.md5(F.col("id").cast("string"))).alias("name"), F.col("id").alias("k"))
        out = merge.append_with_ids(target, batch, ["name"]).where("id > 5")
        r = out.agg(F.count("*").alias("n"), F.count_distinct("id").alias("d"), F.min("id").alias("a"), F.max("id").alias("b"), F.count_distinct("k").alias("k")).first()
        assert tuple(r) == (2_000_000, 2_000_000, 6, 2_000_005, 2_000_000)
        ends = out.groupBy(F.substring("name", 1, 2).alias("h")).agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("h").collect()
        assert all(x.b < y.a for x, y in zip(ends, ends[1:]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old[0])
        spark.conf.set("spark.sql.shuffle.partitions", old[1])


def test_appending_nothing_and_rows_without_an_order(spark):
    target = spark.createDataFrame([(7, "x")], "id long, name string")
    assert merge.append_with_ids(target, target.drop("id").limit(0), ["name"]).collect() == target.collect()
    more = spark.createDataFrame([(None,), ("a",), (None,)], "name string")
    assert sorted((r.id, r.name) for r in merge.append_with_ids(target, more, ["name"]).collect()) == [(7, "x"), (8, None), (9, None), (10, "a")]
    assert [r.id for r in merge.append_with_ids(target.limit(0), more, ["name"]).orderBy("id").collect()] == [1, 2, 3]


def test_a_load_touches_only_the_parts_of_its_keys(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], "id long, k string, v string, w string").schema
    files = lambda: {str(p.relative_to(path)): p.stat().st_mtime_ns for p in (tmp_path / "t" / "data").rglob("*.parquet")}
    rows = lambda: {r.k: (r.v, r.w) for r in parted.read_table(spark, path, schema).collect()}
    first = spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("1").alias("v"), F.lit("1").alias("w"))
    assert parted.upsert(first, path, schema, ["k"], ["v"]) == 400 and len(rows()) == 400
    before, parts = files(), parted.commit_of(spark, path)["parts"]
    assert len(parts) > 50
    second = spark.createDataFrame([("k5", "2", "2"), ("new", "2", "2"), (None, "2", "2")], "k string, v string, w string")
    assert parted.upsert(second, path, schema, ["k"], ["v"], 2) == 3
    now = parted.commit_of(spark, path)["parts"]
    assert sum(now[p] != parts.get(p) for p in now) <= 2 and before.items() <= files().items()
    assert rows()["k5"] == ("2", "1") and rows()["new"] == ("2", "2") and rows()["k6"] == ("1", "1") and len(rows()) == 401
    whole = files()
    assert parted.upsert(second, path, schema, ["k"], ["v"], 2) == 3 and files() == whole  # the same load again
    assert len(parted.read_table(spark, path, schema, 1).collect()) == 400

    bad = spark.createDataFrame([("k7", "3", "3"), ("k8", "3", "3")], "k string, v string, w string").withColumn("v", F.when(F.col("k") == "k8", F.raise_error(F.lit("torn"))).otherwise(F.col("v")))
    seen = rows()
    with pytest.raises(Exception, match="torn"):
        parted.upsert(bad, path, schema, ["k"], ["v"])
    assert rows() == seen and parted.commits(spark, path) == [1, 2]
    assert parted.upsert(second.limit(0), path, schema, ["k"], ["v"]) == 0 and rows() == seen
    assert parted.vacuum(spark, path, kept=1) >= 1 and rows() == seen and parted.commits(spark, path) == [3]


def test_a_crash_before_the_commit_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], "id long, k string, v string").schema
    rows = lambda: {r.k: r.v for r in parted.read_table(spark, path, schema).collect()}
    make = lambda *r: spark.createDataFrame(list(r), "k string, v string")
    parted.upsert(make(("a", "1"), ("b", "1")), path, schema, ["k"], ["v"], 1)

    def crash(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(parted, "_commit", crash)
        with pytest.raises(KeyboardInterrupt):
            parted.upsert(make(("a", "2"), ("c", "2")), path, schema, ["k"], ["v"], 2)
    assert rows() == {"a": "1", "b": "1"}
    parted.upsert(make(("a", "2"), ("c", "2")), path, schema, ["k"], ["v"], 2)
    assert rows() == {"a": "2", "b": "1", "c": "2"}
    with pytest.raises(RuntimeError):
        parted._commit(spark, path, 2, {"rows": 0, "parts": {}})  # a second writer of the same number


def test_institutions_of_a_large_project_are_dealt_into_blocks(spark):
    rows = [(f"p{i % 3}", f"inst{i % 40}") for i in range(200)] + [("", "x"), (None, "y"), ("p9", ""), ("p9", None), ("p8", "alone")]
    df = spark.createDataFrame(rows, "project_id string, pi_institution string")
    sets = {}
    for p, i in rows:
        if p and i:
            sets.setdefault(p, set()).add(i)
    expected = {}
    for s in sets.values():
        for a in s:
            for b in s:
                if a < b:
                    expected[a, b] = expected.get((a, b), 0) + 1
    for block in (1, 7, 500):
        assert {(r.a, r.b): r.projects for r in refresh.co_participation(df, block).collect()} == expected


def test_refresh_keeps_the_rows_of_a_source_that_fails(spark, tmp_path):
    def broken():
        raise OSError("not there")

    old = grants(spark, [row(1, "cordis_bulk", "1")])
    new = grants(spark, [row(2, "gepris", "2")])
    path = str(tmp_path / "grants")
    assert refresh.load_sources(spark, path, {"cordis_bulk": lambda: old}) == {"cordis_bulk": "ok"}
    out, states = refresh.refresh(spark, path, binding.funders(spark), {"cordis_bulk": broken, "gepris": lambda: new})
    assert states == {"cordis_bulk": "error: OSError", "gepris": "ok"} and {r.source for r in out.collect()} == {"cordis_bulk", "gepris"}


def test_no_similar_pair_is_lost_at_any_cutoff(spark):
    import random

    rng = random.Random(3)
    names = sorted({"".join(rng.choice("abcd ") for _ in range(rng.randint(1, 12))).strip() or "a" for _ in range(160)} | {"abcde", "abxde"})
    df = spark.createDataFrame([(n,) for n in names], "t string")
    for cutoff, block in ((68, 1000), (70, 3), (80, 20), (90, 1), (97, 1000), (100, 5)):
        expected = {(a, b) for a in names for b in names if 200 * entity.common_subsequence(a, b) / (len(a) + len(b)) >= cutoff}
        assert {(r.a, r.b) for r in entity.similar_pairs(df, df, cutoff, block).collect()} == expected
    words = ["institute", "of", "technology", "university", "national", "centre", "for", "physics", "north", "south"]
    long = sorted({" ".join(sorted(rng.choice(words)[: rng.randint(1, 12)] for _ in range(rng.randint(2, 6)))) for _ in range(120)})
    many = spark.createDataFrame([(n,) for n in long], "t string")
    for cutoff in (75, 90):
        expected = {(a, b) for a in long for b in long if 200 * entity.common_subsequence(a, b) / (len(a) + len(b)) >= cutoff}
        assert {(r.a, r.b) for r in entity.similar_pairs(many, many, cutoff, 10).collect()} == expected
    with pytest.raises(ValueError):
        entity.similar_pairs(df, df, 60)
    odd = spark.createDataFrame([(None,), ("",), ("b a",)], "t string")
    assert [tuple(r)[:2] for r in entity.similar_pairs(odd, odd, 90).collect()] == [("b a", "b a")]


def test_escaped_wildcards_are_literal(spark):
    assert match.pieces(r"%a\_b%") == ["a_b"] and match.pieces(r"%50\%%x\\%") == ["50%", "x\\"] and match.pieces("%") == []
    texts = spark.createDataFrame([(1, "xA_By"), (2, "a-b c"), (3, "axb"), (4, None), (None, "a_b")], "id long, project_title string").withColumn("abstract", F.lit(None).cast("string"))
    found = lambda *p: {tuple(r) for r in match.matched_patterns(texts, spark.createDataFrame([("x", q) for q in p], "application string, pattern string")).collect()}
    assert found(r"%a\_b%", "%A%c%") == {(1, r"%a\_b%", "project_title"), (2, "%A%c%", "project_title")}
    assert found("%", "%%") == {(i, p, "project_title") for i in (1, 2, 3) for p in ("%", "%%")}
    for wrong in ("a%", "%a", "%a_b%", "", r"%a\%"):
        with pytest.raises(ValueError):
            match.pieces(wrong)


def test_needles_in_texts_equal_brute_force(spark):
    import random

    rng = random.Random(6)
    some = lambda n, letters="abcé ": "".join(rng.choice(letters) for _ in range(n))
    texts = [some(rng.randint(0, 300)) for _ in range(120)] + ["", "a", "same " * 30, "same " * 30, "日本語" * 9, "ab" * 500_000]
    needles = {t[i : i + n] for t in texts[:120] for n in (1, 2, 3, 5, 8, 13, 21, 40) if len(t) > n for i in [rng.randrange(len(t) - n)]}
    needles |= {"", "zz", "same same", "語日", "ab" * 200, "ba" * 3, some(25, "xyz")} | {some(rng.randint(1, 9)) for _ in range(200)}
    rows = spark.createDataFrame([*enumerate(texts), (None, "a"), (999, None)], "key long, text string").repartition(3)
    wanted = spark.createDataFrame([(n,) for n in [*needles, None, "same same"]], "needle string")
    expected = {(k, n) for k, t in enumerate(texts) for n in needles if n in t}
    for most, size in ((1, 10**6), (10**6, 0), (3, 0)):  # needles sent to tasks, their grams sent, grams joined
        got = [(r.key, r.needle) for r in substring_join.containing(rows, wanted, most, size).select("key", "needle").collect()]
        assert len(got) == len(set(got)) and set(got) == expected
        assert substring_join.containing(rows, wanted.limit(0), most, size).count() == 0 and substring_join.containing(rows.limit(0), wanted, most, size).count() == 0


def test_pieces_stand_in_order(spark):
    import random

    rng = random.Random(8)
    some = lambda n: "".join(rng.choice("abcAB ") for _ in range(n))
    texts, patterns = [some(rng.randint(0, 30)) for _ in range(150)], sorted({"%" + "%".join(some(rng.randint(0, 3)) for _ in range(rng.randint(1, 4))) + "%" for _ in range(120)})

    def like(text, pattern):
        at = 0
        for piece in pattern.lower().split("%"):
            at = text.lower().find(piece, at)
            if at < 0:
                return False
            at += len(piece)
        return True

    df = spark.createDataFrame(list(enumerate(texts)), "id long, project_title string").withColumn("abstract", F.lit(None).cast("string"))
    got = {(r.key, r.pattern) for r in match.matched_patterns(df, spark.createDataFrame([("x", p) for p in patterns], "application string, pattern string")).collect()}
    assert got == {(i, p) for i, t in enumerate(texts) for p in patterns if like(t, p)}


def test_a_bad_file_anywhere_fails_its_source_alone(spark, tmp_path):
    good = spark.createDataFrame([("gepris", "gepris_1", "T")], "source string, source_id string, project_title string")
    rows = spark.range(0, 100, 1, 10).selectExpr("'cordis_bulk' as source", "concat('c', id) as source_id", "if(id = 99, raise_error('bad file'), 'x') as project_title")
    old = spark.createDataFrame([("cordis_bulk", "old", "O")], "source string, source_id string, project_title string")
    path = str(tmp_path / "grants")
    refresh.load_sources(spark, path, {"cordis_bulk": lambda: old})
    out, states = refresh.refresh(spark, path, binding.funders(spark), {"cordis_bulk": lambda: rows, "gepris": lambda: good, "other": lambda: good})
    assert states.pop("other").startswith("error")  # rows of another source
    assert states["gepris"] == "ok" and states["cordis_bulk"].startswith("error")
    assert {r.source_id for r in out.collect()} == {"old", "gepris_1"}
