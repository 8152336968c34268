"""SQL of those training-data queries that plain SQL can express, written from the description of each result."""

from __future__ import annotations

from grantlake.llm.decontam import SPAN
from grantlake.llm.grid_codes import ENTRIES, PARTS, ROUNDS, SCALE
from grantlake.llm.licences import PHRASES
from grantlake.llm.neardup import SHINGLE, SIMILARITY

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
DOCS = f"docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents)"


def windows(width: str) -> str:
    """Texts of all runs of so many words of w, as a list in order."""
    return f"list_transform(generate_series(1, len(w) - {width} + 1), lambda i: array_to_string(w[i : i + {width} - 1], ' '))"


def filter_audit() -> str:
    """Every order applied to every mask, without intervals."""
    fails = {"A": "len(w) < 200", "B": "100 * len(list_distinct(w)) < 50 * len(w)", "C": "100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t)", "D": "regexp_matches(t, '[#$%&*|]')", "E": "coalesce(doc_id > least_id, false)"}
    return rf"""WITH RECURSIVE docs AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
            min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least_id FROM documents),
        marks AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        masks AS (SELECT part, {" || ".join(f"CASE WHEN {c} THEN '{f}' ELSE '' END" for f, c in fails.items())} AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM docs LEFT JOIN marks USING (doc_id)),
        counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masks GROUP BY part, mask),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS filter),
        orders AS (SELECT '' AS o UNION ALL SELECT o || filter FROM orders, letters WHERE NOT contains(o, filter)),
        steps AS (SELECT o, step, o[step] AS filter FROM orders, (SELECT unnest(generate_series(1, 5)) AS step) WHERE length(o) = 5),
        gone AS (SELECT part, o, n, good, toxic, list_min(list_filter([instr(o, f) for f in string_split(mask, '')], lambda i: i > 0)) AS step FROM counts, (SELECT DISTINCT o FROM steps) WHERE mask <> ''),
        removed AS (SELECT part, o, step, sum(n) AS n, sum(good) AS good, sum(toxic) AS toxic FROM gone GROUP BY part, o, step),
        totals AS (SELECT part, filter, sum(n) AS total, sum(CASE WHEN contains(mask, filter) THEN n ELSE 0 END) AS failing, sum(CASE WHEN mask = filter THEN n ELSE 0 END) AS alone FROM counts, letters GROUP BY part, filter),
        rows AS (SELECT part, o, step, filter, total, failing, alone, coalesce(n, 0) AS n, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM steps JOIN totals USING (filter) LEFT JOIN removed USING (part, o, step))
        SELECT part, o AS filter_order, CAST(step AS INT) AS step, filter, CAST(total - sum(n) OVER (PARTITION BY part, o ORDER BY step) AS BIGINT) AS kept, CAST(n AS BIGINT) AS removed, CAST(failing - n AS BIGINT) AS redundant,
        CAST(alone AS BIGINT) AS unique_fails, CAST(good AS BIGINT) AS good_lost, CAST(toxic AS BIGINT) AS toxic_lost, CAST(sum(n) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM rows"""


def vector_codes() -> str:
    """Every part against every entry of its codebook, four rounds unrolled."""
    nearest = """SELECT r, p, min(d * 256 + e) % 256 AS e, min(d * 256 + e) // 256 AS d FROM (SELECT r, parts.p, e,
        CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS BIGINT) AS d FROM parts JOIN book{} USING (p)) GROUP BY r, p"""
    rounds = [
        f"""near{i} AS MATERIALIZED ({nearest.format(i)}),
        means{i} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, e, i, CAST(floor(sum(x[i]) / count(*)) AS DOUBLE) AS m FROM near{i} JOIN parts USING (r, p), (SELECT unnest(generate_series(1, (SELECT max(len(x)) FROM parts))) AS i) GROUP BY p, e, i) GROUP BY p, e),
        book{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(means{i}.c, book{i}.c) AS c FROM book{i} LEFT JOIN means{i} USING (p, e)),"""
        for i in range(ROUNDS)
    ]
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        cuts AS (SELECT unnest(generate_series(0, {PARTS - 1})) AS p),
        parts AS MATERIALIZED (SELECT r, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x FROM kept, cuts),
        book0 AS MATERIALIZED (SELECT p, e, x AS c FROM parts JOIN (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {ENTRIES}) USING (r)),
        {' '.join(rounds)}
        last AS MATERIALIZED ({nearest.format(ROUNDS)}),
        coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM last GROUP BY r),
        digest AS (SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM (SELECT p, e, unnest(c) AS y, unnest(generate_series(1, len(c))) AS i FROM book{ROUNDS}))
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded JOIN kept USING (r), digest"""


ORACLE = {
    "op3_decontamination": f"""WITH {DOCS},
        items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
        wins AS (SELECT DISTINCT item_id, n, unnest({windows('n')}) AS key FROM (SELECT *, least(len(w), {SPAN}) AS n FROM items) WHERE n > 0),
        lists AS (SELECT r, n, {windows('n')} AS keys FROM docs, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n),
        places AS (SELECT r, n, unnest(keys) AS key, unnest(generate_series(1, len(keys))) AS p FROM lists),
        hits AS (SELECT r, p, n, item_id FROM places JOIN wins USING (n, key)),
        covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY r),
        found AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hits GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
        coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)""",
    "op6_minhash_near_dedup": f"""WITH RECURSIVE {DOCS},
        texts AS (SELECT array_to_string(w, ' ') AS key, any_value(w) AS w, min(doc_id) AS d FROM docs WHERE len(w) > 0 GROUP BY 1),
        shingles AS (SELECT d, s, count(*) AS c FROM (SELECT d, unnest({windows('n')}) AS s FROM (SELECT *, least(len(w), {SHINGLE}) AS n FROM texts)) GROUP BY d, s),
        sizes AS (SELECT d, sum(c) AS n FROM shingles GROUP BY d),
        shared AS (SELECT x.d AS a, y.d AS b, sum(least(x.c, y.c)) AS o FROM shingles x JOIN shingles y ON x.s = y.s AND x.d <> y.d GROUP BY 1, 2),
        edges AS (SELECT a, b FROM shared JOIN sizes x ON x.d = a JOIN sizes y ON y.d = b WHERE o / (x.n + y.n - o) >= {SIMILARITY}),
        reach AS (SELECT d, d AS l FROM texts UNION SELECT e.b, r.l FROM reach r JOIN edges e ON e.a = r.d),
        classes AS (SELECT d, min(l) AS class_id FROM reach GROUP BY d)
        SELECT doc_id, coalesce(class_id, doc_id) AS class_id FROM docs LEFT JOIN texts ON texts.key = array_to_string(docs.w, ' ') AND len(docs.w) > 0 LEFT JOIN classes USING (d)""",
    "quality_base": rf"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        lines AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM docs),
        places AS (SELECT r, unnest(keys) AS key, unnest(generate_series(1, len(keys))) AS p FROM (SELECT r, {windows('8')} AS keys FROM docs WHERE len(w) >= 8)),
        again AS (SELECT r, p FROM places QUALIFY count(*) OVER (PARTITION BY r, key) > 1),
        covered AS (SELECT r, count(DISTINCT q) AS n_repeat_words FROM (SELECT r, unnest(generate_series(p, p + 7)) AS q FROM again) GROUP BY r),
        counted AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
            CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM lines LEFT JOIN covered USING (r))
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted""",
    "licence_base": f"""WITH {DOCS},
        phrases AS (SELECT phrase, label, len(string_split(phrase, ' ')) AS n FROM (VALUES {", ".join(f"('{p}', '{x}')" for p, x in PHRASES.items())}) AS t(phrase, label)),
        lists AS (SELECT r, n, {windows('n')} AS keys FROM docs, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n),
        places AS (SELECT r, n, unnest(keys) AS phrase, unnest(generate_series(0, len(keys) - 1)) AS p FROM lists),
        found AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places JOIN phrases USING (n, phrase) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels FROM docs LEFT JOIN found USING (r)""",
    "op11_vector_codes": vector_codes(),
    "op13_filter_audit": filter_audit(),
}
