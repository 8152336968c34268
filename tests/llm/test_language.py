import random
import re
from collections import defaultdict

import numpy as np

from grantlake.llm.language import BUCKETS, EVIDENCE, LANGUAGES, SMOOTH_HOST, SMOOTH_TABLE, identify
from tests.llm.odd import documents


def test_pages_get_the_language_of_their_text(spark, sf):
    pages, docs = spark.read.parquet(f"{sf}/pages.parquet"), spark.read.parquet(f"{sf}/documents.parquet")
    rows = identify(pages, docs).collect()
    assert len(rows) == pages.count()
    assert sum(r.language == r.declared for r in rows) / len(rows) > 0.98
    assert all(0 < r.probability <= 1 for r in rows)


def test_weak_text_is_decided_by_declaration_and_host(spark):
    docs = spark.createDataFrame([("le chat est sur la table avec nous " * 20, "fr"), ("the cat is on the table with us " * 20, "en"), ("der Hund ist auf dem Tisch mit uns " * 20, "de"), (None, "fr"), ("x", None)], "text string, lang string")
    french = "<html lang='fr'><body><p>le chat est sur la table avec nous"
    english = "<html lang='en'><body><p>the cat is on the table with us"
    rows = [(i, f"https://a.example.fr/{i}", french) for i in range(30)] + [(100 + i, f"https://b.example.com/{i}", english) for i in range(30)]
    rows += [(200, "https://a.example.fr/x", "<p>42"), (201, "https://b.example.com/x", "<p>42"), (202, "https://new.example.fr/", ""), (203, "https://other.example/", "<html lang=fr>"), (204, "https://a.example.fr/y", english)]
    got = {r.page_id: r.language for r in identify(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()}
    assert [got[i] for i in (200, 201, 202, 203, 204)] == ["fr", "en", "fr", "fr", "en"]


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (2, "", ""), (None, "http://a.example/", "<p>x"), (3, "no host", "plain text only")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, host string")
    docs = documents(spark)
    assert len(identify(pages, docs).collect()) == len(rows)
    assert {r.language for r in identify(pages, docs.limit(0)).collect()} == {None}
    assert identify(pages.limit(0), docs).count() == 0


def test_no_language_is_dropped_however_many_there_are(spark):
    rng = random.Random(3)
    codes = [a + b for a in "abcdef" for b in "klmnopq"][: LANGUAGES + 8]
    text = {}
    for code in codes:
        letters = rng.sample("abcdefghijklmnopqrstuvwxyz", 6)
        text[code] = [" ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(30)) for _ in range(2)]
    docs = [(t, code) for i, code in enumerate(codes) for t in text[code] * (len(codes) - i)]  # the last ones are the rarest
    pages = [(i, f"https://h{i}.example/", f"<html lang='{code}'><body><p>{text[code][0]}") for i, code in enumerate(codes)]
    rows = identify(spark.createDataFrame(pages, "page_id long, url string, html string"), spark.createDataFrame(docs, "text string, lang string")).collect()
    assert {r.page_id: r.language for r in rows} == dict(enumerate(codes))


def plain_fusion(pages, documents):
    """{page_id: (language, probability)}: the fusion of all evidence in plain Python; pages are (id, url, html with text only in p)."""

    def buckets(text):
        data = f" {' '.join(re.findall('[^\\x00-@\\[-`{-\x7f]+', re.sub('[A-Z]', lambda m: m[0].lower(), text)))} ".encode()
        return [(((a << 16 | b << 8 | c) * 2654435761) % 2**32) >> 18 for a, b, c in zip(data, data[1:], data[2:])]

    langs = sorted({x for _, x in documents})
    counts = {x: np.full(BUCKETS, 0.5) for x in langs}
    for text, lang in documents:
        for b in buckets(text):
            counts[lang][b] += 1
    logs = {x: np.log(c / c.sum()) for x, c in counts.items()}
    seen, sums = {}, {k: defaultdict(lambda: np.zeros(len(langs))) for k in ("host", "domain", "suffix", "declared", "all")}
    for page, url, html in pages:
        own = buckets(" ".join(re.findall("<p>([^<]*)", html)))
        score = np.array([sum(logs[x][b] for b in own) for x in langs])
        score = np.maximum((score - score.max()) * min(1.0, 1 / np.sqrt(max(len(own), 1) / 50)), -EVIDENCE)
        p = np.exp(score) / np.exp(score).sum()
        host = re.match("https?://([^/]*)", url)[1]
        declared = (re.search("lang='([a-z]+)'", html) or [None, ""])[1]
        keys = {"host": host, "domain": ".".join(host.split(".")[-2:]), "suffix": host.split(".")[-1], "declared": declared, "all": ""}
        seen[page] = score, keys
        for k, v in keys.items():
            sums[k][v] += p
    every = sums["all"][""] + 1 / len(langs)
    every /= every.sum()
    drawn = lambda n, q, k: (n + k * q) / (n.sum() + k)
    out = {}
    for page, (score, keys) in seen.items():
        suffix = drawn(sums["suffix"][keys["suffix"]], every, SMOOTH_HOST)
        domain = drawn(sums["domain"][keys["domain"]], suffix, SMOOTH_HOST)
        host = drawn(sums["host"][keys["host"]], domain, SMOOTH_HOST)
        odds = score + np.log(host) + np.log(drawn(sums["declared"][keys["declared"]], every, SMOOTH_TABLE) / every)
        odds = np.exp(odds - odds.max())
        out[page] = langs[int(odds.argmax())], odds.max() / odds.sum()
    return out


def test_fusion_equals_plain_python(spark):
    rng = random.Random(6)
    vocabulary = {"aa": "karo lami tosu", "bb": "wexi lami quzo", "cc": "pyth gron tosu"}
    text = lambda lang, n: " ".join(rng.choice(vocabulary[lang].split()) for _ in range(n))
    docs = [(text(x, 40), x) for x in vocabulary for _ in range(6)]
    pages = []
    for i in range(120):
        lang = rng.choice("aabbc") * 2
        host = f"{rng.choice(['www', 'blog'])}.site{rng.randint(1, 4)}.{lang if rng.random() < 0.7 else 'com'}"
        declared = rng.choice([f" lang='{lang}'", "", " lang='bb'"])
        pages.append((i, f"https://{host}/{i}", f"<html{declared}><body><p>{text(lang, rng.randint(0, 6))}</p></body></html>"))
    expected = plain_fusion(pages, docs)
    rows = identify(spark.createDataFrame(pages, "page_id long, url string, html string"), spark.createDataFrame(docs, "text string, lang string")).collect()
    assert len(rows) == 120 and all(abs(r.probability - expected[r.page_id][1]) < 1e-6 and r.language == expected[r.page_id][0] for r in rows)
    assert len({r.language for r in rows}) == 3
