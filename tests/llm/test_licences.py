import random
import re

import numpy as np

from grantlake.llm.licences import LEAST, PHRASES, TEMPLATES, Automaton, Scanner, licence_scan
from tests.llm.odd import documents

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    at = [p for p, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def test_matching_statistics_equal_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        templates = [[rng.randrange(1, 4) for _ in range(rng.randrange(1, 12))] for _ in range(rng.randrange(1, 5))]
        automaton = Automaton(templates)
        text = [rng.randrange(1, 5) for _ in range(40)]
        runs = {tuple(t[i:j]): None for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
        for i, (length, state) in enumerate(automaton.statistics(text)):
            assert length == max((n for n in range(i + 2) if n == 0 or tuple(text[i + 1 - n : i + 1]) in runs))
            if length:
                ends = [(t, at) for t, of in enumerate(templates) for at in range(length - 1, len(of)) if of[at + 1 - length : at + 1] == text[i + 1 - length : i + 1]]
                assert automaton.ends[state] == ends


def test_matches_of_every_template_equal_brute_force():
    rng = random.Random(5)
    letters = "abcdefgh"
    for _ in range(40):
        texts = [" ".join(rng.choice(letters) for _ in range(rng.randrange(3, 16))) for _ in range(3)]
        texts.append(texts[0] + " " + texts[1])  # a template inside another
        scanner = Scanner({f"t{i}": {"text": t} for i, t in enumerate(texts)}, {})
        words_ = [rng.choice(letters + "z") for _ in range(25)] + texts[3].split() + texts[1].split()
        ids = np.array([scanner.vocabulary.get(w.encode(), 0) for w in words_])
        expected = set()
        for n, t in enumerate(texts):
            of = t.split()
            best = [max((k for k in range(1, i + 2) if any(of[j : j + k] == words_[i + 1 - k : i + 1] for j in range(len(of)))), default=0) for i in range(len(words_))]
            for i, k in enumerate(best):
                if k >= LEAST and (i + 1 == len(best) or best[i + 1] <= k):
                    expected |= {(i + 1 - k, i + 1, n, j + k - 1) for j in range(len(of)) if of[j : j + k] == words_[i + 1 - k : i + 1]}
        got = [(a, b, n, last) for a, b, places in scanner.matches(ids) for n, last in places]
        assert len(got) == len(set(got)) and set(got) == expected


def test_a_template_covered_inside_another_one_is_found():
    words_of = lambda p, n: [f"{p}{i}" for i in range(n)]
    b = words_of("b", 50)
    scanner = Scanner({"a": {"text": " ".join(b[:45] + words_of("x", 20))}, "b": {"text": " ".join(b)}}, {})
    both = scanner.scan(" ".join(b[:45] + words_of("x", 20)).encode())
    assert both["labels"] == "a,b" and {s["label"]: round(s["coverage"], 2) for s in both["spans"]} == {"a": 1.0, "b": 0.9}
    assert scanner.scan(" ".join(b[:45]).encode())["labels"] == "b"


def test_base_columns_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = licence_scan(docs).collect()
    assert len(rows) == len(texts) and any(r.n_base for r in rows) and any("apache" in r.labels for r in rows)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_templates_are_found_with_small_changes_and_other_text_not():
    scanner = Scanner()
    for label, texts in TEMPLATES.items():
        for text in texts.values():
            assert label in scanner.scan(("Some words before. " + text.upper() + ", and after").encode())["labels"].split(","), text
            w = text.split()
            if len(w) > 20:
                w[10] = "changed"
                assert label in scanner.scan(" ".join(w).encode())["labels"].split(",")
    assert scanner.scan(b"the use of this software and the terms of the work are for any other person to read in the file")["labels"] == ""


def test_every_copy_of_a_template_is_a_span():
    scanner, between = Scanner(), " some other words stand here " * 3
    text = " ".join(TEMPLATES["mit"]["text"].split())
    n = len(text.split())
    spans = [s for s in scanner.scan((between.join([text] * 3) + between + "Licensed under CC BY 4.0").encode())["spans"] if s["part"] == "text"]
    assert [(s["label"], s["first"], s["last"]) for s in spans] == [("mit", k * (n + 15), k * (n + 15) + n - 1) for k in range(3)]
    grant = scanner.scan(TEMPLATES["mit"]["grant"].encode())["spans"]
    assert {(s["label"], s["part"]) for s in grant} == {("mit", "grant")}  # the opening alone is no whole text
    assert len([s for s in scanner.scan(b"licensed under cc by 4 0 " * 7)["spans"] if s["label"] == "cc-by"]) == 7


def test_odd_rows(spark):
    docs = documents(spark)
    rows = licence_scan(docs).collect()
    assert len(rows) == docs.count() and all(r.labels == "" and r.score == 0 and r.first_word is None for r in rows)
    assert licence_scan(docs.limit(0)).count() == 0
