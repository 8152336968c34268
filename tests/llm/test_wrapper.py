import html as h
import random
import re

from grantlake.llm.wrapper import Node, Shapes, Tree, extract, main_text, match, parse


def test_articles_of_the_tables_are_extracted(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    expected = {}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        text = h.unescape(re.sub(r"<[^>]+>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", body))
        expected[r.page_id] = re.sub(r"\s+", " ", text).strip()
    rows = extract(pages).collect()
    assert {r.page_id: r.text for r in rows} == expected and all(r.n_chars == len(r.text) for r in rows)


def page(i, body):
    """A page whose template is not declared by tags or classes, only by being constant."""
    return f"""<html><head><title>t{i}</title></head><body><div><p>Welcome to our site</p><ul><li>Home<li>About us</ul></div>
    <div><h2>Story {i}</h2>{body}</div><div><p>All the best from the team</p><p>Call us any time</p></div></body></html>"""


def test_constant_nodes_go_and_varying_slots_stay(spark):
    rng = random.Random(1)
    rows, expected = [], {}
    for i in range(12):
        paragraphs = [f"Text {i} {rng.random()}" for _ in range(rng.randint(1, 5))]
        rows.append((i, f"https://host.example/{i}", page(i, "".join(f"<p>{p}" for p in paragraphs))))
        expected[i] = " ".join([f"Story {i}", *paragraphs])
    rows.append((90, "https://lonely.example/", page(90, "<p>x")))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract(pages).collect()}
    assert {r.page_id: r.text for r in extract(pages, model_bytes=0).collect()} == got  # without broadcasts
    assert {k: got[k] for k in expected} == expected
    assert got[90].startswith("Welcome to our site Home About us Story 90 x")


def test_declared_parts_markup_and_references():
    text = lambda s: main_text(parse(s), set())
    assert text("a &amp; b&nbsp;&#233; <script>no<p></script> <style>x</style><!-- c --> <b>bo</b>ld<p>  two\n words") == "a & b é bold two words"
    assert text("<body><nav>n</nav><header>h</header><article><h1>T</h1><p>x<aside>s</aside><p>y<br>z<div class='comments'>c</div></article><footer>f</footer>") == "T x y z"
    assert text("<main><form><input>f</form><div class='cookie-notice'>c</div><p hidden>q</p><p style='display:none'>r</p>kept</main> outside") == "kept"
    assert text("<div class='sidebar'>s</div><div id='content'><p>body</p></div><div class=\"ad\">a</div>") == "body"
    assert text("1 < 2 and <p>a <unknown>b</unknown></p></p></div>") == "1 < 2 and a b"
    assert text("") == ""
    assert text("<p>open <script>a") in ("open", "open a")


def tree(tag, *children):
    return Node(tag, False, parts=list(children))


def largest(a, b):
    """Simple tree matching as it is defined, by the whole table of children."""
    if a.tag != b.tag:
        return 0
    one, other = a.sections, b.sections
    table = [[0] * (len(other) + 1) for _ in range(len(one) + 1)]
    for i in range(1, len(one) + 1):
        for j in range(1, len(other) + 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + largest(one[i - 1], other[j - 1]))
    return 1 + table[-1][-1]


def test_simple_tree_matching_pairs_in_order():
    a, b = Tree(tree("root", tree("div", tree("ul"), tree("h1")), tree("section"))), Tree(tree("root", tree("div", tree("h1")), tree("form"), tree("section")))
    size, pairs = match(Shapes(), a, b)
    assert size == 4 and [a.nodes[i].tag for i, _ in pairs] == ["root", "div", "h1", "section"]
    assert match(Shapes(), a, Tree(tree("x"))) == (0, [])


def test_simple_tree_matching_equals_the_whole_table_on_random_trees():
    rng = random.Random(7)

    def grown(depth):
        return tree(rng.choice("ab" if depth else "r"), *[grown(depth + 1) for _ in range(rng.randint(0, 4) if depth < 4 else 0)])

    shapes = Shapes()  # one memory for all pairs
    for _ in range(150):
        a, b = grown(0), grown(0)
        x, y = Tree(a), Tree(b)
        size, pairs = match(shapes, x, y)
        assert size == largest(a, b) == len(pairs) and len({i for i, _ in pairs}) == len({j for _, j in pairs}) == size
        assert all(x.nodes[i].tag == y.nodes[j].tag for i, j in pairs)
        up = {(x.parents[i], y.parents[j]) for i, j in pairs[1:]}
        assert up <= set(pairs)  # parents of a pair are a pair


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (2, "", ""), (None, "http://a.example/", "<p>x"), (3, "no host", "plain text only"), (4, "http://b.example", "<div>" * 300 + "deep" + "</div>" * 300), (5, "//c.example", "x" * 50000)]
    pages = spark.createDataFrame([(*r, "t", 3) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = extract(pages).collect()
    assert len(got) == len(rows) and {r.text for r in got if r.page_id in (1, 2)} == {""}
    assert {r.text for r in got if r.page_id == 4} == {"deep"} and {r.n_chars for r in got if r.page_id == 5} == {50000}
    assert extract(pages.limit(0)).count() == 0


def test_template_does_not_hang_on_one_page_or_layout(spark):
    rows = [(0, "https://h.example/0", ""), (1, "https://h.example/1", "<p>404</p>"), (2, "https://h.example/2", None)]
    stale = page(3, "<p>Text 3").replace("All the best", "Farewell")  # the smallest page of the layout words a block differently
    rows.append((3, "https://h.example/3", stale))
    expected = {i: f"Story {i} Text {i}" for i in range(4, 20)}
    rows += [(i, f"https://h.example/{i}", page(i, f"<p>Text {i}")) for i in range(4, 20)]
    expected |= {i: f"Item {i}" for i in range(30, 36)}
    rows += [(i, f"https://h.example/{i}", f"<body><table><tr><td>Our shop sells</td></tr><tr><td>Item {i}</td></tr></table><ol><li>Delivery is free</ol></body>") for i in range(30, 36)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for size in (1 << 20, 0):
        got = {r.page_id: r.text for r in extract(pages, model_bytes=size).collect()}
        assert {k: got[k] for k in expected} == expected and got[1] == "404" and got[0] == got[2] == ""


def test_long_lists_are_matched_as_short_ones():
    items = [tree("li", tree("ul" if i % 3 else "ol", *[tree("li")] * (i % 5))) for i in range(150)]
    a, b = Tree(tree("root", *items)), Tree(tree("root", *items[1:]))
    size, pairs = match(Shapes(), a, b)
    assert size == len(pairs) == len(b.nodes)  # all of the smaller one, though the lists are shifted


def test_markup_of_any_depth(spark):
    deep = lambda tag, n: f"<{tag}>a" * n + "deep" + f"</{tag}>b" * n
    rows = [(i, f"https://deep.example/{i}", deep("div" if i % 2 else "section", 20_000) + f"<p>{i}") for i in range(8)] + [(9, "https://deep.example/9", "<div>" * 30_000)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(got) == 9 and got[9] == "" and all(str(i) in got[i] for i in range(8))


def test_slots_that_rotate_are_template_by_themselves(spark):
    rng = random.Random(3)
    stock = [f"Offer {k} of our shop" for k in range(5)]
    rows = [(i, f"https://r.example/{i}", f"<body><div>{rng.choice(stock)}</div><table><tr><td>Story {i} {rng.random()}</td></tr></table></body>") for i in range(40)]
    rows.append((99, "https://r.example/99", "<body><div>A new offer</div><table><tr><td>Story 99</td></tr></table></body>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for size in (1 << 20, 0):
        got = {r.page_id: r.text for r in extract(pages, model_bytes=size).collect()}
        assert all(got[i].startswith(f"Story {i}") and "ffer" not in got[i] for i in [*range(40), 99])


def test_the_template_alone_finds_menus_and_adverts_of_the_tables(spark):
    """Without names of tags and classes, pages of hosts with many pages lose what induction finds, and the article stays."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("url LIKE '%//blog.tionsh.example.com/%'")
    told = {r.page_id: r.text for r in extract(pages).collect()}
    induced = {r.page_id: r.text for r in extract(pages, declared=False).collect()}
    plain = {r.page_id: main_text(parse(r.html), set(), False) for r in pages.collect()}
    assert len(told) > 100 and all(told[k] in induced[k] for k in told)
    less = [k for k in told if len(induced[k]) < len(plain[k])]
    assert len(less) > 0.95 * len(told)  # induction takes something away
    assert sum(len(induced[k]) - len(told[k]) for k in told) < 0.35 * sum(len(plain[k]) - len(told[k]) for k in told)


def test_words_of_classes_inside_an_article_tell_nothing(spark):
    """Weak words mark parts of the page, but parts of an article only where the host's template has them as well."""
    article = '<article><p>Intro {0}.</p><div class="legal-history"><p>One {0}</p></div><p class="share">Two {0}</p><div class="discussion">Three {0}</div><div class="comments">C {0}</div>{1}<p>Last {0}</p></article>'
    side = '<div class="related">More</div><div class="legal">Terms</div>'
    text = lambda k: f"Intro {k}. One {k} Two {k} Three {k} Last {k}"
    single = spark.createDataFrame([(1, "https://one.example/a", f"<body>{side}{article.format('x', '')}</body>")], "page_id long, url string, html string")
    assert extract(single).first().text == text("x")
    shared = '<div class="share">Share this page</div>'
    many = [(k, f"https://many.example/{k}", f"<body>{side}{article.format(f'word{k}', shared)}</body>") for k in range(12)]
    rows = {r.page_id: r.text for r in extract(spark.createDataFrame(many, "page_id long, url string, html string")).collect()}
    assert rows == {k: text(f"word{k}") for k in range(12)}  # the constant part goes, by the template
    few = {r.page_id: r.text for r in extract(spark.createDataFrame(many[:2], "page_id long, url string, html string")).collect()}
    assert all("Share this page" in t for t in few.values())  # two pages have no template
