import random
import re
from collections import defaultdict

from bidlake.llm import htmltext
from tests.conftest import SF001

SETTINGS = htmltext.ExtractSettings()


def text(html, wrapper=None):
    """Through the given wrapper, or through that of the page alone."""
    return htmltext.main_text(html, wrapper or htmltext.wrapper([html or ""], SETTINGS))


def test_furniture_goes_and_blocks_stay():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "<p>no</p>";</script></head><body>
    <header><a href="/">Site</a></header><nav><ul><li><a>Menu</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
    <article><h1>A  title</h1><p>First <b>bold</b>&nbsp;&amp; &eacute;t&#233;<br>line</p><aside>Side</aside><p>Second
    line<p>Third<ul><li>one<li>two</ul><form><input>Send</form><div class="comments"><p>Me too</p></div></article>
    <div class="ad">Buy</div><!-- <p>hidden</p> --><footer>&copy; site</footer></body></html>"""
    assert text(html) == "A title\n\nFirst bold & été line\n\nSecond line\n\nThird\n\none\n\ntwo"


def test_names_of_furniture():
    body = "<body><div class='page with-sidebar'><article><p>kept</p><ul id=userComments><li>me</ul><p class=lead>too</p></article><div class=leftSidebar>links</div></div></body>"
    assert text(body) == "kept\n\ntoo"


def test_names_only_break_ties():
    body = "<body><div class='{0}'><p>Some words of page {2}</p><p>and a few more of {2}</p></div><div class='{1}'><p>beside {2}</p></div></body>"
    whole, kept = "Some words of page 9\n\nand a few more of 9\n\nbeside 9", "Some words of page 9\n\nand a few more of 9"
    read = lambda *names: text(body.format(*names, 9), htmltext.wrapper([body.format(*names, n) for n in range(7, 10)], SETTINGS))
    for name in ("commentary", "page no-sidebar", "menu", "comments"):  # what holds the text stays, whatever its name
        assert read(name, "x") == whole
    for name in ("comments no-js", "sidebar has-background", "mainmenu", "sitefooter", "cookie-bar", "userComments"):
        assert read("x", name) == kept
    for name in ("commentary", "with-sidebar", "no-comments", "documents", "adder"):
        assert read("x", name) == text(body.format("x", name, 9)) == whole


def test_pages_without_telling_names():
    """Menus, notices and ends are told from articles by the host's other pages alone."""
    pick = random.Random(2)
    word = lambda: pick.choice(["river", "stone", "cloud", "lamp", "field", "green", "seven", "other"]) + str(pick.randrange(50))
    words = lambda n: " ".join(word() for _ in range(n))
    pages, want = [], []
    for _ in range(12):
        title, paragraphs, links = words(4), [words(pick.randrange(8, 40)) for _ in range(pick.randrange(2, 6))], [f"<a href=/x>{words(2)}</a>" for _ in range(3)]
        sources = "".join(f"<p><a href=/s>{words(3)}</a></p>" for _ in range(3)) if pick.random() < 0.3 else ""
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        pages.append(f"<body><div><span>{pick.choice(['Hello', 'Hello'])} to our site</span><div>{''.join(f'<div>{x}</div>' for x in links + [f'<a href=/y>{words(1)}</a>'])}</div></div>"
                     f"<div><h1>{title}</h1><div>{body}{sources}</div></div><div><i>Written by the desk</i><u>All rights</u></div></body>")
        want.append((title, paragraphs))
    wrapper = htmltext.wrapper(pages, SETTINGS)
    for page, (title, paragraphs) in zip(pages, want):
        got = htmltext.main_text(page, wrapper).split("\n\n")
        assert got[:1 + len(paragraphs)] == [title, *paragraphs] and len(got) in (1 + len(paragraphs), 4 + len(paragraphs))
        assert htmltext.main_text(page, None).startswith("Hello to our site")


def test_three_linked_sources_inside_an_article_stay():
    body = "<body><div><p>First words of it</p><ul><li><a>One source</a></li><li><a>Two source</a></li><li><a>Three source</a></li></ul><p>Last words of it</p></div></body>"
    assert text(body) == "First words of it\n\nOne source\n\nTwo source\n\nThree source\n\nLast words of it"


def test_matching_is_the_largest_by_trying_all():
    """The number of matched nodes against every order-preserving pairing."""
    pick = random.Random(7)

    def tree(kind, depth=0):
        node = kind(pick.choice("abc") if depth else "r")
        node.children = [tree(kind, depth + 1) for _ in range(pick.randrange(0, 4 if depth < 2 else 1))]
        return node

    def best(t, s):
        if t.sign != s.sign:
            return 0

        def pair(i, j):
            if i == len(t.children) or j == len(s.children):
                return 0
            return max(pair(i + 1, j), pair(i, j + 1), best(t.children[i], s.children[j]) + pair(i + 1, j + 1))

        return 1 + pair(0, 0)

    for _ in range(150):
        t, s = tree(htmltext.Template), tree(htmltext.Shape)
        assert htmltext.tree_match(t, s, {}) == best(t, s)


def test_wrappers_of_all_hosts_are_those_of_each(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "url", "html")
    rows = {r["page_id"]: r for r in htmltext.extract(pages.repartition(5)).collect()}
    hosts = defaultdict(list)
    for r in pages.orderBy("page_id").collect():
        hosts[r["url"].split("://")[1].split("/")[0].split("?")[0].split("#")[0].lower()].append(r)
    differ = 0
    for found in hosts.values():
        wrapper = htmltext.wrapper([r["html"] for r in found], SETTINGS)
        for r in found:
            assert rows[r["page_id"]]["text"] == htmltext.main_text(r["html"], wrapper)
            differ += rows[r["page_id"]]["text"] != htmltext.main_text(r["html"], None)
    assert differ == sum(map(len, hosts.values()))  # no page's text comes without its wrapper


def test_constants_by_a_share_of_the_pages_with_the_node(spark):
    row = lambda i: f"<body><div><p>{'Shared line' if i % 3 else f'own line {i}'}</p></div><section><p>alpha {i} text of the page</p></section>{'<u>Rare end</u>' if i in (1, 4) else ''}</body>"
    pages = spark.createDataFrame([(i, "http://h/x", row(i)) for i in range(12)] + [(50 + i, "http://h/y", row(0)) for i in range(20)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in htmltext.extract(pages.repartition(6)).collect()}
    for i in range(12):  # two thirds of the different pages; copies of one page count once
        assert got[i] == "\n\n".join([f"own line {i}"] * (i % 3 == 0) + [f"alpha {i} text of the page"] + ["Rare end"] * (i in (1, 4)))


def test_broken_markup():
    assert text(None) == text("") == text("<!-- never closed <p>x") == ""
    assert text("plain words") == "plain words"
    assert text("<article><p><b>one<br><p>two</i></p><div>three") == "one\n\ntwo\n\nthree"
    assert text("<article><p>cut &amp off</p><p>and <a hr") == "cut & off\n\nand"
    assert text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert text("<article><p>a < b and c</p><p title='x>y'>q</p></article>") == "a < b and c\n\nq"


def test_constant_texts_are_template():
    page = "<body><div id=top>Welcome to the site</div><div><p>{}</p><p>{}</p></div><div>All rights reserved</div></body>"
    pages = [page.format(f"alpha {i}", f"beta {i * 7}") for i in range(5)]
    template = htmltext.wrapper(pages, SETTINGS)
    assert text(page.format("new one", "new two"), template) == "new one\n\nnew two"
    few = htmltext.wrapper(pages[:1] * 8, SETTINGS)
    assert text(pages[0], few).startswith("Welcome to the site\n\nalpha 0")


def test_matching_skips_what_one_page_lacks():
    with_extra = "<body><h2>Head</h2><section>Extra {0}</section><div>Text {0}</div><div class=end>End</div></body>"
    without = "<body><h2>Head</h2><div>Text {0}</div><div class=end>End</div></body>"
    template = htmltext.wrapper([with_extra.format(1), without.format(2), with_extra.format(3), without.format(4)], SETTINGS)
    assert text(without.format(9), template) == "Text 9"
    assert text(with_extra.format(9), template) == "Extra 9\n\nText 9"


def test_pages_against_the_texts_they_were_made_from(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = htmltext.extract(spark.read.parquet(f"{SF001}/pages.parquet")).collect()
    assert len(rows) == spark.read.parquet(f"{SF001}/pages.parquet").count()
    checked = 0
    for r in rows:
        number = re.search(r"/(\d+)", r["url"].split("://", 1)[1])
        assert r["n_chars"] == len(r["text"])
        if number and int(number.group(1)) in docs:
            lines = [" ".join(x.split()) for x in docs[int(number.group(1))].split("\n") if x.strip()]
            assert r["text"].split("\n\n")[1:] == lines  # after the heading
            checked += 1
    assert checked > 20


def test_awkward_rows(spark):
    rows = [(1, None, "<p>a</p>", "x"), (2, "http://h/1", None, "x"), (3, "http://h/2", "", "x"), (None, "no url", "<p>b &lt; c</p>", "x"), (4, "http://h/3", "<p>d</p>", "x"),
            (4, "http://h/3", "<p>d</p>", "x"), (5, "http://h/5", "<article>" + "<p>long text</p>" * 20000 + "</article>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, template string")
    got = htmltext.extract(pages).collect()
    assert sorted((str(r["page_id"]), r["text"]) for r in got if r["page_id"] != 5) == sorted([("1", "a"), ("2", ""), ("3", ""), ("None", "b < c"), ("4", "d"), ("4", "d")])
    assert next(r for r in got if r["page_id"] == 5)["n_chars"] == 20000 * 11 - 2
    assert htmltext.extract(pages.limit(0)).count() == 0


def test_depth_closes_nothing_and_hides_no_furniture():
    deep = "<div>" * 80 + "deep" + "</div>" * 80
    assert text(f"<body><div class=page><article><p>one</p>{deep}<p>two</p></article></div></body>") == "one\n\ndeep\n\ntwo"
    assert text("<article>" + "<div>" * 90 + "<nav><p>menu</p></nav><p>kept</p>" + "</div>" * 90 + "</article>") == "kept"
    assert text("<article><p>a</p><div class=sidebar>" + "<div>" * 90 + "x" + "</div>" * 90 + "<p>side</p></div></article>") == "a"
    page = "<body>" + "<div>" * 1500 + "<p>Welcome</p><section>{0}</section>" + "</div>" * 1500 + "<i>{1}</i></body>"
    pages = [page.format(f"alpha {i}", "<p>x</p>" * (i % 2)) for i in range(4)]
    template = htmltext.wrapper(pages, SETTINGS)
    assert text(page.format("new", ""), template) == "new"


def test_linked_blocks_and_text_beside_a_teaser_stay():
    body = "<body><div><p>First text of the page</p><h2><a href=x>A linked heading</a></h2><p><a href=y>Read the report here</a></p><p>Last text</p></div>{}</body>"
    want = "First text of the page\n\nA linked heading\n\nRead the report here\n\nLast text"
    assert text(body.format("")) == want
    assert text(body.format("<ul>" + "<li><a href=z>other page</a></li>" * 5 + "</ul>")) == want
    assert text(body.format("<div><a>Home</a> <a>About</a> <a>More</a></div>")) == want
    assert text(body.format("<ol><li><a>A study</a>, by Someone and Another</li><li><a>Two</a>, 1999</li><li><a>Three</a>, 2001</li></ol>")).endswith("A study, by Someone and Another\n\nTwo, 1999\n\nThree, 2001")
    assert text(body.format("<article><p>Teaser</p></article>")) == want + "\n\nTeaser"
    assert text("<body><p>Outside</p><article><p>The long text of an article</p></article></body>") == "The long text of an article"
