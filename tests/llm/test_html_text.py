import itertools

from tablehaul.llm import html_text
from tablehaul.llm.html_text import Node, _match, _weight, align, extract, is_part, parse, shape, skeleton, texts
from tests.llm.helpers import frame


def main_text(page):
    return [n.text for n in texts(parse(page)) if not n.skipped]


def test_blocks():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="ad">
    <nav><ul><li><a href="/x>y">Menu</a></li></ul></nav><div class="top cookie-notice">Cookies!</div><!-- <p>no</p> -->
    <article class="post related"><h1>Title &amp; more</h1><p><b>Bold  line.<br><p>Next&nbsp;one &#233;&#x41; a&lt;b 1 < 2</p>tail
    <form><p>no</p></form><aside>no</aside><ul><li>one<li>two</ul><table><tr><td>x<td>y</table><div hidden>no</div><button>no</button></article>
    <div id="comments"><p>no</p></div><footer>no</footer>"""
    assert main_text(page) == ["Title & more", "Bold line.", "Next one éA a<b 1 < 2", "tail", "one", "two", "x", "y"]
    assert main_text(None) == main_text("") == main_text("<nav>x") == []
    assert main_text("plain") == ["plain"] and main_text("<p>a<" + "<div>" * 5000 + "deep") == ["a<", "deep"]
    assert main_text("</p></div>x</article>") == ["x"] and len(main_text("<p>" + "w " * 100_000)[0]) == 199_999


def tree(tag, *children):
    node = Node(tag, False)
    node.children = list(children)
    return node


def best(a, b):
    """Simple tree matching by its definition."""
    if a.tag != b.tag:
        return 0
    n, m = len(a.children), len(b.children)
    table = [[0] * (m + 1) for _ in range(n + 1)]
    for i, j in itertools.product(range(1, n + 1), range(1, m + 1)):
        table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + best(a.children[i - 1], b.children[j - 1]))
    return table[n][m] + 1


def test_simple_tree_matching():
    import random

    rng = random.Random(1)

    def grow(depth):
        return tree(rng.choice("abc"), *[grow(depth - 1) for _ in range(rng.randint(0, 3))] if depth else [])

    for _ in range(200):
        a, b = tree("r", *[grow(2) for _ in range(4)]), tree("r", *[grow(2) for _ in range(4)])
        shape(a), shape(b)
        assert _weight(a, b, {}) == best(a, b)
        pairs = []
        _match(a.children, b.children, {}, pairs)
        assert sum(best(x, y) for x, y in pairs) + 1 == best(a, b)
    a, b = parse("<div><p>x</p><p>y</p></div><p>z</p>"), parse("<div><p>1</p></div><h1>n</h1><p>3</p>")
    assert {(x.text, y.text) for x, y in align(a, b)} == {("x", "1"), ("z", "3")}


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "host", True) for i, u, h in rows], "page_id long, url string, html string, host string, evidence boolean")


def test_template_goes_and_varying_text_stays(spark):
    rows = []
    for i in range(30):
        body = "".join(f"<p>Paragraph {j} of page {i} says something of its own.</p>" for j in range(2 + i % 3))
        rows.append((i, f"https://Site.example.org/{i}", f"<body><div><p>Welcome to the site</p></div><div><h2>Story {i}</h2>{body}</div><div><p>All rights"
                     " reserved</p></div></body>"))
    copies = [(100 + i, f"http://copies.example.org/{i}", "<div><p>The same story everywhere.</p></div>") for i in range(12)]
    alone = [(200, "https://one.example.org/", "<p>Only page</p>"), (201, None, "<p>No url</p>"), (None, "x", None), (203, "https://site.example.org/z", "")]
    expected = {i: "\n".join([f"Story {i}", *[f"Paragraph {j} of page {i} says something of its own." for j in range(2 + i % 3)]]) for i in range(30)}
    expected |= {100 + i: "The same story everywhere." for i in range(12)} | {200: "Only page", 201: "No url", None: "", 203: ""}
    for hot in (1000, 0):
        got = extract(pages(spark, rows + copies + alone), hot_hosts=hot).collect()
        assert {r.page_id: r.text for r in got} == expected
        assert all(r.n_chars == len(r.text) for r in got) and len(got) == len(expected)
    assert extract(pages(spark, [])).count() == 0


def test_long_boilerplate_is_template_and_repeated_pages_vote_once(spark):
    long = "<div><p>" + "These words stand on every page of the site. " * 20 + "</p></div>"
    rows = [(i, f"https://long.example.org/{i}", f"<body>{long}<div><p>Short story {i}</p></div></body>") for i in range(12)]
    page = "<body><div><p>One story, word for word.</p></div><div><p>Version {}</p></div></body>"
    rows += [(100 + i, f"https://few.example.org/{i}", page.format(i % 2)) for i in range(20)]
    got = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}
    assert got == {i: f"Short story {i}" for i in range(12)} | {100 + i: f"One story, word for word.\nVersion {i % 2}" for i in range(20)}


def test_names_of_parts():
    for part in ("site-header", "cookie-notice", "commentList", "ad-slot-3", "sidebar_left", "top related-posts", "share-buttons"):
        assert is_part(part, False), part
    for text in ("search-results", "social-history", "entry-header", "article-header", "reply-to-critics", "header-of-the-story", "download", "post-17"):
        assert not is_part(text, False), text
    assert is_part("comments", True) and not is_part("header", True) and is_part("header", False)
    assert main_text("<article><header class='entry-header'><h1>Title</h1></header><p>x</p><footer>no</footer></article><header><h1>Site</h1></header>") == ["Title", "x"]
    assert main_text("<div class='article-header'>Title</div><div class='search-results'><p>Body</p></div>") == ["Title", "Body"]


def test_skeletons_see_outer_elements_only():
    one = "<body><div><ul><li>a</ul></div><article><p>x</p><table><tr><td>y</table></article></body>"
    other = "<body class='x'><div><ul><li>a<li>b</ul></div><article><div>z</div></article></body>"
    assert skeleton(parse(one)) == skeleton(parse(other)) != skeleton(parse("<body><section>a</section><article>x</article></body>"))


def test_layouts_changing_names_and_doubtful_parts(spark):
    rows = []
    for i in range(40):  # names with numbers in them on every page
        rows.append((i, f"https://numbers.example.org/{i}", f"<body class='postid-{i} tag-{'abcdefgh'[i % 8] * 3}'><div id='top-{i}'><p>The same on top</p></div><div id='post-{i}'><p>Story {i}</p></div></body>"))
    for i in range(40):  # two layouts of one host
        body = f"<section><p>Section story {i}</p></section><div><p>All rights reserved</p></div>" if i % 2 else f"<div><p>Welcome, reader</p></div><main><p>Main story {i}</p></main>"
        rows.append((100 + i, f"https://two.example.org/{i}", f"<body>{body}</body>"))
    for i in range(12):  # whatever varies is in a part that a name calls an advert
        rows.append((200 + i, f"https://odd.example.org/{i}", f"<body><div class='banner'><p>Only text {i}</p></div><div><p>Imprint</p></div></body>"))
    rows.append((300, "https://two.example.org/rare", "<body><div><p>Welcome, reader</p></div><table><tr><td>Rare page</table></body>"))
    want = ({i: f"Story {i}" for i in range(40)} | {100 + i: f"{'Section' if i % 2 else 'Main'} story {i}" for i in range(40)}
            | {200 + i: f"Only text {i}" for i in range(12)} | {300: "Rare page"})
    for hot in (1000, 0):
        got = {r.page_id: r.text for r in extract(pages(spark, rows), hot_hosts=hot).collect()}
        assert {k: v for k, v in got.items() if v != want[k]} == {}


def test_lists_too_long_to_align_in_one_table(monkeypatch):
    top = "".join(f"<p class='{chr(97 + i)}'>t</p>" for i in range(10))
    a = parse("<div>" + top + "".join(f"<p>{i}</p><div><p>x</p></div>" for i in range(60)) + "<h2>end</h2><p>mine</p></div>")
    b = parse("<div><h3>new</h3>" + top + "".join(f"<p>{i}</p>" for i in range(70)) + "<h2>end</h2><p>yours</p><p>more</p></div>")
    exact = align(a, b)
    monkeypatch.setattr(html_text, "CELLS", 300)
    cut = align(a, b)
    assert {(x.text, y.text) for x, y in cut} >= {("t", "t"), ("end", "end"), ("mine", "more")} and len(cut) > 0.7 * len(exact)
