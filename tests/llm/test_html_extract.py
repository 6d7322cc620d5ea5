from pyspark.sql import functions as F

from wardlens.llm import html_extract as h

PAGES = "page_id bigint, url string, html string"


def article(page):
    main, whole, _ = h.parse(page)
    return main or whole


def test_blocks_references_and_white_space():
    page = ("<html><head><title>t</title><script>if (a<b) x('</p>')</script></head><body><nav><a>menu</a></nav>"
            "<article><h1>A &amp; B</h1><p><b>One\n  two.<br><p>caf&eacute;&nbsp;x &#233; &lt;tag&gt; &am</p>"
            "<!-- gone --><ul><li>i<li>j</ul>tail <i>inline</i> text</article><footer>f</footer></body></html>")
    assert article(page) == ["A & B", "One two.", "café x é <tag> &am", "i", "j", "tail inline text"]


def test_what_is_no_article_goes():
    page = ("<body><header>site</header><div class='cookie-notice'><p>we use</p></div><article><header><h1>T</h1></header>"
            "<p>a</p><div class=\"ad banner\"><p>buy</p></div><aside>side</aside><form><p>f</p><input></form>"
            "<style>p{}</style><section id='comments'><article class=comment><p>first!</p></article></section>"
            "<p>b</p></article><div class=sidebar>s</div></body>")
    assert article(page) == ["T", "a", "b"]


def test_a_wrapper_with_such_a_class_does_not_empty_the_page(make):
    page = "<body><div class='layout has-sidebar'><article><p>a</p></article></div></body>"
    assert h.page_rows(make([(1, "http://x/", page)], PAGES)).first().text == "a"


def test_broken_pages():
    assert article("") == [] and article("plain & simple") == ["plain & simple"]
    assert article("<p>a<p>b</div></span>") == ["a", "b"] and article("<p>a<p class='x>b</p>c") == ["a", "b", "c"]
    assert article("x <y") == ["x <y"] and article("<p title='a>b' id=\"c>d\">e</p>") == ["e"]
    assert article("1 < 2 and <3 <p>x") == ["1 < 2 and <3", "x"]
    assert article("<article><p>open <b>bold") == ["open bold"]
    assert article("<script>never closed <p>x") == [] and article("a<!-- open") == ["a"]
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert article(deep) == ["x"]
    import time
    start = time.time()
    for nasty in ("<a \"" * 20_000, "<a \"" * 20_001 + ">", "<p " * 30_000, "<a" * 50_000 + ">", "<" * 100_000 + ">",
                  "<a \">\" '>" * 20_001, "<!--" * 20_000, "<ul>" + "<li>a" * 30_000):
        h.parse(nasty)
    assert time.time() - start < 10  # time in proportion to the page, however broken
    long = "<article>" + "<p>word</p>" * 20_000 + "</article>"
    assert len(article(long)) == 20_000


def test_recurring_subtrees_go_but_quoted_prose_stays(make):
    box = "<div><span>Partner offers</span> for you</div>"
    rows = [(i, f"http://User@Host.example:80/{i}", f"<body>{box}<article><p>Text {i}.</p><p>Same quote.</p>{box}"
             "</article></body>") for i in range(12)]
    rows += [(100 + i, "http://small.example/", f"<body>{box}<p>Only {i}</p></body>") for i in range(2)]
    got = {r.page_id: r for r in h.page_rows(make(rows, PAGES)).collect()}
    assert all(got[i].text == f"Text {i}.\n\nSame quote." for i in range(12))
    assert got[0].host == "host.example"
    assert got[100].text == "Partner offers for you\n\nOnly 0"  # too rare to be a template of that host


def test_nulls_repeats_empty_table_and_clashes(make):
    rows = [(1, None, None), (2, "nonsense", ""), (None, "http://a/", "<p>x y</p>"), (1, None, None)]
    got = sorted((r.page_id or 0, r.text, r.n_chars) for r in h.page_rows(make(rows, PAGES)).collect())
    assert got == [(0, "x y", 3), (1, "", 0), (1, "", 0), (2, "", 0)]
    assert h.page_rows(make([], PAGES)).count() == 0
    extra = make(rows, PAGES).withColumn("text", F.lit("old")).withColumn("templates", F.lit(1))
    out = h.main_text(extra)
    assert out.filter("page_id = 2").first().text == "" and "templates" in out.columns


def test_copies_of_a_page_keep_their_text(make):
    body = "<div class=content><p>The same long article.</p><table><tr><td>Colour<td>red</table></div>"
    rows = [(i, f"http://a.example/{i}", f"<body><div>Menu of the site</div>{body}</body>") for i in range(9)]
    rows += [(100 + i, f"http://a.example/o{i}", f"<body><div>Menu of the site</div><div><p>Other article number {i}."
              "</p></div></body>") for i in range(20)]
    # near copies, and products with an equal row
    rows += [(200 + i, f"http://a.example/n{i}", f"<body><div>Date {i}</div><div><p>An article printed often, "
              "nearly the same each time.</p></div></body>") for i in range(6)]
    rows += [(300 + i, f"http://a.example/p{i}", f"<body><p>Product {i} of our catalogue</p><table><tr><td>Size<td>{i}"
              "<tr><td>Made of<td>wood</table></body>") for i in range(6)]
    got = {r.page_id: r.text for r in h.page_rows(make(rows, PAGES)).collect()}
    assert {got[i] for i in range(9)} == {"The same long article.\n\nColour\n\nred"}
    assert all(got[100 + i] == f"Other article number {i}." for i in range(20))
    assert all("An article printed often" in got[200 + i] for i in range(6))
    assert all("Made of\n\nwood" in got[300 + i] for i in range(6))


def test_prose_on_most_pages_goes_and_the_size_of_the_host_does_not_matter(make):
    box = "<div class=box><p>Join our list</p></div>"
    rows = [(i, f"http://a.example/{i}", f"<body><main><p>Text number {i}.</p><p>Same quote.</p>{box}</main></body>")
            for i in range(12)]
    rows += [(100 + i, f"http://b.example/{i}", f"<body><p>Notice of the site</p><p>Text number {i}.</p></body>")
             for i in range(12)]
    # five of 1,500 pages
    rows += [(1000 + i, f"http://c.example/{i}", f"<body>{'<div>Seasonal offer</div>' if i < 5 else ''}"
              f"<article><p>Text number {i}.</p>{'<div>Rare partner</div>' if i < 5 else ''}</article></body>")
             for i in range(1500)]
    got = {r.page_id: r.text for r in h.page_rows(make(rows, PAGES)).collect()}
    assert all(got[i] == f"Text number {i}.\n\nSame quote." for i in range(12))
    assert all(got[100 + i] == f"Text number {i}." for i in range(12))
    assert all(got[1000 + i] == f"Text number {i}." for i in range(1500))


def test_names_of_a_layout_do_not_hide_the_article():
    stray = "<p>(c) 2020</p>"
    for wrapper in ("<div class='layout has-sidebar'><article>{}</article></div>", "<article class='post no-comments'>{}</article>",
                    "<div class='page search-enabled menu-open'><div>{}</div></div>", "<div class='page page--sidebar'>{}</div>",
                    "<div class=sidebar><main>{}</main></div>", "<main class='related'>{}</main>",
                    "<div id=menu><div class=nav>{}</div></div>"):
        got = article("<body>" + wrapper.format("<p>" + "The text itself. " * 10 + "</p><div class='ad'>buy</div>") + stray)
        assert got[0] == ("The text itself. " * 10).strip() and "buy" not in got, wrapper
    assert article("<div class='site-footer'><p>foot</p></div><div class='comments-area'><article><p>first!</p></article></div>"
                   "<article><p>a</p></article><div id=comments><p>" + "c " * 500 + "</p></div>") == ["a"]
    assert article("<p>a short post of some words</p><div class='cookie-notice'><p>We use cookies here.</p></div>") == [
        "a short post of some words"]


def test_names_decide_by_whole_tokens_only():
    for name in ("id='related-work'", "class='search-methods'", "class='market-share'", "class='notice-period'", "id='socialHistory'",
                 "class='x comments-open'", "class=banner-making", "role=note"):
        page = f"<article><p>a</p><section {name}><p>Own words.</p></section><p {name}>More.</p></article>"
        assert article(page) == ["a", "Own words.", "More."], name
    for name in ("class=cookieBanner", "class='adBox'", "class='x commentlist'", "id=responses", "id='respond'", "class=related-posts",
                 "class='share_buttons'", "class='ad-slot-3'", "class='site-footer'", "class=AD", "role=complementary", "id='top-nav'",
                 "class='newsletter-signup'", "class='you-may-also-like-related'", "class='post-comments'", "class='cookie-consent__text'"):
        page = f"<article><p>a</p><div {name}><p>Other words.</p></div></article>"
        assert article(page) == ["a"], name


def test_small_hosts_lose_their_menus_and_keep_their_prose(make):
    menu = "<div><span>Home</span> <span>About</span></div>"
    rows = [(k * 10 + i, f"http://{k}.example/{i}", f"<body>{menu}<p>Shared words of all.</p><p>Page {i} of {k}.</p></body>")
            for k in (2, 3, 4) for i in range(k)]
    rows += [(90, "http://4.example/x", f"<body>{menu}<p>One more page.</p></body>")]
    got = {r.page_id: r.text for r in h.page_rows(make(rows, PAGES)).collect()}
    assert got[20] == "Home About\n\nShared words of all.\n\nPage 0 of 2."  # two pages are too few to tell
    assert got[30] == "Shared words of all.\n\nPage 0 of 3." and got[90] == "One more page."
    assert [got[40 + i] for i in range(4)] == [f"Shared words of all.\n\nPage {i} of 4." for i in range(4)]


def test_templates_equal_a_plain_count_per_host(make):
    """The subtrees that recur, against counting them page by page."""
    import random
    from collections import defaultdict
    rng = random.Random(3)
    parts = [f"<div>Part {k}</div>" for k in range(6)] + [f"<div><p>Prose {k}</p></div>" for k in range(4)]
    rows = [(i, f"http://h{i % 3}.example/{i}", "<body>" + "".join(p for p in parts if rng.random() < 0.6) + f"<p>Own {i % 17}.</p></body>")
            for i in range(40)] + [(50 + i, "http://tiny.example/", f"<body>{parts[0]}<p>{i}</p></body>") for i in range(3)]
    on, bodies = defaultdict(set), defaultdict(set)
    for _, url, page in rows:
        parsed, host = h.read(page), url.split("/")[2]
        body = "|".join(parsed.text())
        bodies[host].add(body)
        for c in parsed.cuts:
            on[host, c.digest].add(body)
    want = {}
    for (host, digest), pages in on.items():
        n, size = len(pages), len(bodies[host])
        if n >= 5 or (n >= 3 and n >= 0.75 * size):
            want[host, digest] = n >= size / 2 if n >= 5 else None
    pages = make(rows, PAGES).withColumn("host", h.host_of(F.col("url")))
    found = h.subtrees(pages)
    sites = {r.site: r.host for r in found.join(pages.select(h.page_key().alias("page"), "host"), "page").select("site", "host").collect()}
    got = {(sites[r.site], r.hash): r.common for r in h.site_templates(found, 5, 0.5).collect()}
    assert got == want
