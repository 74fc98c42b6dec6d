import re
from html import unescape

from pathloom.llm.html_text import best_path, extract, main_text, parse
from pathloom.llm.queries import op6_html_text


def plain(html):
    """The given pages have one article each: its blocks, cut at the tags that begin or end one."""
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", html or "", re.S)
    if not inner:
        return ""
    blocks = re.split(r"</?(?:p|h1)\b[^>]*>", inner[1])
    texts = [" ".join(unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


def test_query_against_the_given_template(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    found = {r.page_id: r for r in op6_html_text(spark, small).collect()}
    assert len(found) == len(pages)
    for p in pages:
        assert found[p.page_id] == (p.page_id, p.url, plain(p.html), len(plain(p.html)))


LONG = "A sentence, with some words in it, that goes on for a while and says little. " * 4
PAGE = f"""<html><head><title>T</title><script>var a = "<p>x</p>";</script></head><body class="page-17 sidebar-left"><header><h1>Site</h1></header>
<div id="nav-main"><a href=/>Home</a></div><div class="cookie-notice"><p>{LONG}</p></div><form><p>{LONG}</p></form>
<div class="post-12 hentry"><div class="entry-content"><h2>Head &amp; tail</h2><p>One&nbsp;two<br>three &lt;b&gt; <a href="x">link</a></p>
<ul><li>first</li><li>second <b>bold</b></li></ul><p>{LONG}</p><div class="ad-box">buy</div><!-- <p>no</p> --></div>
<section class="comments"><p>{LONG}{LONG}{LONG}</p></section></div><aside><p>{LONG}</p></aside><footer><p>{LONG}</p></footer></body></html>"""
TEXT = "\n".join(["Head & tail", "One two three <b> link", "first", "second bold", LONG.strip()])


def test_page_without_an_article_element():
    assert extract(PAGE, None) == TEXT
    assert best_path(parse(PAGE))[0] == "body.page-#.sidebar-left>div.hentry.post-#>div.entry-content"


def test_hosts_outvote_single_pages(spark):
    odd = PAGE.replace('<div class="entry-content">', f'<div class="extra"><p>{LONG * 9}</p></div><div class="entry-content">')
    pages = spark.createDataFrame([(i, f"http://A.example/{i}", PAGE, "w") for i in range(5)] + [(9, "http://a.example/odd", odd, "w"), (10, "http://b.example/odd", odd, "w")],
                                  "page_id long, url string, html string, winner string")
    found = {r.page_id: r.text for r in main_text(pages).collect()}
    assert all(found[i] == TEXT for i in (0, 1, 2, 3, 4, 9)) and found[10] == LONG.strip() + (" " + LONG.strip()) * 8


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "x", ""), (None, "http://a/", "plain text  only"), (3, "http://a/", "<p>a<p>b"), (4, "http://a/", "<article>x < y & z &amp; w"),
            (5, "u", "<div" * 2000), (6, "u", "<div>" * 3000 + "deep"), (7, "u", "<p>" + "w " * 300000), (8, "u", "<script>never closed <p>x</p>"), (8, "u", "<a 'b>c</a>d"),
            (9, "u", "<!-- open <p>x"), (10, "u", "</div></p></article>t<nav>m</nav>")]
    found = sorted(((r.page_id, r.text[:40], r.n_chars) for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()), key=repr)
    assert [f for f in found if f[0] in (1, 2, None, 3, 4, 6, 7, 8, 9, 10)] == sorted(
        [(1, "", 0), (2, "", 0), (None, "plain text only", 15), (3, "a\nb", 3), (4, "x < y & z & w", 13), (6, "deep", 4), (7, ("w " * 20), 599999), (8, "", 0), (8, "cd", 2),
         (9, "", 0), (10, "t", 1)], key=repr)
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_layout_words_of_a_wrapper_are_no_aside():
    for wrapper in ("div class='container has-sidebar'", "div id='page' class='no-sidebar'", "div class='cookie-consent-ready'", "section class='search-methods'", "div class='modal-open'"):
        tag = wrapper.split()[0]
        article = f"<h1>Head</h1><p>{LONG}</p><div class='share'>Share this</div>"
        for inner in (f"<article>{article}</article>", f"<main>{article}</main>", f"<div class='post'>{article}</div>"):
            page = f"<body><nav>Menu</nav><{wrapper}>{inner}<div class='sidebar'>Other posts</div><div class='comments'><article class='comment'><p>{LONG * 5}</p></article></div></{tag}></body>"
            assert extract(page, None) == "Head\n" + LONG.strip(), page
    assert extract(f"<body><div class='post'><p>{LONG}</p></div><div class='with-ads ad-zone'>buy this</div><div class='sidebar'><p>{LONG * 3}</p></div></body>", None) == LONG.strip()


def test_winner_does_not_replace_another_template(spark):
    first, second = f"<body><div><p>{LONG}</p></div></body>", f"<body><div>Welcome</div><div class=post>{LONG * 3}</div></body>"
    rows = [(i, "http://a.example/" + str(i), first if i < 6 else second) for i in range(10)]
    rows += [(20 + i, None if i % 2 else "no host", f"<body><div><p>{LONG}</p></div></body>") for i in range(5)]
    rows.append((30, None, f"<body><div>{LONG}</div><div class=post>{LONG}</div></body>"))
    found = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i] == LONG.strip() for i in range(6)) and all((LONG * 3).strip() in found[i] for i in range(6, 10))
    assert found[30] == LONG.strip() + "\n" + LONG.strip()


def test_best_container_keeps_all_parts():
    parts = f"<div class=intro><p>{LONG * 3}</p></div><div class=details><p>{LONG * 2}</p></div>"
    assert extract(f"<body><nav>x</nav><div class=page>{parts}</div></body>", None) == "\n".join([(LONG * 3).strip(), (LONG * 2).strip()])
    assert extract(f"<body><div class=post><h1>Head</h1><div class=entry-content><p>{LONG}</p></div></div></body>", None) == "Head\n" + LONG.strip()


def test_pages_written_inside_a_form_or_dialog():
    article = f"<h1>Head</h1><p>{LONG}</p><form><label>Mail</label><p>{LONG}</p></form>"
    want = "Head\n" + LONG.strip()
    for wrapper in ("form id='form1'", "dialog open", "fieldset", "div role='form'"):
        tag = wrapper.split()[0]
        assert extract(f"<body><{wrapper}><div><article>{article}</article></div></{tag}></body>", None) == want, wrapper
        assert extract(f"<body><{wrapper}><div class='page'><h1>Head</h1><p>{LONG * 9}</p></div></{tag}></body>", None) == "Head\n" + (LONG * 9).strip(), wrapper
    assert extract("<body><nav>Home</nav><form><label>Name</label><label>Password</label></form></body>", None) == ""


def test_content_sections_with_unlucky_words():
    for name in ("id='related-work'", "class='social-history'", "class='share-prices'", "class='chapter-navigation-at-sea'", "class='comment-on-methods with-figures'"):
        page = f"<body><article><h1>Head</h1><p>{LONG * 6}</p><section {name}><p>{LONG}</p></section></article></body>"
        assert extract(page, None) == "\n".join(["Head", (LONG * 6).strip(), LONG.strip()]), name
    links = " ".join(f"<a href='{i}'>Another story of the day {i}</a>" for i in range(9))
    for name in ("class='related-stories'", "class='newsletter-signup-form'", "class='share-box'"):
        page = f"<body><article><h1>Head</h1><p>{LONG * 6}</p><section {name}>{links}</section></article></body>"
        assert extract(page, None) == "Head\n" + (LONG * 6).strip(), name


def test_formulas_and_words_on_buttons_stay():
    page = f"<body><article><p>{LONG}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math>, press <button>Save</button> twice.</p><button>Share</button></article></body>"
    assert extract(page, None) == LONG.strip() + "\nLet x=1, press Save twice."
