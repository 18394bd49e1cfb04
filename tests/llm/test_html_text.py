import html
import random
import re

import pytest

from stocktake.llm.html_text import extract_text, main_text

from .cases import prose

PARAS = [prose(k, 20 + 17 * k).replace("\n", " ") + ", so it was, they say." for k in range(1, 6)]
ARTICLE = "".join(f"<p>{html.escape(p)}</p>" for p in PARAS)
MENU = "<ul>" + "".join(f'<li><a href="/{k}">Section {k} of the site</a></li>' for k in range(9)) + "</ul>"
COMMENT = "<p>" + prose(40, 60) + ", first, second, third</p>"
JOINED = "\n".join(re.sub(r"\s+", " ", p) for p in PARAS)

PAGES = {
    "article": f"<html><head><title>No</title><style>p{{}}</style></head><body><header>Site</header><nav>{MENU}</nav><article><h1>A head</h1>{ARTICLE}</article><footer>&copy; us</footer></body></html>",
    "divisions": f'<body><div id="top-menu">{MENU}</div><div class="wrap"><div class="body-text"><h1>A head</h1>{ARTICLE}</div><div class="sidebar"><p>{prose(9, 90)}, a, b, c</p></div></div><div class="page-footer">us</div>',
    "no names": f"<body><div>{MENU}</div><div><h1>A head</h1><div>{ARTICLE}</div></div><div>{MENU}</div></body>",
    "comments": f'<main><h1>A head</h1>{ARTICLE}<section id="comments"><h2>3 Comments</h2><article class="comment">{COMMENT * 9}</article></section></main>',
    "notices": f'<div role="dialog">We use cookies, and more, and more</div><div class="cookie-notice"><p>{prose(8, 80)}</p></div><article><h1>A head</h1>{ARTICLE}<aside>{COMMENT}</aside><form><p>{COMMENT}</p><input><button>Go</button></form></article>',
    "form around": f'<form id="all"><div class="has-sidebar"><main><h1>A head</h1>{ARTICLE}</main></div></form>',
    "hidden": f'<article><h1>A head</h1><div style="display: none">{COMMENT}</div><p hidden>x y z</p><script>if (a < b) "<p>no</p>"</script><noscript><p>no</p></noscript>{ARTICLE}<div class="related-posts">{MENU}</div>{MENU}</article>',
    "header inside": f'<article><header><h1>A head</h1><span>by someone</span></header>{ARTICLE}<footer>tags</footer></article>',
    "unclosed": "<body><article><h1>A head" + "".join(f"<p>{html.escape(p)}" for p in PARAS) + "</article><footer>us",
}


@pytest.mark.parametrize("name", PAGES)
def test_article_of_page(name):
    assert main_text(PAGES[name]) == "A head\n" + JOINED


def test_sections_keep_all_their_text():
    sections = "".join(f"<div><h2>Part {k}</h2><p>{p}</p><p>Short.</p></div>" for k, p in enumerate(PARAS))
    want = "\n".join(f"Part {k}\n{line}\nShort." for k, line in enumerate(JOINED.split("\n")))
    assert main_text(f"<body><nav>{MENU}</nav><div>{sections}</div></body>") == want


def test_blocks_and_white_space():
    page = "<article><p>one&nbsp;&amp;\n two<br>three <b>fo</b>ur</p>loose <i>text</i><ul><li>a<li>b</ul><table><tr><td>x<td>y</table><pre>p\n q</pre></article>"
    assert main_text(page) == "one & two three four\nloose text\na\nb\nx\ny\np q"
    assert main_text("<p>Hi.</p>") == "Hi." and main_text("plain, no markup &lt;") == "plain, no markup <"
    assert main_text("<div class='ad'>only this</div>") == "only this"  # names decide nothing if no text would be left


def test_links_in_text_stay_and_link_lists_go():
    page = f'<article><p>See <a href="/x">the whole report of the year</a>, please, as it was printed.</p>{MENU}<p>{PARAS[0]}</p></article>'
    assert main_text(page) == "See the whole report of the year, please, as it was printed.\n" + re.sub(r"\s+", " ", PARAS[0])


def test_broken_markup_never_fails():
    rng = random.Random(5)
    pieces = ["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<article>", "</article>", "<li>", "<ul>", "</ul>", "<td>", "<tr>", "<table>", "text, ", "&amp;", "<!--", "-->", "<", "</", "<a href='", ">", "<br/>", "</br>", "<h1>", "</h2>", "<body>", "<html>", "&#x;", "<![CDATA[", "<?x"]
    for k in range(400):
        text = main_text("".join(rng.choice(pieces) for _ in range(rng.randrange(60))))
        assert text == "\n".join(re.sub(r"\s+", " ", b).strip() for b in text.split("\n")), k
    deep = main_text("<div>" * 30000 + "deep, " + "<p>" * 30000 + "<b>" * 30000 + "end")
    assert deep.split() == ["deep,", "end"]


def test_query_rows(spark):
    long = "<article>" + "".join(f"<p>{prose(k, 40)}</p>" for k in range(3000)) + "</article>"
    rows = [(1, "u", PAGES["article"], "x", 3), (1, "u", PAGES["article"], "x", 3), (2, None, None, "x", 3), (None, "v", "", "x", 3), (3, "w", " \n ", "x", 3), (4, "w", long, "x", 3), (5, "é", "<p>日本語, \U0001f600</p>", "x", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    found = extract_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = found.collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {(r.page_id, r.url): r for r in got}
    assert by[1, "u"].text == "A head\n" + JOINED and by[2, None].text == by[None, "v"].text == by[3, "w"].text == ""
    assert by[4, "w"].text.count("\n") >= 2999 and by[5, "é"].text == "日本語, \U0001f600"
    assert extract_text(pages.limit(0)).count() == 0
