import html
import re
import time

import pytest

from conftest_llm import SF, with_clashes
from pulse.llm.html_density import extract, main_text
from pulse.llm.queries import QUERIES

PARA = "This is a paragraph of the article, long enough to be told from the rest of the page."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{x}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize("source, want", [
    (None, ""), ("", ""), ("  \n ", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\nb"),
    ("<p>a <b>b</b>c<br>d</p>", "a bc d"), ("<div>x<div>y</div>z</div>", "x\ny\nz"), ("a < b", "a < b"), ("<p>&lt;p&gt; &#233; &eacute; &nbsp;&#x1F600;", "<p> é é 😀"),
    ("<p>a<script>if (a < b) '</p>'</script>b</p>", "ab"), ("<p>a<!-- <p>no</p> -->b", "ab"), ("<ul><li>one<li>two</ul>", "one\ntwo"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"), ("<p title='a > b'>x</p>", "x"), ("<P>UP</P>", "UP"), ("<p>a\n\t  b</p>", "a b"), ("<script>only()</script>", ""),
    ("</p></div>x", "x"), ("<p>a</3>b", "ab"), ("<textarea><p>x</p></textarea><p>y", "y"),
])
def test_small_pages(source, want):
    assert main_text(source) == want


def test_article_without_the_rest():
    got = main_text(page(
        f"<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class='cookie-notice'>We use cookies</div><div id=sidebar><p>{PARA}</p></div>"
        f"<article><header><h1>Title</h1></header><p>{PARA}</p><div class='ad'>Buy</div><p>Second <a href=x>link</a> one.</p><aside>Aside</aside>"
        f"<form><input><p>Subscribe</p></form><footer>By me</footer></article><section class='comments'><p>{PARA} I disagree.</p></section><footer>&copy;</footer>"))
    assert got == f"Title\n{PARA}\nSecond link one."


def test_densest_subtree_without_article_tags():
    menu = "<div>" + "".join(f"<a href=/{k}>Menu item {k}</a>" for k in range(12)) + "</div>"
    got = main_text(page(f"{menu}<div><div><h2>Head</h2><p>{PARA}</p><p>{PARA} Again.</p></div><div><a href=1>x</a> <a href=2>y</a></div></div>{menu}"))
    assert got == f"Head\n{PARA}\n{PARA} Again."


LONG = "Words of a long paragraph that goes on and on, as articles do. " * 5


def test_article_in_several_containers():
    """Each section's sum is larger than that of the container of both."""
    texts = [f"{LONG}Number {k}." for k in range(10)]
    halves = ["".join(f"<p>{x}</p>" for x in part) for part in (texts[:5], texts[5:])]
    menu = "<div>" + "".join(f"<a href=/{k}>Menu item {k}</a>" for k in range(6)) + "</div>"
    for between in ("", menu):
        for source in (f"{menu}<div><section>{halves[0]}</section>{between}<section>{halves[1]}</section></div>{menu}",
                       f"{menu}<div>{halves[0]}</div>{between}<div><div>{halves[1]}</div></div>{menu}"):
            assert main_text(page(source)) == "\n".join(texts)


def test_several_articles():
    texts = [f"{LONG}Number {k}." for k in range(6)]
    one, two = f"<article><p>{texts[0]}</p></article>", "<article>" + "".join(f"<p>{x}</p>" for x in texts[1:]) + "</article>"
    assert main_text(page(f"<main>{one}{two}</main>")) == main_text(page(f"<div>{one}{two}</div>")) == "\n".join(texts)
    assert main_text(page(f"<main>{two}<p>Beside</p></main>")) == "\n".join(texts[1:])


def test_content_that_looks_like_boilerplate_stays():
    """Lists of references, sections named like boilerplate, buttons in a sentence."""
    titles = [f"A study of the {k}th question and what became of it" for k in ("first", "second", "third", "fourth", "fifth")]
    refs = "<ul>" + "".join(f"<li><a href=/{k}>{x}</a></li>" for k, x in enumerate(titles)) + "</ul>"
    assert main_text(page(f"<article><p>{LONG}</p>{refs}</article>")) == "\n".join([LONG.strip(), *titles])
    menu = "<ul>" + "".join(f"<li><a href=/{k}>Item {k}</a></li>" for k in range(6)) + "</ul>"
    assert main_text(page(f"<article><p>{LONG}</p>{menu}<p>{PARA}</p></article>")) == f"{LONG.strip()}\n{PARA}"
    for name in ("related-work", "search-strategy", "discussion"):
        assert main_text(page(f"<article><p>{LONG}</p><div class='{name}'><p>{LONG}</p></div></article>")) == f"{LONG.strip()}\n{LONG.strip()}"
    links = "".join(f"<a href=/{k}>More {k}</a>" for k in range(8))
    assert main_text(page(f"<article><p>{LONG}</p><div class='related'>{links}</div></article>")) == LONG.strip()
    assert main_text(page(f"<article><p>Press the <button>Save</button> key. {LONG}</p><p><button>Save</button></p></article>")) == f"Press the Save key. {LONG.strip()}"


def test_depth_of_inline_elements_changes_nothing():
    for depth in (3, 63, 64, 65, 500):
        assert main_text(page("<b>" + f"<p>{PARA}" + "<i>" * depth + "one</b>two")) == f"{PARA}onetwo"


def test_pages_without_any_hints(monkeypatch):
    """No article, class, id or named element: the densities find the article, and without them it is lost."""
    from pulse.llm import html_density as H
    menu = lambda k, n: "<div>" + "".join(f"<a href=/{k}/{i}>Topic {i}</a> " for i in range(n)) + "</div>"
    pages = []
    for n, inner in ((3, 1), (6, 2), (12, 3)):
        texts = [f"{LONG}Number {k} of {n}." for k in range(n)]
        pages.append((page(menu(1, 9) + "<div>" * inner + "".join(f"<p>{x}</p>" for x in texts) + "</div>" * inner + menu(2, 5) + menu(3, 14)), "\n".join(texts)))
    assert all(main_text(source) == want for source, want in pages)
    monkeypatch.setattr(H, "density", lambda *a: 1.0)
    assert not any(main_text(source) == want for source, want in pages)


def test_page_inside_a_form_or_a_marked_container():
    assert main_text(page(f"<form><p>{PARA}</p></form>")) == PARA
    assert main_text(page(f"<div class='widget'><p>{PARA}</p></div>")) == PARA


@pytest.mark.parametrize("source", ["<div>" * 50000 + "deep" + "</div>" * 50000, "<b>" * 30000 + "x<p>y" * 300, "<" * 100000, "<a \"<b " * 3000 + "'", "<p>x" * 50000,
                                    "<!--" * 20000, "<a href='" * 20000, "<p>" + "word " * 400000])
def test_large_and_broken_pages_end(source):
    start = time.time()
    main_text(source)
    assert time.time() - start < 20


def brute(source):
    """The given pages: blocks of the article element, split at the tags they use."""
    inner = source[source.index("<article>") + 9:source.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub("</?b>", "", re.sub("<br>", "\n", b))).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op2_text_density"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == brute(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]


def test_table(frame):
    ddl = "page_id long, url string, html string"
    rows = [(1, "u", "<p>x"), (1, "u", "<p>x"), (None, None, None), (2, None, "")]
    got = extract(with_clashes(frame(rows, ddl))).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, [(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0), (2, None, "", 0)]))
    assert extract(frame([], ddl)).collect() == []
