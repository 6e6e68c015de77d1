"""Blocks of broken pages against a slow, plain reading, and pages of 1 MB of each odd kind."""

import html
import random
import re
import time

import pytest

from factweave.llm import op05_html as op


def _pieces(page):
    """Markup and text, one after the other, character by character."""
    out, at = [], 0
    while at < len(page):
        if page[at] != "<":
            end = at
            while end < len(page) and page[end] != "<":
                end += 1
            out.append(("text", page[at:end], ""))
            at = end
            continue
        for start, stop in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">")):
            if page.startswith(start, at):
                end = page.find(stop, at + len(start) if len(start) > 2 else at)
                at = len(page) if end < 0 else end + len(stop)
                break
        else:
            name = re.match(r"</?[a-zA-Z][^\s/>]*", page[at:])
            if name is None:
                out.append(("text", "<", ""))
                at += 1
                continue
            end = at + len(name[0])
            while end < len(page) and page[end] != ">":
                if page[end] in "\"'" and page[end] in page[end + 1 :]:
                    end = page.index(page[end], end + 1)
                end += 1
            tag, inside = name[0][1:].lower(), page[at + len(name[0]) : end]
            out.append(("tag", tag, inside))
            at = min(end + 1, len(page))
            if tag in op._RAW and not (tag in ("svg", "math") and inside.rstrip().endswith("/")):
                close = re.compile(rf"</{tag}\b[^>]*(>|\Z)", re.I).search(page, at)
                at = close.end() if close else len(page)
    return out


def _plain(page):
    """Blocks, the elements around each found by reading the page from its start again."""
    pieces, ends = _pieces(page), []

    def around(n, leaving):
        stack, articles, boxes = [], 0, 0
        for i, (kind, name, inside) in enumerate(pieces[: n + leaving]):
            heads = [k for k, e in enumerate(stack) if e[0] == "head"]
            if heads and ((kind == "text" and name.strip()) or (kind == "tag" and name[0] != "/" and name not in op._HEAD)):
                del stack[heads[0] :]
            if kind == "text" or i == n:
                continue
            bare = name.removeprefix("/")
            if bare not in op._NESTING or bare in op._RAW and name[0] != "/":
                continue
            if name[0] == "/":
                found = [k for k, e in enumerate(stack) if e[0] == bare]
                if found:
                    del stack[found[-1] :]
                continue
            inner = stack[-1] if stack else ("", False, 0, 0)
            article = inner[2]
            if bare in op._IN and not article:
                articles += 1
                article = articles
            boxes += 1
            stack.append((bare, inner[1] or op._excluded(bare, inside, inner[2]), article, boxes))
        return stack[-1][1:] if stack else (False, 0, 0)

    def breaks(n):
        kind, name, inside = pieces[n]
        bare = name.removeprefix("/")
        if kind == "text" or bare in op._RAW and name[0] != "/":
            return False
        if bare in op._INLINE and bare not in op._NESTING:
            return bare == "span" and name[0] != "/" and op._excluded(bare, inside, around(n, 0)[1])
        return bare not in ("br", "hr", "wbr") and bare not in op._VOID

    text, state, out = "", None, []
    for n, (kind, name, _) in enumerate(pieces):
        left = around(n, 0) != around(n, 1)
        if left or breaks(n):
            ends.append((text, state))
            text, state = "", None
        if kind == "text":
            text += name
            state = around(n, 1)
        elif name.removeprefix("/") in ("br", "hr"):
            text += " "
            state = around(n, 1)
    ends.append((text, state))
    for text, state in ends:
        folded = " ".join(html.unescape(text).split())
        if folded:
            out.append((folded, *state))
    return out


def test_blocks_equal_a_plain_reading():
    random.seed(3)
    units = ["<div>", "</div>", "<p>", "</p>", "<ul>", "</ul>", "<li>", "<article>", "</article>", "<nav>", "</nav>", "<head>", "</head>", "<body>", "<title>t</title>", "<header>", "</header>", "<b>", "</b>", "<br>", "<hr>", "<span class='ad'>", "<span>", "<div class=\"ad\">", "<svg/>", "<svg>x</svg>", "<script>a<b</script>", "<script>", "<!-- <p> -->", "<!--", "<!x>", "<", " < ", "one ", "two", " ", "&amp; ", "<p title='x", "\"", "'", ">", "<em\n>", "<![CDATA[z]]>"]
    for _ in range(1500):
        page = "".join(random.choice(units) for _ in range(random.randint(1, 25)))
        assert [(b.text, b.out, b.article, b.box) for b in op.blocks(page)] == _plain(page), page


@pytest.mark.parametrize("unit", ["<div>", "</ul>", "<svg/>", "<a x", "<a \"'", "<head><p>", "<div><head>x", "<script>", "<!--", "<!", "<", "<p class='", "&amp;", "<span class=\"ad\">x", "<title>x", "<b>\"", "x "])
def test_long_pages(unit):
    page = "<div>" * 1000 + unit * (1_000_000 // len(unit)) + "\"'</div>"
    start = time.time()
    op.main_text(page)
    assert time.time() - start < 8


def test_text_of_a_long_page():
    words = "the cat and the dog of the house " * 30_000
    assert op.main_text(f"<nav>menu</nav><article><p>{words}</p><p>{words}</p></article>") == f"{words.strip()} {words.strip()}"


def test_pages_repeat(spark):
    pages = spark.createDataFrame([(None, None, "<article><p>Hi</p></article>", 1), (1, "u", "", 2), (1, "u", "", 2)], "page_id long, url string, html string, n_chars int")
    found = sorted((tuple(r) for r in op.extract(pages).collect()), key=str)
    assert found == [(1, "u", "", 0), (1, "u", "", 0), (None, None, "Hi", 2)]
    assert op.extract(pages.limit(0)).collect() == []


def _page(inside, around=""):
    return f"<html><head><title>t</title></head><body>{around}<article>{inside}</article></body></html>"


LONG = "There is a great deal to be said for reading the whole of it before one says what it is about, and so it is with this."


def test_words_that_begin_like_marks_are_no_marks():
    for word in ("commentary", "modality", "noticed", "bannerman", "sponsorable", "cookiecutter", "adventure"):
        assert op.main_text(_page(f'<div class="{word}"><p>{LONG}</p></div>')) == LONG, word
    for word in ("comments", "comment-list", "commentList", "commentlist", "modal", "cookie-notice", "newsletter-signup", "sponsored"):
        assert op.main_text(_page(f'<p>{LONG}</p><div class="{word}"><p>{LONG} And more.</p></div>')) == LONG, word


def test_formulas_and_linked_references_stay():
    assert op.main_text(_page("<p>We have <math><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>x=2</annotation></math> and so it is.</p>")) == "We have x=2 and so it is."
    listed = "".join(f'<li><a href="#{i}">Reference number {i}: a title that is long enough to be a block of its own in a list, with its year 19{i}0</a></li>' for i in range(5))
    found = op.main_text(_page(f"<p>{LONG}</p><ol>{listed}</ol>"))
    assert all(f"Reference number {i}:" in found for i in range(5))


def test_no_page_with_an_article_is_empty(spark):
    rows = op.extract(spark.read.parquet("/root/testdata/sf0.1/pages.parquet")).where("n_chars = 0")
    assert rows.count() == 0
