"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block-level tags. In the first pass each block is decided
by where it stands (menus, footers, forms and the like are out, an article's body is in)
and by its length, stop-word density and link density; short blocks stay ambiguous. In
the second pass an ambiguous block takes the label of its nearest decided neighbours
inside or outside the article, of two as near the one in the same element; where they
still disagree it is out.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factweave.llm import _words
from factweave.llm._store import bounded_batches

# Common function words.
STOP_WORDS = frozenset(
    """a an and are as at be been but by can do for from had has have he her his i if in is it its not of on or our she
    so that the their them there they this to was we were what when which who will with you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die doch du ein eine einem einen einer er es für
    hat ich ihr im in ist ja kann mit nach nicht noch nur oder sein sich sie sind so um und uns von vor war was wenn
    wie wir zu zum zur über
    au aux avec ce ces cette dans de des du elle en est et être il ils je la le les leur lui mais ne nous on ou où par
    pas plus pour que qui sa se ses son sont sur un une vous à
    al como con cual de del el ella en era es esta este fue ha hay la las lo los me mi más muy no nos o para pero por
    que se ser si sin sobre son su sus también te un una y ya yo""".split()
)
# Thresholds of the block rules (characters and shares).
SHORT, LONG, STOP_LOW, STOP_HIGH, LINKS = 70, 200, 0.30, 0.32, 0.2
# Elements.
_RAW = frozenset("script style noscript template textarea title iframe svg annotation annotation-xml canvas object audio video xmp noembed noframes".split())
_OUT = frozenset("head nav footer aside form button select option label fieldset menu dialog datalist".split())
_IN = frozenset("article main".split())
#: What may stand in a head; any other element, or text, ends a head that is left open.
_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript template".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Formulas are part of the text they stand in.
_MATH = frozenset("math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
_INLINE = _MATH | frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
_NESTING = frozenset("div section article main nav header footer aside form ul ol dl table tbody thead tr td th fieldset figure body html head details dialog menu button select blockquote label".split())
# Words of class, id and role that mark what is not the article.
_WORDS_OUT = frozenset("ad ads adv nav navbar menu social share sharing related promo tags login signup search skip legal copyright complementary navigation contentinfo dialog alert alertdialog hidden toc".split())
#: Words that mark it alone, in the plural, or put together with one that names a container.
_MARKS_OUT = re.compile(
    r"(?:advert(?:s|ise|isement|isements|ising)?|adsense|comments?|commenters?|sidebars?|cookies?|consent|newsletters?|subscri(?:be|bed|ber|bers|ption|ptions)|sponsor(?:s|ed|ship)?|breadcrumbs?|footers?|banners?|popups?|modals?"
    r"|notices?|notif(?:y|ication|ications)|widgets?|disqus|replies|toolbars?|masthead|paginat(?:e|ion|or)|outbrain|taboola|gdpr|dropdowns?|recommend(?:ed|ation|ations)|promos?|menus?|navbars?)"
    r"(?:area|bar|block|body|box|container|content|count|dialog|feed|form|group|holder|inner|item|items|link|links|list|lists|outer|overlay|panel|region|root|row|section|slot|text|thread|tree|unit|widget|wrap|wrapper|zone)?"
)
_HEADER_OUT = frozenset("header topbar".split())
_ARTICLE_WORDS = frozenset("article post entry content story body main".split())

_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"""(class|id|role|aria-label|aria-hidden|style|hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[a-z]+", re.I)
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    """Text between two block-level tags."""

    text: str
    linked: int
    out: bool
    article: int  # number of the article or main element around it, 0 outside
    box: int  # number of the innermost grouping element around it
    label: str = ""


def _excluded(name: str, attributes: str, article: int) -> bool:
    if name in _OUT:
        return True
    if name == "header":
        return not article
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
            continue
        parts = [p.lower() for p in _PART.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value))]
        if any(p in _WORDS_OUT or _MARKS_OUT.fullmatch(p) for p in parts):
            return True
        if not article and any(p in _HEADER_OUT for p in parts) and not any(p in _ARTICLE_WORDS for p in parts):
            return True
    return False


def _tokens(page: str) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, name, attributes) of each piece of markup in order; the name of a
    closing tag begins with a slash, and comments and declarations have none. A quote
    without its fellow is an ordinary character; what is not closed ends with the page.
    Each character is looked at a bounded number of times. The receiver may send the
    place to go on from."""
    size = len(page)
    last = {q: page.rfind(q) for q in "\"'"}
    at = page.find("<")
    while at >= 0:
        name = attributes = ""
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            end = size if end < 0 else end + 3
        elif page.startswith("<![CDATA[", at):
            end = page.find("]]>", at + 9)
            end = size if end < 0 else end + 3
        elif page.startswith(("<!", "<?"), at):
            end = page.find(">", at)
            end = size if end < 0 else end + 1
        else:
            found = _NAME.match(page, at + 1)
            if found is None:
                at = page.find("<", at + 1)
                continue
            name, end = found[0].lower(), found.end()
            while True:
                stop = _STOP.search(page, end)
                if stop is None:
                    end = size
                    break
                end = stop.end()
                if stop[0] == ">":
                    break
                if stop.start() < last[stop[0]]:
                    end = page.index(stop[0], end) + 1
            attributes = page[found.end() : end].removesuffix(">")
        on = yield at, end, name, attributes
        at = page.find("<", end if on is None else on)


_CLOSERS = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in _RAW}


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, white space folded and references decoded. The time is
    in proportion to the page's length, whatever its markup."""
    out: list[Block] = []
    stack: list[tuple[str, bool, int, int]] = []  # name, excluded, article, box
    open_: dict[str, int] = {}  # how many elements of a name the stack holds
    heads: list[int] = []  # where on the stack the heads are
    unclosed: set[str] = set()  # raw elements without a closing tag from here on
    text: list[str] = []
    links: list[str] = []
    in_link = articles = boxes = 0
    excluded, article, box = False, 0, 0

    def close() -> None:
        nonlocal text, links
        if text:
            joined = " ".join(_html.unescape("".join(text)).split())
            if joined:
                out.append(Block(joined, len(" ".join(_html.unescape(" ".join(links)).split())), excluded, article, box))
        text, links = [], []

    def pop(until: int) -> None:
        nonlocal excluded, article, box
        while len(stack) > until:
            open_[stack.pop()[0]] -= 1
        while heads and heads[-1] >= until:
            heads.pop()
        excluded, article, box = stack[-1][1:] if stack else (False, 0, 0)

    def leave_head() -> None:
        """What cannot stand in an open head ends it."""
        if heads:
            close()
            pop(heads[0])

    def add(part: str) -> None:
        if heads and part.strip():
            leave_head()
        text.append(part)
        if in_link:
            links.append(part)

    at, on = 0, None
    tokens = _tokens(page)
    while True:
        try:
            start, end, name, attributes = tokens.send(on)
        except StopIteration:
            break
        on = None
        if start > at:
            add(page[at:start])
        at = end
        if not name:
            continue
        closing, name = name.startswith("/"), name.removeprefix("/")
        if not closing and name not in _HEAD:
            leave_head()
        if name == "a":
            in_link = 0 if closing else 1
        if name in _RAW and not closing:
            if name in ("svg", "annotation", "annotation-xml") and attributes.rstrip().endswith("/"):
                continue
            found = None if name in unclosed else _CLOSERS[name].search(page, at)
            if found is None:
                unclosed.add(name)
            on = at = found.end() if found else len(page)
            continue
        if name in _INLINE and name not in _NESTING:
            if name != "span" or closing or not _excluded(name, attributes, article):
                continue
        if name in ("br", "hr", "wbr"):
            text.append(" " if name != "wbr" else "")
            continue
        if name in _VOID:
            continue
        close()
        if name not in _NESTING:
            continue
        if closing:
            if open_.get(name):
                until = len(stack) - 1
                while stack[until][0] != name:
                    until -= 1
                pop(until)
        else:
            inside = article
            if name in _IN and not article:
                articles += 1
                inside = articles
            boxes += 1
            if name == "head":
                heads.append(len(stack))
            open_[name] = open_.get(name, 0) + 1
            stack.append((name, excluded or _excluded(name, attributes, article), inside, boxes))
            excluded, article, box = stack[-1][1:]
        in_link = 0
    if at < len(page):
        add(page[at:])
    close()
    return out


def _first_pass(block: Block) -> str:
    if block.out:
        return "bad"
    n = len(block.text)
    density = block.linked / n
    if block.article:
        # Lists of linked references are part of an article; what is no part of it is marked as such.
        return "good" if n >= SHORT or density <= 0.5 else ""
    if density > LINKS and (n < LONG or density > 0.5):
        return "bad"
    if n < SHORT:
        return "bad" if block.linked else ""
    found = [w.lower() for w in _WORD.findall(block.text)]
    stops = sum(w in STOP_WORDS for w in found) / max(1, len(found))
    if stops >= STOP_HIGH or n >= LONG and stops >= STOP_LOW / 3:
        return "good"
    return "good" if stops >= STOP_LOW else ""


def main_text(page: str | None) -> str:
    """The article's text: kept blocks in page order, joined by a space."""
    if not page:
        return ""
    found = blocks(page)
    for block in found:
        block.label = _first_pass(block)
    whole = any(b.article and not b.out and b.label == "good" for b in found)
    if whole:
        for block in found:
            if not block.article:
                block.label = "bad"
    decided = [b.label for b in found]
    before: list[tuple[int, str]] = []
    last: dict[int, tuple[int, str]] = {}
    for i, b in enumerate(found):
        before.append(last.get(b.article, (-1, "")))
        if decided[i] and not b.out:
            last[b.article] = (i, decided[i])
    last = {}
    for i in range(len(found) - 1, -1, -1):
        b = found[i]
        after = last.get(b.article, (-1, ""))
        if not decided[i]:
            near = [(abs(i - k), found[k].box != b.box, label) for k, label in (before[i], after) if k >= 0]
            nearest = [label for d, apart, label in near if (d, apart) == min(near)[:2]]
            b.label = "good" if nearest and all(x == "good" for x in nearest) else "bad"
            if b.article and not near:
                b.label = "good"
        if decided[i] and not b.out:
            last[b.article] = (i, decided[i])
    return " ".join(b.text for b in found if b.label == "good")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) of each page. A null or empty page gives an empty
    text; a page of any length is read whole by one task, in some ten times its bytes; broken, unclosed or cut-off markup is read as far as it goes. Every row is on
    its own, whatever its key; further columns are not read."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in _words.chunks(batch, "html", 8_000_000):
                texts = [main_text(p) for p in chunk.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([chunk.column("key"), chunk.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["key", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    out = bounded_batches(rows).mapInArrow(work, f"key {kinds['key']}, url {kinds['url']}, text string, n_chars long")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
