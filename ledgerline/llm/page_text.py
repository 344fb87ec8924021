"""Main text of web pages by the distribution of text over lines.

Markup is stripped to lines, one per block, and lines inside page furniture (navigation, adverts, forms, comments...)
are dropped; on a page that marks its article, so are lines outside it. A line counts its letters outside links, or all
of them if a link is as long as a sentence. The counts of three lines in a row are summed; text starts where the sums
rise from zero (surge) and ends where they are back at zero (dive), and all that lies between is kept. So only three or
more lines in a row that are nothing but short links, which is a menu, part the text, and such lines before its start
and behind its end are not part of it. The tags of a marked article only add to these counts: its borders count as
text, so that fewer than three such lines beside them stay, and so does a line in it without a link, such as a rule of
asterisks.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import quoted

WINDOW = 3
SENTENCE = 5  # words; a line of links with as many is text, such as a reference
# Element names and words of class, id and role attributes; from the HTML standard and common usage.
_RAW = "script|style|iframe|textarea|title|xmp|noembed|noframes"  # text only, so an unclosed one runs to the end
_EMBEDDED = frozenset("svg math object canvas template noscript".split())  # left out up to the closing tag, if there is one
_FURNITURE = frozenset("nav aside form footer head menu button select dialog fieldset audio video map".split())
_BLOCKS = frozenset(
    "html body head main article section header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table "
    "caption thead tbody tfoot tr td th blockquote pre hr address figure figcaption form fieldset legend details "
    "summary menu dialog center hgroup option select button".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ALWAYS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notification alert popup modal overlay newsletter subscribe subscription signup login search menu "
    "nav navbar navigation breadcrumb breadcrumbs sidebar aside widget share sharing social related recommended "
    "recommendations comment comments commentlist respond reply replies disqus discussion pagination pager toolbar "
    "skip tags footer copyright legal disclaimer".split()
)
_OUTSIDE = frozenset("header masthead topbar".split())  # furniture unless inside the article
# Words that change nothing beside those two, such as in site-header and comment-list.
_SITE = frozenset(["site"])
_NEUTRAL = frozenset("area bar block body box button buttons form group icons inner item items links list posts primary secondary section site slot top bottom unit".split())
_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.DOTALL)


def _token(rest: str) -> re.Pattern[str]:
    return re.compile(
        rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
        rf"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<rest>{rest})>|<[!?][^>]*>|</[^>]*>",
        re.DOTALL | re.IGNORECASE,
    )


_QUOTED = _token(r"(?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+")
_PLAIN = _token(r"[^>]*+")
_NAMED = re.compile(r"</?[a-zA-Z]")
_WORD = re.compile(r"[^\W_]+")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_READ = frozenset("class id role itemprop hidden aria-hidden".split())


def _tokens(page: str) -> Iterator[re.Match[str]]:
    """Tags, comments and raw elements in one pass forward. Where a quote in a tag is never closed, this tag and all
    after it are read without regard to quotes, so no part of a page is gone through again for each tag."""
    pattern, last, at = _QUOTED, page.rfind(">"), page.find("<")
    while at >= 0:
        # Behind the last > there can only be a comment that is not closed.
        found = (pattern if at < last else _COMMENT).match(page, at)
        if found is None and at < last and pattern is _QUOTED and _NAMED.match(page, at):
            pattern = _PLAIN
            continue
        if found is not None:
            yield found
        at = page.find("<", found.end() if found else at + 1)


def _marks(rest: str) -> dict[str, set[str]]:
    """The whole words of the attributes that tell what an element is."""
    if "=" not in rest and "hidden" not in rest:
        return {}
    found = ((m[1].lower(), m[2]) for m in _ATTRIBUTE.finditer(rest))
    return {name: set((value or "true").strip("\"'").lower().split()) for name, value in found if name in _READ}


def _says(names: set[str], furniture: frozenset[str], beside: frozenset[str]) -> bool:
    """True if a name is furniture as a whole: ``comment-list`` is, ``has-sidebar`` and ``category-legal`` are not."""
    for name in names:
        parts = set(re.split(r"[-_]+", name)) - {""}
        if parts & furniture and parts <= furniture | beside:
            return True
    return False


def _embedded(tokens: list[re.Match[str]]) -> dict[int, int]:
    """Start of each embedded element that is closed, with its end."""
    found: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for token in tokens:
        name = (token["name"] or "").lower() if token.re is not _COMMENT else ""
        if name not in _EMBEDDED:
            continue
        if token["close"]:
            if opened.get(name):
                found[opened[name].pop()] = token.end()
        elif not token["rest"].endswith("/"):
            opened.setdefault(name, []).append(token.start())
    return found


def _letters(text: str) -> int:
    """Letters and digits; marks between links, such as ``|`` and ``&raquo;``, are none."""
    return sum(map(len, _WORD.findall(html_lib.unescape(text) if "&" in text else text)))


def lines_of(page: str) -> list[tuple[str, bool, bool, int]]:
    """Blocks of a page in order: text, whether in page furniture, whether in its article, letters outside links."""
    out: list[tuple[str, bool, bool, int]] = []
    parts: list[str] = []
    plain, breaks, in_link, linked = 0, 0, False, False
    open_: list[tuple[str, bool, bool]] = []  # name, furniture, article
    furniture = article = 0

    def end_line() -> None:
        nonlocal plain, linked
        if parts:
            text = " ".join(html_lib.unescape("".join(parts)).split())
            if text:
                out.append((text, furniture > 0, article > 0, plain or int(article > 0 and not linked)))
            parts.clear()
        plain, linked = 0, in_link

    def close(until: int) -> None:
        nonlocal furniture, article
        while len(open_) > until:
            _, chrome, main = open_.pop()
            furniture, article = furniture - chrome, article - main

    at = 0
    tokens = list(_tokens(page))
    embedded = _embedded(tokens)
    for token in tokens:
        if token.start() < at:  # in an embedded element
            continue
        if token.start() > at:
            text = page[at : token.start()]
            parts.append(text)
            if not text.isspace():
                breaks = 0
                if not in_link:
                    plain += _letters(text)
        at = embedded.get(token.start(), token.end())
        name = (token["name"] or "").lower() if token.re is not _COMMENT else ""
        if not name:
            continue
        if name == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:
                end_line()
            continue
        if name == "a":
            in_link = not token["close"]
            linked = linked or in_link
        if name in _BLOCKS:
            end_line()
        if name in _VOID or name in _EMBEDDED or token["rest"].endswith("/"):
            continue
        if token["close"]:
            for k in range(len(open_) - 1, -1, -1):
                if open_[k][0] == name:
                    close(k)
                    break
            continue
        marks = _marks(token["rest"])
        told = name in ("article", "main") or "main" in marks.get("role", ()) or "articlebody" in marks.get("itemprop", ())
        said = marks.get("class", set()) | marks.get("id", set()) | marks.get("role", set())
        by_name = name not in ("html", "body") and _says(said, _ALWAYS, _NEUTRAL)
        if furniture and (name == "main" or name == "article" and not by_name):
            close(next(k for k, o in enumerate(open_) if o[1]))  # an article does not stand in furniture: something was left open
        main = told and not furniture
        chrome = (
            name in _FURNITURE
            or by_name and not told
            or not article and not told and (name == "header" or name not in ("html", "body") and _says(said, _OUTSIDE, _SITE))
            or "true" in marks.get("aria-hidden", ()) or "hidden" in marks
        )
        if name == "body":
            close(0)
        if name in _BLOCKS or chrome or main:
            if chrome or name != "p":  # a paragraph is often left open, and ends with its line anyhow
                open_.append((name, chrome, main and not chrome))
                furniture, article = furniture + chrome, article + (main and not chrome)
    if at < len(page):
        parts.append(page[at:])
        plain += 0 if in_link else _letters(page[at:])
    end_line()
    return out


def main_text(page: str | None) -> str:
    """The page's main text, blocks joined by line feeds; empty if there is none."""
    lines = [line for line in lines_of(page or "") if not line[1]]
    marked = any(inside for _, _, inside, _ in lines)
    lines = [line for line in lines if line[2] or not marked]
    weight = [plain if plain or len(text.split()) < SENTENCE else len(text) for text, _, _, plain in lines]
    edge = int(marked)  # a line at either end stands for the article's tags
    weight = [1] * edge + weight + [1] * edge
    spans, start = [], None
    for k in range(len(weight) + 1):
        here = sum(weight[k : k + WINDOW])
        if here and start is None:
            start = next(j for j in range(k, k + WINDOW) if weight[j])  # surge, from the line that makes it
        elif not here and start is not None:
            spans.append((start, k))  # dive
            start = None
    kept = [k - edge for a, b in spans for k in range(a, b)]
    return "\n".join(lines[k][0] for k in kept if 0 <= k < len(lines))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of each page, one row per row of ``pages``; a null page has no text. Each page
    is read where it is; nothing is shuffled."""
    types = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(*[F.col(quoted(c)) for c in ("page_id", "url")], F.col("html").cast("string").alias("html"))
    return narrow.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")
