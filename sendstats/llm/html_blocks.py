"""Main text of web pages by line-block distribution.

Markup is stripped to lines, one per block element. Lines inside elements that never
hold article text (menus, forms, adverts and so on) stand empty. The text lengths of
each line and its neighbours are summed over a sliding window; the curve surges where the
article begins and dives where it ends, and all lines between are kept.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# Element names of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "object", "canvas", "audio", "video", "textarea", "title")
ASIDE = frozenset("head nav footer aside form button select menu dialog fieldset".split())
CONTENT = frozenset("article main".split())

# Words in the class, id or role of an element that name what is not the article.
MARKS = frozenset(
    "ad ads adv advert advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments "
    "cookie cookies consent disclaimer disqus footer header masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination pager popup promo promoted related recommended reply replies respond share sharing sidebar skip social "
    "sponsor sponsored subscribe subscription toolbar widget contentinfo complementary search alert "
    "copyright".split()
)
# Words that may stand beside them in a name ("ad-box", "comment-list") without changing what it names.
BESIDE = frozenset(
    "area bar block box btn button buttons container content form group icon icons inner item items left link links list main "
    "outer page panel posts right section site slot thread top unit wrap wrapper bottom".split()
)
# In an article these name parts of it as well.
OWN = frozenset("header banner masthead alert notice notices disclaimer".split())
# Ids are made from the text of headings; only these, as a whole, tell what is not the article.
IDS = frozenset("comment comments disqus disqus_thread respond sidebar navbar breadcrumb breadcrumbs masthead adbox adslot".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
WINDOW = 3  # lines that are summed

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
_FORM_END = re.compile(r"</form\b[^>]*>", re.I)
_HOLDS = re.compile(r"<(?:article|main|h1)\b", re.I)
_BODY_BEGINS = re.compile(r"<body\b[^>]*>\s*\Z", re.I)
_BODY_ENDS = re.compile(r"\s*(?:<script\b.*?</script\s*>\s*)*(?:</body|</html|\Z)", re.I | re.S)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


def _words(value: str) -> list[str]:
    return [w.lower() for w in _PARTS.findall(value)]


def _marked(token: str) -> bool:
    """Whether a whole class name, such as "ad-box", names what is not the article."""
    words = set(_words(token))
    return words <= MARKS | BESIDE and not words.isdisjoint(MARKS - OWN)


def _unwanted(name: str, attributes: str, in_content: bool) -> bool:
    """Whether an element is none of the article; a header or title inside the article belongs to it."""
    if name in ASIDE or name == "header" and not in_content:
        return True
    if not attributes or name in CONTENT or name in ("html", "body"):
        return False
    # The first of repeated attributes holds.
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    if "hidden" in found or found.get("aria-hidden", "").strip().lower() == "true" or _NOT_SHOWN.search(found.get("style", "")):
        return True
    identity = found.get("id", "").strip()
    if name not in HEADINGS and (identity.lower() in IDS or not in_content and _marked(identity)):
        return True
    classes, roles = found.get("class", ""), found.get("role", "").lower().split()
    if not MARKS.isdisjoint(roles):
        return True
    if in_content:
        return any(_marked(token) for token in classes.split())
    return not MARKS.isdisjoint(_words(classes))


def _around(page: str, start: int, at: int) -> bool:
    """Whether the form with the tag at ``start`` to ``at`` stands round the article or the whole body."""
    close = _FORM_END.search(page, at)
    inner, after = (close.start(), close.end()) if close else (len(page), len(page))
    if _HOLDS.search(page, at, inner):
        return True
    return bool(_BODY_BEGINS.search(page[max(0, start - 2_000) : start]) and _BODY_ENDS.match(page, after))


def lines_of(page: str) -> list[tuple[str, bool, bool]]:
    """(text, wanted, in an article element) of each block of a page, in page order."""
    out: list[tuple[str, bool, bool]] = []
    buffer: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # name, unwanted, content
    state = [True, False]

    def flush() -> None:
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append((text, state[0], state[1]))

    def settle() -> None:
        state[0] = not any(unwanted for _, unwanted, _ in stack)
        state[1] = any(content for _, _, content in stack)

    at, end = 0, len(page)
    while at < end:
        tag = _TAG.search(page, at)
        if tag is None:
            buffer.append(page[at:])
            break
        buffer.append(page[at : tag.start()])
        at = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        if not tag[1]:
            if name == "br":
                buffer.append(" ")
                continue
            if name in RAW:
                close = _RAW_END[name].search(page, at)
                at = close.end() if close else end
                continue
            unwanted = _unwanted(name, tag[3], state[1])
            if name == "form" and not state[1] and _around(page, tag.start(), at):
                unwanted = False
            if name in BLOCKS or unwanted:
                flush()
            if name not in VOID and not tag[3].endswith("/"):
                # A paragraph ends where the next block begins; list items and cells end one another.
                if name in BLOCKS:
                    while stack and stack[-1][0] == "p" or stack and stack[-1][0] == name and name in ("li", "td", "th", "tr", "dt", "dd", "option"):
                        stack.pop()
                if unwanted or name in BLOCKS or name in CONTENT:
                    stack.append((name, unwanted, name in CONTENT))
                    settle()
        else:
            names = [n for n, _, _ in stack]
            if name in BLOCKS or name in names:
                flush()
            if name in names:
                del stack[len(names) - 1 - names[::-1].index(name):]
                settle()
    flush()
    return out


def between(lengths: list[int], floor: int) -> tuple[int, int]:
    """First and last line of the article: where the sums over the window surge and dive.

    The curve surges at the first sum above ``floor`` and dives after the last such sum.
    Windows reach over the edges, so both ends are then moved in to lines with text.
    """
    sums = [sum(lengths[i : i + WINDOW]) for i in range(len(lengths))]
    high = [i for i, s in enumerate(sums) if s > floor]
    if not high:
        return 0, -1
    first, last = high[0], min(high[-1] + WINDOW - 1, len(lengths) - 1)
    while first < last and not lengths[first]:
        first += 1
    while last > first and not lengths[last]:
        last -= 1
    return first, last


def main_text(page: str | None) -> str:
    """The article of a page: its blocks joined by empty lines; empty if there is none."""
    lines = lines_of(page or "")
    article = any(wanted and content for _, wanted, content in lines)
    # Where the page marks its article, all lines outside it stand empty; the curve then
    # has nothing but the article, whose shortest lines count as well.
    lengths = [len(text) if wanted and (content or not article) else 0 for text, wanted, content in lines]
    floor = 0 if article else min(80, max(lengths, default=0) // 2)
    first, last = between(lengths, floor)
    return "\n\n".join(lines[i][0] for i in range(first, last + 1) if lengths[i])


def main_texts(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    NULL and empty pages, and pages without an article, have an empty text. Repeated rows
    stay apart, an empty table gives no rows, and other columns are not carried.
    """

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(page) for page in frame["html"]]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    kind = pages.schema["page_id"].dataType.simpleString()
    # Ids travel as text: pandas would turn a column with NULLs into floats.
    keyed = pages.selectExpr("CAST(page_id AS string) AS page_id", "url", "html")
    found = keyed.mapInPandas(extract, "page_id string, url string, text string, n_chars bigint")
    return found.selectExpr(f"CAST(page_id AS {kind}) AS page_id", "url", "text", "n_chars")
