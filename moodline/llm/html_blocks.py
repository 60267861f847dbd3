"""Main text of web pages by two-pass block rules (operator 9).

Markup is cut into blocks at block-level tags. The first pass decides blocks by
the place they stand in (menus, forms, adverts and the like are out), link
density, length and the share of stop words: long blocks rich in stop words are
main text, blocks made of links are not, and short or undecided ones wait. Stop
words decide only on pages rich in them; on others, in a language without a list
or full of numbers, blocks of some length with few links are main text. In
the second pass a waiting block inherits the label of its nearest decided
neighbours: both sides agree, or the nearer one wins, or, between two equally
near, main text; on a page without any main text so far, all waiting blocks are.
Where a page marks its article (article, main or the roles of those names),
blocks outside it are out and blocks inside it are main text unless they stand
in a place that is out.

Words in a class or id (``sidebar``, ``comments``) put an element out, but not one
that only tells of its page (``has-sidebar``, ``search-result-page``), holds the
marked article or, comments apart, holds most of the page's text.

Cases: null and empty pages give an empty text. Unclosed and crossed tags,
comments and references are read as browsers do; text is never dropped for its
length. Extra columns pass through.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from moodline.llm import ships_by_value

ships_by_value(__name__)

# Common function words of four languages.
STOP_WORDS = frozenset("""
the of and to in is that it for was on are as with they at be this from have or by one had not but what all were
when we there can an your which their said if do will each about how up out them then she many some so these would
der die das und ist von zu den mit ein eine auf für im dem nicht sich des auch als an es wird aus er hat dass sie
nach bei noch war wie über einen so zum haben nur oder vor zur bis mehr durch man dann da sein einer einem
le la les de des et un une est que qui dans pour sur pas au par il elle ce se ne plus son avec sont mais ou du en
aux cette ses nous vous été leur comme être fait tout deux même ces
el los las y que se no su por con para una como más pero sus este ya entre cuando muy sin sobre también me hasta
hay donde quien desde nos durante uno ni contra otros ese eso ante ellos del al lo es
""".split())

# Tags by their role.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option
p pre section summary table tbody td tfoot th thead title tr ul""".split())
_OUT_TAGS = frozenset("""head nav footer aside form button select textarea script style noscript template svg math
iframe object canvas audio video map dialog menu label fieldset title""".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp svg math".split())
_ENDS_P = _BLOCK - {"body", "html", "head", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option"}
# Words in class, id and role that mark what is not main text.
_OUT_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
comments consent cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notices
overlay pagination popup promo promoted promotion recommended related replies reply share sharing sidebar signup
social sponsor sponsored subscribe subscription toolbar widget complementary contentinfo search alert dialog
""".split())
# Beside one of those words in one name, they tell of a page or a state; readers' words.
_STATE_WORDS = frozenset("has have with without no not page layout site body enabled open".split())
_READER_WORDS = frozenset("comment comments disqus reply replies".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>?
    |<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?:[^>"']++|"[^"]{0,2000}+"|'[^']{0,2000}+')*+|[^>]*+)>""", re.S | re.X)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_DENSE = re.compile("[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff]")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

LONG, SHORT = 200, 70
STOP_HIGH, STOP_LOW = 0.30, 0.15
LINKS = 0.33


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    out: bool  # stands in a place that is never main text
    inside: bool  # stands in a marked article
    heading: bool


MOST = 0.5  # of a page's text, in an element that is therefore not out for its name


def _named_out(value: str) -> tuple[bool, bool]:
    """(a name of this class or id puts its element out, as readers' words)."""
    out = readers = False
    for name in value.split():
        parts = {w.lower() for w in _NAME.findall(name)}
        if parts & _OUT_WORDS and not parts & _STATE_WORDS:
            out, readers = True, readers or bool(parts & _READER_WORDS)
    return out, readers


def _marks(attributes: str) -> tuple[bool, bool, bool, bool]:
    """(hidden or of a role that is out, out by name, by readers' words, marks an article)."""
    out = named = readers = inside = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            out = True
        elif name == "style":
            out |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I))
        elif name == "role":
            out |= value.lower() in _OUT_WORDS
            inside |= value.lower() in ("main", "article")
        else:
            found, by = _named_out(value)
            named, readers = named or found, readers or by
    return out, named, readers, inside


def blocks(page: str) -> list[Block]:
    done: list[Block] = []
    held: list[int] = []  # per block: the nearest element around it that is out by name, -1: none
    parts: list[str] = []
    linked = 0
    # tag, out, inside an article, nearest element that is out by name
    stack: list[tuple[str, bool, bool, int]] = []
    places: dict[str, list[int]] = {}  # open tags by name
    open_blocks: list[int] = []
    out = inside = False
    named = -1
    around: list[int] = []  # of every element that is out by name: the next one around it
    readers: list[bool] = []  # and whether by readers' words
    cleared: set[int] = set()  # those that are not out, after all
    article = False
    links = 0
    breaks = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                done.append(Block(text, linked, out, inside, any(t in _HEADINGS for t, *_ in stack[-3:])))
                held.append(named)
            parts.clear()
        linked = 0

    def pop_to(at: int) -> None:
        nonlocal out, inside, links, named
        while len(stack) > at:
            tag = stack.pop()[0]
            links -= tag == "a"
            places[tag].pop()
            if open_blocks and open_blocks[-1] == len(stack):
                open_blocks.pop()
        out, inside, named = stack[-1][1:] if stack else (False, False, -1)

    def add(text: str) -> None:
        nonlocal linked, breaks
        if text:
            parts.append(text)
            if links:
                linked += len("".join(text.split()))
            if not text.isspace():
                breaks = 0

    at, end = 0, len(page)
    last = page.rfind(">")
    while at < end:
        # Beyond the last closing bracket no tag ends, and nothing but a comment is left to find.
        m = _TOKEN.search(page, at) if at <= last else re.compile(r"<!--.*|<[!?].*", re.S).search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = m["tag"] if at <= last + 1 and m.re is _TOKEN else None
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            if tag in _BLOCK:
                close()
            if places.get(tag) and (tag in _BLOCK or not open_blocks or open_blocks[-1] < places[tag][-1]):
                pop_to(places[tag][-1])
            continue
        if tag == "br":
            breaks += 1
            if breaks > 1:
                close()
            else:
                parts.append(" ")
            continue
        if tag in _BLOCK:
            close()
            breaks = 0
            ended = {"p"} if tag in _ENDS_P else set()
            ended |= {"li"} if tag == "li" else {"dd", "dt"} if tag in ("dd", "dt") else {"option"} if tag == "option" else set()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ended:
                    pop_to(i)
                    break
                if stack[i][0] in _BLOCK and stack[i][0] != "p":
                    break
        if tag in _VOID:
            continue
        marked_out, by_name, by_readers, marked_in = _marks(m["more"]) if m["more"] else (False,) * 4
        starts_article = marked_in or tag in ("article", "main")
        if tag in ("html", "body", "article", "main"):
            marked_out = False
        elif not inside:
            marked_out |= tag == "header" or "header" in _NAME.findall(m["more"].lower())
        if starts_article and not out and not marked_out and not article and not by_name:
            k = named
            while k >= 0:  # what holds the article is not out for its name
                cleared.add(k)
                k = around[k]
            article = True
        if tag in ("html", "body", "article", "main"):
            by_name = False
        if tag in ("svg", "math") and m["more"].endswith("/"):
            continue
        if tag in _RAW:
            shut = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = shut.end() if shut else end
            continue
        if m["more"].endswith("/"):
            continue
        if by_name:
            readers.append(by_readers)
            around.append(named)
            named = len(around) - 1
        places.setdefault(tag, []).append(len(stack))
        if tag in _BLOCK:
            open_blocks.append(len(stack))
        stack.append((tag, out or marked_out or tag in _OUT_TAGS, inside or starts_article, named))
        out, inside, named = stack[-1][1:]
        links += tag == "a"
    close()
    total = sum(len(b.text) for b in done if not b.out)
    size = [0] * (len(around) + 1)  # the last entry gathers what lies in none
    for b, k in zip(done, held, strict=True):
        if not b.out:
            size[k] += len(b.text)
    for k in range(len(around) - 1, -1, -1):  # elements come after those around them
        size[around[k]] += size[k]
    named_out = [False] * (len(around) + 1)
    for k, outer in enumerate(around):
        own = k not in cleared and (article or readers[k] or size[k] <= MOST * total)
        named_out[k] = own or named_out[outer]
    for b, k in zip(done, held, strict=True):
        b.out |= named_out[k]
    return done


def stop_count(text: str) -> tuple[int, int]:
    """(stop words, words)."""
    found = text.lower().split()
    return sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in found), len(found)


def _extent(text: str) -> int:
    """Characters, those of scripts that write a word in one or two of them counted three times."""
    return len(text) + 2 * len(_DENSE.findall(text))


def first_pass(found: list[Block]) -> list[bool | None]:
    """True: main text, False: not, None: waits for its neighbours."""
    marked = any(b.inside and not b.out for b in found)
    labels: list[bool | None] = []
    undecided: list[tuple[int, int, int]] = []  # block, stop words, words
    for i, b in enumerate(found):
        density = b.linked / max(1, len(b.text.replace(" ", "")))
        if b.out or marked and not b.inside:
            labels.append(False)
        elif density > LINKS and not b.inside:
            labels.append(False)
        else:
            labels.append(None)
            if _extent(b.text) >= SHORT and not b.heading:
                undecided.append((i, *stop_count(b.text)))
    listed = sum(stop for _, stop, _ in undecided) >= STOP_HIGH * sum(n for *_, n in undecided)
    for i, stop, n in undecided:
        share = stop / n
        if not listed or share >= STOP_HIGH or share >= STOP_LOW and len(found[i].text) >= LONG:
            labels[i] = True
    return labels


def second_pass(found: list[Block], labels: list[bool | None]) -> list[bool]:
    """Waiting blocks inherit from their nearest decided neighbours.

    Inside a marked article only neighbours inside it count, and without any
    the block is main text; elsewhere the page's edges count as not main text.
    """
    n = len(found)
    left: list[tuple[int, bool] | None] = [None] * n
    right: list[tuple[int, bool] | None] = [None] * n
    for order, side in ((range(n), left), (range(n - 1, -1, -1), right)):
        last: dict[bool, tuple[int, bool] | None] = {True: None, False: None}
        for i in order:
            side[i] = last[found[i].inside]
            if labels[i] is not None and not (found[i].inside and not labels[i]):
                last[found[i].inside] = (i, bool(labels[i]))
    out = []
    for i, label in enumerate(labels):
        if label is not None:
            out.append(label)
            continue
        near = [x for x in (left[i], right[i]) if x]
        if not near:
            out.append(found[i].inside)
        elif len({x[1] for x in near}) == 1 and (len(near) == 2 or found[i].inside):
            out.append(near[0][1])
        elif len(near) == 1:
            out.append(near[0][1] and (found[i].heading or found[i].inside or abs(near[0][0] - i) == 1))
        else:
            apart = [abs(x[0] - i) for x in near]
            out.append(True if apart[0] == apart[1] else near[apart.index(min(apart))][1])
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    labels = first_pass(found)
    keep = second_pass(found, labels)
    if not any(keep):
        keep = [label is None for label in labels]
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        names = [f.name for f in batch.schema if f.name != "html"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=[*names, "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with html replaced by text, its main text, and n_chars, that text's code points."""
    rest = [f for f in pages.schema.fields if f.name not in ("html", "text", "n_chars")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), "text string", "n_chars long"])
    return pages.select(*(f.name for f in rest), "html").mapInArrow(_extract, schema)
