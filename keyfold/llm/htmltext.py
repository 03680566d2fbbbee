"""Main text of web pages by block rules in two passes.

A page is cut into blocks at its block-level tags. What stands in menus, forms,
adverts and the like is out by its element, role or class. The first pass judges
a block by its length, its share of linked text and its share of stop words, and
leaves the rest undecided. The second pass lets undecided blocks inherit from the
nearest decided ones before and after. Where the page marks its article, that is
a prior: within it a block is only bad if most of it is linked and others beside it
are as well, outside of it only long prose is good. Of several kinds of marks the one with most prose counts, so
teasers in <article> do not outdo a text in <main>.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .quality import STOP_WORDS
from .tokencount import batches_of

# Their content is not markup, and lasts to the end of the page if they are not closed.
_RAW = "script|style|textarea"
# Left out with all they hold; those that are not closed hold nothing.
_HELD = frozenset("noscript template iframe object svg canvas select audio video map math".split())
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    # A quote only opens a value after an equals sign; elsewhere it is a character like others.
    r"""|<(/?)([a-z][a-z0-9:-]*)((?:[^<>=]++|=\s*+(?>"[^"]*"|'[^']*')|=)*+)>""",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([a-z][a-z0-9:-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_LINK_TAG = re.compile(r"<(/?)a[\s>]", re.IGNORECASE)
_PART = re.compile(r"[a-z]+")

_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_OUT = frozenset("head title nav footer aside button dialog menu".split())
# Out as well, unless nothing outside of them is prose: some pages are one form.
_FORMS = frozenset(("form", "fieldset"))
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
# Words of a class or id that mark what is not the article.
_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar navigation menu breadcrumb"
    " breadcrumbs masthead footer cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe"
    " subscription signup login share sharing social related recommended recommendations comment comments commentlist respond reply replies"
    " disqus discussion widget toolbar pagination pager skip".split()
)
_CONTENT_WORDS = frozenset("article content entry post story main".split())
# What a class name may have beside them, as in `ad-box`; `with-sidebar` is not a sidebar.
_BESIDE_WORDS = _CONTENT_WORDS | frozenset(
    "a area bar block body box buttons bottom container form global group header icons inner left links list l m message mobile module page panel primary"
    " reader readers right row s secondary section site slot small text thread threads title top unit user users wrap wrapper x".split()
)
_STOP = frozenset(STOP_WORDS)

SHORT, LONG = 70, 140
MOST_LINKED, MOST_LINKED_INSIDE = 0.33, 0.5
FEW_STOPS, MANY_STOPS = 0.15, 0.25
# A page whose unlinked blocks have a smaller share of stop words is in another language.
KNOWN_STOPS = 0.1


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    out: bool
    sure: int
    # 1 within a form, 2 marked out by a class or id alone.
    doubtful: int = 0


def _attributes(raw: str) -> dict[str, str]:
    if not raw.strip(" /"):
        return {}
    return {name.lower(): value.strip("\"'").lower() for name, value in _ATTRIBUTE.findall(raw)}


def _named_out(attributes: dict[str, str]) -> bool:
    """Whether a whole class or id says that the element is not the article."""
    for value in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = set(_PART.findall(value))
        if not _OUT_WORDS.isdisjoint(parts) and parts <= _OUT_WORDS | _BESIDE_WORDS:
            return True
    return False


def _marked_out(name: str, attributes: dict[str, str]) -> bool:
    if name in _OUT:
        return True
    if not attributes or name in ("html", "body", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", ""):
        return True
    return attributes.get("role") in _OUT_ROLES


def _is_article(name: str, attributes: dict[str, str]) -> int:
    """How surely the element holds the article: 3, 2, 1, or 0 for not."""
    if name == "article" or "articlebody" in attributes.get("itemprop", ""):
        return 3
    if name == "main" or attributes.get("role") == "main":
        return 2
    if name in ("div", "section", "td"):
        marks = _PART.findall(f"{attributes.get('class', '')} {attributes.get('id', '')}")
        return int(bool(marks) and set(marks) <= _CONTENT_WORDS | {"body", "text", "page", "single"} and not _CONTENT_WORDS.isdisjoint(marks))
    return 0


def _is_link(attributes: dict[str, str], heading: bool) -> bool:
    """Not an anchor that only has a name, nor a heading that points into its page."""
    target = attributes.get("href", "")
    if not target:
        return "name" not in attributes and "id" not in attributes
    return not (heading and target.startswith("#"))


def blocks(page: str) -> list[Block]:
    """The blocks in page order, those without text left out."""
    found: list[Block] = []
    parts: list[str] = []
    # Linked text so far; whether a link is open, the blocks within it, and whether it is in a paragraph.
    linked, in_link, link_blocks, in_paragraph, open_ended = 0, False, 0, False, False
    # The element that is being skipped, and how deep its name is nested.
    skip, skipped = "", 0
    # Of an inline one: what its block had before it, and the blocks opened within it.
    cut: tuple[int, int] | None = None
    skip_blocks = forms = 0
    # The same for one marked out by its class or id; what it holds is still told apart.
    doubt, doubted, doubt_within = "", 0, 0
    # The element whose content is no text at all, and where the last of each name ends.
    held = ""
    ends: dict[str, int] = {}
    lower = ""
    # Open elements that may hold the article: name, depth of the name, sureness.
    roots: list[list] = []
    header, heading = 0, False

    def end() -> None:
        nonlocal linked, cut
        hidden = bool(skip)
        if cut:
            drop_inline()
            hidden = False
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            block = Block(text, linked, heading, hidden, max((r[2] for r in roots), default=0), 2 if doubt else int(forms > 0))
            # Of an article's own header, headings and prose belong to it.
            block.out = hidden or (header > 0 and not heading and not (roots and _is_prose(block)))
            found.append(block)
        parts.clear()
        linked = 0

    def drop_inline() -> None:
        """Throw away the text of an inline part that is out; its block goes on."""
        nonlocal linked, cut
        del parts[cut[0] :]
        linked, cut = cut[1], None

    def add(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if in_link:
            linked += len(text)

    at = 0
    for token in _TOKEN.finditer(page):
        if token.start() > at and not held:
            add(page[at : token.start()])
        at = token.end()
        name = token[3]
        if name is None:
            continue
        name, closes = name.lower(), bool(token[2])
        if held:
            if closes and name == held:
                held = ""
            continue
        if name in _HELD:
            if closes or token[4].endswith("/"):
                continue
            if name not in ends:
                lower = lower or page.lower()
                ends[name] = max((lower.rfind(f"</{name}{c}") for c in "> \n\t"), default=-1)
            if ends[name] > token.start():
                held = name
            continue
        is_block = name in _BLOCKS
        if name == "a":
            in_link, link_blocks = not closes and _is_link(_attributes(token[4]), heading), 0
            # One that is never closed ends with its block.
            following = _LINK_TAG.search(page, at) if in_link else None
            open_ended = not following or not following[1]
        elif name == "br":
            parts.append(" ")
        if is_block:
            end()
            if in_link and (open_ended or (closes and not link_blocks) or (name == "p" and in_paragraph and not closes)):
                in_link = False
            elif in_link:
                link_blocks += -1 if closes else 1
            else:
                in_paragraph = name == "p" and not closes
        if closes:
            if name in _FORMS and forms:
                forms -= 1
            if skip == name:
                skipped -= 1
                if not skipped:
                    if cut:
                        drop_inline()
                    elif not is_block:
                        end()
                    skip = ""
            elif skip and is_block and skip not in _BLOCKS:
                # An inline part ends with the block it stands in.
                if not skip_blocks:
                    skip = ""
                skip_blocks = max(0, skip_blocks - 1)
            elif skip and name in ("body", "html", "article", "main"):
                # What was never closed ends with what holds it.
                skip = ""
            if doubt == name:
                doubted -= 1
                if not doubted:
                    # Text before the end of an inline part is a block of its own.
                    end()
                    doubt = ""
            elif doubt and name in ("body", "html"):
                doubt = ""
            if name == "header" and header:
                header -= 1
            if name in _HEADINGS:
                heading = False
            for i in range(len(roots) - 1, -1, -1):
                if roots[i][0] == name:
                    roots[i][1] -= 1
                    if not roots[i][1]:
                        del roots[i:]
                        if len(roots) < doubt_within:
                            # What was never closed ends with what holds it.
                            doubt = ""
                    break
            continue
        if name in _VOID or token[4].endswith("/"):
            continue
        if name in _HEADINGS:
            heading = True
        elif is_block:
            heading = False
        attributes = _attributes(token[4])
        out = _marked_out(name, attributes)
        if skip:
            skip_blocks += is_block
            if name == skip:
                skipped += 1
            if name == "body" or (name in ("article", "main") and not out and skip in ("nav", "head", "title", "header")):
                skip = ""
            else:
                continue
        if name == "header":
            header += 1
            if not roots:
                out = True
        if out:
            skip, skipped, skip_blocks = name, 1, 0
            cut = None if is_block else (len(parts), linked)
            continue
        forms += name in _FORMS
        if doubt == name:
            doubted += 1
        elif not doubt and name not in ("html", "body", "main") and _named_out(attributes):
            if not is_block:
                end()
            doubt, doubted, doubt_within = name, 1, len(roots)
        for root in reversed(roots):
            if root[0] == name:
                root[1] += 1
                break
        if sure := _is_article(name, attributes):
            roots.append([name, 1, sure])
    if not held:
        add(page[at:])
    end()
    return found


def _is_prose(block: Block) -> bool:
    return len(block.text) >= SHORT and block.linked <= MOST_LINKED * len(block.text)


def _candidates(found: Sequence[Block]) -> list[Block]:
    """The blocks that are not marked out. What only its class or id marks comes back where nothing else has prose."""
    left = [b for b in found if not b.out]
    for level in (0, 1):
        sure = [b for b in left if b.doubtful <= level]
        if any(_is_prose(b) for b in sure):
            return sure
    sure = [b for b in left if not b.doubtful]
    if not any(_is_prose(b) or b.sure > 1 for b in left if b.doubtful > 1):
        return sure
    if any(b.sure for b in sure) and not any(_is_prose(b) for b in left if b.doubtful):
        return sure
    return left


def _article_mark(found: Sequence[Block]) -> int:
    """The sureness of the mark that holds most prose, the surest of those alike; 0 without marks."""
    marks = sorted({b.sure for b in found} - {0}, reverse=True)
    return max(marks, key=lambda mark: sum(len(b.text) for b in found if b.sure == mark and _is_prose(b)), default=0)


def _stops(text: str) -> tuple[int, int]:
    """How many words are stop words, and how many words there are."""
    words = text.split()
    return sum(w.strip(".,;:!?()\"'").lower() in _STOP for w in words), len(words)


def _is_known(found: Sequence[Block]) -> bool:
    """Whether the page is in a language of the stop words, by its longer unlinked blocks."""
    counts = [_stops(b.text) for b in found if _is_prose(b)]
    return sum(n for n, _ in counts) >= KNOWN_STOPS * sum(n for _, n in counts)


def _first_pass(block: Block, mark: int, known: bool) -> bool | None:
    """True for good, False for bad, None for undecided."""
    size = len(block.text)
    n_stops, n_words = _stops(block.text)
    stops = n_stops / n_words
    if mark and block.sure == mark:
        if block.linked > MOST_LINKED_INSIDE * size:
            return False
        return True if size >= SHORT else None
    if block.linked > MOST_LINKED * size:
        return False
    if mark:
        return size >= LONG and (stops >= MANY_STOPS or not known)
    if not known:
        return True if size >= SHORT else None
    if size < SHORT:
        return None
    if stops >= MANY_STOPS or (size >= LONG and stops >= FEW_STOPS):
        return True
    return None if size < LONG and stops >= FEW_STOPS else False


def main_blocks(page: str) -> list[str]:
    """The blocks of the main text, in page order."""
    # Marked parts are out and say nothing about the rest.
    found = _candidates(blocks(page))
    mark = _article_mark(found)
    known = _is_known(found)
    labels = [_first_pass(b, mark, known) for b in found]
    # Within the article one linked block among others is part of it; a run of them is a list of links.
    labels = [
        good is not False or _is_lone(labels, i) if mark and b.sure == mark and good is not None else good
        for i, (b, good) in enumerate(zip(found, labels, strict=True))
    ]
    # Code, tables and lists of references are prose of few stop words; between good blocks they stay.
    few = {i for i, (b, good) in enumerate(zip(found, labels, strict=True)) if good is False and not mark and _is_prose(b)}
    labels = [None if i in few else good for i, good in enumerate(labels)]
    before, after = _nearest(labels), [*reversed([_flip(x, len(labels)) for x in _nearest(labels[::-1])])]
    kept = []
    for i, (block, good) in enumerate(zip(found, labels, strict=True)):
        if i in few:
            near = [labels[j] for j in (before[i], after[i]) if j is not None]
            good = len(near) == 2 and all(near)
        elif good is None:
            # A heading goes with what follows.
            near = [x for x in ((after[i],) if block.heading and after[i] is not None else (before[i], after[i])) if x is not None]
            # The nearer one decides; of two as near, both must be good; of none, text stands.
            least = min((abs(i - j) for j in near), default=0)
            good = all(labels[j] for j in near if abs(i - j) == least)
            if mark:
                # Within the article only what stands among bad parts of it goes.
                own = [labels[j] for j in (before[i], after[i]) if j is not None and found[j].sure == mark]
                good = block.heading or not own or any(own)
        if good:
            kept.append(block.text)
    return kept


def _is_lone(labels: Sequence[bool | None], i: int) -> bool:
    """Whether the blocks on both sides are there and not bad."""
    return 0 < i < len(labels) - 1 and labels[i - 1] is not False and labels[i + 1] is not False


def _nearest(labels: Sequence[bool | None]) -> list[int | None]:
    """For each place, the last decided place before it."""
    last, out = None, []
    for i, label in enumerate(labels):
        out.append(last)
        if label is not None:
            last = i
    return out


def _flip(place: int | None, size: int) -> int | None:
    return None if place is None else size - 1 - place


def extract_text(pages: DataFrame, html: str = "html", keep: Sequence[str] | None = None) -> DataFrame:
    """``pages`` with ``text``, the blocks of the main text joined by an empty line, and ``n_chars``.

    Character references are decoded, white space within a block becomes one
    space. Null and empty pages have an empty text, and an empty table stays so. Pages are read whole, however
    long; unclosed tags end with what holds them. ``keep`` names the columns to
    return, all unless given; columns of the new names are replaced. Repeated rows
    are extracted each.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("page"), F.col(html).alias("html"))
    schema = StructType([*rows.select("page").schema, StructField("text", StringType()), StructField("n_chars", LongType())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in batches_of(batch.column("html")):
                part = batch.slice(start, end - start)
                texts = ["\n\n".join(main_blocks(p)) if p else "" for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=schema.names
                )

    return rows.mapInArrow(extract, schema).select("page.*", "text", "n_chars")
