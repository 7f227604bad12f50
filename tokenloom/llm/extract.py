"""Main text of HTML pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass judges every block alone, by its
length, its share of stop words, its share of link text and the containers around it. The second
pass gives the blocks left open (short ones, and middling ones) the label of their nearest decided
neighbours. The good blocks, joined by one space, are the text.

* Containers: text in menus, footers, sidebars, forms, notices, adverts and comments is bad, text in scripts, styles and
  other non-text elements is skipped. A page that marks its article has its text there; its other blocks are bad.
  Inside an article only containers are judged by their names, and by what a name says last: a `user-comments` list goes, a
  `related-work` section and a paragraph of any class stay. A paragraph or heading that is one link stays, such a list item goes.
* End tags may be missing: the head ends at the first tag of the body, paragraphs, list items, cells and rows end where the
  next one begins, buttons and the like at the next block, and an element ends whatever was left open inside it.
* Character references are decoded once; white space in a block becomes one space.
* Null and empty pages, and pages without a good block, give the empty text. Broken markup is read as far as it goes.
* Pages are read one by one: repeated rows, repeated or null ids and other columns make no difference. An empty table
  gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names by what they do to the text.
BLOCK_TAGS = set(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
SKIPPED_TAGS = set("script style head title noscript template iframe object embed svg canvas audio video select textarea button".split())
# What may stand in a head, skipped elements that hold no blocks, and which open element a start tag ends.
HEAD_TAGS = set("title meta link script style base noscript template".split())
PHRASING_TAGS = set("title svg select textarea button".split())
ENDED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    **{t: ({"tbody", "thead", "tfoot", "caption"}, {"table"}) for t in ("tbody", "thead", "tfoot")},
}
# Elements that hold parts of an article, which alone are judged by their names there.
CONTAINER_TAGS = set("div section ul ol dl table fieldset details figure center hgroup span".split())
LIST_TAGS = set("li ul ol dl dt dd td th".split())
# Elements whose end tag ends everything that was left open inside.
ENDING_TAGS = set("html body article main section div table tr td th ul ol dl li blockquote form nav aside footer header".split())
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
BAD_TAGS = set("nav footer aside form menu dialog".split())
ARTICLE_TAGS = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Words of class, id and role names that mark what is not the article.
BAD_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login social share sharing related recommended teaser comment comments respond reply "
    "disqus widget toolbar pagination pager copyright complementary contentinfo search form".split()
)
# Frequent function words of the languages of the pages.
STOP_WORDS = set(
    "the of and to in is that it was for on are with as be at this have from or by not but what all were when we there can an your "
    "which their if do will each how them then she many some so these would other into has more her two like him see could no than been "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man sein "
    "le la les de des un une et en du que qui dans pour pas sur au est par il sont plus avec se ce cette mais ou où son ses aux elle nous "
    "vous ils leur même comme tout être avoir fait sans très entre "
    "el los las del una y a por con no para su al lo como más pero sus ya este sí porque esta cuando muy sobre también me hasta hay "
    "donde quien desde nos durante uno ni contra otros ese eso ante ellos mi".split()
)

SHORT_CHARS, LONG_CHARS = 70, 200
LINKS_BAD, ARTICLE_LINKS_BAD = 0.33, 0.5
STOPS_GOOD, STOPS_FAIR = 0.30, 0.15
GOOD, FAIR, SHORT, BAD = "good", "fair", "short", "bad"

_NAME = re.compile(r"[a-z0-9]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    link_chars: int
    place: str
    heading: bool
    tag: str = ""


class _Blocks(HTMLParser):
    """Collects blocks; `open` holds the open elements with what they say about the text inside."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, str]] = []
        self.parts: list[str] = []
        self.link_chars = self.links = self.skipping = 0
        self.heading = False

    def place(self) -> str:
        """The innermost container decides; an article inside comments, sidebars and the like is none."""
        inside = ""
        for _, says in reversed(self.open):
            if says == "skip" or (says == "bad" and inside != "article") or says == "named":
                return "bad"
            if says == "article":
                inside = "article"
        return inside

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            tag = next((t for t, _ in reversed(self.open) if t in BLOCK_TAGS), "")
            self.blocks.append(Block(text, self.link_chars, self.place(), self.heading, tag))
        self.parts, self.link_chars = [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.open, self.skipping = [], 0
        if tag not in HEAD_TAGS and tag != "html":
            self.end_head()
        if tag in BLOCK_TAGS:
            self.flush()
            self.end_implied(tag)
        if tag in VOID_TAGS:
            return
        if tag == "a":
            self.links += 1
        says = ""
        if tag in SKIPPED_TAGS:
            says, self.skipping = "skip", self.skipping + 1
        elif tag in ARTICLE_TAGS:
            says = "article"
        elif tag in BAD_TAGS or (tag == "header" and self.place() != "article"):
            says = "bad"
        if tag not in ("html", "body", *ARTICLE_TAGS) and attrs and self.badly_named(tag, attrs):
            says = "skip" if says == "skip" else "named"
        elif not says and ("role", "main") in attrs:
            says = "article"
        if tag in BLOCK_TAGS or says:
            self.open.append((tag, says))
        if tag in HEADINGS:
            self.heading = True

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self.flush()
        if tag == "a":
            self.links = max(0, self.links - 1)
        if tag in HEADINGS:
            self.heading = False
        for at in range(len(self.open) - 1, -1, -1):
            name, says = self.open[at]
            if name == tag:
                self.end_at(at)
                return
            if says == "skip" and (tag == "p" or name not in PHRASING_TAGS):
                # Inside elements that hold whole fragments, only an ancestor that is no paragraph ends them.
                if tag == "p" or not any(t == tag and t in ENDING_TAGS for t, _ in self.open[:at]):
                    return

    def end_at(self, at: int) -> None:
        self.skipping -= sum(s == "skip" for _, s in self.open[at:])
        del self.open[at:]

    def end_head(self) -> None:
        for at, (name, _) in enumerate(self.open):
            if name == "head":
                self.end_at(at)
                return

    def end_implied(self, tag: str) -> None:
        """Ends what a block-level start tag ends: phrasing elements, paragraphs, and items of its own list or table."""
        while self.open and self.open[-1][0] in PHRASING_TAGS | {"p"}:
            self.end_at(len(self.open) - 1)
        ends, within = ENDED_BY.get(tag, ((), ()))
        for at in range(len(self.open) - 1, -1, -1):
            name, says = self.open[at]
            if name in within or says == "skip":
                return
            if name in ends:
                self.end_at(at)
                return

    def badly_named(self, tag: str, attrs) -> bool:
        if self.place() != "article":
            return _badly_named(attrs)
        return tag in CONTAINER_TAGS and any(
            name in ("class", "id", "role") and value and any(_NAME.findall(t)[-1:] and _NAME.findall(t)[-1] in BAD_NAMES for t in value.lower().split())
            for name, value in attrs
        )

    def handle_startendtag(self, tag, attrs):
        if tag in BLOCK_TAGS:
            self.flush()

    def handle_data(self, data):
        if self.skipping:
            return
        self.parts.append(data)
        if self.links:
            self.link_chars += len(data)


def _badly_named(attrs) -> bool:
    return any(
        name in ("class", "id", "role") and value and not BAD_NAMES.isdisjoint(_NAME.findall(value.lower()))
        for name, value in attrs
    )


def blocks_of(html: str) -> list[Block]:
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


def first_label(block: Block, has_article: bool) -> str:
    """The label of a block by itself."""
    links = block.link_chars / len(block.text)
    if block.place == "bad" or (has_article and not block.place):
        return BAD
    if block.place:
        return BAD if links > ARTICLE_LINKS_BAD and block.tag in LIST_TAGS else GOOD
    if links > LINKS_BAD:
        return BAD
    if len(block.text) < SHORT_CHARS:
        return SHORT
    words = _WORD.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
    if stops >= STOPS_GOOD:
        return GOOD if len(block.text) >= LONG_CHARS else FAIR
    return FAIR if stops >= STOPS_FAIR else BAD


def final_labels(blocks: list[Block], labels: list[str]) -> list[str]:
    """Open blocks take the label of their nearest decided neighbours; short ones need one on either side, fair ones one."""
    before, seen = [], BAD
    for label in labels:
        before.append(seen)
        seen = label if label in (GOOD, BAD) else seen
    after, seen = [], BAD
    for label in reversed(labels):
        after.append(seen)
        seen = label if label in (GOOD, BAD) else seen
    after.reverse()
    # A run of fair blocks without any decided good one around is the text itself.
    lone = GOOD not in labels
    out = []
    for block, label, left, right in zip(blocks, labels, before, after):
        if label == SHORT:
            label = GOOD if (left == right == GOOD) or (block.heading and right == GOOD) else BAD
        elif label == FAIR:
            label = GOOD if GOOD in (left, right) or lone else BAD
        out.append(label)
    return out


def main_text(html: str | None) -> str:
    if not html:
        return ""
    blocks = blocks_of(html)
    has_article = any(b.place == "article" for b in blocks)
    labels = final_labels(blocks, [first_label(b, has_article) for b in blocks])
    return " ".join(b.text for b, label in zip(blocks, labels) if label == GOOD)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h.as_py()) for h in batch.column(2)]
        columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: `page_id`, `url`, `text` and `n_chars`, its code points."""
    slim = pages.select(pages[page_id].cast("long").alias("page_id"), pages[url].cast("string").alias("url"), pages[html].cast("string").alias("html"))
    return slim.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
