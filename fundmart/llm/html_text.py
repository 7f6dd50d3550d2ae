"""HTML extraction by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass looks at each block alone:
what stands in a menu, header, footer, sidebar, notice, advert, form or comment section is
out by its place; of the rest, blocks made of links are bad, long blocks with many stop
words are good, and short blocks, or long ones without stop words, are undecided. In the
second pass an undecided block inherits the label of the nearest block that the first pass
decided by its words, within the same article; on a tie the good one counts. Without any
such neighbour it stays in, as it has no sign of being boilerplate.

Where a page marks its article (article or main), only blocks inside count as text. An article
is never dropped for its own names or those of what stands around it, comments excepted; a
form around all of a page's text is no form. Names are read as whole words of a class, id or
role, which count by their last part (``site-footer``), unless they tell of something else
(``has-sidebar``) or stand on the frame of a page (``page sidebar-right``).

Defined results: a null or empty page gives an empty text, and so does a page of
boilerplate only; broken markup is read as far as it goes; very long pages are read whole, in
time in proportion to their length; ``n_chars`` counts code points;
repeated rows give repeated results; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundmart.llm.base import named, query, table

# A block of this many characters can be judged by its words.
LONG = 80
STOP_DENSITY = 0.12
LINK_DENSITY = 0.5

# Frequent function words of the four languages.
STOP_WORDS = frozenset(
    "a about after all also an and any are as at be been but by can do for from had has have he her"
    " his how i if in into is it its more no not of on one only or other our out she so some than"
    " that the their them there these they this to was we were what when which who will with would"
    " you your"
    " au aux avec ce ces cette dans de des du elle en est et eux il je la le les leur lui mais ne"
    " nous on ou où par pas pour qu que qui sa se ses son sont sur un une vous"
    " aber als am an auch auf aus bei bin bis das dass dem den der des die du ein eine einem einen"
    " einer er es für hat ich ihr im in ist mit nach nicht noch nur oder sein sich sie sind so über"
    " um und uns von vor war wie wir zu zum zur"
    " al como con cuando de del desde el ella en entre era es esta este fue ha hay la las lo los más"
    " me mi muy no o para pero por porque que se sin sobre son su sus también un una y ya".split()
)
# Tags that end a block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html legend li main menu"
    " nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
# Tags whose content is no text of the page.
DROPPED_TAGS = frozenset(
    "audio button canvas datalist head iframe math noframes noscript object option script select"
    " style svg template textarea title video".split()
)
# Tags that are boilerplate wherever they stand, and tags without an end.
BOILERPLATE_TAGS = frozenset("aside dialog footer form menu nav".split())
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Words of class, id and role that mark boilerplate, and that mark text.
BOILERPLATE_NAMES = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert alerts banner breadcrumb"
    " breadcrumbs comment commentlist comments complementary consent contentinfo cookie cookies"
    " dialog discussion disqus disclaimer feedback footer gdpr header hidden login masthead menu modal nav"
    " navbar navigation newsletter notice notices notification overlay pager pagination popup promo"
    " promotion recommended related replies reply respond responses search share sharing sidebar"
    " signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget"
    " widgets".split()
)
TEXT_NAMES = frozenset("article articlebody body content entry main post story text".split())
COMMENT_NAMES = frozenset("comment commentlist comments disqus replies reply".split())
PAGE_TAGS = frozenset(("html", "body"))
# First parts of names that tell of something else, last parts that tell where a
# thing stands, and names of the frame of a page.
OTHERS = frozenset("has have no not with without show hide is".split())
SIDES = frozenset("left right top bottom primary secondary main first second list area".split())
FRAMES = frozenset("page site wrapper wrap container layout body app root".split())
# Boilerplate that an article inside does not undo.
FIRM_TAGS = frozenset("aside dialog footer menu nav".split())
OPEN_ENDED = frozenset(("p", "li", "dt", "dd", "option", "tr", "td", "th"))

SCHEMA = "page_id {id}, url {url}, text string, n_chars long"
_NAME = re.compile(r"[a-z0-9]+")
_TOKEN = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    article: int  # 0: outside any
    boilerplate: bool
    form: bool
    parts: list[str] = field(default_factory=list)
    link_chars: int = 0
    text: str = ""


class _Blocks(HTMLParser):
    """Cuts a page into blocks and notes where each of them stands."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        # Open tags with what they add: (tag, kind of boilerplate, article number or 0, dropped).
        self.open: list[tuple[str, int, int, bool]] = []
        # Where each tag, the last block and the last container are open.
        self.places: dict[str, list[int]] = {}
        self.block_places: list[int] = []
        self.container_places: list[int] = []
        # Open boilerplate by kind: none, by name, firm, forms.
        self.kinds = [0, 0, 0, 0]
        self.outside: list[list[int]] = []
        self.dropped = self.links = self.articles = self.breaks = 0
        self.article = [0]
        self.now: Block | None = None

    def _cut(self) -> None:
        self.now = None
        self.breaks = 0

    def _names(self, attrs) -> set[str]:
        """Whole names, and the boilerplate that a name of several parts tells of."""
        names: set[str] = set()
        for key, value in attrs:
            if key in ("class", "id", "role", "itemprop") and value:
                names.update(value.lower().split())
        framed = not names.isdisjoint(FRAMES)
        for name in list(names):
            parts = _NAME.findall(name)
            if len(parts) < 2 or parts[0] in OTHERS:
                continue
            names.add(parts[-1])
            if not framed and (parts[-1] in SIDES or parts[-1].isdigit()):
                names.add(parts[0])
        return names

    def _is_boilerplate(self, tag: str, attrs) -> int:
        """0: no; 1: by its names; 2: firmly; 3: a form."""
        if tag in PAGE_TAGS:
            return 0
        names = self._names(attrs)
        if names & COMMENT_NAMES:
            return 2
        found = {k: (v or "").lower() for k, v in attrs}
        if "hidden" in found or found.get("aria-hidden") == "true":
            return 2
        if "display:none" in found.get("style", "").replace(" ", ""):
            return 2
        if tag in ("article", "main"):
            return 0
        if tag in FIRM_TAGS:
            return 2
        if tag == "form":
            return 3
        if tag == "header" and not self.article[-1]:
            return 1
        bad = names & BOILERPLATE_NAMES
        if self.article[-1]:
            # An article's own header or title bar is part of it.
            bad -= {"banner", "header", "masthead"}
        return 1 if bad and not names & TEXT_NAMES else 0

    def handle_starttag(self, tag, attrs) -> None:
        if tag == "br":
            self.breaks += 1
            if self.breaks > 1:
                self._cut()
            elif self.now is not None:
                self.now.parts.append(" ")
            return
        if tag in BLOCK_TAGS:
            self._cut()
        if tag == "a":
            self.links = 1
        if tag in VOID_TAGS:
            return
        if tag in OPEN_ENDED and self.places.get(tag):
            # A new one ends the one before it, unless a container stands between.
            at = self.places[tag][-1]
            if not self.container_places or self.container_places[-1] < at:
                self._pop(at)
        kind, dropped = self._is_boilerplate(tag, attrs), tag in DROPPED_TAGS
        article = 0
        if tag in ("article", "main") and not kind and not self.article[-1]:
            self.articles += 1
            article = self.articles
            self.article.append(article)
            # Only firm boilerplate around an article counts inside.
            self.outside.append(self.kinds)
            self.kinds = [0, 0, self.kinds[2], 0]
        self.kinds[kind] += 1
        self.dropped += dropped
        if kind:
            self._cut()
        at = len(self.open)
        self.open.append((tag, kind, article, dropped))
        self.places.setdefault(tag, []).append(at)
        if tag in BLOCK_TAGS:
            self.block_places.append(at)
            if tag not in OPEN_ENDED:
                self.container_places.append(at)

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def _pop(self, to: int) -> None:
        while len(self.open) > to:
            tag, kind, article, dropped = self.open.pop()
            self.places[tag].pop()
            if tag in BLOCK_TAGS:
                self.block_places.pop()
                if tag not in OPEN_ENDED:
                    self.container_places.pop()
            self.kinds[kind] -= 1
            self.dropped -= dropped
            if article:
                self.article.pop()
                self.kinds = self.outside.pop()
            if kind:
                self._cut()

    def handle_endtag(self, tag) -> None:
        if tag in BLOCK_TAGS:
            self._cut()
        if tag == "a" or tag in BLOCK_TAGS:
            self.links = 0
        places = self.places.get(tag)
        # An inline end tag does not reach beyond the block that it stands in.
        inside = tag in BLOCK_TAGS or not self.block_places
        if places and (inside or self.block_places[-1] < places[-1]):
            self._pop(places[-1])

    def handle_data(self, data) -> None:
        if self.dropped:
            return
        if self.now is None:
            if not data.strip():
                return
            self.now = Block(self.article[-1], any(self.kinds[1:3]), self.kinds[3] > 0)
            self.blocks.append(self.now)
        if data.strip():
            self.breaks = 0
        self.now.parts.append(data)
        if self.links:
            self.now.link_chars += len(data)


def _judge(block: Block) -> str:
    """First pass, by words alone: good, bad or open."""
    if block.link_chars > LINK_DENSITY * len(block.text):
        return "bad"
    if len(block.text) < LONG:
        return "bad" if "©" in block.text and not block.article else "open"
    words = _TOKEN.findall(block.text.lower())
    stops = sum(w in STOP_WORDS for w in words)
    return "good" if stops >= STOP_DENSITY * max(len(words), 1) else "open"


def _nearest(labels: list[str]) -> list[bool]:
    """Second pass: whether each block counts as text."""
    far = len(labels) + 1
    before, after = [], []
    for out, order in ((before, labels), (after, labels[::-1])):
        at, label = far, "none"
        for x in order:
            at += 1
            if x != "open":
                at, label = 0, x
            out.append((at, label))
    after.reverse()
    result = []
    for (a, left), (b, right) in zip(before, after, strict=True):
        if a != b:
            label = left if a < b else right
        else:
            label = left if left == right else "good"
        result.append(label != "bad")
    return result


def extract(html: str) -> str:
    """The main text of a page: its blocks in page order, one per line."""
    parser = _Blocks()
    # What no tag can end behind the last bracket is no tag.
    end = html.rfind(">") + 1
    parser.feed(html[:end])
    parser.feed(html[end:].replace("<", "&lt;"))
    parser.close()
    blocks = []
    for block in parser.blocks:
        block.text = " ".join("".join(block.parts).split())
        if block.text and not block.boilerplate:
            blocks.append(block)
    outside = [b for b in blocks if not b.form]
    blocks = outside or blocks
    if any(b.article for b in blocks):
        blocks = [b for b in blocks if b.article]
    kept = []
    for article in dict.fromkeys(b.article for b in blocks):
        own = [b for b in blocks if b.article == article]
        kept += [b.text for b, good in zip(own, _nearest([_judge(b) for b in own]), strict=True) if good]
    return "\n".join(kept)


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: its main text and the text's length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h.as_py()) for h in batch.column(2)]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        named(id_col).alias("page_id"),
        named(url_col).alias("url"),
        F.coalesce(named(html_col).cast("string"), F.lit("")).alias("html"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, SCHEMA.format(id=kinds["page_id"], url=kinds["url"]))


@query()
def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))
