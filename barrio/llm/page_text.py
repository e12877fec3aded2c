"""Main text of HTML pages by nearest-URL page differencing.

1. A page is read into lines: a line is a block of visible text with its
   white space collapsed, in page order, with the zone it stands in
   (``article`` or ``main``: inside that element; ``frame``: inside an element that by
   name, role, class or id is a menu, header, footer, sidebar, notice, advert,
   form or reader comment; else ``open``).  Scripts, styles, head and markup
   give no lines.
2. Pages of a host are ordered by path; a page is paired with the nearest
   other page before it and after it.  Copies of a page (equal lines) tell
   nothing and are passed by.
3. The lines of a pair are aligned by a longest common subsequence.  Aligned
   lines are shared, and shared lines are deleted, except those that the page
   itself marks as its article (or main part): copied articles and sentences that many
   articles hold are the text that is asked for.
4. Of the lines left, those in frames go: frames that differ from page to page
   (dates, rotating adverts) are not shared.  A page that marks an article has
   its text there, so its open lines go too.

Pages are dealt by ranges of host, path and id, so a large host is spread over
many tasks and html travels once; a task reads its pages in that order and
holds one page and its two neighbours.  The first and the last page of a range
have a neighbour on one side only (ranges are cut on samples: for pages that
mark no article, the lines deleted there can differ from run to run).

Null and empty html give an empty text; broken html is read as far as it goes.
A null url is a host of its own.  Every row gives a row: ids are not compared,
so null and repeated ids are as any others; rows with an equal page are copies.
An empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barrio.llm.tables import picked
from barrio.llm.url_filter import url_parts

ROWS = 256                   # pages taken from a batch at a time

# Element names, roles and class words.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section
summary table tbody tfoot thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
FRAMES = frozenset("nav footer aside form menu dialog button select search fieldset".split())
FRAME_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar "
                        "toolbar".split())
FRAME_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment
comments consent cookie cookies disclaimer footer masthead menu modal nav navbar navigation newsletter notice
notification pager pagination popup promo promoted promotion related replies respond share sharing sidebar social
sponsor sponsored subscribe toolbar widget""".split())
# words that may stand beside a frame word in one class or id (side-nav, comment-list)
WITH_FRAME = frozenset("""area article articles bar block body bottom box button buttons center col column container content
desktop el fixed form global group header icons inner item items js left link links list main mobile outer page pane panel
post posts primary reader right root row secondary section signup site slot small sticky stories tertiary text thread top
unit user wrap wrapper""".split())
ARTICLE_WORDS = frozenset("ad advert advertisement comment comments promo related sponsored teaser".split())
# elements that an implied end of a paragraph or list item does not reach over
BOUNDS = frozenset("div ul ol dl table td section body".split())
TABLE = 1 << 28              # cells of an alignment whose rows are held
ENDS_P = BLOCKS - {"html", "body", "caption", "tbody", "tfoot", "thead", "tr", "li", "dd", "dt"}

_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>"']|"[^"]*+"|'[^']*+')*+)(?:>|\Z)""",
                  re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+")


def _names_frame(value: str, words: frozenset[str]) -> bool:
    """Whether one of the names in a class or id is a frame's: it has a frame
    word, and none that tells of something else (social-history does not)."""
    for name in value.split():
        parts = _WORD.findall(name)
        if any(p in words for p in parts) and all(p in words or p in FRAME_WORDS or p in WITH_FRAME for p in parts):
            return True
    return False


def _is_frame(name: str, attributes: str) -> bool:
    if name in FRAMES:
        return True
    # a page's or article's own classes may tell what it has beside it
    if not attributes.strip() or name in ("html", "body", "main"):
        return False
    words = ARTICLE_WORDS if name == "article" else FRAME_WORDS
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        if key in ("class", "id") and _names_frame(value, words):
            return True
        if key == "role" and value.strip() in FRAME_ROLES:
            return True
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            return True
    return False


class _Open:
    """The open elements, with each name's places, so that no lookup scans them."""

    def __init__(self):
        self.names: list[str] = []
        self.adds: list[str] = []                      # what each adds to the depth
        self.places: dict[str, list[int]] = defaultdict(list)
        self.bounds: list[int] = []                    # places that an implied end does not pass
        self.depth = {"frame": 0, "article": 0, "main": 0}

    def push(self, name: str, adds: str) -> None:
        if adds:
            self.depth[adds] += 1
        if adds or name in BOUNDS:
            self.bounds.append(len(self.names))
        self.places[name].append(len(self.names))
        self.names.append(name)
        self.adds.append(adds)

    def last(self, name: str) -> int:
        """The innermost place of an element, or -1."""
        places = self.places.get(name)
        return places[-1] if places else -1

    def implied(self, name: str) -> int:
        """That place if no bound is inside it, or -1."""
        at = self.last(name)
        return at if not self.bounds or self.bounds[-1] <= at else -1

    def close(self, at: int) -> None:
        for i in range(len(self.names) - 1, at - 1, -1):
            self.places[self.names[i]].pop()
            if self.adds[i]:
                self.depth[self.adds[i]] -= 1
            if self.bounds and self.bounds[-1] == i:
                self.bounds.pop()
        del self.names[at:], self.adds[at:]

    def marked(self, at: int) -> bool:
        """Whether an element from that place on adds to the depth."""
        return any(self.adds[at:])


def page_lines(page: str) -> list[tuple[str, str]]:
    """(zone, line) of each block of visible text, in page order."""
    lines: list[tuple[str, str]] = []
    stack = _Open()
    held: list[str] = []

    def end_line() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if text:
            lines.append((next((zone for zone, n in stack.depth.items() if n), "open"), text))

    def close(at: int) -> None:
        end_line()
        stack.close(at)

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        held.append(page[at:m.start() if m else n])
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name in BLOCKS:
                end_line()
            i = stack.last(name)
            if i >= 0:
                if name in BLOCKS or stack.marked(i):
                    close(i)
                else:
                    stack.close(i)
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if name in BLOCKS:
            end_line()
        if name in ("br", "td", "th"):
            held.append(" ")
        if name in VOID or m[3].rstrip().endswith("/"):
            continue
        if name in ENDS_P or name in ("li", "dd", "dt", "tr"):
            # a block ends an open paragraph, a list item the one before it
            i = stack.implied("p" if name in ENDS_P else name)
            if i >= 0:
                close(i)
        adds = ""
        if _is_frame(name, m[3]) or (name == "header" and not stack.depth["article"] and not stack.depth["main"]):
            adds = "frame"
        elif name in ("article", "main"):
            adds = name
        elif "role=\"main\"" in m[3]:
            adds = "main"
        stack.push(name, adds)
    end_line()
    return lines


def _rows_of(a: list[str], b: list[str]) -> list[int]:
    """Bit sets of ``b`` after each line of ``a``: a zero where one more line of
    ``b`` makes a common subsequence longer."""
    places: dict[str, int] = defaultdict(int)
    for j, line in enumerate(b):
        places[line] |= 1 << j
    whole = (1 << len(b)) - 1
    row, rows = whole, []
    for line in a:
        hits = row & places.get(line, 0)
        row = ((row + hits) | (row - hits)) & whole
        rows.append(row)
    return rows


def _common(a: list[str], b: list[str]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    if len(a) * len(b) > TABLE and len(a) > 1:
        # halve a; the cut of b is where both halves' subsequences add up to most
        half = len(a) // 2
        ahead = _lengths(_rows_of(a[:half], b)[-1], len(b))
        back = _lengths(_rows_of(a[:half - 1:-1], b[::-1])[-1], len(b))
        cut = int((ahead + back[::-1]).argmax())
        return _common(a[:half], b[:cut]) + [half + i for i in _common(a[half:], b[cut:])]
    rows, i, j, found = _rows_of(a, b), len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                found.append(i)
                j -= 1
    return found[::-1]


def _lengths(row: int, n: int) -> np.ndarray:
    """The longest common subsequence with each beginning of n lines."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), bitorder="little")[:n]
    return np.r_[0, np.cumsum(1 - bits.astype(np.int64))]


def shared_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` on a longest common subsequence with ``b``.

    Rows of the table are bit sets, so equal lines cost no more than others;
    above ``TABLE`` cells the first half is solved before the second, and no
    more than two rows are held.
    """
    low, high = 0, 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    inner = _common(a[low:len(a) - high], b[low:len(b) - high])
    return {*range(low), *range(len(a) - high, len(a)), *(low + i for i in inner)}


def main_text(lines: list[tuple[str, str]], shared: set[int]) -> str:
    """The page's text: its own lines outside frames.  Where a page marks an
    article or a main part, the lines inside either."""
    marked = any(zone in ("article", "main") for zone, _ in lines)
    return "\n\n".join(text for i, (zone, text) in enumerate(lines) if (
        zone in ("article", "main") if marked else zone == "open" and i not in shared))


class _Run:
    """Neighbouring pages of a host with equal lines."""

    def __init__(self, host: str, texts: list[str]):
        self.host, self.texts, self.pages = host, texts, []

    def rows(self, *near: _Run | None) -> Iterator[dict]:
        shared: set[int] = set()
        for other in near:
            if other is not None and other.host == self.host:
                shared |= shared_lines(self.texts, other.texts)
        for page_id, url, lines in self.pages:
            yield {"page_id": page_id, "url": url, "text": main_text(lines, shared),
                   "n_lines": len(lines), "n_shared": len(shared)}


RESULT = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_lines", pa.int32()),
                    ("n_shared", pa.int32())])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads pages sorted by host and path; holds a page and its two neighbours."""
    before = run = None
    out: list[dict] = []
    for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
        for r in batch.to_pylist():
            lines = page_lines(r["html"] or "")
            texts = [text for _, text in lines]
            if run is None or run.host != r["host"] or run.texts != texts:
                new = _Run(r["host"], texts)
                if run is not None:
                    out += run.rows(before, new)
                before, run = run, new
            # copies share one list of lines
            if run.pages and run.pages[-1][2] == lines:
                lines = run.pages[-1][2]
            run.pages.append((r["page_id"], r["url"], lines))
        if out:
            yield pa.RecordBatch.from_pylist(out, RESULT)
            out = []
    if run is not None:
        yield pa.RecordBatch.from_pylist(list(run.rows(before)), RESULT)


def extracted(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_lines, n_shared of every page."""
    host, path = url_parts(F.col("url"))
    rows = (picked(pages, page_id=id_col, url=url_col, html=html_col)
            .withColumn("page_id", F.col("page_id").cast("long"))
            .withColumn("host", F.when(F.col("url").isNull(), "\0").otherwise(host)).withColumn("path", path))
    order = ["host", "path", "page_id"]
    return (rows.repartitionByRange(*order).sortWithinPartitions(*order, F.xxhash64("html"))
            .select("page_id", "url", "html", "host")
            .mapInArrow(_texts, "page_id long, url string, text string, n_lines int, n_shared int"))
