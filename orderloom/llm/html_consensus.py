"""Main text of HTML pages by consensus host paths.

Every page's containers are scored by the text that their blocks hold outside links and boilerplate. The best one, widened
to what it is a part of, votes for its generalised path (tags with their classes, digits dropped) among the pages of its
host; votes are counted in Spark. Each page is then extracted anew with the path that has most votes among those that
hold a fair share of its text, so a page whose own best container is misled by a long notice follows its host's template.
A path that only one page votes for is no consensus; a page without any takes its own best one. Paths are chained hashes,
and scores are summed by one walk up the tree, so the work grows with a page's length, however deep its markup nests."""

from __future__ import annotations

import html
import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from orderloom.llm.common import settle, table, text_slices
from orderloom.operators.sized import broadcast_if_small

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup or not text to read.
_RAW = frozenset("script style noscript template iframe textarea title svg select canvas audio video".split())
_BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog button fieldset head label".split())
_BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form menu dialog alert".split())
_BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu menus "
    "breadcrumb breadcrumbs header masthead footer sidebar aside cookie cookies consent notice notices gdpr popup modal "
    "overlay newsletter subscribe subscription signup login comment comments disqus respond reply replies share sharing "
    "social related recommended pagination pager toolbar widget hidden form search skip".split())
#: Words beside these in a class or id that don't change what it means; ``social-links``, but not ``social-science``.
_NEUTRAL_WORDS = frozenset(
    "site page main top bottom left right box bar list block wrapper wrap container content area section inner outer link "
    "links button buttons btn slot unit panel global primary secondary inline fixed sticky row col column item items text "
    "title count thread body mobile desktop results field fields icon icons holder zone group bottom first last".split())
#: Share of the text at a page's own best path that the host's path must hold.
FAIR = 0.05
#: Votes that make a path a host's.
VOTES = 2
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul "
    "caption".split())
_CONTAINERS = frozenset("article body div main section td blockquote html dd center".split())
#: Parts of a text; they and the text around them belong together.
_PARTS = frozenset("section td blockquote dd".split())
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
              "th": {"td", "th"}, "option": {"option"}}
_WORD = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")


class Block:
    __slots__ = ("parts", "linked", "container", "_text")

    def __init__(self, container: int):
        """``container``: the number of the innermost one around it, -1 for none."""
        self.parts, self.linked, self.container, self._text = [], 0, container, None

    def text(self) -> str:
        if self._text is None:
            self._text = " ".join(html.unescape("".join(self.parts)).split())
        return self._text


class Page:
    """Text blocks outside boilerplate, and the containers by number, in the order in which they open: path, tag, number
    of the container around (-1 for none) and the number behind the last one inside."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.paths: list[str] = []
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.ends: list[int] = []
        self.numbers: dict[str, list[int]] = {}

    def sizes(self) -> np.ndarray:
        return np.array([len(b.text()) for b in self.blocks], dtype=np.int64)

    def places(self) -> np.ndarray:
        """For each block the number of the innermost container around it."""
        return np.array([b.container for b in self.blocks], dtype=np.int64)

    def at(self, path: str, places: np.ndarray) -> np.ndarray:
        """For each block whether a container at ``path`` is around it."""
        if path not in self.numbers:
            return np.zeros(len(places), dtype=bool)
        depth = np.zeros(len(self.paths) + 2, dtype=np.int64)  # behind the last one: for no container
        np.add.at(depth, self.numbers[path], 1)
        np.subtract.at(depth, [self.ends[n] for n in self.numbers[path]], 1)
        inside = np.cumsum(depth) > 0
        inside[-1] = False
        return inside[places]


def _boilerplate(token: str) -> bool:
    """Whether all words of a class or id are of boilerplate or neutral, and one is of boilerplate."""
    words = _WORD.findall(token)
    return any(w in _BOILERPLATE_WORDS for w in words) and all(w in _BOILERPLATE_WORDS or w in _NEUTRAL_WORDS for w in words)


def _attributes(name: str, raw: str) -> tuple[str, bool]:
    """Generalised step of a path, and whether the element is boilerplate by itself."""
    step, odd = name, name in _BOILERPLATE_TAGS
    if not raw or raw.isspace():
        return step, odd
    classes: set[str] = set()
    for key, value in _ATTR.findall(raw):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true"):
            odd = True
        elif key == "role":
            odd |= value in _BOILERPLATE_ROLES
        elif key in ("class", "id") and name not in ("html", "body"):
            odd |= name != "article" and name != "main" and any(map(_boilerplate, value.split()))
            if key == "class":
                classes.update(_DIGITS.sub("", c) for c in value.split())
    classes.discard("")
    return step + "".join(f".{c}" for c in sorted(classes)), odd


def read_blocks(page: str) -> Page:
    """The blocks and containers of a page. An article's own header holds its title and is not dropped."""
    stack: list[tuple[str, str, bool, int, int]] = []  # name, path, boilerplate, innermost container, own number or -1
    opened: dict[str, int] = {}
    read = Page()
    current: Block | None = None
    links = at = 0

    def feed(text: str) -> None:
        nonlocal current
        if not text or (stack and stack[-1][2]):
            return
        if current is None:
            if text.isspace():
                return
            current = Block(stack[-1][3] if stack else -1)
            read.blocks.append(current)
        current.parts.append(text)
        if links:
            current.linked += len(text)

    def pop() -> None:
        nonlocal links
        name, _, _, _, own = stack.pop()
        opened[name] -= 1
        links -= name == "a"
        if own >= 0:
            read.ends[own] = len(read.paths)

    while True:
        found = _TAG.search(page, at)
        feed(page[at:found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        name = found["name"] or found["name2"]
        if not name:
            continue
        name = name.lower()
        block = name in _BLOCKS
        if block:
            current = None
        elif name == "br":
            feed(" ")
        if found["end"] or found["end2"]:
            if opened.get(name):
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        attrs = found["attrs"] or found["attrs2"] or ""
        if name in _VOID or attrs.endswith("/"):
            continue
        if name in _RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if block and any(x[0] == "p" for x in stack[-6:]):  # a block ends an open paragraph and what is open in it
            depth = max(i for i, x in enumerate(stack) if x[0] == "p")
            if not any(x[0] in _CONTAINERS for x in stack[depth:]):
                while len(stack) > depth:
                    pop()
        shut = _CLOSED_BY.get(name)
        if shut and stack and stack[-1][0] in shut:
            pop()
        step, odd = _attributes(name, attrs)
        if name == "header" and (opened.get("article") or opened.get("main")):
            odd = False
        path = blake2b(f"{stack[-1][1] if stack else ''}/{step}".encode(), digest_size=8).hexdigest()
        around, own = stack[-1][3] if stack else -1, -1
        if name in _CONTAINERS:
            own = len(read.paths)
            read.paths.append(path)
            read.numbers.setdefault(path, []).append(own)
            read.tags.append(name)
            read.parents.append(around)
            read.ends.append(-1)
        links += name == "a"
        opened[name] = opened.get(name, 0) + 1
        stack.append((name, path, odd or bool(stack and stack[-1][2]), around if own < 0 else own, own))
    read.ends = [len(read.paths) if end < 0 else end for end in read.ends]
    return read


def best_path(page: Page) -> str | None:
    """Path of the container with the highest score, widened. A block counts its characters outside links for the
    container it stands in, and half, a quarter ... for those further out; ties go to the smaller path."""
    scores = [0.0] * len(page.paths)
    filled = [False] * len(page.paths)
    for block in page.blocks:
        if block.container >= 0:
            size = len(block.text())
            scores[block.container] += size - 2 * min(block.linked, size)
            filled[block.container] = True
    for number in range(len(scores) - 1, 0, -1):
        parent = page.parents[number]
        if parent >= 0 and filled[number]:
            scores[parent] += scores[number] / 2
            filled[parent] = True
    totals: dict[str, float] = {}
    for number, score in enumerate(scores):
        if filled[number]:
            totals[page.paths[number]] = totals.get(page.paths[number], 0.0) + score
    if not totals:
        return None
    best = min(totals, key=lambda p: (-totals[p], p))
    return _widened(best, max((n for n in range(len(scores)) if filled[n] and page.paths[n] == best),
                              key=lambda n: (scores[n], -n)), page)


def _widened(path: str, number: int, page: Page) -> str:
    """Path of the outermost container around ``number`` that adds text of the article to what stands at ``path``.

    An article or main does, and so does what a quote or a definition stands in. Any other does if what it adds stands
    in it directly or in its parts (sections, cells ...) and is no list of links; other containers beside the best one
    may be boilerplate that nothing marks."""
    place = page.places()
    sizes, linked = page.sizes(), np.array([b.linked for b in page.blocks], dtype=np.int64)
    whole: list[int] = []  # the innermost container around, itself included, that is no part
    for own, (tag, parent) in enumerate(zip(page.tags, page.parents)):
        whole.append(own if tag not in _PARTS else whole[parent] if parent >= 0 else -1)
    strange = np.array([whole[n] if n >= 0 else -1 for n in place.tolist()], dtype=np.int64)
    covered, tag, outer = page.at(path, place), page.tags[number], page.parents[number]
    while outer >= 0:
        added = (place >= outer) & (place < page.ends[outer]) & ~covered
        wide = page.tags[outer] in ("article", "main") or tag in ("blockquote", "dd")
        if wide or (added.any() and 2 * np.minimum(linked, sizes)[added].sum() < sizes[added].sum()
                    and (strange[added] <= outer).all()):
            path, tag = page.paths[outer], page.tags[outer]
            covered = page.at(path, place) if added.any() else covered
        outer = page.parents[outer]
    return path


def main_text(text: str | None, winners: list[str] | None) -> str:
    """Text of the blocks in the containers at the first of ``winners`` that holds a fair share of what stands at the
    page's own best path, else at that one."""
    page = read_blocks(text or "")
    own = best_path(page)
    if own is None:
        return "\n".join(t for t in (b.text() for b in page.blocks) if t)
    sizes, places = page.sizes(), page.places()
    chosen = page.at(own, places)
    least = FAIR * sizes[chosen].sum()
    for path in winners or ():
        if path == own:
            break
        if path in page.numbers:
            held = page.at(path, places)
            if sizes[held].sum() >= least:
                chosen = held
                break
    return "\n".join(b.text() for b, taken in zip(page.blocks, chosen) if taken and b.text())


def host_of(url: str | None) -> str:
    """Lower-case host, without user and port; empty where there is none."""
    rest = (url or "").partition("://")[2] or (url or "").removeprefix("//")
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rpartition("@")[2].partition(":")[0].lower()


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, text, n_chars) for each row of ``pages`` (page_id, url, html; others are ignored).

    Null or empty html gives an empty text; a null url counts as host ''. Pages without any container are taken whole.
    Repeated rows come back as often as they came in, an empty table gives an empty result, and ties between paths go
    to the smaller one."""
    pages = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))

    def vote(batches):
        for batch in batches:
            counts: dict[tuple[str, str], int] = {}
            for url, page in zip(batch.column("url").to_pylist(), batch.column("html")):
                if path := best_path(read_blocks(page.as_py() or "")):
                    key = (host_of(url), path)
                    counts[key] = counts.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in counts], pa.string()), pa.array([p for _, p in counts], pa.string()),
                 pa.array(list(counts.values()), pa.int64())], names=["host", "path", "n"])

    votes = pages.select("url", "html").mapInArrow(vote, "host string, path string, n long")
    votes = votes.groupBy("host", "path").agg(F.sum("n").alias("n"))
    ranked = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path"))), lambda v: v["path"])
    winners = settle(votes.where(F.col("n") >= VOTES).groupBy("host").agg(ranked.alias("paths")), "host-paths")

    def hosts(batches):
        for batch in batches:
            host = pa.array([host_of(u) for u in batch.column("url").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, host], names=[*batch.schema.names, "host"])

    def extract(batches):
        for batch in batches:
            for part in text_slices(batch, "html"):
                names: dict[str, list[str]] = {}
                texts = []
                for page, host, paths in zip(part.column("html"), part.column("host").to_pylist(), part.column("paths")):
                    if host not in names:
                        names[host] = paths.as_py() or []
                    texts.append(main_text(page.as_py(), names[host]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), part.column("host"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "host", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    named = pages.mapInArrow(hosts, f"page_id {kind}, url string, html string, host string")
    return named.join(broadcast_if_small(winners), "host", "left").select(
        "page_id", "url", "html", "host", "paths").mapInArrow(
        extract, f"page_id {kind}, url string, host string, text string, n_chars long")


def op2_html_consensus(spark, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))
