"""Main-text extraction with consensus host paths.

Pass 1 parses every page into containers and text blocks, scores the
containers (plain text in them, link text and noise left out) and emits
the page's best one as a *generalised path*: the chain of tags with their
classes and ids, digits replaced. Spark sums the votes per (host, path) -
partial sums are formed map-side, so a host with a third of all pages is
no hot key. A page is then extracted with that of its host's voted paths
(two pages or more) that has most votes among the containers of this page
that hold at least ``FAIR_SHARE`` of the text of its own best one; those
containers' paths come out of pass 1, so pages and votes meet on (host,
path) and no list of a host's paths is ever built. A page that no voted path
fits (a host of one page, an odd template) keeps its own container. Pass 2
parses each page again with its path.

Noise: menus, page headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments. Elements and roles tell, and whole
class names: a name counts by its words, unless it only states something
(``has-sidebar``, ``share-enabled``); with a word for content beside
(``entry-header``) only words that are never content count. A name alone is overruled
where the container holds most of the page's text and few links, and where
the page would have no text otherwise.

Text: blocks inside the chosen container in page order without noise;
references decoded, white space inside a block collapsed, blocks joined by
one line feed.

Edge cases: a null or empty page has empty text; a null or odd URL belongs
to the empty host; unclosed and crossed tags are closed where the next
block begins; time and memory grow in proportion to a page, also for broken
markup and deep nesting; equal rows give equal rows; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import materialise

# Element names and words in classes and ids.
SKIPPED = "script style noscript template iframe textarea title svg math select object canvas audio video".split()
CONTAINERS = frozenset("html body main article section div td th center blockquote details "
                       "aside nav header footer form dialog menu fieldset figure".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre table thead tbody tfoot tr caption "
                                "address hr figcaption summary legend option hgroup search".split())
VOID = frozenset(["hr"])
NOISE_TAGS = frozenset("nav footer aside form dialog menu header head button search".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NOISE_WORDS = frozenset("""
    banner banners promo promos promoted promotion notice notices notification notifications alert popup modal overlay
    sidebar sidebars widget widgets recommended recommendations share sharing social topbar toolbar footer foot masthead
    header discussion pagination pager paging login signin signup search form hidden tracking paywall disclaimer
    subscribe subscription
    """.split())
NEVER_CONTENT = frozenset("""
    ad ads adv advert adverts advertisement advertising adsense adslot adbox sponsor sponsored sponsors cookie cookies
    consent gdpr newsletter related breadcrumb breadcrumbs menu menus nav navbar navigation comment comments
    commentlist reply replies respond disqus
    """.split())
GOOD_WORDS = frozenset("article content main post entry story text".split())
STATES = frozenset("has with no is not without show hide skip js".split())              # first words of names that state something
STATE_ENDS = frozenset("enabled disabled active inactive on off".split())
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
              "th": ("td", "th"), "option": ("option",)}
LIMITS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"),
          "th": ("table", "tr"), "option": ("select",)}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(SKIPPED) + r")(?=[\s/>])[^>]*+(?:(?<=/)>|>.*?(?:</(?P=raw)(?=[\s/>]|\Z)[^>]*+(?:>|\Z)|\Z))"
    r"""|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attrs>[^>"']*+(?:(?:"[^"]*"|'[^']*')[^>"']*+)*+)>"""
    r"|<(?P<end2>/?)(?P<tag2>[a-z][^\s/>]*+)[^>]*+(?:>|\Z)", re.I | re.S)
ATTR = re.compile(r"""([a-z-]+)\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
DIGITS = re.compile(r"\d+")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

FAIR_SHARE = 0.9
BY_NAME, BY_STRONG_NAME, BY_ELEMENT = 1, 2, 3      # why a container is noise


def name_noise(names: list[str]) -> tuple[int, bool]:
    """(what the class names and ids say about noise, whether one stands for content)."""
    level, good = 0, False
    for name in names:
        words = [w.lower() for w in WORDS.findall(name)]
        if not words or words[0] in STATES or words[-1] in STATE_ENDS:
            continue
        content = not GOOD_WORDS.isdisjoint(words)
        if not NEVER_CONTENT.isdisjoint(words):
            level = BY_STRONG_NAME
        elif content:
            good = True
        elif not NOISE_WORDS.isdisjoint(words):
            level = max(level, BY_NAME)
    return level, good and level == 0


class Box:
    """A container of a page: its place in the tree and its own text."""
    __slots__ = ("parent", "tag", "step", "own", "good", "plain", "linked", "heads", "noise", "key", "in_article")

    def __init__(self, parent, tag, step, own, good):
        self.parent, self.tag, self.step, self.own, self.good = parent, tag, step, own, good
        self.plain = self.linked = 0        # characters outside and inside links, in the box itself
        self.heads = 0
        self.noise = False
        self.key = step_key(parent.key if parent else 0, step)
        self.in_article = tag == "article" or (parent is not None and parent.in_article)

    @property
    def path(self) -> str:
        steps, box = [], self
        while box is not None:
            steps.append(box.step)
            box = box.parent
        return ">".join(reversed(steps))


def step_key(key: int, step: str) -> int:
    """The 64-bit key of a path from that of its parent and its last step."""
    raw = hashlib.blake2b(key.to_bytes(8, "little", signed=True) + step.encode(), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def path_key(path: str) -> int:
    """``Box.key`` of a whole path."""
    key = 0
    for step in path.split(">"):
        key = step_key(key, step)
    return key


def parse(page: str) -> tuple[list[Box], list[tuple[Box, str, int]]]:
    """(containers in page order, blocks as (container, text, characters outside links))."""
    root = Box(None, "html", "html", 0, False)
    boxes, blocks = [root], []
    stack: list[tuple[str, Box]] = [("html", root)]      # open block elements and the container they stand in
    open_tags: dict[str, int] = {"html": 1}
    pieces: list[str] = []
    plain, in_link, heading, body_seen = 0, 0, False, False

    def flush() -> None:
        nonlocal pieces, plain
        if pieces:
            text = " ".join(html_lib.unescape("".join(pieces)).split())
            if text:
                box = stack[-1][1]
                blocks.append((box, text, plain))
                box.plain += plain
                box.linked += max(0, len(text) - plain)
                box.heads += heading
            pieces, plain = [], 0

    def pop_to(n: int) -> None:
        flush()
        for tag, _ in stack[max(1, n):]:
            open_tags[tag] -= 1
        del stack[max(1, n):]

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text = page[at:m.start()]
            pieces.append(text)
            if not in_link:
                plain += len(text.strip())
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            pieces.append(" ")
            continue
        if tag == "head" or tag == "html":
            continue
        if tag == "a":
            in_link = 0 if (m["end"] or m["end2"]) else 1
            continue
        if tag not in BLOCKS:
            continue
        in_link = 0
        if m["end"] or m["end2"]:
            heading_end = tag[0] == "h" and tag[1:].isdigit()
            if open_tags.get(tag):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        pop_to(i)
                        break
            else:
                flush()
            heading = False if heading_end else heading
            continue
        flush()
        heading = False
        if stack[-1][0] in CLOSED_BY_BLOCK and tag != "hgroup":
            pop_to(len(stack) - 1)
        if tag in SAME_LEVEL and any(open_tags.get(t) for t in SAME_LEVEL[tag]):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in LIMITS[tag]:
                    break
                if stack[i][0] in SAME_LEVEL[tag]:
                    pop_to(i)
                    break
        if tag in VOID:
            continue
        box = stack[-1][1]
        attrs = {a.lower(): b or c or d for a, b, c, d in ATTR.findall(m["attrs"])} if m["attrs"] else {}
        if tag in CONTAINERS or attrs.get("class") or attrs.get("id") or attrs.get("role"):
            names = attrs.get("class", "").split() + attrs.get("id", "").split()
            level, good = name_noise(names)
            step = tag + "".join(sorted("." + DIGITS.sub("0", c) for c in attrs.get("class", "").lower().split())) + (
                "#" + DIGITS.sub("0", attrs["id"].lower()) if attrs.get("id") else "")
            step = step.replace(">", "_")
            if tag in ("body", "main", "article"):
                level = 0
            if (tag in NOISE_TAGS and not (tag == "header" and (box.in_article or good))) \
                    or attrs.get("role", "").lower() in NOISE_ROLES or attrs.get("aria-hidden") == "true" \
                    or HIDDEN.search(attrs.get("style", "")) or " hidden" in f" {ATTR.sub('', m['attrs'] or '')} ".lower():
                level = BY_ELEMENT
            if tag != "body":
                box = Box(box, tag, step, level, good or tag in ("article", "main"))
                boxes.append(box)
            elif not body_seen:
                body_seen, root.step = True, f"html>{step}"
                root.key = path_key(root.step)
        if tag != "body":
            stack.append((tag, box))
            open_tags[tag] = open_tags.get(tag, 0) + 1
        heading = tag[0] == "h" and tag[1:].isdigit()
    if at < len(page):
        pieces.append(page[at:])
    flush()
    settle_noise(boxes)
    return boxes, blocks


def settle_noise(boxes: list[Box]) -> None:
    """Decide which containers are noise. Parents come before children."""
    plain, linked = {id(b): b.plain for b in boxes}, {id(b): b.linked for b in boxes}
    for b in reversed(boxes):
        if b.parent is not None and b.own != BY_ELEMENT:
            plain[id(b.parent)] += plain[id(b)]
            linked[id(b.parent)] += linked[id(b)]
    whole = plain[id(boxes[0])]
    for b in boxes:                     # most of the text and few links: not noise, whatever its name
        if b.own == BY_NAME and plain[id(b)] > 0.6 * whole and linked[id(b)] < 0.3 * plain[id(b)]:
            b.own = 0
    for least in (BY_NAME, BY_STRONG_NAME, BY_ELEMENT):
        text = 0
        for b in boxes:
            b.noise = b.own >= least or (b.parent is not None and b.parent.noise)
            text += 0 if b.noise else b.plain
        if text:
            break


def best_box(boxes: list[Box]) -> tuple[Box, dict[int, int]]:
    """(the container with most plain text, half of what nested containers
    hold counted; what each container holds with all in it)."""
    score = {id(b): float(b.plain) for b in boxes}
    whole = {id(b): 0 if b.noise else b.plain for b in boxes}
    heads = {id(b): 0 if b.noise else b.heads for b in boxes}
    for b in reversed(boxes):
        if b.parent is not None and not b.noise:
            score[id(b.parent)] += score[id(b)] / 2
            whole[id(b.parent)] += whole[id(b)]
            heads[id(b.parent)] += heads[id(b)]
    rated = [(score[id(b)] * (1.5 if b.good else 1.0), -i) for i, b in enumerate(boxes) if not b.noise]
    best = boxes[-max(rated)[1]] if rated else boxes[0]
    up = best
    while up is not None:                       # an article around it is the whole of it
        if up.tag in ("article", "main"):
            best = up
            if up.tag == "article":
                break
        up = up.parent
    while best.parent is not None and best.parent.parent is not None and best.tag not in ("article", "main") \
            and heads[id(best.parent)] > heads[id(best)] and whole[id(best.parent)] <= 1.25 * whole[id(best)]:
        best = best.parent                      # the heading stands beside the text
    return best, whole


def text_of(boxes: list[Box], blocks, chosen: list[Box]) -> str:
    """Blocks that lie in any chosen container and in no noise."""
    inside = {id(b) for b in chosen}
    for b in boxes:                             # parents come before children
        if b.parent is not None and id(b.parent) in inside:
            inside.add(id(b))
    return "\n".join(text for box, text, _ in blocks if not box.noise and id(box) in inside)


def vote(page: str | None) -> tuple[str, int, int, list[int]]:
    """(path of the best container, its key, what it holds, keys of the
    paths whose containers hold a fair share of that)."""
    if not page:
        return "", 0, 0, []
    boxes, _ = parse(page)
    best, whole = best_box(boxes)
    held = whole[id(best)]
    by_key: dict[int, int] = {}                 # containers of one path hold their texts together
    for b in boxes:
        if not b.noise:
            by_key[b.key] = by_key.get(b.key, 0) + whole[id(b)]
    return best.path, best.key, held, [k for k, n in by_key.items() if held and n >= FAIR_SHARE * held]


def extract(page: str | None, path: str | None = None) -> tuple[str, str]:
    """(text, path used) with the path that the page's host agreed on, or the
    page's own best container."""
    if not page:
        return "", ""
    boxes, blocks = parse(page)
    if path:
        key = path_key(path)
        same = [b for b in boxes if b.key == key and not b.noise]
        if same and same[0].path == path:
            return text_of(boxes, blocks, same), path
    best, _ = best_box(boxes)
    return text_of(boxes, blocks, [best]), best.path


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, path per row."""
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")),
                                    r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    who = F.struct("page_id", "url", F.xxhash64("html").alias("hash")).alias("who")     # rows equal in these are copies

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                s = b.slice(at, 1000)
                found = [vote(p) for p in s.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), s.column(1), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.int64()),
                     pa.array([x[2] for x in found], pa.int64()), pa.array([x[3] for x in found], pa.list_(pa.int64()))],
                    names=["who", "host", "path", "key", "held", "fair"])

    kind = src.select(who).schema["who"].dataType.simpleString()
    ballots = materialise(src.select(who, host.alias("host"), "html").mapInArrow(
        votes, f"who {kind}, host string, path string, key long, held long, fair array<long>").where(F.col("held") > 0), "html-votes")
    weight = F.sum(F.floor(F.log1p("held") * 1000)).alias("weight")         # whole numbers: the same in any order
    tally = (ballots.groupBy("host", "key").agg(F.count(F.lit(1)).alias("pages"), weight, F.min("path").alias("path"))
             .where(F.col("pages") > 1))
    agreed = (ballots.select("who", "host", F.explode("fair").alias("key")).join(tally, ["host", "key"])
              .groupBy("who").agg(F.min(F.struct(-F.col("weight"), "path")).alias("best"))
              .select("who", F.col("best.path").alias("agreed")))
    joined = src.select("page_id", "url", "html", who).join(agreed, "who", "left").select("page_id", "url", "html", "agreed")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                s = b.slice(at, 1000)
                found = [extract(p, x) for p, x in zip(s.column(2).to_pylist(), s.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([s.column(0), s.column(1), pa.array([x[0] for x in found], pa.string()),
                                                  pa.array([x[1] for x in found], pa.string())], names=["page_id", "url", "text", "path"])

    kind = dict(src.dtypes)["page_id"]
    out = joined.mapInArrow(texts, f"page_id {kind}, url string, text string, path string")
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "path")
