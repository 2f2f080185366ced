"""Main text of web pages, without what the site repeats on its pages.

A page is read as a stream of tags and texts, in one pass forward by the rules of HTML: a quote within
an unquoted value is a character like others, and a tag that never ends takes the rest of the page
with it. The work is in proportion to the length of the page, whatever its markup. Menus, headers and footers of the site, sidebars,
notices, adverts, forms, scripts, styles and reader comments go by their element, role or class.
A class or id counts as a whole name; of hyphenated names, those made of listed words and of
HELPERS only (ad-slot, but not no-sidebar or article-header). No element goes by its class if it
holds an article or main element, or half of the text that would be left; in an article, names of
DOUBTFUL_CLASSES decide together with what the element is: a division or section is a notice by that
name, and it holds reader comments if it comes after text of the article and consists of nothing
but like elements. The others are left to the counts per host.
Besides, every closed element with text is hashed with all that is in it, its children by their
hashes, and hashes are counted per host. Groups (div, section, lists) that stand on three pages of a host go, however many pages it
has. Paragraphs and other elements are what articles may repeat as well, such as a licence line; they
go if they stand on at least half of the host's pages, and on at least 20.

Pages of a host with equal text, as read without its template, count as one page, so that copies of
an article (mirrors, print or tracking urls) do not make its paragraphs a template. Nor is anything
cut out of an article that would lose half of its text or more, or of another page of which less
than a quarter would be left, as near copies would. Where a page has an article or main element, its
text is the page's text, else that of the body.

Elements on half of a host's pages are few: if pages have s elements on average, at most 2 s of them
can be that frequent. They are joined to the pages by host. Repeated groups may be many, so they are
joined to the elements of each page, and a page gets those that it has.

Defined cases: a null or empty html, or one without text, gives an empty text; unclosed elements
end with the one around them; a url without a host counts as a host of its own; repeated rows give
repeated results and count as one page; pages of any length are read whole; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchtrail.llm.common import written
from touchtrail.llm.url_filter import host_of

LEAST_SHARE = 0.5
LEAST_PAGES = 20
LEAST_PAGES_OF_GROUPS = 3
# Of a page without article text, what the template must leave.
LEAST_LEFT = 0.25

# Names of elements, roles and classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noframes xmp".split())
BLOCKS = frozenset(
    """address article aside blockquote body br caption center dd details dialog dir div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li
    main menu nav ol option p pre search section summary table tbody td tfoot th thead tr
    ul""".split()
)
GROUPS = frozenset("center details dir div dl fieldset header hgroup ol section ul".split())
DROPPED = frozenset(
    """nav footer aside form script style noscript template textarea title iframe noframes xmp head
    button select menu dialog svg canvas object audio video""".split()
)
DROPPED_ROLES = frozenset(
    """navigation banner contentinfo complementary search dialog alertdialog alert menu menubar
    form""".split()
)
DROPPED_CLASSES = frozenset(
    """ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar
    menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar cookie cookies
    consent gdpr notice notices banner popup modal overlay newsletter subscribe signup share
    sharing social related comment comments discussion replies responses disqus widget toolbar
    pagination""".split()
)
# Words that tell nothing beside one of the above, and names that articles use for their own parts.
HELPERS = frozenset(
    """site page top bottom left right inner outer box bar area list links link item items button
    buttons block section container wrapper wrap slot unit form icons icon main primary
    secondary user users reader readers visitor visitors""".split()
)
DOUBTFUL_CLASSES = frozenset(
    """notice notices header footer banner masthead related discussion replies responses toolbar widget
    overlay modal promotion social consent""".split()
)
NOTICE_CLASSES = frozenset("notice notices banner".split())
REPLY_CLASSES = frozenset("discussion replies responses".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
CLOSES = {
    "p": BLOCKS - {"br"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
    "option": frozenset({"option"}),
}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_GAP = re.compile(r"[\s/]*")
_KEY = re.compile(r"[^\s/>][^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_UNQUOTED = re.compile(r"[^\s>]+")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
_TELLING = frozenset("class id role hidden aria-hidden".split())
_PART = re.compile(r"[-_]+")


def _attributes(html: str, at: int) -> tuple[int, dict[str, str], bool] | None:
    """Place after a tag, its telling attributes and whether it closes itself; None if it never ends.

    ``at`` is the place after its name.
    """
    found: dict[str, str] = {}
    size = len(html)
    while True:
        start, at = at, _GAP.match(html, at).end()
        if at == size:
            return None
        if html[at] == ">":
            return at + 1, found, at > start and html[at - 1] == "/"
        key = _KEY.match(html, at)
        at, value = key.end(), ""
        equals = _EQUALS.match(html, at)
        if equals:
            at = equals.end()
            if at == size:
                return None
            if html[at] in "\"'":
                end = html.find(html[at], at + 1)
                if end < 0:
                    return None
                value, at = html[at + 1 : end], end + 1
            elif html[at] != ">":
                bare = _UNQUOTED.match(html, at)
                value, at = bare.group(), bare.end()
        name = key.group().lower()
        if name in _TELLING:
            found.setdefault(name, unescape(value).lower())


def _known(name: str) -> tuple[list[str], bool]:
    """Listed words of a class name, and whether all its other words are helpers."""
    parts = [part for part in _PART.split(name) if part]
    known = [part for part in parts if part in DROPPED_CLASSES]
    return known, bool(known) and all(p in DROPPED_CLASSES or p in HELPERS for p in parts)


def _unwanted(name: str, attributes: dict[str, str], in_article: bool) -> str:
    """Whether an element goes by its name or role ("surely"), by its class ("class"), if it holds
    nothing but like elements ("replies"), or not.
    """
    if name in DROPPED or (name == "header" and not in_article):
        return "surely"
    if not attributes:
        return ""
    if "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return "surely"
    if attributes.get("role", "").strip() in DROPPED_ROLES:
        return "surely"
    if name in ("html", "body", "article", "main"):
        return ""
    doubt = ""
    for one in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        known, listed = _known(one)
        if not listed:
            continue
        if not in_article or not DOUBTFUL_CLASSES.issuperset(known):
            return "class"
        if name in GROUPS and not NOTICE_CLASSES.isdisjoint(known):
            return "class"
        if name in GROUPS and not REPLY_CLASSES.isdisjoint(known):
            doubt = "replies"
    return doubt


class _Open:
    """An open element: what it is, what came before it, and a running hash of what is in it."""

    __slots__ = ("name", "shape", "start", "before", "left_out", "said", "hash", "children", "others")

    def __init__(self, name: str, shape: str, start: int, before: int, left_out: str, said: int):
        self.name, self.shape, self.start, self.before = name, shape, start, before
        self.left_out, self.said, self.hash = left_out, said, xxhash.xxh3_64()
        # Shapes of its child elements but headings, and whether it holds anything else.
        self.children: dict[str, int] = {}
        self.others = False

    def holds_like_elements(self) -> bool:
        """Whether it consists of several groups of one shape, with headings at most beside them."""
        counts = list(self.children.values())
        return not self.others and len(counts) == 1 and counts[0] > 1


def read_page(html: str, template: frozenset[int] = frozenset()) -> tuple[str, dict[int, tuple[bool, bool]]]:
    """Main text of a page without elements whose hash is in ``template``; hashes of its elements.

    With each hash: whether it is a group, and whether it is one in the text. Only elements that
    have text and are closed by their own end tag are hashed.
    """
    # Texts, and which of them stand in an article.
    out: list[str] = []
    inside: list[bool] = []
    # Runs of texts in elements of the template, and in elements unwanted by their class, those
    # with the number of articles around them.
    cuts: list[tuple[int, int]] = []
    by_class: list[tuple[int, int, int]] = []
    hashes: dict[int, tuple[bool, bool]] = {}
    # Open elements, and how many of each name.
    stack: list[_Open] = []
    named: dict[str, int] = {}
    outside: set[int] = set()
    dropped = articles = said = hashed = 0
    article_said = False
    at, size = 0, len(html)

    def read_up_to(place: int) -> None:
        """Put what was read since the last time into the hash of the innermost element."""
        nonlocal hashed
        if stack and place > hashed:
            stack[-1].hash.update(html[hashed:place].encode("utf-8", "replace"))
        hashed = max(hashed, place)

    def pop(end: int | None) -> None:
        nonlocal dropped, articles
        read_up_to(at if end is None else end)
        here = stack.pop()
        name = here.name
        named[name] -= 1
        number = here.hash.intdigest()
        if stack:
            stack[-1].hash.update(number.to_bytes(8, "little"))
        if end is not None and said > here.said and name in BLOCKS:
            group = name in GROUPS
            hashes[number] = (group, group and (articles > 0 or hashes.get(number, (0, False))[1]))
            if group and not articles:
                outside.add(number)
            if number in template:
                cuts.append((here.before, len(out)))
        dropped -= here.left_out == "surely"
        articles -= name in ("article", "main")
        if here.left_out == "class" or (here.left_out == "replies" and here.holds_like_elements()):
            by_class.append((here.before, len(out), articles))
        if name in BLOCKS:
            add(" ")

    def add(text: str) -> None:
        nonlocal said, article_said
        if not dropped and text:
            if not text.isspace():
                said += 1
                article_said = article_said or articles > 0
                if stack:
                    stack[-1].others = True
            out.append(text)
            inside.append(articles > 0)

    def opened(name: str, start: int, attributes: dict[str, str]) -> None:
        nonlocal dropped, articles
        shape = f"{name} {attributes.get('class', '')}"
        if stack and name not in HEADINGS:
            parent = stack[-1]
            if name in GROUPS or name in ("li", "article"):
                parent.children[shape] = parent.children.get(shape, 0) + 1
            else:
                parent.others = True
        left_out = _unwanted(name, attributes, articles > 0)
        if left_out == "replies" and not article_said:
            left_out = ""
        read_up_to(start)
        stack.append(_Open(name, shape, start, len(out), left_out, said))
        named[name] = named.get(name, 0) + 1
        dropped += left_out == "surely"
        articles += name in ("article", "main")

    while at < size:
        # Text up to the next markup; a lone < is text.
        start = at
        at = html.find("<", at)
        while 0 <= at < size - 1 and not (html[at + 1] in "/!?" or html[at + 1].isalpha() and html[at + 1].isascii()):
            at = html.find("<", at + 1)
        if at < 0 or at == size - 1:
            add(unescape(html[start:]))
            at = size
            break
        if at > start:
            add(unescape(html[start:at]))
        mark = at
        if html[at + 1] in "!?":
            if html.startswith("<!--", at):
                if html.startswith((">", "->"), at + 4):
                    at = html.index(">", at) + 1
                else:
                    end = _COMMENT_END.search(html, at + 4)
                    at = end.end() if end else size
            else:
                at = html.find(">", at) + 1 or size
            continue
        closing = html[at + 1] == "/"
        word = _NAME.match(html, at + 1 + closing)
        if word is None:
            # Not a letter after the slash: a comment of another kind.
            at = html.find(">", at) + 1 or size
            continue
        tag = _attributes(html, word.end())
        if tag is None:
            at = size
            break
        name = word.group().lower()
        at, attributes, closes_itself = tag
        if closing:
            if name == "br" or name == "p":
                add(" ")
            if named.get(name):
                at, after = mark, at
                while stack[-1].name != name:
                    pop(None)
                at = after
                pop(at)
            continue
        at, after = mark, at
        while stack and name in CLOSES.get(stack[-1].name, ()):
            pop(None)
        at = after
        if name in BLOCKS:
            add(" ")
        if name in VOID or closes_itself and name not in BLOCKS and name not in RAW:
            continue
        if name in RAW:
            if stack and name not in ("script", "style", "noscript", "template"):
                stack[-1].others = True
            end = _RAW_END[name].search(html, at)
            at = html.find(">", end.end()) + 1 or size if end else size
            continue
        opened(name, mark, attributes)
    while stack:
        pop(None)
    if by_class:
        _drop_by_class(out, inside, by_class)
    # An article that holds no text leaves the rest of the page to speak for it.
    whole = _spaced([text for text, held in zip(out, inside) if held])
    least = 1 - LEAST_SHARE
    if not whole:
        inside = [True] * len(out)
        whole, least = _spaced(out), LEAST_LEFT
        hashes |= dict.fromkeys(outside, (True, True))
    if not cuts:
        return whole, hashes
    for start, end in _outermost(cuts):
        out[start:end] = [""] * (end - start)
    text = _spaced([text for text, held in zip(out, inside) if held])
    return whole if len(text) <= least * len(whole) else text, hashes


def _outermost(runs: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Runs that no other one contains; they are nested or apart."""
    reached = 0
    for start, end in sorted(runs, key=lambda run: (run[0], -run[1])):
        if end > reached:
            yield start, end
            reached = end


def _drop_by_class(out: list[str], inside: list[bool], runs: list[tuple[int, int, int]]) -> None:
    """Empties the texts of elements unwanted by their class, but not those of a page's wrapper.

    That is an element around half of the text of the page's articles, or of the page where it has
    none; within an article, one around all of its text.
    """
    sizes = [len(text.strip()) for text in out]
    in_article = [size if held else 0 for size, held in zip(sizes, inside)]
    up_to = [0, *accumulate(in_article if any(in_article) else sizes)]
    gone = 0
    # Elements are nested or apart and come outermost first, so nothing in one has gone before it.
    for start, end, around in sorted(runs, key=lambda run: (run[0], -run[1])):
        if end > gone and up_to[end] - up_to[start] < up_to[-1] * (1 if around else LEAST_SHARE):
            out[start:end] = [""] * (end - start)
            gone = end


def _spaced(texts: list[str]) -> str:
    return " ".join("".join(texts).split())


def _element_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, page, element, content, group, used) per element; a null element stands for the page.

    content: hash of the page's text; used: the element is a group in that text.
    """
    for batch in batches:
        hosts, pages, numbers, contents, kinds = [], [], [], [], []
        given = (column.to_pylist() for column in batch.columns)
        for host, page, html in zip(*given):
            text, found = read_page(html)
            content = xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))
            hosts += [host] * (len(found) + 1)
            pages += [page] * (len(found) + 1)
            numbers += [None, *found]
            contents += [content] * (len(found) + 1)
            kinds += [(False, False), *found.values()]
        signed = [pa.array(n, pa.uint64()).view(pa.int64()) for n in (numbers, contents)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(hosts, pa.string()),
                pa.array(pages, pa.int64()),
                *signed,
                *(pa.array([kind[n] for kind in kinds], pa.bool_()) for n in (0, 1)),
            ],
            ["host", "page", "element", "content", "group", "used"],
        )


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        rows = zip(*(batch.column(n) for n in ("_template", "_groups")))
        for html, lists in zip(batch.column("_html").to_pylist(), rows):
            numbers = [n for numbers in lists for n in numbers.as_py() or ()]
            texts.append(read_page(html, frozenset(n & (2**64 - 1) for n in numbers))[0])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"),
                batch.column("url"),
                pa.array(texts, pa.string()),
                pa.array([len(text) for text in texts], pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def template_elements(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Hashes of the elements that make up the template of a host: those of all of its pages, as
    (host, _template), and the groups by page, as (host, page, _groups).
    """
    rows = written(
        pages.select("host", "page", "_html").mapInArrow(
            _element_rows,
            "host string, page long, element long, content long, group boolean, used boolean",
        ),
        "elements",
    )
    counted = written(
        rows.select("host", "element", "content", "group")
        .distinct()
        .groupBy("host", "element")
        .agg(F.count("*").alias("n"), F.max("group").alias("group"))
        .where(f"n >= {LEAST_PAGES} or group and n >= {LEAST_PAGES_OF_GROUPS}"),
        "counts",
    )
    sizes = counted.where("element is null").select("host", F.col("n").alias("pages"))
    frequent = (
        counted.where(f"element is not null and n >= {LEAST_PAGES}")
        .join(sizes, "host")
        .where(F.col("n") >= LEAST_SHARE * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_list("element").alias("_template"))
    )
    groups = (
        rows.where("used")
        .join(counted.where("group").select("host", "element"), ["host", "element"])
        .groupBy("host", "page")
        .agg(F.collect_set("element").alias("_groups"))
    )
    return frequent, groups


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    chosen = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("_html"),
        F.xxhash64(html).alias("page"),
    ).withColumn("host", F.coalesce(host_of(F.col("url")), F.lit("")))
    frequent, groups = template_elements(chosen)
    return (
        chosen.join(written(frequent, "templates"), "host", "left")
        .join(written(groups, "groups"), ["host", "page"], "left")
        .select("page_id", "url", "_html", "_template", "_groups")
        .mapInArrow(_text_rows, "page_id long, url string, text string, n_chars long")
    )
