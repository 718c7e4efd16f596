"""Main text of web pages by equivalence-class template deduction over the pages of a host."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import staged, text_slices
from barloom.operators.spread import lookup_join

# A class counts from so many pages, this share of its host's pages and so many tokens on.
LEAST_PAGES, LEAST_SHARE, LEAST_TOKENS = 3, 0.5, 3
# Share of a host's free text that its main container holds at least; share of an article that its template may take.
MAIN_SHARE, MOST_TEMPLATE = 0.6, 0.5
# Tokens whose occurrences are added up in a task before they are sent on.
HELD = 200_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
UNSEEN = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe input map menu nav noembed noframes noscript "
    "object optgroup option script select style svg template textarea title video xmp".split()
)
# What a new element of the first kind closes, unless an element of the last set stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
LABELS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies copyright dialog disqus dropdown footer gdpr header legal login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination popup promo promoted promotion recommended related replies "
    "reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget "
    "widgets alert aside".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar status".split())
# Text, end tag, start tag and its attributes, comment or declaration, start tag with an open quote, a lone sign.
MARKUP = re.compile(
    r"([^<]+)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<!--.*?(?:--!?>|\Z)|<[!?/][^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|(<)",
    re.S,
)
TELLING = re.compile(r"class|id|role|hidden|style|itemprop", re.I)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[a-z]+")
HOST = r"^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


@dataclass(slots=True)
class Element:
    name: str
    path: int  # hash of the names and labels from the root to here
    dropped: bool
    article: int
    main: int
    link: bool
    opened: tuple[tuple[int, int], ...]  # (path, number) of the block elements that stand open, from the root


@dataclass(slots=True)
class Block:
    """The text between two block elements; `keys` are the tokens of its parts, `within` the elements about it."""

    text: str
    keys: list[int]
    link_chars: int
    dropped: bool
    article: int
    main: int
    within: tuple[tuple[int, int], ...]

    @property
    def free_chars(self) -> int:
        return 0 if self.dropped else len(self.text) - min(self.link_chars, len(self.text))


@dataclass
class Page:
    tokens: list[tuple[int, bool]] = field(default_factory=list)  # (key, whether it is a tag), in page order
    blocks: list[Block] = field(default_factory=list)


# What tags of one spelling mean, and paths of elements; emptied when they have grown.
TAGS: dict[tuple[str, str], tuple[str, bool, bool, bool]] = {}
PATHS: dict[tuple[int, str, str], int] = {}
CACHED = 50_000


def hashed(token: str, path: int) -> int:
    """A token within its path: the same text or tag elsewhere in the tree is another token."""
    return xxhash.xxh64_intdigest(token, path) & 0x7FFFFFFFFFFFFFFF


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def labelled(found: dict[str, str]) -> bool:
    """Whether class, id, role or hiding attributes tell that an element is not part of the article."""
    if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES:
        return True
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    return any(w in LABELS for w in WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{found.get('class', '')} {found.get('id', '')}").lower()))


def meaning(name: str, text: str) -> tuple[str, bool, bool, bool]:
    """(label, whether labelled, whether an article, whether a main element) of a start tag."""
    if not TELLING.search(text):
        return "", False, name == "article", name == "main"
    known = TAGS.get((name, text))
    if known is None:
        if len(TAGS) > CACHED:
            TAGS.clear()
        found = attributes(text)
        label = " ".join(sorted(re.sub(r"\d+", "", f"{found.get('class', '')} {found.get('id', '')}").split()))
        article = name == "article" or "articlebody" in found.get("itemprop", "").lower()
        known = TAGS[name, text] = label, labelled(found), article, name == "main" or found.get("role", "").lower() == "main"
    return known


def path_of(up: int, name: str, label: str) -> int:
    known = PATHS.get((up, name, label))
    if known is None:
        if len(PATHS) > CACHED:
            PATHS.clear()
        known = PATHS[up, name, label] = hashed(f"<{name} {label}", up)
    return known


BOUNDS_OF_P = frozenset({"td", "th", "table", "button", "object", "article", "section", "div"})
ENDS_OF_P = frozenset({"p"})


def read_page(source: str) -> Page:
    """Tokens and text blocks of a page, whatever of its tags are missing, unclosed or crossed.

    Tokens are the tags and the runs of text between them, each with its path from the root.
    """
    page, number = Page(), 0
    tokens = page.tokens
    stack = [Element("", 0, False, 0, 0, False, ())]
    text: list[str] = []
    keys: list[int] = []
    links = 0

    def flush() -> None:
        nonlocal text, keys, links
        joined = " ".join("".join(text).split()) if text else ""
        if joined:
            e = stack[-1]
            page.blocks.append(Block(joined, keys, links, e.dropped, e.article, e.main, e.opened))
        text, keys, links = [], [], 0

    def close(k: int) -> None:
        if any(e.name not in INLINE for e in stack[k:]):
            flush()
        del stack[k:]

    scan = MARKUP.scanner(source)
    while (m := scan.match()) is not None:
        kind = m.lastindex
        if kind == 1 or kind == 7:
            up = stack[-1]
            if up.dropped:
                continue
            run = m[kind]
            if "&" in run:
                run = html.unescape(run)
            text.append(run)
            if not run.isspace():
                key = hashed(run.strip(), up.path)
                keys.append(key)
                tokens.append((key, False))
                if up.link:
                    links += len(run)
            continue
        if kind == 2:
            name = m[2].lower()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    tokens.append((path_of(stack[k].path, "/", name), True))
                    close(k)
                    break
            continue
        if kind is None:
            continue
        name, given = m[kind - 1].lower(), m[kind]
        inline = name in INLINE
        if not inline:
            ends, bounds = CLOSES.get(name, (ENDS_OF_P, BOUNDS_OF_P))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in ends:
                    close(k)
                    break
                if stack[k].name in bounds:
                    break
            if name not in VOID or name in ("br", "hr"):
                flush()
        label, marked, article, main = meaning(name, given)
        up = stack[-1]
        path = path_of(up.path, name, label)
        tokens.append((path, True))
        if name in VOID:
            continue
        number += 1
        dropped = up.dropped or marked or (name in UNSEEN and not (name == "header" and (up.article or up.main)))
        if (article or main) and up.dropped and not marked:
            # An article does not stand in a menu, header or footer: such an element was not closed.
            dropped = any(e.dropped and e.name not in ("nav", "header", "footer", "ul", "ol", "li", "a") for e in stack)
        stack.append(
            Element(
                name,
                path,
                dropped,
                up.article or number * article,
                up.main or number * main,
                up.link or name == "a",
                up.opened if inline else (*up.opened, (path, number)),
            )
        )
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.I).search(source, m.end())
            scan = MARKUP.scanner(source, end.start() if end else len(source))
    flush()
    return page


def page_tokens(pages: DataFrame) -> DataFrame:
    """Rows (host, name, keys, tags, within, chars, depths, total): a page's tokens in order, the free text within each of
    its block elements and in all, and a hash that stands for the page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "html"):
                rows = []
                for source in part.column(2).to_pylist():
                    page = read_page(source or "")
                    held: dict[int, list[int]] = {}
                    for block in page.blocks:
                        if chars := block.free_chars:
                            for depth, (key, _) in enumerate(block.within):
                                row = held.setdefault(key, [0, 0])
                                row[0], row[1] = row[0] + chars, max(row[1], depth)
                    rows.append((*(map(list, zip(*page.tokens, strict=True)) if page.tokens else ([], [])), list(held), [c for c, _ in held.values()], [d for _, d in held.values()], sum(b.free_chars for b in page.blocks)))
                longs = pa.list_(pa.int64())
                types = [longs, pa.list_(pa.bool_()), longs, longs, longs, pa.int64()]
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["host", "name", "keys", "tags", "within", "chars", "depths", "total"])

    rows = pages.where("host <> ''").select("host", F.xxhash64("url", "html").alias("name"), "html")
    schema = "host string, name long, keys array<long>, tags array<boolean>, within array<long>, chars array<long>, depths array<long>, total long"
    return rows.mapInArrow(read, schema)


def occurrences(pages: DataFrame) -> DataFrame:
    """Rows (host, key, tag, a, b, pages, total) of every token of every host, from `page_tokens`.

    (a, b) stands for the occurrence vector: the sum over pages of hashes of the page and the token's count there, so equal
    vectors have equal sums, which add up in any order and in parts. Key 0 counts the pages.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int, bool], list[int]] = {}
        for batch in batches:
            for host, name, keys, tags in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = Counter(zip(keys, tags, strict=True))
                counts[0, False] = 1
                hashes: dict[int, int] = {}
                for (key, tag), n in counts.items():
                    h = hashes.get(n)
                    if h is None:
                        h = (name ^ n * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
                        h = hashes[n] = (h ^ h >> 29) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
                    row = held.setdefault((host, key, tag), [0, 0, 0, 0])
                    row[0] += h >> 33
                    row[1] += h & 0x7FFFFFFF
                    row[2] += 1
                    row[3] += n
                if len(held) > HELD:
                    yield sent(held)
                    held = {}
        yield sent(held)

    def sent(held: dict[tuple[str, int, bool], list[int]]) -> pa.RecordBatch:
        hosts, keys, tags = zip(*held, strict=True) if held else ((), (), ())
        sums = zip(*held.values(), strict=True) if held else ((),) * 4
        columns = [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), pa.array(tags, pa.bool_())]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(s, pa.int64()) for s in sums)], ["host", "key", "tag", "a", "b", "pages", "total"])

    rows = pages.select("host", "name", "keys", "tags")
    rows = rows.mapInArrow(counted, "host string, key long, tag boolean, a long, b long, pages long, total long")
    return rows.groupBy("host", "key", "tag").agg(*[F.sum(c).alias(c) for c in ("a", "b", "pages", "total")])


def classes(pages: DataFrame) -> DataFrame:
    """Rows (host, classes): the large and frequent equivalence classes of each host's `page_tokens`, by occurrence vector.

    Only tokens on half of a host's pages are in them, so a host has at most twice the tokens of its mean page.
    """
    tokens = staged(occurrences(pages).where(f"pages >= {LEAST_PAGES}"), "tokens")
    sizes = tokens.where("key = 0").select("host", F.col("pages").alias("host_pages"))
    frequent = lookup_join(tokens.where("key <> 0"), sizes, ["host"], "inner")
    frequent = frequent.where(F.col("pages") >= LEAST_SHARE * F.col("host_pages"))
    members = F.collect_list(F.struct("key", "tag")).alias("members")
    found = frequent.groupBy("host", "a", "b", "pages", "total").agg(members)
    found = found.where((F.size("members") >= LEAST_TOKENS) & F.exists("members", lambda m: m["tag"]))
    return found.groupBy("host").agg(F.collect_list(F.struct("pages", "total", "members")).alias("classes"))


def places(pages: DataFrame, known: DataFrame, tokens: int) -> DataFrame:
    """Rows (host, key, low, high, own_low, own_high, root, depth, chars) of the tokens of classes and, as key 0, of hosts.

    A token's place is the number of root-class tags before it, its own place that of its class's tags since the class
    last began; the root class is the widest of those that occur once a page. `chars` is the free text within an element.
    """

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            names_ = ("host", "keys", "tags", "within", "chars", "depths", "total", "classes")
            for row in zip(*(batch.column(c).to_pylist() for c in names_), strict=True):
                add_places(held, *row)
                if len(held) > HELD:
                    yield sent(held)
                    held = {}
        yield sent(held)

    names = ["low", "high", "own_low", "own_high", "root", "depth", "chars"]

    def sent(held: dict[tuple[str, int], list[int]]) -> pa.RecordBatch:
        hosts, keys = zip(*held, strict=True) if held else ((), ())
        values = zip(*held.values(), strict=True) if held else ((),) * len(names)
        columns = [pa.array(hosts, pa.string()), pa.array(keys, pa.int64()), *(pa.array(v, pa.int64()) for v in values)]
        return pa.RecordBatch.from_arrays(columns, ["host", "key", *names])

    rows = lookup_join(pages.drop("name"), known, ["host"], "inner", tokens)
    rows = rows.mapInArrow(placed, "host string, key long, " + ", ".join(f"{n} long" for n in names))
    least, most = [F.min(c).alias(c) for c in ("low", "own_low")], [F.max(c).alias(c) for c in ("high", "own_high", "root", "depth")]
    return rows.groupBy("host", "key").agg(*least, *most, F.sum("chars").alias("chars"))


def add_places(
    held: dict[tuple[str, int], list[int]],
    host: str,
    keys: list[int],
    tags: list[bool],
    within: list[int],
    chars: list[int],
    depths: list[int],
    total: int,
    found: list[dict],
) -> None:
    """Add one page's places to those held."""
    once = [k for k, c in enumerate(found) if c["pages"] == c["total"]]
    root = max(once, key=lambda k: (found[k]["pages"], len(found[k]["members"]), min(m["key"] for m in found[k]["members"])), default=-1)
    of = {m["key"]: k for k, c in enumerate(found) for m in c["members"]}
    sizes = [sum(m["tag"] for m in c["members"]) for c in found]
    seen = [0] * len(found)
    rank = 0
    for key, tag in zip(keys, tags, strict=True):
        k = of.get(key)
        if k is None:
            continue
        own = seen[k] % sizes[k]
        row = held.setdefault((host, key), [rank, rank, own, own, int(k == root and tag), 0, 0])
        row[:4] = min(row[0], rank), max(row[1], rank), min(row[2], own), max(row[3], own)
        seen[k] += tag
        rank += tag and k == root
    held.setdefault((host, 0), [0] * 7)[6] += total
    for key, size, depth in zip(within, chars, depths, strict=True):
        if (host, key) in held:
            row = held[host, key]
            row[5], row[6] = max(row[5], depth), row[6] + size


def host_templates(pages: DataFrame) -> DataFrame:
    """Rows (host, template, container): the tokens of the valid classes, and the path of the element that holds the text.

    Valid are tokens that stand in one slot of the root class on all pages and in one place of their own class: those
    classes are ordered and nest in one another. The container is the deepest root-class element with most of the free text.
    """
    pages = staged(page_tokens(pages), "page-tokens")
    known = staged(classes(pages), "classes")
    count = F.aggregate("classes", F.lit(0), lambda n, c: n + F.size(c["members"]))
    tokens = known.agg(F.sum(count)).first()[0] or 0
    found = staged(places(pages, known, tokens), "places")
    total = found.where("key = 0").select("host", F.col("chars").alias("host_chars"))
    valid = lookup_join(found.where("key <> 0 AND low = high AND own_low = own_high"), total, ["host"], "inner")
    holds = (F.col("root") == 1) & (F.col("chars") > 0) & (F.col("chars") >= MAIN_SHARE * F.col("host_chars"))
    size = F.col("chars") * 1000 - F.col("depth")  # the least text, of equals the deepest
    return valid.groupBy("host").agg(
        F.collect_list("key").alias("template"), F.min_by(F.when(holds, F.col("key")), F.when(holds, size)).alias("container")
    )


def main_text(page: Page, template: set[int], container: int | None) -> str:
    """Text of the blocks of the article that are no template, one space apart.

    The article is the longest article element, without one the longest main element, else the container of the host,
    else the deepest element with most of the page's free text. A block is template if all its runs of text are. Where that would
    be over half of the article, as on hosts whose pages are copies of one, nothing is taken for template.
    """
    free = [b for b in page.blocks if not b.dropped]
    for kind in ("article", "main"):
        sizes: Counter = Counter()
        for b in free:
            if getattr(b, kind):
                sizes[getattr(b, kind)] += len(b.text)
        if sizes:
            longest = max(sizes, key=lambda k: (sizes[k], -k))
            free = [b for b in free if getattr(b, kind) == longest]
            break
    else:
        free = in_container(free, container)
    rest = [b for b in free if not template.issuperset(b.keys)]
    taken = sum(len(b.text) for b in free) - sum(len(b.text) for b in rest)
    return " ".join(b.text for b in (rest if taken <= MOST_TEMPLATE * sum(len(b.text) for b in free) else free))


def in_container(free: list[Block], container: int | None) -> list[Block]:
    inside = [b for b in free if any(path == container for path, _ in b.within)]
    if inside:
        return inside
    sizes: Counter = Counter()
    depth: dict[int, int] = {}
    for b in free:
        for d, (_, number) in enumerate(b.within):
            sizes[number] += b.free_chars
            depth[number] = d
    least = MAIN_SHARE * sum(b.free_chars for b in free)
    held = [n for n in sizes if sizes[n] >= least and sizes[n]]
    if not held:
        return free
    # The least text; paragraphs alone are no container.
    best = min(held, key=lambda n: (sizes[n], -depth[n]))
    return [b for b in free if any(number == best for _, number in b.within)]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text), one for each page: the article without menus, adverts, forms, comments and the like.

    Template classes are deduced over the pages of each host; a host with fewer than three pages, or a page without a
    host, has none and is read by its own elements. Null and empty pages have an empty text. Repeated rows count again and
    are answered each; an empty table gives none; further columns are not looked at.
    """
    host = F.lower(F.regexp_extract(F.coalesce(pages[url_col], F.lit("")), HOST, 1))
    own = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), host.alias("host"), pages[html_col].alias("html"))
    known = staged(host_templates(own.select("host", "url", "html")), "templates")
    tokens = known.agg(F.sum(F.size("template"))).first()[0] or 0
    rows = lookup_join(own, known, ["host"], "left", tokens).select("page_id", "url", "html", "template", "container")
    id_type = own.schema["page_id"].dataType.simpleString()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "html"):
                found = [
                    main_text(read_page(source or ""), set(template or ()), container)
                    for source, template, container in zip(*(part.column(k).to_pylist() for k in (2, 3, 4)), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string())], ["page_id", "url", "text"])

    return rows.mapInArrow(extracted, f"page_id {id_type}, url string, text string")
