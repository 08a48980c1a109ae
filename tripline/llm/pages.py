"""Main text of web pages by differencing each page with the one of the nearest URL.

Pages are ordered by host and URL path. Each is paired with its neighbour in that order on the
same host, of two the one whose path agrees further. The text lines of the two are aligned by
longest common subsequence, and shared lines are deleted as the site's template.

Markup is heeded where it says what a line is. Lines in menus, sidebars, forms and the like are
template whether a neighbour shares them or not; lines of an ``article`` or ``main`` element are
content even where a neighbour shares them, as copies of an article and often repeated
sentences do. Differencing decides for all other lines, that is on pages without such an element.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a line is by its markup.
TEMPLATE, ARTICLE, OPEN = 0, 1, 2

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*'|["'])*+)>|<[!?/][^>]*>""", re.DOTALL
)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.IGNORECASE) for t in ("script", "style", "textarea", "title", "noscript", "xmp")}
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = frozenset(
    "aside button datalist dialog embed fieldset footer form head iframe menu nav object option select svg template".split()
)
_NAMED = re.compile(
    r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE
)
_MARKS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|breadcrumbs?|comments?|complementary|consent|contentinfo|cookies?|copyright|disclaimer"
    r"|footer|gdpr|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|notices|notification|pagination|popup"
    r"|promo\w*|related|replies|reply|search|share|sharing|sidebar|signup|skip|social|sponsor\w*|subscribe|toolbar"
    r"|widget)(?:$|[\s_-])",
    re.IGNORECASE,
)


def _role(tag: str, attributes: str, inside: int) -> int:
    """What an element's lines are; ``inside`` is what its parent's are."""
    if inside == TEMPLATE or tag in _DROPPED or (tag == "header" and inside != ARTICLE):
        return TEMPLATE
    if tag in ("article", "main"):
        marked = ARTICLE
    else:
        marked = inside
    if tag != "body" and attributes:
        for found in _NAMED.findall(attributes):
            if _MARKS.search(" ".join(found)):
                return TEMPLATE
    return marked


def lines_of(page: str) -> list[tuple[str, int]]:
    """The text lines of a page with what they are by markup, in page order.

    A line is the text of a block: from one block tag to the next. Inline tags do not end it.
    Character references are decoded, white space becomes one space, empty lines go.
    """
    lines: list[tuple[str, int]] = []
    open_tags: list[tuple[str, int]] = []
    text: list[str] = []
    role, at = OPEN, 0

    def end_line() -> None:
        if text and (line := " ".join(entities.unescape("".join(text)).split())):
            lines.append((line, role))
        text.clear()

    while found := _TAG.search(page, at):
        text.append(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag not in _INLINE:
            end_line()
        if found[1]:
            depth = next((i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == tag), None)
            if depth is not None:
                inner = open_tags[depth:]
                if any(r != open_tags[depth][1] for _, r in inner) or role != open_tags[depth][1]:
                    end_line()
                role = open_tags[depth][1]
                del open_tags[depth:]
        elif tag in _RAW_END:
            close = _RAW_END[tag].search(page, at)
            at = close.end() if close else len(page)
        elif tag not in _VOID and not found[3].endswith("/"):
            if tag == "p" and open_tags and open_tags[-1][0] == "p":  # one paragraph ends another
                role = open_tags.pop()[1]
            own = _role(tag, found[3], role)
            if own != role:
                end_line()
            open_tags.append((tag, role))
            role = own
    rest = page[at:]
    cut = rest.find("<")  # a tag that the page's end cuts off
    text.append(rest if cut < 0 or not re.match(r"<[a-zA-Z/!?]", rest[cut:]) else rest[:cut])
    end_line()
    return lines


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each prefix of ``b``.

    One addition of whole bit rows for each element of ``a``.
    """
    where: dict = {}
    for i, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    bits = np.frombuffer(format(row, f"0{len(b)}b").encode(), np.uint8)[::-1] == ord("0") if b else np.empty(0, bool)
    return np.concatenate(([0], np.cumsum(bits)))


def common(a: list, b: list) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    ours, theirs = set(a[head : len(a) - tail]), set(b[head : len(b) - tail])
    mine = [i for i in range(head, len(a) - tail) if a[i] in theirs]
    other = [x for x in b[head : len(b) - tail] if x in ours]
    return [*range(head), *_halved(a, mine, other), *range(len(a) - tail, len(a))]


def _halved(a: list, mine: list[int], other: list) -> list[int]:
    """The middle part, by halving: memory stays that of one row."""
    if not mine or not other:
        return []
    if len(mine) == 1:
        return mine if a[mine[0]] in other else []
    half = len(mine) // 2
    left, right = mine[:half], mine[half:]
    ahead = _lengths([a[i] for i in left], other)
    back = _lengths([a[i] for i in reversed(right)], other[::-1])[::-1]
    cut = int((ahead + back).argmax())
    return _halved(a, left, other[:cut]) + _halved(a, right, other[cut:])


def main_text(lines: list[tuple[str, int]], nearest: list[str] | None) -> tuple[str, int]:
    """The page's text, and how many of its lines the nearest page shares."""
    texts = [t for t, _ in lines]
    if nearest is None or nearest == texts:  # a copy says nothing about the template
        shared: set[int] = set()
    else:
        shared = set(common(texts, nearest))
    kinds = {k for _, k in lines}
    if ARTICLE in kinds:
        kept = [t for t, k in lines if k == ARTICLE]
    else:
        kept = [t for i, (t, k) in enumerate(lines) if k == OPEN and i not in shared]
    return " ".join(kept), len(shared)


def _agreement(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _order(host: str, path: str, key: object) -> tuple:
    return host, path, key is not None, key if key is not None else 0


def _lined(bounds: list[tuple[tuple, tuple]]):
    """Pages to their lines, each to its range of the URL order.

    The first and last pages of a range also go, as visitors, to the range next to it.
    """
    firsts = [a for a, _ in bounds]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, parts, visitor, texts, kinds = [], [], [], [], []
            values = [batch.column(i).to_pylist() for i in (0, 2, 3)]
            for i, (key, host, path) in enumerate(zip(*values, strict=True)):
                lines = lines_of(batch.column(4)[i].as_py() or "")
                place = _order(host, path, key)
                part = max(bisect_right(firsts, place) - 1, 0)
                goes = [(part, False)]
                if place == bounds[part][0] and part > 0:
                    goes.append((part - 1, True))
                if place == bounds[part][1] and part + 1 < len(bounds):
                    goes.append((part + 1, True))
                for to, visits in goes:
                    at.append(i)
                    parts.append(to)
                    visitor.append(visits)
                    texts.append([t for t, _ in lines])
                    kinds.append(bytes(k for _, k in lines))
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(parts, pa.int32()),
                    *(batch.column(i).take(rows) for i in range(4)),
                    pa.array(visitor, pa.bool_()),
                    pa.array(texts, pa.list_(pa.string())),
                    pa.array(kinds, pa.binary()),
                ],
                names=["part", "key", "url", "host", "path", "visitor", "lines", "kinds"],
            )

    return scan


def _differenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in URL order to main texts; three pages are held at a time."""
    held: list[tuple] = []

    def answer(before: tuple | None, page: tuple, after: tuple | None) -> tuple:
        near = [x for x in (before, after) if x is not None and x[0] == page[0] and x[3] == page[3]]
        nearest = max(near, key=lambda x: _agreement(x[4], page[4]), default=None)
        lines = list(zip(page[6], page[7], strict=True))
        text, shared = main_text(lines, nearest[6] if nearest else None)
        return page[1], page[2], text, len(text), nearest[1] if nearest else None, len(lines), shared

    def out(answers: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
        key, url = like.schema.field("key").type, like.schema.field("url").type
        kinds = (key, url, pa.string(), pa.int64(), key, pa.int64(), pa.int64())
        columns = list(zip(*answers, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["key", "url", "text", "n_chars", "nearest", "n_lines", "n_shared"],
        )

    batch = None
    for batch in batches:
        answers = []
        for row in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
            held.append(row)
            if len(held) == 2 and not held[0][5]:
                answers.append(answer(None, held[0], held[1]))
            elif len(held) == 3:
                if not held[1][5]:
                    answers.append(answer(*held))
                held.pop(0)
        yield out(answers, batch)
    if held and not held[-1][5]:
        before = held[-2] if len(held) > 1 else None
        yield out([answer(before, held[-1], None)], batch)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(key, url, text, n_chars, nearest, n_lines, n_shared)`` for every row of ``pages``.

    ``text`` is the main text, its blocks joined by one space; ``nearest`` the page it was
    differenced with and ``n_shared`` how many of its ``n_lines`` lines that page shares.

    The URL order is cut into ranges in a first pass over URLs alone, which brings two keys per
    range to the driver, as many as there are shuffle partitions. Texts are shuffled once, and a
    host of any size is spread over ranges. Neighbours across a range's ends are sent to both,
    so results do not depend on where ranges end.

    Null html is an empty page. Null or unparsable URLs form a host without a name. A page alone
    on its host, or next to a copy of itself only, is judged by markup. Rows that repeat key and
    URL are copies of each other. An empty table gives no rows; other columns are not read.
    """
    spark = pages.sparkSession
    given = F.coalesce(F.col(url), F.lit(""))
    host = F.lower(F.regexp_extract(given, "^[^:/?#]+://(?:[^@/?#]*@)?([^:/?#]*)", 1))
    path = F.regexp_extract(given, "^(?:[^:/?#]+://[^/?#]*)?([^?#]*)", 1)
    named = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), host.alias("host"), path.alias("path"), F.col(html).alias("html")
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "key"]
    place = F.struct(*order)
    ranges = named.select(*order).repartitionByRange(n, *order)
    ends = ranges.groupBy(F.spark_partition_id().alias("part")).agg(F.min(place).alias("a"), F.max(place).alias("b"))
    bounds = sorted((_order(*r.a), _order(*r.b)) for r in ends.collect())
    kind, url_kind = (pages.schema[c].dataType.simpleString() for c in (key, url))
    if not bounds:
        bounds = [(("", "", False, 0), ("", "", False, 0))]
    lined = named.mapInArrow(
        _lined(bounds),
        f"part int, key {kind}, url {url_kind}, host string, path string, visitor boolean, lines array<string>, kinds binary",
    )
    placed = lined.repartitionById(n, F.col("part")).sortWithinPartitions("part", *order)
    found = placed.mapInArrow(
        _differenced,
        f"key {kind}, url {url_kind}, text string, n_chars long, nearest {kind}, n_lines long, n_shared long",
    )
    return found.withColumnsRenamed({"key": key, "url": url})
