"""HTML extraction by inferred wrappers (operator 6).

A page is read as a stream of block tags and texts. Streams of one host are aligned one after another into a
wrapper, a regular expression without alternatives: where they differ, what only one has becomes optional,
neighbours that repeat become a repeated group, and texts that differ between pages become slots. Wrappers of parts of a host
are aligned the same way, so a host with a third of all pages is worked off by many tasks, batch by batch.

The wrapper then tells which of its elements hold the article: an article element, else the main part by its role
or class, else the innermost element with most of the slots' text. Menus, headers, footers, sidebars, notices,
adverts, forms and comments are known by tag, role or name. A name (a class or an id) counts by its head word, so
"related-posts" is aside, "related-work" and "no-sidebar" are not; names never make a body, main or article element
aside, nor an element with most of the slots' text where no article or main part is found outside of it. Each page is read again with its
host's wrapper; a page that has none of its elements is read by its own.

Block texts have their character references decoded and white space reduced to single spaces, and are joined by
single spaces. A null page gives an empty text; a null or odd URL belongs to the host ''. Broken markup ends
elements as browsers do for paragraphs, items and cells. Scripts, styles, buttons, pictures and the like have no text:
they end at their own closing tag; without one, scripts and styles end with the page, others at the next block tag.
Repeated rows and ids are read one by one.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausemill.llm.common import stored
from clausemill.llm.url_rules import host_of

# How tags are treated, and names of what is no article.
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup html li main menu nav ol p pre section summary table tbody td tfoot th thead"
    " tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = {"br", "hr"}
RAW = set("button noscript object select svg template".split())  # dropped, with tags inside
RAW_TEXT = {  # dropped, with characters up to the closing tag inside
    tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE) for tag in "iframe noembed script style textarea title".split()
}
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
SCOPES = set("table td th ul ol dl body article section div".split())
ASIDE_TAGS = set("nav footer aside form menu dialog".split())
ASIDE_ROLES = set("navigation banner contentinfo complementary search form alert dialog".split())
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice popup"
    " modal overlay newsletter subscribe subscription share sharing social comment comments disqus replies sidebar nav navbar"
    " navigation menu breadcrumb breadcrumbs footer masthead related recommended widget login signup pagination pager toolbar".split()
)
PART_WORDS = set(  # behind the head word of a name
    "area bar block box button buttons container content group holder icon icons inner item items left right top bottom link links list"
    " main module outer panel post posts primary row secondary section slot unit widgets wrap wrapper".split()
)
STATE_WORDS = set("disable disabled enable enabled has have hide is no not show with without".split())
NEVER_ASIDE = set("html body main article".split())  # by their names
MAIN_WORDS = set("article articlebody content entry main maincontent post story".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

MAX_NESTING = 120  # elements nested deeper count as part of the one around them
MAX_ITEMS = 48  # longer sequences of children become one repeated group of optional members
MOST = 0.6
SCARCE = 0.1  # slots with less of the text do not tell where the article is: long constant texts are weighed too
LONG_TEXT = 80
FAN = 64  # partial wrappers of a host that are aligned at once

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>?", re.DOTALL
)
ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none", re.IGNORECASE)
NAME = re.compile(r"[a-z]+")


def _names_aside(name: str) -> bool:
    """Whether the head word of a class or id says that it is no article."""
    words = [w for w in NAME.findall(name.partition("--")[0]) if len(w) > 1]
    if not STATE_WORDS.isdisjoint(words):
        return False
    while len(words) > 1 and words[-1] in PART_WORDS:
        words.pop()
    return bool(words) and words[-1] in ASIDE_WORDS


class Element:
    """A block element with its children in order: elements and texts."""

    __slots__ = ("tag", "label", "aside", "main", "children")

    def __init__(self, tag: str, attributes: str = ""):
        names, roles, named = [], set(), False
        for m in ATTRIBUTE.finditer(attributes) if attributes else ():
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "role":
                roles |= set(value.split())
            else:
                names += NAME.findall(value)
                named = named or any(map(_names_aside, value.split()))
        self.tag = tag
        self.label = ".".join([tag, *sorted(set(names) | roles)])
        words = set(names)
        self.main = tag == "main" or "main" in roles or bool(words & MAIN_WORDS)
        known = tag in ASIDE_TAGS or bool(roles & ASIDE_ROLES) or bool(HIDDEN.search(attributes))
        self.aside = 1 if known else 2 if named and tag not in NEVER_ASIDE else 0  # 2: by its names only
        self.children: list[Element | str] = []


def _tags(page: str) -> list[tuple[int, int, str, bool, str]]:
    """Start, end, name, closing and attributes of every tag; comments and closed raw texts have no name."""
    out, at, unclosed = [], 0, set()
    while m := TOKEN.search(page, at):
        tag, at = (m[2] or "").lower(), m.end()
        if tag in RAW_TEXT and not m[1] and (tag in ("script", "style") or not m[3].endswith("/")):
            end = None if tag in unclosed else RAW_TEXT[tag].search(page, at)
            if end or tag in ("script", "style"):
                tag, at = "", end.end() if end else len(page)
            else:
                unclosed.add(tag)
        out.append((m.start(), at, tag, bool(m[1]), m[3] or ""))
    return out


def _raw_ends(tags: list[tuple[int, int, str, bool, str]]) -> dict[int, int | None]:
    """For every opening tag of a raw element, the place of its closing tag in the list, or None."""
    out: dict[int, int | None] = {}
    open_: dict[str, list[int]] = {tag: [] for tag in RAW}
    for k, (_, _, tag, closing, attributes) in enumerate(tags):
        if closing:
            if open_.get(tag):
                out[open_[tag].pop()] = k
        elif (tag in RAW or tag in RAW_TEXT) and not attributes.endswith("/"):
            out[k] = None
            if tag in RAW:
                open_[tag].append(k)
    return out


def tree(page: str) -> Element:
    """The block elements of a page; text is kept raw, inline tags are gone."""
    root = Element("html")
    stack, text, at, k, dropped = [root], [], 0, 0, False
    found = _tags(page)
    raw_ends = _raw_ends(found)

    def flush() -> None:
        if text:
            joined = "".join(text)
            text.clear()
            if joined and not joined.isspace():
                stack[-1].children.append(joined)

    def pop_to(depth: int) -> None:
        flush()
        for tag in tags[depth:]:
            opened[tag] -= 1
        del stack[depth:], tags[depth:]

    tags, opened = [root.tag], Counter()  # of the stack; the root is not counted

    while k < len(found):
        start, end, tag, closing, attributes = found[k]
        if not dropped and start > at:
            text.append(page[at:start])
        at = end
        if k in raw_ends:
            if raw_ends[k] is None:
                dropped = True
            else:
                k = raw_ends[k]
                at = found[k][1]
            k += 1
            continue
        k += 1
        if tag in BREAKS and not dropped:
            text.append(" ")
            continue
        if tag not in BLOCKS:
            continue
        dropped = False
        if closing:
            if opened[tag]:
                pop_to(next(depth for depth in range(len(tags) - 1, 0, -1) if tags[depth] == tag))
            else:
                flush()
            continue
        flush()
        if tag in ("html", "body") and (tag == "html" or opened["body"]):
            continue
        if tags[-1] == "p" or (tags[-1] in HEADINGS and tag in HEADINGS):
            pop_to(len(stack) - 1)
        elif tag in ENDS:
            for depth in range(len(stack) - 1, 0, -1):
                if tags[depth] in ENDS[tag]:
                    pop_to(depth)
                    break
                if tags[depth] in SCOPES:
                    break
        element = Element(tag, attributes)
        if len(stack) <= MAX_NESTING:
            stack[-1].children.append(element)
        else:  # its content is that of the element around it
            element.children = stack[-1].children
        if tag not in VOID:
            stack.append(element)
            tags.append(tag)
            opened[tag] += 1
    if not dropped:
        text.append(page[at:])
    flush()
    return root


def plain(text: str) -> str:
    """Decoded and with single spaces."""
    return " ".join(entities.unescape(text).split())


# A wrapper's item: label, optional, repeated, characters on all pages, text (None where it differs) and its items.
# Texts also have a digest of what stands there on each page (None for a slot, where pages differ) and the characters
# of the longest single text. Groups of several items have the label "(...)".


def _digest(text: str) -> str:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()[:16]


def _text_item(text: str) -> dict:
    text = plain(text)
    return {"l": "#", "o": 0, "r": 0, "c": len(text), "t": text[:80], "d": _digest(text), "n": len(text), "k": []}


def wrapper_of(element: Element) -> dict:
    """The wrapper of one page's element, with repeated neighbours folded."""
    kids = [_text_item(c) if isinstance(c, str) else wrapper_of(c) for c in element.children]
    kids = _folded(kids)
    return {
        "l": element.label, "o": 0, "r": 0, "c": sum(k["c"] for k in kids), "t": None, "k": kids,
        "a": element.aside, "m": int(element.main),
    }


def _merged(a: dict, b: dict, repeated: bool, beside: bool = False) -> dict:
    """Two items with one label as one; ``repeated``: they are neighbours; ``beside``: they stand in one page."""
    out = {**a, "c": a["c"] + b["c"], "o": a["o"] | b["o"], "r": a["r"] | b["r"] | int(repeated)}
    if a["l"] == "#":
        same = a["d"] == b["d"]
        out["t"] = a["t"] if same else None
        if not same:
            out["d"] = _digest(a["d"] + b["d"]) if beside and a["d"] and b["d"] else None
        out["n"] = max(a["n"], b["n"])
    elif a["k"] or b["k"]:
        out["k"] = aligned(a["k"], b["k"], beside)
    return out


def _group(items: list[dict], repeated: int) -> dict:
    label = "(" + " ".join(i["l"] for i in items) + ")"
    return {"l": label, "o": 0, "r": repeated, "c": sum(i["c"] for i in items), "t": None, "k": items}


def _folded(items: list[dict]) -> list[dict]:
    """Neighbouring repeats, of one item or of up to three, as repeated items or groups."""
    for width in (1, 2, 3):
        out, at = [], 0
        while at < len(items):
            unit, next_ = items[at : at + width], at + width
            labels = [i["l"] for i in unit]
            again = 0
            while len(unit) == width and [i["l"] for i in items[next_ : next_ + width]] == labels:
                unit = [_merged(x, y, width == 1, True) for x, y in zip(unit, items[next_ : next_ + width], strict=True)]
                next_ += width
                again += 1
            if width == 1 or not again:
                out.append(unit[0])
                at = next_ if again else at + 1
            else:
                out.append(_group(unit, 1))
                at = next_
        items = out
    if len(items) > MAX_ITEMS:
        members: dict[str, dict] = {}
        for i in items:
            for j in i["k"] if i["l"].startswith("(") else [i]:
                members[j["l"]] = _merged(members[j["l"]], j, False, True) if j["l"] in members else j
        items = [_group([{**m, "o": 1} for m in members.values()], 1)]
        items[0]["l"] = "(*)"
    return items


def aligned(a: list[dict], b: list[dict], beside: bool = False) -> list[dict]:
    """Two sequences, of one page if ``beside``, as one: common items in order are merged, the others become optional."""
    if [i["l"] for i in a] == [i["l"] for i in b]:
        return [_merged(x, y, False, beside) for x, y in zip(a, b, strict=True)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i]["l"] == b[j]["l"] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i]["l"] == b[j]["l"]:
            out.append(_merged(a[i], b[j], False, beside))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append({**a[i], "o": 1})
            i += 1
        else:
            out.append({**b[j], "o": 1})
            j += 1
    return _folded(out + [{**x, "o": 1} for x in a[i:] + b[j:]])


def expression(item: dict) -> str:
    """The wrapper as a regular expression over tags, constant texts and slots (``#``)."""
    sign = "*" if item["o"] and item["r"] else "+" if item["r"] else "?" if item["o"] else ""
    inner = " ".join(expression(k) for k in item["k"])
    if item["l"] == "#":
        return ("#" if item["t"] is None else json.dumps(item["t"], ensure_ascii=False)) + sign
    return (f"({inner})" if item["l"].startswith("(") else f"<{item['l']}>{inner}</>") + sign


def _weigher(wrapper: dict, named: bool = False) -> Callable[[dict], int]:
    """How items are weighed: by characters of slots that are no aside; ``named``: or are so by their names only.

    Where slots are scarce, long constant texts count too, and without these all texts.
    """

    def by(counts: Callable[[dict], bool]) -> Callable[[dict], int]:
        def weigh(item: dict) -> int:
            if item["l"] == "#":
                return item["c"] if counts(item) else 0
            return 0 if item.get("a") == 1 or (item.get("a") and not named) else sum(map(weigh, item["k"]))

        return weigh

    slots, every = by(lambda i: i["d"] is None), by(lambda i: True)
    if slots(wrapper) > SCARCE * every(wrapper):
        return slots
    longer = by(lambda i: i["d"] is None or i["n"] > LONG_TEXT)
    return longer if longer(wrapper) else every


def _marked(wrapper: dict) -> tuple[list[tuple[dict, list[str]]], list[tuple[dict, list[str]]]]:
    """The article elements and the main parts that are no aside, with their label paths."""
    articles, mains = [], []

    def walk(item: dict, path: list[str]) -> None:
        if item["l"] == "#" or item.get("a") or (item["l"].split(".")[0] == "header" and len(path) > 0):
            return
        path = path if item["l"].startswith("(") else [*path, item["l"]]
        if item["l"].split(".")[0] == "article":
            articles.append((item, path))
            return
        if item.get("m"):
            mains.append((item, path))
        for k in item["k"]:
            walk(k, path)

    walk(wrapper, [])
    return [(i, p) for i, p in articles if i["c"]], [(i, p) for i, p in mains if i["c"]]


def _opened(wrapper: dict) -> list[list[str]]:
    """Label paths of elements that are aside by their names but hold most of the text; in the wrapper they are so no more.

    Where an article or main part is found without them, only elements inside of it.
    """
    out: list[list[str]] = []
    weigh = _weigher(wrapper, named=True)
    least = MOST * weigh(wrapper)

    def walk(item: dict, path: list[str]) -> None:
        for k in item["k"]:
            if k["l"] == "#" or k.get("a") == 1 or weigh(k) <= least:
                continue
            inner = path if k["l"].startswith("(") else [*path, k["l"]]
            if k.get("a"):
                k["a"] = 0
                out.append(inner)
            walk(k, inner)

    articles, mains = _marked(wrapper)
    for item, path in articles or mains or [(wrapper, [wrapper["l"]])]:
        walk(item, path)
    return out


def reading(wrapper: dict) -> tuple[list[list[str]], list[list[str]]]:
    """The label paths of the elements that hold the article, and of those that are no aside whatever their names."""
    opened = _opened(wrapper)
    return article_paths(wrapper), opened


def article_paths(wrapper: dict) -> list[list[str]]:
    """The label paths of the elements that hold the article."""
    articles, mains = _marked(wrapper)
    if articles:
        return [path for _, path in articles]
    weigh = _weigher(wrapper)
    if mains:
        return [max(mains, key=lambda x: (weigh(x[0]), x[0]["c"], len(x[1])))[1]]
    item, path = wrapper, [wrapper["l"]]
    while True:
        inner = [k for k in item["k"] if k["l"] != "#" and not k.get("a")]
        best = max(inner, key=weigh, default=None)
        block = best is not None and (best["l"].startswith("(") or best["l"].split(".")[0] in SCOPES | {"main", "center"})
        if not block or best["r"] or weigh(best) < MOST * weigh(wrapper):
            return [path]
        item = best
        path = path if item["l"].startswith("(") else [*path, item["l"]]


def article(root: Element, paths: list[list[str]], opened: list[list[str]] = ()) -> str:
    """The text of a page's elements at some label paths, without what is aside and not opened."""
    wanted, prefixes = {tuple(p) for p in paths}, {tuple(p[:n]) for p in paths for n in range(1, len(p) + 1)}
    let_in = {tuple(p) for p in opened}
    blocks: list[str] = []

    def collect(element: Element, path: tuple[str, ...], outside: bool) -> None:
        for c in element.children:
            if isinstance(c, str):
                if text := plain(c):
                    blocks.append(text)
                continue
            inner = (*path, c.label) if let_in else path
            if not (c.aside and (c.aside == 1 or inner not in let_in)) and not (outside and c.tag == "header"):
                collect(c, inner, outside)

    def walk(element: Element, path: tuple[str, ...]) -> None:
        if path in wanted:
            collect(element, path, len(path) == 1 or path[-1].split(".")[0] == "body")
            return
        for c in element.children:
            if not isinstance(c, str) and (longer := (*path, c.label)) in prefixes:
                walk(c, longer)

    walk(root, (root.label,))
    return " ".join(blocks)


def _folded_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part = TaskContext.get().partitionId()
    for number, batch in enumerate(batches):
        rows = []
        for host, pages in batch.groupby("host", sort=True):
            wrapper = None
            for page in pages["html"]:
                one = wrapper_of(tree(page or ""))
                wrapper = one if wrapper is None else _merged(wrapper, one, False)
            rows.append((host, (part * 31 + number) % FAN, f"{part:08d}.{number:08d}", json.dumps(wrapper)))
        yield pd.DataFrame(rows, columns=["host", "part", "at", "wrapper"])


def _aligned_rows(rows: pd.DataFrame) -> dict:
    wrapper = None
    for one in map(json.loads, rows.sort_values("at")["wrapper"]):
        wrapper = one if wrapper is None else _merged(wrapper, one, False)
    return wrapper


def _align_part(rows: pd.DataFrame) -> pd.DataFrame:
    out = rows.head(1).copy()
    out["at"], out["wrapper"] = rows["at"].min(), json.dumps(_aligned_rows(rows))
    return out


def _align_host(rows: pd.DataFrame) -> pd.DataFrame:
    wrapper = _aligned_rows(rows)
    return pd.DataFrame(
        {"host": rows["host"].head(1), "expression": [expression(wrapper)], "paths": [json.dumps(reading(wrapper))]}
    )


def infer(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Each host's wrapper as ``expression`` and the ``paths`` of its article and of what is opened, as a written table."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    kind = "host string, part int, at string, wrapper string"
    parts = rows.mapInPandas(_folded_batches, kind).groupBy("host", "part").applyInPandas(_align_part, kind)
    hosts = parts.groupBy("host").applyInPandas(_align_host, "host string, expression string, paths string")
    return stored(pages.sparkSession, hosts, "wrappers")


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, list[list[list[str]]]] = {}
    for batch in batches:
        texts = []
        for page, paths in zip(batch["html"], batch["paths"], strict=True):
            root = tree(page or "")
            found = ""
            if paths is not None:
                if paths not in known:
                    known[paths] = json.loads(paths)
                found = article(root, *known[paths])
            texts.append(found or article(root, *reading(wrapper_of(root))))
        yield pd.DataFrame({"row": batch["row"], "text": texts, "n_chars": [len(t) for t in texts]})


def extract(pages: DataFrame, wrappers: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Each page's ``key`` and ``url`` with the article's ``text`` and its ``n_chars``."""
    rows = pages.select(
        host_of(F.col(url)).alias("host"), F.to_json(F.struct(F.col(key).alias("k"), F.col(url).alias("u"))).alias("row"), F.col(html).alias("html")
    )
    read = rows.join(wrappers.select("host", "paths"), "host", "left").select("row", "html", "paths")
    kinds = dict(pages.dtypes)
    back = F.from_json("row", f"k {kinds[key]}, u {kinds[url]}")
    return (
        read.mapInPandas(_read, "row string, text string, n_chars long")
        .select(back.alias("row"), "text", "n_chars")
        .select(F.col("row.k").alias(key), F.col("row.u").alias(url), "text", "n_chars")
    )
