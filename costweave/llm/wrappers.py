"""Main text of web pages through wrappers: union-free regular expressions over a site's tokens.

A page is a stream of tags (with a mark where an attribute says that the element is a menu, an advert and the like) and
texts. Blocks that repeat side by side are folded into repeated groups. The different streams of all pages of a host
are aligned one after the other unless what came before describes them, in parts of a bounded size whose expressions are aligned in turn,
and so are the records of a repeated group: what differs becomes an optional group, a block that a repeated group already describes is taken
into it, and a text that differs becomes a slot. The result is the host's wrapper. Its texts are labelled once: article
or not, by the regions that are open around them, and, on a site that marks no article, by whether they are the same on
all aligned pages. A page is then read by matching its whole stream against the wrapper, which tells for every text
which of the wrapper's it is. A page that does not match is aligned by itself and labelled by the same rules.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterable, Iterator, Set
from difflib import SequenceMatcher

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costweave.functions.sizing import BROADCAST_BYTES, is_bounded
from costweave.session import cut_lineage

#: Fixed lists of HTML's elements: raw text, blocks, and what is never an article.
RAW = "script style textarea title noscript iframe xmp noembed noframes".split()
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td "
    "tfoot th thead title tr ul".split())
ASIDE = set(
    "aside button canvas datalist dialog footer form head iframe input label menu nav noembed noframes noscript object optgroup option "
    "script select style svg template textarea title xmp".split())
#: Elements whose end tag may be left out.
LOOSE = set("dd dt li option p td th tr".split())
VOID = set("area base br col embed hr img input link meta source track wbr".split())
#: Words of class, id and role attributes.
ASIDE_WORDS = set(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer login "
    "menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion related respond share sharing "
    "sidebar signup social sponsor sponsored subscribe toolbar widget complementary contentinfo search".split())
#: Beside these in one hyphenated name, an aside word tells of the page's layout or state, not of the element.
LAYOUT_WORDS = set("has have with without no not is are content open opened closed enabled disabled hide show hidden visible".split())
HEAD_WORDS = {"header", "masthead", "banner"}
MAIN_WORDS = {"main", "articlebody"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
RAW_END = {name: re.compile(rf"</{name}\b", re.I) for name in RAW}
TEXT = "#"
MARKS = "-~+^"
LONGEST_BLOCK = 48
#: The parts of more hosts than this are not broadcast.
LARGE_HOSTS = 1_000_000

Node = str | list  # a tag, a text ["#", constant or None, pages], or a group ["?" or "+", nodes]


def _mark(name: str, attributes: str) -> str:
    """``-`` for an element beside the article, ``~`` for one that is so unless the article is inside, ``^`` for a header, ``+`` for the article, else nothing."""
    if name in ASIDE and name != "form":
        return "-"
    weak = name == "form"
    mark = "^" if name == "header" else "+" if name in ("article", "main") else ""
    if attributes and not attributes.isspace():
        for key, value in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'").lower()
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
                return "-"
            if key in ("class", "id", "role", "itemprop") and name not in ("body", "html"):
                words = set(re.split(r"[^a-z0-9]+", value))
                if words & ASIDE_WORDS and not (mark == "+" and key != "role") and _aside(value):
                    weak = True
                if words & HEAD_WORDS and not mark:
                    mark = "^"
                if words & MAIN_WORDS and key in ("role", "itemprop"):
                    mark = "+"
    return "~" if weak else mark


def _aside(value: str) -> bool:
    """Whether one of the names in an attribute is that of an element beside the article."""
    for name in value.split():
        words = set(re.split(r"[^a-z0-9]+", name))
        if words & ASIDE_WORDS and not words & LAYOUT_WORDS:
            return True
    return False


def tokens(page: str) -> tuple[list[str], dict[int, str]]:
    """The stream of a page, and the decoded texts by their place in it; blank texts are left out."""
    stream, texts, at, n = [], {}, 0, len(page)

    def text(raw: str) -> None:
        if raw and not raw.isspace():
            texts[len(stream)] = html.unescape(raw)
            stream.append(TEXT)
        elif raw:
            blanks.append(len(stream))

    blanks: list[int] = []
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            stream.append(f"/{name}")
            continue
        stream.append(f"<{name}{_mark(name, m[3] or m[6] or '')}")
        if name in RAW_END:
            end = RAW_END[name].search(page, at)
            at = end.start() if end else n
    for i in blanks:
        if i - 1 in texts:
            texts[i - 1] += " "
        elif i in texts:
            texts[i] = " " + texts[i]
        elif i < len(stream):
            texts.setdefault(-i - 1, " ")
    return stream, texts


def fold(nodes: list[Node], keys: list[str]) -> list[Node]:
    """Elements of one form that stand side by side, as repeated groups; short ones first."""
    out: list[Node] = []
    names: list[str] = []

    def element(size: int) -> bool:
        """Whether the last ``size`` nodes are one element."""
        return names[-size][0] == "<" and names[-1] == f"/{names[-size][1:].rstrip(MARKS)}"

    for node, key in zip(nodes, keys, strict=True):
        out.append(node)
        names.append(key)
        for size in range(2, min(LONGEST_BLOCK, len(out)) + 1):
            if not element(size):
                continue
            before = out[-size - 1] if len(out) > size else None
            if isinstance(before, list) and before[0] == "+" and _keys(before[1]) == names[-size:]:
                group, gone = ["+", _joined(before[1], out[-size:])], size + 1
            elif len(out) >= 2 * size and names[-2 * size:-size] == names[-size:]:
                group, gone = ["+", _joined(out[-2 * size:-size], out[-size:])], 2 * size
            else:
                continue
            del out[-gone:], names[-gone:]
            out.append(group)
            names.append(_key(group))
            break
    return out


def _key(node: Node) -> str:
    if isinstance(node, str):
        return node
    if node[0] == TEXT:
        return TEXT
    # A repeated group is known by what it begins with, so that groups of one kind meet and are aligned in turn.
    return f"({_key(node[1][0])}){node[0]}"


def _keys(nodes: list[Node]) -> list[str]:
    return [_key(n) for n in nodes]


def _one(x: Node, y: Node, pages: bool) -> Node:
    """Two nodes of one key as one; texts that differ become slots. ``pages``: they are of different pages."""
    if isinstance(x, str):
        return x
    if x[0] == TEXT:
        return [TEXT, x[1] if x[1] == y[1] and pages else None, x[2] + y[2] if pages else x[2]]
    return [x[0], _joined(x[1], y[1], pages)]


def _joined(a: list[Node], b: list[Node], pages: bool = False) -> list[Node]:
    if _keys(a) == _keys(b):
        return [_one(x, y, pages) for x, y in zip(a, b, strict=True)]
    return align(a, b, pages)


def _records(nodes: list[Node], keys: list[str]) -> tuple[list[Node], list[str]]:
    """Runs of elements whose end tags are often left out, with inline tags and texts alone in them, as repeated groups."""
    out: list[Node] = []
    i = 0
    while i < len(nodes):
        start = keys[i]
        if start[1:] not in LOOSE or start[0] != "<":
            out.append(nodes[i])
            i += 1
            continue
        body: list[Node] | None = None
        while i < len(nodes) and keys[i] == start:
            j = i + 1
            while j < len(nodes) and (keys[j] in (TEXT, f"/{start[1:]}") or keys[j][-1] not in MARKS and keys[j][1:] not in BLOCKS):
                j += 1
            body = nodes[i:j] if body is None else _joined(body, nodes[i:j])
            i = j
        out.append(["+", body])
    return out, _keys(out)


def _of_page(stream: list[str], texts: dict[int, str]) -> list[Node]:
    return fold(*_records([[TEXT, texts[i].strip(), 1] if k == TEXT else k for i, k in enumerate(stream)], stream))


def align(a: list[Node], b: list[Node], pages: bool = True) -> list[Node]:
    """The expression that describes what either of two describes; what only one has becomes optional."""

    def flat(nodes: list[Node], side: int) -> list[tuple[Node, int]]:
        return [(n, side * (at + 1) * grouped) for at, node in enumerate(nodes)
                for grouped in [isinstance(node, list) and node[0] == "?"] for n in (node[1] if grouped else [node])]

    x, y = flat(a, 1), flat(b, -1)
    out: list[tuple[Node, int]] = []  # with 0 for what both have, else a number that an optional group shares
    for kind, i, j, m, n in SequenceMatcher(None, [_key(v) for v, _ in x], [_key(v) for v, _ in y], autojunk=False).get_opcodes():
        if kind == "equal":
            out += [(_one(p, q, pages), g or h) for (p, g), (q, h) in zip(x[i:j], y[m:n], strict=True)]
        elif met := _repeats([v for v, _ in x[i:j]], [v for v, _ in y[m:n]]):
            out.append((met, 0))
        else:
            out += [(v, g or len(a) + 1 + i) for v, g in x[i:j]] + [(v, h or -len(b) - 1 - m) for v, h in y[m:n]]
    grouped: list[Node] = []
    last = 0
    for node, group in out:
        if group and group == last:
            grouped[-1][1].append(node)
        else:
            grouped.append(["?", [node]] if group else node)
        last = group
    return grouped


def _repeats(old: list[Node], new: list[Node]) -> Node | None:
    """One repeated group for two differing parts, when one is a block that the other repeats."""
    for many, one in ((old, new), (new, old)):
        if one and len(many) == 1 and isinstance(many[0], list) and many[0][0] == "+" and _keys(many[0][1]) == _keys(one):
            return ["+", _joined(many[0][1], one)]
    return None


def infer(pages: list[str]) -> list[Node]:
    wrapper = _of_page(*tokens(pages[0]))
    for page in pages[1:]:
        wrapper = align(wrapper, _of_page(*tokens(page)))
    return wrapper


def infer_all(pages: Iterable[str]) -> list[Node]:
    """The expression of any number of pages: those that it describes already are not aligned again."""
    nodes: list[Node] | None = None
    wrapper: Wrapper | None = None
    for page in pages:
        stream, texts = tokens(page)
        if wrapper is None or wrapper.matched(stream) is None:
            own = _of_page(stream, texts)
            nodes = own if nodes is None else align(nodes, own)
            wrapper = Wrapper(nodes)
    return nodes or []


class Regions:
    """Which regions are open while tags go by."""

    def __init__(self) -> None:
        self.open: list[tuple[str, str]] = []

    def tag(self, tag: str) -> None:
        if tag[0] == "/":
            name = tag[1:]
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == name:
                    del self.open[i:]
                    break
            return
        name, mark = tag[1:].rstrip(MARKS), tag[-1] if tag[-1] in MARKS else ""
        if name not in VOID and (mark or name in HEADINGS or any(n == name for n, _ in self.open)):
            self.open.append((name, mark))

    def label(self) -> str:
        """``article``, ``inner`` for an article inside a marked container, ``aside``, or ``body`` for what is in none."""
        marks = [m for _, m in self.open]
        first = marks.index("+") if "+" in marks else len(marks)
        if "-" in marks or "~" in marks[first:] or first == len(marks) and "~" in marks:
            return "aside"
        if "^" in marks and not (first < len(marks) and any(n in HEADINGS for n, _ in self.open)):
            return "aside"
        return "body" if first == len(marks) else "inner" if "~" in marks[:first] else "article"


class Wrapper:
    """A wrapper as a pattern over streams; every text of it is a group of the pattern and has a label."""

    def __init__(self, nodes: list[Node]):
        self.codes: dict[str, str] = {TEXT: TEXT}
        self.labels: list[str] = []
        self.constant: list[bool] = []
        self.told: list[str | None] = []  # the text that all aligned pages have in a place, if it is one
        self.balanced = True
        self.pattern = regex.compile(self._expression(nodes, Regions()))

    def _code(self, tag: str) -> str:
        return self.codes.setdefault(tag, chr(0xE000 + len(self.codes)))

    def _expression(self, nodes: list[Node], regions: Regions) -> str:
        out = []
        for n in nodes:
            if isinstance(n, str):
                regions.tag(n)
                out.append(self._code(n))
            elif n[0] == TEXT:
                self.labels.append(regions.label())
                self.constant.append(n[1] is not None and n[2] > 2)
                self.told.append(n[1])
                out.append(f"({TEXT})")
            else:
                before = list(regions.open)
                out.append(f"(?:{self._expression(n[1], regions)}){n[0]}+")
                self.balanced &= regions.open == before
        return "".join(out)

    def matched(self, stream: list[str]) -> regex.Match | None:
        if any(k not in self.codes for k in stream):
            return None
        return self.pattern.fullmatch("".join(map(self.codes.__getitem__, stream)))

    def seen(self, stream: list[str], texts: dict[int, str]) -> Iterator[tuple[int, bool]]:
        """(number of the wrapper's text, whether this page has another one there) for the texts told to be constant."""
        if (m := self.matched(stream)) is not None:
            for i, told in enumerate(self.told):
                if told is not None and (at := m.starts(i + 1)):
                    yield i, any(texts[j].strip() != told for j in at)

    def chosen(self, stream: list[str]) -> set[int] | None:
        """The places of the article's texts in a page's stream, None if the page is not of this form."""
        m = self.matched(stream)
        if m is None:
            return None
        constant = {at for i, same in enumerate(self.constant) if same for at in m.starts(i + 1)}
        if not self.balanced:
            # A group that a page may lack opens or closes a region, so the labels behind it are the page's own.
            return by_itself(stream, constant)
        wanted = main_region(stream)
        found = {at for i, label in enumerate(self.labels) if label == wanted for at in m.starts(i + 1)}
        return found - constant if wanted == "body" else found


def _settled(nodes: list[Node], pages: dict[int, int], broken: Set[int], first: int = 0) -> int:
    """Write into an expression what all pages say of its constant texts, numbered as in :class:`Wrapper`; the number of its texts."""
    for n in nodes:
        if isinstance(n, str):
            continue
        if n[0] == TEXT:
            n[1:] = [None if first in broken else n[1], max(n[2], pages.get(first, 0))]
            first += 1
        else:
            first = _settled(n[1], pages, broken, first)
    return first


def main_region(stream: list[str]) -> str:
    """The label of a page's article: an article inside a marked container is a teaser if the page has another one."""
    if not any(k[0] == "<" and k[-1] == "+" for k in stream):
        return "body"
    regions, inner = Regions(), False
    for k in stream:
        if k == TEXT:
            continue
        regions.tag(k)
        if k[0] == "<" and k[-1] == "+":
            marks = [m for _, m in regions.open]
            if "-" in marks:
                continue
            if "~" not in marks[:marks.index("+")]:
                return "article"
            inner = True
    return "inner" if inner else "article"


def by_itself(stream: list[str], constant: Set[int] = frozenset()) -> set[int]:
    """The same choice from a page's own regions."""
    regions, found = Regions(), {"article": set(), "inner": set(), "body": set(), "aside": set()}
    for i, k in enumerate(stream):
        if k == TEXT:
            found[regions.label()].add(i)
        else:
            regions.tag(k)
    wanted = main_region(stream)
    return found["body"] - constant if wanted == "body" else found[wanted]


def main_text(page: str, wrapper: Wrapper | None) -> str:
    stream, texts = tokens(page)
    chosen = wrapper.chosen(stream) if wrapper else None
    if chosen is None:
        chosen = by_itself(stream)
    blocks: list[str] = []
    block: list[str] = []

    def end() -> None:
        if words := " ".join("".join(block).split()):
            blocks.append(words)
        block.clear()

    for i, k in enumerate(stream):
        if -i - 1 in texts:
            block.append(" ")
        if i in chosen:
            block.append(texts[i])
        elif k == TEXT:
            continue
        elif k == "<br":
            block.append(" ")
        elif k[1:].rstrip(MARKS) in BLOCKS:
            end()
    end()
    return "\n".join(blocks)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", streams_per_part: int = 256) -> DataFrame:
    """(key, url, text, n_chars) for every row.

    The form of a host's wrapper is inferred from all its pages: one page of each different stream, in parts of about
    ``streams_per_part``, so that a host of any size is spread over tasks. Which of its texts are the same on all pages is
    then settled by every page of the host that has this form, and the wrapper is applied to every page. A null url
    belongs to the host without a name; a null or empty body, or one without an article, gives an empty text. Repeated
    rows give equal texts; null keys are kept; other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.coalesce(F.col(body), F.lit("")).alias("body"), host.alias("host"))
    hashed = rows.where("body != ''").select("host", "body", F.xxhash64("body").alias("h"))

    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each stream a task sends the page of the smallest hash, and others that came before it.
        least: dict[tuple[str | None, int], int] = {}
        for batch in batches:
            if len(least) > 200_000:
                least.clear()
            forms, plain, own = [], [], []
            for i, (host_of, page, h) in enumerate(zip(*(batch.column(c) for c in ("host", "body", "h")), strict=True)):
                stream, _ = tokens(page.as_py())
                form = xxhash.xxh3_64_intdigest("\n".join(stream).encode("utf-8", "surrogatepass")) - (1 << 63)
                if least.get((at := (host_of.as_py(), form)), 1 << 63) > h.as_py():
                    least[at] = h.as_py()
                    own.append(i)
                    forms.append(form)
                    plain.append(main_region(stream) == "body")
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(own, pa.int64())) for c in ("host", "body", "h")), pa.array(forms, pa.int64()), pa.array(plain, pa.bool_())],
                names=["host", "body", "h", "form", "plain"])

    # The limit of one row per stream is applied in every task before anything is shuffled.
    first = Window.partitionBy("host", "form").orderBy("h")
    found = cut_lineage(hashed.mapInArrow(streams, "host string, body string, h long, form long, plain boolean").withColumn(
        "place", F.row_number().over(first)).where("place = 1").drop("place"))
    hosts = found.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.max("plain").alias("plain"))

    def learn(group: pa.Table) -> pa.Table:
        group = group.sort_by("h")
        nodes = infer_all(p.as_py() for p in group["body"])
        return pa.table({"host": group["host"].slice(0, 1), "part": group["part"].slice(0, 1), "wrapper": [json.dumps(nodes)]})

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        nodes = json.loads(group["wrapper"][0].as_py())
        for raw in group["wrapper"][1:]:
            nodes = align(nodes, json.loads(raw.as_py()))
        return pa.table({"host": group["host"].slice(0, 1), "wrapper": [json.dumps(nodes)]})

    large = hosts.where(F.col("n") > streams_per_part).select("host", "n")
    if is_bounded(large, LARGE_HOSTS, BROADCAST_BYTES):
        large = F.broadcast(large)
    part = F.coalesce(F.pmod("form", F.ceil(F.col("n") / streams_per_part)), F.lit(0).cast("long")).alias("part")
    # Dealt by host and part: a plan that has met on the host alone would leave all parts of a host to one task.
    dealt = found.join(large, "host", "left").select("host", "h", "body", part).repartition("host", "part")
    parts = dealt.groupBy("host", "part").applyInArrow(learn, "host string, part long, wrapper string")
    formed = cut_lineage(parts.groupBy("host").applyInArrow(join, "host string, wrapper string"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of a text: whether a page differs, and the hashes of some pages that have it, as many as make it a constant.
        known: dict[str, Wrapper] = {}
        for batch in batches:
            found: dict[tuple[str | None, int], tuple[bool, set[int]]] = {}
            for host_of, raw, page, h in zip(*(batch.column(c) for c in ("host", "wrapper", "body", "h")), strict=True):
                w = raw.as_py()
                if w not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[w] = Wrapper(json.loads(w))
                if not any(t is not None for t in known[w].told):
                    continue
                stream, texts = tokens(page.as_py())
                # Constants matter on pages without a marked article alone.
                if main_region(stream) != "body":
                    continue
                for i, differs in known[w].seen(stream, texts):
                    differed, pages_of = found.setdefault((host_of.as_py(), i), (False, set()))
                    if len(pages_of) < 3:
                        pages_of.add(h.as_py())
                    found[host_of.as_py(), i] = differed or differs, pages_of
            out = [(k, i, d, p) for (k, i), (d, pages_of) in found.items() for p in pages_of]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in out], t) for n, t in enumerate((pa.string(), pa.int32(), pa.bool_(), pa.int64()))],
                names=["host", "text", "differs", "page"])

    # Constants matter on pages without a marked article alone: hosts without such a page are not read here.
    asked = formed.join(hosts.where("plain").select("host"), "host")
    seen = hashed.join(asked, "host").select("host", "wrapper", "body", "h").mapInArrow(
        look, "host string, text int, differs boolean, page long")
    told = seen.groupBy("host", "text", "page").agg(F.max("differs").alias("differs")).groupBy("host", "text").agg(
        F.max("differs").alias("differs"), F.count(F.lit(1)).alias("pages")).groupBy("host").agg(
        F.collect_list(F.struct("text", "differs", "pages")).alias("told"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wrappers_of = []
            for raw, told_of in zip(batch.column("wrapper").to_pylist(), batch.column("told").to_pylist(), strict=True):
                nodes = json.loads(raw)
                _settled(nodes, {t["text"]: t["pages"] for t in told_of or ()}, {t["text"] for t in told_of or () if t["differs"]})
                wrappers_of.append(json.dumps(nodes))
            yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(wrappers_of, pa.string())], names=["host", "wrapper"])

    wrappers = cut_lineage(formed.join(told, "host", "left").mapInArrow(settle, "host string, wrapper string"))
    kind = rows.schema["key"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, Wrapper | None] = {}
        for batch in batches:
            texts = []
            for raw, page in zip(batch.column("wrapper"), batch.column("body"), strict=True):
                w = raw.as_py()
                if w not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[w] = Wrapper(json.loads(w)) if w else None
                texts.append(main_text(page.as_py(), known[w]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["key", "url", "text", "n_chars"])

    # One host may have a third of all pages; adaptive execution splits such a partition of this join.
    read = rows.join(wrappers, "host", "left").select("key", "url", "body", "wrapper")
    return read.mapInArrow(apply, f"key {kind}, url string, text string, n_chars long").withColumnRenamed("key", key)
