"""Main text of web pages by inferred wrappers (operator 4).

A page is a stream of tags and text slots. The streams of a host's pages are
aligned one after another into a wrapper, a union-free regular expression:
what only some pages have becomes optional, a stretch that repeats becomes a
repeated group. A text that half of the host's distinct pages hold behind the
same tag is a constant of the template, any other text is a slot. The wrapper
names the element that holds the article's slots; every page of the host is
then read with it, constants left out.
"""

from __future__ import annotations

import difflib
import hashlib
import html as entities
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.scratch import materialise

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea|svg|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-z][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Elements inside running text; they are part of a slot.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Ends of these may be left out; a new block ends them.
LOOSE = frozenset("p li dt dd tr td th option".split())
BOILERPLATE = frozenset("nav header footer aside form button select menu dialog head".split())
_BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|notice|popup|modal|newsletter|subscribe|"
    r"menu|nav\w*|breadcrumbs?|sidebar|side|footer|header|masthead|comments?|disqus|reply|replies|related|share|sharing|"
    r"social|toolbar|pagination|pager|login|signup|search|form)(?:$|[\s_-])",
    re.I,
)
#: Inside the content element only these whole names are boilerplate.
_BAD_INSIDE = frozenset(
    "ad ads advert advertisement banner sponsor promo cookie consent notice popup modal newsletter subscribe menu nav "
    "breadcrumb breadcrumbs sidebar comment comments disqus reply replies related share sharing social pagination pager".split()
)
#: A text is a constant of a host's template on at least so many distinct pages and half of them all.
CONSTANT_PAGES = 5
_MAIN = ("article", "main")
_MAIN_NAME = re.compile(r"(?:^|[\s_-])(?:article|articlebody|main|content|post|entry|story)(?:$|[\s_-])", re.I)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, tag, names or text)`` with kind ``<`` (open), ``/`` (close) or ``#`` (text)."""
    for m in _TOKEN.finditer(page):
        if m["text"] is not None:
            yield "#", "", m["text"]
        elif m["tag"]:
            tag = m["tag"].lower()
            if m["end"]:
                yield "/", tag, ""
            else:
                names = " ".join(a[1] or a[2] or a[3] for a in _NAMED.findall(m["attrs"])) if m["attrs"] else ""
                yield "<", tag, names


def mark(tag: str, names: str) -> str:
    """An element as the wrapper sees it: its tag and its names without numbers."""
    words = [w.lower() for w in names.split() if not any(c.isdigit() for c in w)]
    return ".".join([tag, *words])


def stream(page: str) -> Iterator[tuple[str, str, str, bytes]]:
    """``tokens`` with running text joined into one: ``(kind, tag, names or text, key)``.

    Inline elements are part of the text, character references are decoded and
    white space is one space. The key, of texts only, is a digest of the text
    and the tag before it.
    """
    held: list[str] = []
    before = ""

    def text() -> Iterator[tuple[str, str, str, bytes]]:
        whole = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        if whole:
            yield "#", "", whole, hashlib.blake2b(f"{before}\0{whole}".encode("utf-8", "replace"), digest_size=8).digest()

    for kind, tag, rest in tokens(page):
        if kind == "#":
            held.append(rest)
        elif tag in INLINE:
            if tag == "br":
                held.append(" ")
        else:
            yield from text()
            before = kind + (mark(tag, rest) if kind == "<" else tag)
            yield kind, tag, rest, b""
    yield from text()


def skeleton(page: str, fixed: frozenset[bytes] = frozenset()) -> list:
    """The page's stream of block tags, slots (``#``) and constants (``=`` and key), repeats folded into groups."""
    out: list = []
    for kind, tag, rest, key in stream(page):
        if kind == "#":
            node = "=" + key.hex() if key in fixed else "#"
            if not out or out[-1] != node:
                out.append(node)
        elif tag not in VOID and not (kind == "/" and tag in LOOSE):
            out.append(kind + (mark(tag, rest) if kind == "<" else tag))
    return fold(out)


def fold(seq: list, longest: int = 16) -> list:
    """Replace stretches that repeat side by side by ``["+", stretch]``, shortest first."""
    for size in range(1, longest + 1):
        out, i = [], 0
        while i < len(seq):
            unit = seq[i : i + size]
            if len(unit) == size and seq[i + size : i + 2 * size] == unit:
                while seq[i : i + size] == unit:
                    i += size
                group = unit[0] if size == 1 and unit[0][0] == "+" else ["+", unit]
                out.append(group)
            else:
                out.append(seq[i])
                i += 1
        seq = out
    return seq


def _key(node) -> str:
    return node if isinstance(node, str) else "+" + json.dumps(node[1])


def _is_repeat(group, seq: list) -> bool:
    """Is ``seq`` the group's stretch, once or more?"""
    if isinstance(group, str) or not seq:
        return False
    body = group[1]
    return len(seq) % len(body) == 0 and all(seq[k : k + len(body)] == body for k in range(0, len(seq), len(body)))


def align(wrapper: list, page: list) -> list:
    """Merge a stream into a wrapper; both are lists of ``[node, optional]``.

    Stretches that only one side has become optional, unless one side's
    repeated group stands for the other side's stretch.
    """
    a, b = [_key(n) for n, _ in wrapper], [_key(n) for n, _ in page]
    out: list = []
    for how, i, j, k, m in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
        left, right = wrapper[i:j], page[k:m]
        if how == "equal":
            out += [[x[0], x[1] or y[1]] for x, y in zip(left, right, strict=True)]
        elif len(left) == 1 and _is_repeat(left[0][0], [n for n, _ in right]):
            out += left
        elif len(right) == 1 and _is_repeat(right[0][0], [n for n, _ in left]):
            out += right
        else:
            out += [[n, True] for n, _ in left + right]
    return out


def flat(nodes: list) -> Iterator[tuple[str, bool]]:
    """Tokens of a wrapper in order, with whether they repeat."""
    for n in nodes:
        if isinstance(n, str):
            yield n, False
        else:
            for t, _ in flat(n[1]):
                yield t, True


def is_boilerplate(m: str) -> bool:
    tag, _, names = m.partition(".")
    return tag in BOILERPLATE or bool(names and _BAD_NAME.search(names.replace(".", " ")))


def is_inner_boilerplate(m: str) -> bool:
    tag, *names = m.split(".")
    return tag in BOILERPLATE or not _BAD_INSIDE.isdisjoint(names)


def content_mark(wrapper: list) -> str:
    """The element of the wrapper that holds the article; empty if none stands out.

    An ``article`` or ``main`` element with slots, else one so named, else the
    element with most slots of its own (a repeated slot counts as many),
    boilerplate left aside.
    """
    stack: list[str] = []
    slots: dict[str, int] = {}
    around: dict[str, int] = {}
    for token, many in flat([n for n, _ in wrapper]):
        if token[0] == "<":
            stack.append(token[1:])
        elif token[0] == "/":
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].partition(".")[0] == token[1:]:
                    del stack[k:]
                    break
        elif token == "#" and not any(map(is_boilerplate, stack)):
            weight = 4 if many else 1
            holders = [m for m in stack if m.partition(".")[0] not in LOOSE and not re.match(r"h[1-6]\b", m)]
            for m in set(holders):
                around[m] = around.get(m, 0) + weight
            if holders:
                slots[holders[-1]] = slots.get(holders[-1], 0) + weight
    for tag in _MAIN:
        named = [m for m in around if m.partition(".")[0] == tag]
        if named:
            return max(named, key=lambda m: (around[m], m))
    named = [m for m in around if _MAIN_NAME.search(m.partition(".")[2].replace(".", " "))]
    if named:
        return max(named, key=lambda m: (around[m], m))
    return max(slots, key=lambda m: (slots[m], m), default="")


def extract(page: str, content: str, fixed: frozenset[bytes] = frozenset()) -> str:
    """Blocks of the element ``content`` (of the whole body if the page lacks it), boilerplate and constants left out.

    Outside the content a name that holds a boilerplate word is enough; inside
    it only such a name as a whole, so that a ``story-side`` stays.
    """
    blocks: list[tuple[bool, str]] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, inside boilerplate, inside content
    found = False
    for kind, tag, rest, key in stream(page):
        bad, inside = stack[-1][1:] if stack else (False, False)
        if kind == "#":
            if not bad and key not in fixed:
                blocks.append((inside, rest))
        elif kind == "<":
            if tag in LOOSE:
                while stack and stack[-1][0] == tag:
                    stack.pop()
                bad, inside = stack[-1][1:] if stack else (False, False)
            if tag not in VOID:
                m = mark(tag, rest)
                own = bool(content) and m == content
                found |= own
                root = own or tag in _MAIN or tag in ("body", "html")
                # an article's own header is still boilerplate; the article itself never is
                named = is_inner_boilerplate(m) if inside else is_boilerplate(m)
                stack.append((tag, bad or (named and not root), inside or own))
        else:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
    return "\n\n".join(text for inside, text in blocks if inside or not found)


def _with_host(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host`` of every row; a null url belongs to the host of no name."""
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.withColumn("host", host)


def constant_texts(pages: DataFrame, least: int = CONSTANT_PAGES) -> DataFrame:
    """``host, fixed``: keys of the texts that at least ``least`` and half of a host's distinct pages hold.

    Counted by host and text, so a large host is no group; a host has at most
    twice as many constants as its pages have texts on average.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_ = [h.as_py() or "" for h in batch.column(1)]
            keys = [[b"", *sorted({key for kind, _, _, key in stream(p) if kind == "#"})] for p in pages_]
            digest = [hashlib.blake2b(p.encode("utf-8", "replace"), digest_size=16).digest() for p in pages_]
            columns = [batch.column(0), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "page", "keys"])

    seen = _with_host(pages).select("host", "html").mapInArrow(compute, "host string, page binary, keys array<binary>")
    seen = seen.dropDuplicates(["host", "page"]).select("host", F.explode("keys").alias("key"))
    counts = materialise(seen.groupBy("host", "key").agg(F.count("*").alias("n")).where(F.col("n") >= least), "text-counts")
    total = counts.where("key = X''").select(F.col("host").alias("of"), F.col("n").alias("pages"))
    often = counts.where("key != X''").join(total, F.col("host") == F.col("of")).where("2 * n >= pages")
    return often.groupBy("host").agg(F.sort_array(F.collect_list("key")).alias("fixed"))


def _known(pages: DataFrame, by_host: DataFrame) -> DataFrame:
    """Pages beside what is known of their host (columns of ``by_host``, null if nothing)."""
    by_host = by_host.withColumnRenamed("host", "_of")
    return _with_host(pages).join(by_host, F.col("host") == F.col("_of"), "left").drop("_of")


def host_skeletons(pages: DataFrame, fixed: DataFrame) -> DataFrame:
    """``host, skeleton, n``: the distinct streams of each host, counted before the shuffle."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(1), batch.column(2).to_pylist(), strict=True)
            text = [json.dumps(skeleton(h.as_py() or "", frozenset(f or ())), separators=(",", ":")) for h, f in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text, pa.string())], ["host", "skeleton"])

    rows = _known(pages, fixed).select("host", "html", "fixed")
    return rows.mapInArrow(compute, "host string, skeleton string").groupBy("host", "skeleton").agg(F.count("*").alias("n"))


def infer(streams: list[tuple[int, list]]) -> list:
    """The wrapper of weighted streams, aligned from the most frequent to the rarest."""
    ordered = sorted(streams, key=lambda s: (-s[0], json.dumps(s[1])))
    wrapper = ordered[0][1]
    for _, other in ordered[1:]:
        wrapper = align(wrapper, other)
    return wrapper


def wrappers(pages: DataFrame, fixed: DataFrame, salts: int = 16) -> DataFrame:
    """``host, wrapper, content`` of every host, from its pages and its ``constant_texts``.

    The distinct streams of a host are dealt to ``salts`` groups that are
    aligned apart; their wrappers are aligned once more, so a large host is
    never one group.
    """

    def first(table: pa.Table) -> pa.Table:
        rows = zip(table["n"].to_pylist(), table["skeleton"].to_pylist(), strict=True)
        wrapper = infer([(n, [[x, False] for x in json.loads(s)]) for n, s in rows])
        return pa.table({"host": [table["host"][0].as_py()], "n": [sum(table["n"].to_pylist())], "wrapper": [json.dumps(wrapper)]})

    def second(table: pa.Table) -> pa.Table:
        wrapper = infer([(n, json.loads(w)) for n, w in zip(table["n"].to_pylist(), table["wrapper"].to_pylist(), strict=True)])
        return pa.table({"host": [table["host"][0].as_py()], "wrapper": [json.dumps(wrapper)], "content": [content_mark(wrapper)]})

    found = host_skeletons(pages, fixed).withColumn("_salt", F.pmod(F.hash("skeleton"), F.lit(salts)))
    parts = found.groupBy("host", "_salt").applyInArrow(first, "host string, n long, wrapper string")
    return parts.groupBy("host").applyInArrow(second, "host string, wrapper string, content string")


def main_text(pages: DataFrame) -> DataFrame:
    """Main text of every page (operator 4).

    Returns per row ``page_id, url, text, n_chars``. Null or empty html gives an
    empty text; a null url belongs to the host of no name; repeated rows give
    repeated results. Character references are decoded and white space inside
    a block is one space; blocks are joined by two line ends. Texts that
    ``CONSTANT_PAGES`` and half of a host's distinct pages share behind the same
    tag are template and left out; repeated rows count as one page there.
    """
    fixed = materialise(constant_texts(pages), "constant-texts")
    found = materialise(wrappers(pages, fixed), "wrappers").select(F.col("host").alias("h"), "content")
    by_host = found.join(fixed, F.col("h") == F.col("host"), "left").select(F.col("h").alias("host"), "content", "fixed")
    rows = _known(pages, by_host).select("page_id", "url", "html", "content", "fixed")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = zip(batch.column(2), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)
            text = [extract(h.as_py() or "", c or "", frozenset(f or ())) for h, c, f in known]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(compute, "page_id long, url string, text string, n_chars long")
