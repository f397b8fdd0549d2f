"""Main text of web pages by equivalence-class template deduction.

Pages are read as sequences of tokens: start tags, end tags and words, each
named by its path (tags with classes and ids from the root; words carry their
text; a text run of more than ``RUN_WORDS`` words is one token).  Over the pages
of a host every token has an occurrence vector (how often it stands on each
page); a vector is kept as two sums of hashes of (page, count), so vectors are
compared after one aggregation whose rows are partial sums, never pages.

1. Tokens on at least half of a host's pages that share a vector form a class
   (at most twice as many tokens as its pages hold on average).
2. A class is valid if on all pages its tokens come in one repeated order and
   every repetition lies in the same gap of the root class (the class of tokens
   that stand once on every page).  Valid classes are nested into each other's
   gaps: this is the host's template.
3. What is left between template tokens are the slots.  Texts of slots are
   extracted by place: slots in an article (or main) element are the main text;
   where pages have none, the part of the template that holds half of the
   host's remaining words without links, and its headings.  Slots in menus,
   headers, footers, sidebars, notices, adverts, forms, scripts, styles and
   comments, told by element or by class, id and role, are dropped.  In an
   article element every other word is kept, template word or not: pages may
   share a passage.

Hosts of fewer than ``MIN_PAGES`` different pages have no template; without an
article element all of the text outside dropped elements is their main text.

Defined results: null html gives an empty text; pages whose url has no host are
taken as one host; repeated rows give repeated results; an empty table gives no
rows; other columns are not read.  Pages of any length are read whole, in time
linear in their length.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize

MIN_PAGES, SUPPORT, RUN_WORDS = 3, 0.5, 24
#: Partial sums held by a task before they are passed on; bytes of templates that may be broadcast.
HELD, BROADCAST_BYTES = 200_000, 16 << 20
#: Elements and words whose hashes a task keeps.
KEPT = 200_000

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table
    tbody td tfoot th thead title tr ul""".split())
#: An element that ends an open one of the same group (up to the group's container).
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CONTAINERS = frozenset("ul ol menu dl table select".split())
#: Elements, roles and words of class or id whose text is not main text.
DROPPED_TAGS = frozenset("""aside button canvas dialog footer form head iframe menu nav noscript object script select style svg
    template textarea title""".split())
DROPPED_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
DROPPED_WORDS = frozenset("""ad ads advert advertisement adverts aside banner breadcrumb breadcrumbs comment comments consent cookie
    cookies copyright disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice
    pager pagination popup promo promoted related search share sharing sidebar signup social sponsor sponsored subscribe toolbar
    widget""".split())
#: The words that count, at a name's start, on article and main elements; starts of names that tell a state.
DROPPED_OWN, STATES = frozenset("ad advert comment comments promo sponsored teaser".split()), frozenset("has is no not with".split())

_PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title|xmp|noembed|noframes)(?=[\s/>])[^>]*>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*+>|[^>]*>)|<[!?/][^>]*>|(?P<text>[^<]+|<)", re.S | re.I)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
_TELLING = re.compile(r"class|id|role|itemprop|hidden", re.I)
_DIGITS, _LONG, _SPLIT = re.compile(r"\d+"), re.compile(r"\d{3,}"), re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[A-Z])")


def _hash(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "replace")) >> 1


class Element:
    """A place in a page.  Elements of one path share an object, also between
    the pages of a task, and keep the hashes of the words read there."""
    __slots__ = ("tag", "path", "parent", "dropped", "article", "link", "below", "words")

    def __init__(self, tag: str, more: str, parent: "Element | None"):
        seen = {k.lower(): a or b or c for k, a, b, c, _ in _ATTRIBUTE.findall(more) if k} if "=" in more else {}
        names = f"{seen.get('class', '')} {seen.get('id', '')}".strip()
        self.tag, self.parent, self.below, self.words = tag, parent, {}, {}
        # numbers of single pages (all in ids, long ones in classes) do not tell paths apart
        self.path = _hash(parent.path if parent else 0, tag, _LONG.sub("0", seen.get("class", "")), _DIGITS.sub("0", seen.get("id", "")))
        role = seen.get("role", "").lower()
        # 1: inside a main element, 2: inside an article
        own = 2 if tag == "article" else 1 if tag == "main" or role == "main" or seen.get("itemprop") == "articleBody" else 0
        parts = [[w.lower() for w in _SPLIT.split(n)] for n in names.split()]
        words = {w for p in parts if p[0] not in STATES for w in (p[:1] if own else p)}
        inside = parent.article if parent else 0
        if inside:
            words -= {"header", "masthead"}
        dropped = tag in DROPPED_TAGS or tag == "header" and not inside or role in DROPPED_ROLES or "hidden" in more and bool(
            re.search(r"\bhidden\b(?!-)", more) and seen.get("aria-hidden", "true") == "true")
        if tag not in ("html", "body") and words & (DROPPED_OWN if own else DROPPED_WORDS):
            dropped = True
        self.dropped = dropped or bool(parent and parent.dropped)
        self.article = max(own, inside)
        self.link = tag == "a" or bool(parent and parent.link)


    def child(self, tag: str, more: str) -> "Element":
        key = (tag, more if _TELLING.search(more) else "")
        if key not in self.below:
            self.below[key] = Element(*key, self)
            _SHARED["made"] += 1
        return self.below[key]

    def word(self, word: str) -> int:
        if word not in self.words:
            self.words[word] = _hash(self.path, word)
            _SHARED["made"] += 1
        return self.words[word]


_SHARED: dict = {"made": 0, "root": None}


def _root() -> Element:
    """The root that pages share until ``KEPT`` elements and words hang on it."""
    if _SHARED["root"] is None or _SHARED["made"] > KEPT:
        _SHARED.update(made=0, root=Element("", "", None))
    return _SHARED["root"]


def read(html: str) -> Iterator[tuple[str, Element, str]]:
    """(kind, element, text): kind "<" a start tag, ">" an end tag that is
    written out, "t" a text with its character references decoded, "|" the
    border of a block (also where an end tag is left out)."""
    stack, open_tags = [_root()], Counter()

    def leave(upto: int) -> bool:
        block = False
        while len(stack) > upto:
            e = stack.pop()
            open_tags[e.tag] -= 1
            block |= e.tag in BLOCK
        return block
    for m in _PIECE.finditer(html):
        text, tag = m["text"], m["tag"]
        if text is not None:
            yield "t", stack[-1], entities.unescape(text) if "&" in text else text
        elif tag:
            tag = tag.lower()
            if m["end"]:
                if open_tags[tag] > 0:
                    at = len(stack) - 1
                    while stack[at].tag != tag:
                        at -= 1
                    e = stack[at]
                    if leave(at):
                        yield "|", e, ""
                    yield ">", e, ""
                elif tag in BLOCK:
                    yield "|", stack[-1], ""
                continue
            ends = SIBLINGS.get(tag, ()) if tag in SIBLINGS else ("p",) if tag in BLOCK and tag != "br" else ()
            if any(open_tags[x] > 0 for x in ends):
                at = len(stack) - 1
                while at > 0 and stack[at].tag not in ends and stack[at].tag not in CONTAINERS and not (
                        ends == ("p",) and stack[at].tag in BLOCK):
                    at -= 1
                if stack[at].tag in ends:
                    e = stack[at]
                    leave(at)
                    yield "|", e, ""
            e = stack[-1].child(tag, m["more"])
            if tag in BLOCK:
                yield "|", e, ""
            yield "<", e, ""
            if tag not in VOID and not (m["more"].endswith("/>") and tag not in BLOCK):
                stack.append(e)
                open_tags[tag] += 1
        # comments, raw text elements and declarations hold no text of the page


def tokens(html: str) -> Iterator[tuple[int, str, Element, str]]:
    """(token, kind, element, text) in page order."""
    for kind, e, text in read(html):
        if kind == "<":
            yield e.path, kind, e, ""
        elif kind == ">":
            yield e.path ^ 1 << 62, kind, e, ""
        elif kind == "t":
            words = text.split()
            if len(words) > RUN_WORDS:
                yield _hash(e.path, *words), "t", e, text
            else:
                for w in words:
                    yield e.word(w), "t", e, w


def _sums(held: dict, fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    rows = [(*k, *v) for k, v in held.items()]
    held.clear()
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields])


_VECTOR = [("host", pa.string()), ("token", pa.int64()), ("pages", pa.int64()), ("low", pa.int64()), ("high", pa.int64())]


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial occurrence vectors of (host, token)."""
    held: dict = {}
    for batch in batches:
        for host, key, html in zip(*batch.columns):
            host, key = host.as_py(), key.as_py()
            counts = Counter(t[0] for t in tokens(html.as_py()))
            counts[0] = 1
            drawn = {n: _hash(key, n) for n in set(counts.values())}
            for token, n in counts.items():
                at = held.setdefault((host, token), [0, 0, 0])
                at[0] += 1
                at[1] += drawn[n] & 0x7FFFFFFF
                at[2] += drawn[n] >> 31
            if len(held) >= HELD:
                yield _sums(held, _VECTOR)
    yield _sums(held, _VECTOR)


_FOUND = [("host", pa.string()), ("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("n", pa.int64()), ("m", pa.int64())]


def _lookup(cache: dict, host: str, value: pa.Scalar):
    if host not in cache:
        if len(cache) >= 64:
            cache.clear()
        text = value.as_py()
        cache[host] = json.loads(text) if text else None
    return cache[host]


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How the classes lie on the pages.  kind "order": class a's token order
    (hash low to high; n repetitions); "gap": the gap of class b that class a's
    repetitions start in (low to high); "words": words outside (n) and inside links (m) of
    the text whose nearest root-class element is a (b: the next one above)."""
    held: dict = {}
    cache: dict = {}
    for batch in batches:
        for host, html, classes in zip(*batch.columns):
            host = host.as_py()
            known = _lookup(cache, host, classes)
            if known is None:
                continue
            if not isinstance(known, tuple):
                cache[host] = known = (known, {t: k for k, c in enumerate(known) for t in c}, set(known[0]))
            classes_, at, root = known
            size = [len(c) for c in classes_]
            seen, first, broken = [0] * len(size), [[] for _ in size], set()
            gaps: dict = {}
            for token, kind, e, text in tokens(html.as_py()):
                k = at.get(token)
                if k is not None:
                    place = seen[k] % size[k]
                    if seen[k] < size[k]:
                        first[k].append(token)
                    elif first[k][place] != token:
                        broken.add(k)
                    if place == 0:
                        for b in range(len(size)):
                            if b != k:
                                g = seen[b] % size[b]
                                low, high = gaps.get((k, b), (g, g))
                                gaps[k, b] = min(low, g), max(high, g)
                    seen[k] += 1
                if kind == "t" and k != 0 and not e.dropped:
                    a = e
                    while a.parent and a.path not in root:
                        a = a.parent
                    b = a.parent
                    while b and b.parent and b.path not in root:
                        b = b.parent
                    sums = held.setdefault((host, "words", a.path, b.path if b else 0), [0, 0, 0, 0])
                    sums[3 if e.link else 2] += len(text.split())
                    sums[0] = max(sums[0], int(a.tag in ("h1", "h2")))
            for k, n in enumerate(seen):
                if n:
                    order = -1 if k in broken or n % size[k] else _hash(*first[k])
                    sums = held.setdefault((host, "order", k, 0), [order, order, 0, 0])
                    sums[0], sums[1], sums[2] = min(sums[0], order), max(sums[1], order), sums[2] + n // size[k]
            for (k, b), (low, high) in gaps.items():
                sums = held.setdefault((host, "gap", k, b), [low, high, 0, 0])
                sums[0], sums[1] = min(sums[0], low), max(sums[1], high)
            if len(held) >= HELD:
                yield _sums(held, _FOUND)
    yield _sums(held, _FOUND)


def nest(found: pd.DataFrame, classes: list[list[int]]) -> dict:
    """A host's template: valid classes with the class and gap they lie in, and
    the elements whose slots are the main text where pages have no article."""
    order = found[found.kind == "order"]
    once = {int(r.a): int(r.n) for r in order.itertuples() if r.low == r.high and r.low >= 0}
    gaps = {(int(r.a), int(r.b)): int(r.low) for r in found[found.kind == "gap"].itertuples() if r.low == r.high}
    valid = [k for k in once if k == 0 or (0 in once and gaps.get((k, 0), 0) > 0)]
    parts = []
    for k in sorted(valid):
        around = [b for b in valid if b != k and gaps.get((k, b), 0) > 0]  # strictly inside one gap of b
        inner = max(around, key=lambda b: (once[b], -b), default=None)
        parts.append({"class": k, "in": inner, "gap": gaps.get((k, inner)) if inner is not None else None, "tokens": classes[k]})
    words = found[found.kind == "words"]
    above, own, heading = {}, defaultdict(int), set()
    for r in words.itertuples():
        above[int(r.a)] = int(r.b)
        own[int(r.a)] += int(r.n)
        if r.low:
            heading.add(int(r.a))
    total, depth = defaultdict(int), {}
    for a, n in own.items():
        way = [a]
        while way[-1] in above and above[way[-1]] not in way:
            way.append(above[way[-1]])
        for k, x in enumerate(way):
            total[x] += n
            depth[x] = len(way) - k
    main, whole = None, sum(own.values())
    if 0 in once and whole:
        main = max((x for x in total if x and total[x] * 2 >= whole), key=lambda x: (depth[x], -total[x]), default=None)
        up = above.get(main)
        beside = {h for h in heading if above.get(h) == up and up}
    return {"parts": parts, "main": [main, *sorted(beside)] if main else []}


def _nested(found: pd.DataFrame) -> pd.DataFrame:
    classes = json.loads(found["classes"].iloc[0])
    return pd.DataFrame({"host": [found["host"].iloc[0]], "template": [json.dumps(nest(found, classes))]})


def main_text(html: str, template: dict | None) -> str:
    """The texts of the main slots, in page order."""
    events = [x for x in read(html)]
    level = max((e.article for kind, e, _ in events if kind == "<" and not e.dropped), default=0)
    main = set(template["main"]) if template and not level else set()
    constant = {t for p in template["parts"] for t in p["tokens"]} if main else set()
    inside: dict[int, bool] = {}

    def chosen(e: Element) -> bool:
        if level or not main:
            return e.article >= level
        way, x = [], e
        while x is not None and id(x) not in inside and x.path not in main:
            way.append(id(x))
            x = x.parent
        got = x is not None and inside.get(id(x), True)
        for i in way:
            inside[i] = got
        return got
    out = []
    for kind, e, text in events:
        if kind == "|":
            out.append(" ")
        elif kind == "t" and not e.dropped and chosen(e):
            if constant and text.strip():
                words = text.split()
                if len(words) > RUN_WORDS:
                    text = "" if _hash(e.path, *words) in constant else text
                elif any(e.word(w) in constant for w in words):
                    text = f" {' '.join(w for w in words if e.word(w) not in constant)} "
            out.append(text)
    return " ".join("".join(out).split())


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache: dict = {}
    for batch in batches:
        page_id, url, host, html, template = batch.columns
        texts = [main_text(h.as_py(), _lookup(cache, k.as_py(), t)) for k, h, t in zip(host, html, template)]
        yield pa.RecordBatch.from_arrays([page_id, url, pa.array(texts, pa.string())], ["page_id", "url", "text"])


def _with(pages: DataFrame, per_host: DataFrame, column: str) -> DataFrame:
    """Pages and their host's row: broadcast if the rows are measured to be
    small, else a join that Spark splits where a host is large."""
    size = per_host.agg(F.sum(F.length(column)).alias("bytes")).first()["bytes"] or 0
    return pages.join(F.broadcast(per_host) if size <= BROADCAST_BYTES else per_host, "host", "left")


def _hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): the deduced template of every host, as JSON."""
    rows = _hosted(pages)
    key = F.xxhash64("html").alias("key")
    hosts = rows.select("host", key).groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).groupBy("host").agg(
        F.sum("n").alias("of"), F.count(F.lit(1)).alias("different")).where(F.col("different") >= MIN_PAGES)
    hosts = materialize(hosts, "page_hosts")
    vectors = rows.select("host", key, "html").mapInArrow(_vectors, "host string, token long, pages long, low long, high long")
    vectors = vectors.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum("low").alias("low"), F.sum("high").alias("high"))
    # both written, so that the join needs no host's rows together and Spark can split a large host
    frequent = materialize(vectors.where("pages > 1").join(hosts, "host").where(F.col("pages") >= F.col("of") * SUPPORT), "page_tokens")
    # the token 0 stands once on every page: its class is the root class, listed first
    classes = frequent.groupBy("host", "pages", "low", "high").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    classes = classes.where(F.size("tokens") > 1)
    first = F.struct((~F.array_contains("tokens", F.lit(0).cast("long"))).alias("later"), "tokens")
    listed = classes.groupBy("host").agg(F.sort_array(F.collect_list(first)).alias("all")).where(~F.col("all")[0]["later"])
    listed = materialize(listed.select("host", F.to_json(F.transform("all", lambda c: F.filter(c["tokens"], lambda t: t != 0))).alias("classes")), "page_classes")
    found = _with(rows.select("host", "html"), listed, "classes").where(F.col("classes").isNotNull()).mapInArrow(
        _observed, "host string, kind string, a long, b long, low long, high long, n long, m long")
    found = found.groupBy("host", "kind", "a", "b").agg(F.min("low").alias("low"), F.max("high").alias("high"),
                                                        F.sum("n").alias("n"), F.sum("m").alias("m"))
    # a host's rows: its classes, pairs of them and root-class elements, bounded by its template and not by its pages
    return materialize(found.join(listed, "host").groupBy("host").applyInPandas(_nested, "host string, template string"), "page_templates")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    kind = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    texts = _with(_hosted(pages), templates(pages), "template").select("page_id", "url", "host", "html", "template").mapInArrow(
        _extracted, f"page_id {kind['page_id']}, url {kind['url']}, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
