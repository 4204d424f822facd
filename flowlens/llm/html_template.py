"""Main text of web pages by template deduction over the pages of a host.

A page is a sequence of tokens: element tags told apart by their path, and
whole text blocks told apart by their path and text.  A token's occurrence
vector counts it on each page of the host.  Tokens that share a vector form
an equivalence class; a class that is frequent and large is valid, and valid
classes nest into one another by their spans: the template.  What lies
between template tokens are the slots.

Vectors are never gathered: a token's vector is fingerprinted by a sum of
hashes of (page, count), which is combined before the shuffle, so a host with
a third of all pages is as cheap as any other.

A class is frequent on half of its host's pages, or of the pages of its layout
there (alike in their elements down to the third level).

Extraction walks a page with the template of its host and layout.  Text blocks
that are template tokens go, inside an article element as elsewhere; slots
stay, in page order: those of the article (or else the main) element, or if the
page has none all that are left.  Slots of menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments go.  Where no
template is known the roles alone decide.

An article of which more than half is template, by blocks and by characters, is
a near copy of other articles: its repeated blocks are its text, and it stays whole.

Cases: null or empty html: empty text.  A host with one page, or a page
without a url: no template.  Unclosed elements end with their parents; an
unclosed menu does not swallow an article.  Pages of a host with the same
article count once.  Very long pages are read whole.
"""
from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.llm.byte_bpe import _slices
from flowlens.llm.common import BROADCAST_IDS, reach_workers, written

#: A valid class: tokens, pages, share of the host's pages.
CLASS_TOKENS, CLASS_PAGES, CLASS_SHARE = 3, 3, 0.5

# Elements by what they do to text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "label", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
          "u", "var", "wbr"}
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
BOILER = {"head", "nav", "footer", "aside", "form", "menu", "button", "select", "dialog", "svg", "canvas", "object", "audio",
          "video", "map", "option", "datalist", "fieldset"}
PARAGRAPH_ENDS = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form",
                  "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
#: Words of a class or id that name boilerplate.
WORDS = {"ad", "ads", "adbox", "adslot", "adunit", "adsense", "advert", "adverts", "advertisement", "advertising", "alert",
         "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus",
         "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
         "notices", "notification", "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related",
         "replies", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe",
         "toolbar", "topbar", "widget"}
COMMENT_WORDS = {"comment", "comments", "replies", "disqus"}
#: Of these, what may hold an article element that is not the page's own.
HOLDERS = {"aside", "footer", "dialog"}
HOLDER_WORDS = COMMENT_WORDS | {"recommended", "related", "sidebar", "widget", "promo", "promotion", "sponsored"}

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*|[^>]*)>""", re.S)
_ATTR = re.compile(r"""(class|id|role|itemprop|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_DIGITS = re.compile(r"\d+")
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", url or "")
    return m[1].rpartition("@")[2].lower() if m else ""


def _role(name: str, attrs: str, inside_article: bool) -> str:
    """'drop', 'thin', 'article', 'main' or '' for an element.  'thin' is dropped
    too, but cannot hold an article: one that begins inside ends it."""
    if name in BOILER or name in RAW or (name == "header" and not inside_article):
        return "drop" if name in HOLDERS else "thin"
    words: set[str] = set()
    for m in _ATTR.finditer(attrs) if attrs else ():
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return "drop"
        if key == "role":
            if value.lower() in ROLES:
                return "drop"
            if value.lower() in ("main", "article"):
                return value.lower()
        elif key == "itemprop":
            if value == "articleBody":
                return "article"
            if value == "comment":
                return "drop"
        else:
            parts = [p.lower() for p in _SPLIT.split(value) if p]
            words.update(b for a, b in pairwise(["", *parts]) if a not in ("no", "with", "has", "without"))
    bad = words & WORDS
    if name in ("article", "main"):
        return "drop" if bad & COMMENT_WORDS else name
    if not bad or name in ("html", "body"):
        return ""
    return "drop" if bad & HOLDER_WORDS else "thin"


def tokens(page: str) -> Iterator[tuple]:
    """('open', path, role) / ('close', path, role) / ('text', path, block, zone)
    in page order.  ``zone`` is the role that the block's ancestors give it."""
    total = Counter(m[2].lower() for m in _TAG.finditer(page) if m[1])
    closed: Counter = Counter()
    stack: list[tuple[str, str, str]] = []  # (name, path, role)
    text: list[str] = []
    pos = 0

    def zone() -> str:
        roles = [r for _, _, r in stack if r]
        return "drop" if "drop" in roles or "thin" in roles else "article" if "article" in roles else "main" if "main" in roles else ""

    def block() -> Iterator[tuple]:
        whole = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if whole:
            yield "text", stack[-1][1] if stack else "", whole, zone()

    def pop(k: int) -> Iterator[tuple]:
        while len(stack) > k:
            yield from block()
            _, path, role = stack.pop()
            yield "close", path, role

    while m := _TAG.search(page, pos):
        text.append(page[pos:m.start()])
        pos = m.end()
        if not m[2]:
            continue  # a comment or declaration
        name = m[2].lower()
        if m[1]:
            closed[name] += 1
            if name not in INLINE:
                yield from block()
            at = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1)
            # an end tag closes what is open inside, but not across an article's border
            border = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][2] in ("article", "main")), -1)
            if at >= 0 and (at >= border or name in ("body", "html", "main", "article")):
                yield from pop(at)
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, pos)
            if end:
                closed[name] += 1
                pos = end.end()
            elif name in ("script", "style"):
                pos = len(page)
            continue
        if name in INLINE:
            role = _role(name, m[3], False) if m[3] else ""
            if role in ("drop", "thin") and name not in VOID and not m[3].endswith("/"):
                yield from block()
                stack.append((name, (stack[-1][1] if stack else "") + "/" + name, role))
            continue
        yield from block()
        if name in VOID:
            continue
        if name in PARAGRAPH_ENDS and stack and stack[-1][0] == "p":
            yield from pop(len(stack) - 1)
        if name in ("li", "dt", "dd", "td", "th", "tr", "option") and stack and stack[-1][0] == name:
            yield from pop(len(stack) - 1)
        role = _role(name, m[3], zone() in ("article", "main"))
        if role in ("article", "main") and zone() == "drop":
            # inside a menu that was left open: it ended before the article
            lost = next((k for k, (n, _, r) in enumerate(stack) if r == "thin" or r == "drop" and closed[n] >= total[n]), None)
            if lost is not None and "drop" not in [r for _, _, r in stack[:lost]]:
                yield from pop(lost)
        path = (stack[-1][1] if stack else "") + "/" + name
        words = [v for a in _ATTR.finditer(m[3]) if a[1].lower() in ("class", "id") and (v := a[2] or a[3] or a[4])] if m[3] else []
        path += "." + ".".join(words) if words else ""
        if not m[3].endswith("/") or name in ("div", "p", "section", "article"):
            stack.append((name, path, role))
            yield "open", path, role
    text.append(page[pos:])
    yield from pop(0)
    yield from block()


def _hash(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def layout_of(page: list[tuple]) -> int:
    """The elements down to the third level, numbers in class names aside."""
    return _hash(*sorted({_DIGITS.sub("0", t[1]) for t in page if t[0] == "open" and t[1].count("/") <= 3}))


def page_counts(page: list[tuple]) -> dict[int, tuple[int, int, bool]]:
    """token -> (occurrences, first place in millionths of the page, is a tag)."""
    out: dict[int, tuple[int, int, bool]] = {}
    for place, t in enumerate(page):
        h = _hash(t[0], t[1], t[2] if t[0] == "text" else "")
        n, first, _ = out.get(h, (0, place * 1_000_000 // max(1, len(page) - 1), True))
        out[h] = n + 1, first, t[0] != "text"
    return out


def extract(page: str, template: set[int], layouts: dict[int, set[int]] | None = None) -> tuple[str, int]:
    """(main text, template tokens met).  ``layouts``: what each layout adds to the template."""
    walk = list(tokens(page))
    if layouts:
        template = template | layouts.get(layout_of(walk), set())
    blocks: list[tuple[str, bool, str]] = []  # (zone, is a template token, text)
    met = 0
    for t in walk:
        known = _hash(t[0], t[1], t[2] if t[0] == "text" else "") in template if template else False
        met += known
        if t[0] == "text" and t[3] != "drop":
            blocks.append((t[3], known, t[2]))
    zones = {zone for zone, _, _ in blocks}
    best = next((z for z in ("article", "main") if z in zones), "")
    inside = [(known, x) for zone, known, x in blocks if zone == best]
    repeated, own = ([x for known, x in inside if known == k] for k in (True, False))
    near_copy = best and len(repeated) > len(own) and sum(map(len, repeated)) > sum(map(len, own))
    return " ".join(x for known, x in inside if near_copy or not known), met


#: Layout 0 is the host as a whole; token 0 counts the pages.
_COUNTS = "host string, layout long, token long, lo long, hi long, pages long, place long, tag boolean"


def occurrence_classes(pages: DataFrame) -> DataFrame:
    """host, layout, class, token, pages, place, tag: the valid equivalence classes.

    A class's id is its vector's fingerprint; ``place`` is the mean first
    place of the token, by which classes nest and tokens follow each other.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "html", 4 << 20):
                sums: dict = {}
                for page_id, url, page in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                    host = host_of(url)
                    if not host or not page:
                        continue
                    walk = list(tokens(page))
                    groups = [sums.setdefault((host, k), {0: [0, 0, 0, 0, True]}) for k in (0, layout_of(walk))]
                    for group in groups:
                        group[0][2] += 1
                    for token, (n, place, tag) in page_counts(walk).items():
                        v = _hash(str(page_id), url, str(n)) & (1 << 64) - 1
                        for group in groups:
                            s = group.setdefault(token, [0, 0, 0, 0, tag])
                            s[0] += v & 0xFFFFFFFF
                            s[1] += v >> 32
                            s[2] += 1
                            s[3] += place
                if sums:
                    cols = list(zip(*((h, k, t, *s) for (h, k), group in sums.items() for t, s in group.items())))
                    kinds = (pa.string(), *[pa.int64()] * 6, pa.bool_())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                     names=["host", "layout", "token", "lo", "hi", "pages", "place", "tag"])

    counts = _once(pages).mapInArrow(run, _COUNTS)
    vectors = counts.groupBy("host", "layout", "token").agg(*(F.sum(c).alias(c) for c in ("lo", "hi", "pages", "place")), F.first("tag").alias("tag"))
    vectors = written(vectors.where(F.col("pages") >= CLASS_PAGES), "vectors")
    sizes = vectors.where("token = 0").select("host", "layout", F.col("pages").alias("group_pages"))
    frequent = vectors.where("token <> 0").join(sizes, ["host", "layout"]).where(F.col("pages") >= F.col("group_pages") * CLASS_SHARE)
    large = frequent.groupBy("host", "layout", "lo", "hi").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= CLASS_TOKENS)
    return frequent.join(large, ["host", "layout", "lo", "hi"]).select(
        "host", "layout", F.xxhash64("lo", "hi").alias("class"), "token", "pages", (F.col("place") / F.col("pages")).alias("place"), "tag")


def _once(pages: DataFrame) -> DataFrame:
    """One page of a host for each article (or main) element, or else each whole page.

    Only keys are shuffled: of a repeated article the smallest (page_id, url)
    stays, by a broadcast join while there are few.  Where rows share that too,
    these rows alone are shuffled whole."""
    inner = F.regexp_extract("html", r"(?is)<(?:article|main)\b.*</(?:article|main)\s*>", 0)
    body = F.xxhash64(F.when(inner != "", inner).otherwise(F.col("html")))
    rows = pages.where("html IS NOT NULL AND html <> ''").withColumn("body", F.xxhash64(_host_column("url"), body))
    name = F.struct("page_id", "url")
    times = rows.groupBy("body", "page_id", "url").agg(F.count(F.lit(1)).alias("n")).groupBy("body").agg(
        F.sum("n").alias("n"), F.min(F.struct(name.alias("name"), "n")).alias("won"))
    again = written(times.where("n > 1").select(F.col("body").alias("again"), "won.name", F.col("won.n").alias("copies")), "again")
    few = again.count() <= BROADCAST_IDS
    found = rows.join(F.broadcast(again) if few else again, F.col("body") == F.col("again"), "left").where(
        F.col("again").isNull() | name.eqNullSafe(F.col("name")))
    if again.where("copies > 1").isEmpty():
        return found.select("page_id", "url", "html")
    plain = found.where("copies IS NULL OR copies = 1")
    return plain.unionByName(found.where("copies > 1").dropDuplicates(["body"])).select("page_id", "url", "html")


def _host_column(url: str):
    inner = F.regexp_extract(F.col(url), r"^\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1)
    return F.lower(F.regexp_replace(inner, "^.*@", ""))


def templates(classes: DataFrame) -> DataFrame:
    """host, template, layouts: the tokens of the nested classes in page order,
    and those that each layout adds to them.

    A class whose span (first to last token) crosses the span of the group's
    skeleton, its most frequent class, is not nested in it and is left out.
    """
    group = ["host", "layout"]
    spans = classes.groupBy(*group, "class").agg(F.min("place").alias("a"), F.max("place").alias("b"), F.max("pages").alias("p"),
                                                 F.count(F.lit(1)).alias("n"))
    root = spans.groupBy(*group).agg(F.max_by(F.struct("a", "b"), F.struct("p", "n", "class")).alias("r"))
    nested = spans.join(root, group).where((F.col("a") >= F.col("r.a")) & (F.col("b") <= F.col("r.b"))).select(*group, "class")
    kept = classes.join(nested, [*group, "class"]).groupBy("host", "token").agg(
        F.max_by("place", F.col("layout") == 0).alias("place"), F.collect_set("layout").alias("in"))
    # what the host's template holds, its layouts need not repeat
    own = kept.select("host", "place", "token", F.explode(F.when(F.array_contains("in", F.lit(0).cast("long")), F.array(F.lit(0).cast("long")))
                                                          .otherwise(F.col("in"))).alias("layout"))
    lists = own.groupBy(*group).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "token"))), lambda x: x["token"]).alias("t"))
    return lists.groupBy("host").agg(F.first(F.when(F.col("layout") == 0, F.col("t")), ignorenulls=True).alias("template"),
                                     F.collect_list(F.when(F.col("layout") != 0, F.struct("layout", "t"))).alias("layouts"))


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, template_tokens for every row of pages."""
    reach_workers(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    found = written(templates(occurrence_classes(rows)), "templates")
    joined = rows.withColumn("host", _host_column("url")).join(found, "host", "left").select("page_id", "url", "html", "template", "layouts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, "html", 4 << 20):
                text, met = [], []
                for page, template, layouts in zip(*(batch.column(c).to_pylist() for c in ("html", "template", "layouts"))):
                    t, n = extract(page, set(template or ()), {x["layout"]: set(x["t"]) for x in layouts or ()}) if page else ("", 0)
                    text.append(t)
                    met.append(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()),
                     pa.array(met, pa.int64())], names=["page_id", "url", "text", "n_chars", "template_tokens"])

    return joined.mapInArrow(run, "page_id long, url string, text string, n_chars long, template_tokens long")
