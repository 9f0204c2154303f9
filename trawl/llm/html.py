"""Main-text extraction by equivalence-class template deduction.

1. Every page is read into blocks: the text between block-level tags, entities
   decoded and white space collapsed, each with the path of the tags around it.
   A tag's class, id and role belong to its path (without digits), so ``div.ad`` and
   ``div.body`` are different tokens.
2. Across the pages of a host every path has an occurrence vector: how often
   each page has it.  Spark sums a fingerprint of the vector per (host, path), so
   no host is gathered, whatever its share of the pages.  Paths with one
   vector form an equivalence class.
3. A class is valid when it has enough pages and each of its paths continues a
   path of its own or of a class that occurs on at least as many pages; valid
   classes nest into the host's template.  Paths of invalid classes are markup inside a slot of the
   template and get that slot's label.
4. A slot is content if its text varies between the host's distinct pages and
   is not mostly links.  A constant or linked slot beside content slots, under the same element
   and between them on the pages (a heading: before one), is part of the content.  An article or main element that a page has once is
   evidence: links do not count against it, and where too few distinct pages
   show a slot to judge it, it decides.  A path of an invalid class that lies in a
   constant slot is judged by itself.
5. A page's text is its content blocks in page order, without those under
   a boilerplate tag or cue (menus, headers, footers, sidebars, notices,
   adverts, forms, comments).  Inside an article a compound class is a cue only if all its
   words are cues or name a container (``share-buttons``, not ``social-history``).  A cue is undone for the wrapper that holds the
   page's content: a weak one (a form, a cue word in a compound such as
   ``with-sidebar``) if the only article is below it or nothing else but headings is
   left, a strong one if the only article is below it and nothing else is left.

Cases: null or empty html gives the empty text; a null url is the host ``""``; pages on
a host of their own are their own template (nothing varies, so no
slot is dropped as constant); unclosed and misnested tags, comments and
quotes are read leniently; copies of a page, which differ in boilerplate at
most, count as one page when constancy is judged; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm import common

LEAST_PAGES = 3                # a slot's text is judged constant from so many pages on
LEAST_SHARE = 0.02             # of the host's pages, for a valid class
LINK_SHARE = 0.5
BROADCAST_BYTES = 32 << 20
BATCH_CHARS = 1 << 21

# Element names of HTML.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
         "header", "hgroup", "html", "legend", "li", "main", "menu", "nav", "noscript", "ol", "optgroup", "option", "p", "pre",
         "search", "section", "select", "summary", "svg", "table", "tbody", "td", "template", "tfoot", "th", "thead", "tr", "ul"}
CLOSED_BY_BLOCK = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"},
                  "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr"}, "th": {"tr"}}
BOILERPLATE_TAGS = {"aside", "button", "dialog", "footer", "form", "head", "menu", "nav", "noscript", "search", "select", "svg",
                    "template"}
# Words in class, id and role that mark what is not the main text.
CUES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb", "breadcrumbs",
        "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "copyright", "dialog", "discussion",
        "disqus", "footer", "form", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice",
        "notices", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond",
        "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"}

# Words that name a container whatever it holds.
CONTAINERS = {"area", "bar", "block", "box", "btn", "button", "buttons", "container", "field", "fields", "icon", "icons", "inner", "item",
              "items", "link", "links", "list", "outer", "panel", "row", "section", "wrap", "wrapper"}

_TAG = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_ARTICLE = re.compile(r"(?:article|main)(?![a-z])")
_HEADING = re.compile(r"(?:^|/)h[1-6][^/]*$")
_PAGE = re.compile(r"(?:^|/)(?:html|body)[^/]*$")


def _component(name: str, attrs: str, inside_article: bool) -> str:
    """A tag's token: its name, ``!`` or ``~`` (weak) if it is no main text, and its class, id and role."""
    values = [v for m in _ATTR.finditer(attrs) for v in (m[2] or m[3] or m[4] or "").lower().split()] if attrs else []
    words = [w for v in values for w in _WORD.findall(v)]
    cue = "!" if name in BOILERPLATE_TAGS - {"form"} or name == "header" and not inside_article else ""
    if not cue and name not in ("html", "body"):
        def compound(value: str) -> bool:
            own = _WORD.findall(value)
            return any(w in CUES for w in own) and (not inside_article or all(w in CUES or w in CONTAINERS for w in own))

        cue = "!" if any(v.strip("-_0123456789") in CUES for v in values) else "~" if name == "form" or any(map(compound, values)) else ""
    if "main" in words and any(m[1].lower() == "role" for m in _ATTR.finditer(attrs)):
        name = "main"
    return name + cue + "".join("." + w for w in words)


def blocks(page: str) -> tuple[list[str], list[str], list[int], set[str]]:
    """Paths, texts and linked characters of a page's blocks, in order, and the
    paths of the article and main elements that the page has more than once."""
    paths, texts, links = [], [], []
    articles: set[str] = set()
    repeated: set[str] = set()
    names: list[str] = []
    stack: list[str] = []           # paths of the open block elements
    buf: list[str] = []
    linked, in_link = 0, False

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(buf)).split())
        if text:
            paths.append(stack[-1] if stack else "")
            texts.append(text)
            links.append(min(linked, len(text)))
        buf.clear()
        linked = 0

    at = 0
    while True:
        m = _TAG.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            buf.append(text)
            if in_link:
                linked += len(text)
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        closing = bool(m[1] or m[4])
        if not name:
            continue
        if name in RAW and not closing:
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif name == "a":
            in_link = not closing
        elif name == "br":
            buf.append(" ")
        elif name == "hr":
            flush()
        elif name in BLOCK:
            if not closing or name == "p" or name in names:
                flush()
            if closing:
                if name in names:
                    keep = len(names) - 1 - names[::-1].index(name)
                    del names[keep:], stack[keep:]
                    in_link = False
            else:
                while names and names[-1] in CLOSED_BY_BLOCK:
                    names.pop(), stack.pop()
                if name in CLOSED_BY_SAME:
                    for i in range(len(names) - 1, -1, -1):
                        if names[i] == name or {names[i], name} == {"dt", "dd"} or {names[i], name} == {"td", "th"}:
                            del names[i:], stack[i:]
                            break
                        if names[i] in CLOSED_BY_SAME[name]:
                            break
                inside = any(n in ("article", "main") for n in names)
                part = _component(name, m[3] or m[6] or "", inside)
                names.append(name)
                stack.append(f"{stack[-1]}/{part}" if stack else part)
                if _ARTICLE.match(part):
                    (repeated if stack[-1] in articles else articles).add(stack[-1])
    flush()
    return paths, texts, links, repeated


def _in_article(path: str, repeated: set[str]) -> bool:
    """Whether the outermost article or main element around a block occurs once on its page."""
    parts = path.split("/")
    for i, part in enumerate(parts):
        if _ARTICLE.match(part):
            return "/".join(parts[:i + 1]) not in repeated
    return False


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


PARSED = ("page_id bigint, url string, host string, paths array<string>, texts array<string>, "
          "slot array<string>, times array<int>, first array<int>, last array<int>, chars array<bigint>, linked array<bigint>, said array<bigint>, "
          "article array<boolean>")


def parse_pages(pages: DataFrame) -> DataFrame:
    """Blocks per page, and per distinct path of the page how often it occurs,
    its first and last block, its characters, linked characters and a hash of its text."""
    def parse(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for page in part["html"]:
                paths, texts, links, repeated = blocks(page)
                own: dict[str, list] = {}
                for i, (p, t, n) in enumerate(zip(paths, texts, links, strict=True)):
                    s = own.setdefault(p, [0, 0, 0, [], i, i])
                    s[5] = i
                    s[0] += 1
                    s[1] += len(t)
                    s[2] += n
                    s[3].append(t)
                words, _ = common.word_hashes(["".join(s[3]).replace(" ", "") for s in own.values()])
                rows.append((paths, texts, list(own), [s[0] for s in own.values()], [s[4] for s in own.values()],
                             [s[5] for s in own.values()], [s[1] for s in own.values()],
                             [s[2] for s in own.values()], words.view("int64"), [_in_article(p, repeated) for p in own]))
            out = pd.DataFrame(rows, columns=["paths", "texts", "slot", "times", "first", "last", "chars", "linked", "said", "article"])
            yield pd.concat([part[["page_id", "url", "host"]].astype({"page_id": "Int64"}).reset_index(drop=True), out], axis=1)

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", host_of(F.col("url")).alias("host"),
                        F.coalesce("html", F.lit("")).alias("html"))
    return common.map_pandas(rows, parse, PARSED)


def template(rows: list[dict]) -> dict[str, int]:
    """Label of each path of one host, cues aside: 0 no content, 1 content by its text
    on the pages, 2 content in the pages' article, 3 perhaps content (too few distinct pages).

    ``rows``: path, pages, distinct, times, first and last (means over the pages), vector, chars, linked,
    constant, article; and the host's pages.
    """
    by_path = {r["path"]: r for r in rows}
    classes: dict[tuple, list[str]] = {}
    for r in rows:
        classes.setdefault((r["vector"], r["pages"]), []).append(r["path"])

    def parent(path: str) -> str | None:
        while "/" in path:
            path = path.rpartition("/")[0]
            if path in by_path:
                return path
        return None

    valid = set()
    for (_, pages), members in sorted(classes.items(), key=lambda c: -c[0][1]):
        nested = all((up := parent(p)) is None or by_path[up]["pages"] >= pages for p in members)
        if nested and pages >= LEAST_SHARE * rows[0]["host_pages"]:
            valid.update(members)
    label: dict[str, int] = {}
    for path in sorted(by_path, key=lambda p: p.count("/")):
        r, up = by_path[path], parent(path)
        if path not in valid and up is not None and label[up] and by_path[up]["article"] == r["article"]:
            label[path] = label[up]
        elif r["constant"] and r["distinct"] >= LEAST_PAGES or r["linked"] > LINK_SHARE * r["chars"] and not r["article"]:
            label[path] = 0
        else:
            label[path] = 2 if r["article"] else 1 if r["distinct"] >= LEAST_PAGES else 3
    # Where content begins and ends below each element, by the slots that are content themselves.
    spans: dict[str, tuple[float, float, int]] = {}
    for path, found in label.items():
        r, up = by_path[path], path.rpartition("/")[0] if found else ""
        while up and not _PAGE.search(up):
            low, high, most = spans.get(up, (r["first"], r["last"], found))
            spans[up] = min(low, r["first"]), max(high, r["last"]), found if most == 3 else max(most, found if found < 3 else 0)
            up = up.rpartition("/")[0]
    for path, found in list(label.items()):
        low, high, of = spans.get(path.rpartition("/")[0], (0.0, 0.0, 0))
        r = by_path[path]
        if not found and of and r["last"] < high and (r["first"] > low or _HEADING.search(path)):
            label[path] = of
    return label


def templates(parsed: DataFrame) -> DataFrame:
    """(host, labels map<path, label>)."""
    # Copies of a page have one fingerprint: that of its slots outside boilerplate.
    told = F.filter(F.arrays_zip("slot", "said"), lambda s: ~F.contains(s["slot"], F.lit("!")))
    page = F.xxhash64(F.when(F.size(told) > 0, told).otherwise(F.arrays_zip("slot", "said")))
    slots = parsed.select("host", "page_id", page.alias("page"), F.explode(
        F.arrays_zip("slot", "times", "first", "last", "chars", "linked", "said", "article")).alias("s"))
    token = slots.groupBy("host", F.col("s.slot").alias("path")).agg(
        F.count("*").alias("pages"), F.count_distinct("page").alias("distinct"), F.sum("s.times").alias("times"), F.sum("s.chars").alias("chars"),
        F.avg("s.first").alias("first"), F.avg("s.last").alias("last"),
        F.sum("s.linked").alias("linked"), F.bit_xor(F.xxhash64("page_id", "s.times")).alias("vector"),
        (F.min("s.said") == F.max("s.said")).alias("constant"), F.min("s.article").alias("article"))
    sizes = parsed.groupBy("host").agg(F.count("*").alias("host_pages"))
    # One row per path of the host's template, not per page.
    rows = token.join(sizes, "host").repartition(common.partitions(parsed.sparkSession), "host").sortWithinPartitions("host")

    def deduce(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in common.whole_groups(parts, ["host"]):
            for host, own in part.groupby("host", sort=False):
                found = template(own.to_dict("records"))
                yield pd.DataFrame({"host": host, "path": list(found), "label": list(found.values())})

    return common.map_pandas(rows, deduce, "host string, path string, label int")


def _undone(content: Column) -> Column:
    """The cued wrapper of a page that holds its content after all, or the empty path."""
    def some(test) -> Column:
        return F.filter(content, test)

    def wrapper(found: Column) -> Column:            # of the fewest cues, then of the longest block
        cues = F.transform(found, lambda b: F.struct(
            F.length(F.translate(b["cue"], "!~", "")) - F.length(b["cue"]), F.length(b["text"]), b["cue"].alias("cue")))
        return F.array_max(cues)["cue"]

    def head(b: Column) -> Column:
        return b["path"].rlike("(^|/)h[1-6][^/]*$")

    weak = some(lambda b: (b["cue"] != "") & ~F.contains(b["cue"], F.lit("!")) & ~head(b))
    weak_article = F.filter(weak, lambda b: b["label"] == 2)
    article = some(lambda b: F.contains(b["cue"], F.lit("!")) & (b["label"] == 2))
    return (F.when(F.exists(content, lambda b: (b["cue"] == "") & (b["label"] == 2) & ~head(b)), "")
            .when(F.size(weak_article) > 0, wrapper(weak_article))
            .when(F.exists(content, lambda b: (b["cue"] == "") & ~head(b)), "")
            .when(F.size(weak) > 0, wrapper(weak))
            .when(F.size(article) > 0, wrapper(article)).otherwise(""))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    parsed = common.written(parse_pages(pages), "pages")
    labels = common.written(templates(parsed), "templates")
    size = labels.agg(F.coalesce(F.sum(F.length("path") + F.length("host") + 16), F.lit(0))).first()[0]
    by_host = labels.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("path", "label"))).alias("labels"))
    joined = parsed.select("page_id", "url", "host", "paths", "texts").join(
        F.broadcast(by_host) if size <= BROADCAST_BYTES else by_host, "host", "left")
    marked = joined.withColumn("b", F.filter(F.transform("paths", lambda p, i: F.struct(
        F.try_element_at("labels", p).alias("label"), F.get("texts", i).alias("text"), p.alias("path"),
        F.regexp_extract(p, "^(.*[!~][^/]*)", 1).alias("cue"))), lambda b: b["label"] > 0))
    marked = marked.withColumn("undone", _undone(F.col("b")))
    marked = marked.withColumn("b", F.filter("b", lambda b: (b["cue"] == "") | F.startswith(
        F.concat("undone", F.lit("/")), F.concat(b["cue"], F.lit("/")))))
    article = F.exists("b", lambda b: b["label"] == 2)
    kept = F.filter("b", lambda b: ~article | (b["label"] < 3))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), "\n")
    return marked.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("bigint"))
