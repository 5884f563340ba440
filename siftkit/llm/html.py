"""Operator 7: main text of web pages, with repeated text of a host found by suffix arrays."""

from __future__ import annotations

import hashlib
import html as _entities
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import prepare, store, table

GROUP_PAGES = 256            # pages of a host whose token streams are joined in one task
GROUP_CHARS = 16 << 20       # and the characters of such a group
DEPTH = 8                    # tokens that a repeated substring has at least
MIN_PAGES = 5                # different pages of a host that a repeated substring is boilerplate from
SHARE_PCT = 50               # and the share of the host's different pages
ARTICLE_REST_PCT = 70        # what stays of an article at least, else it is a copy and stays whole

RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas"}
DROPPED = {"nav", "aside", "footer", "form", "button", "select", "menu", "dialog", "label", "head"}
EMBEDDED = {"noscript", "template", "svg", "math", "object", "canvas"}     # of these, passed over where never closed
BLOCKS = {"p", "div", "section", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "dl", "dt",
          "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "blockquote", "pre", "figure", "figcaption", "header", "hr",
          "body", "html", "address", "details", "summary", "fieldset", "center"} | DROPPED
BOXES = {"div", "section", "article", "main", "header", "ul", "ol", "dl", "table", "blockquote", "figure", "body",
         "details", "span", "li"} | DROPPED
UNWANTED = {"ad", "ads", "adv", "advert", "advertisement", "adbox", "banner", "sponsor", "sponsored", "promo",
            "promotion", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer",
            "header", "cookie", "cookies", "consent", "notice", "notices", "popup", "modal", "newsletter", "subscribe",
            "share", "sharing", "social", "related", "recommended", "comment", "comments", "reply", "replies",
            "disqus", "widget", "toolbar", "pagination", "pager", "copyright", "hidden"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>"']|"[^"]*+"|'[^']*+')*+)>"""
                    r"""|<[!?][^>]*+>?""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)


def _unwanted(attrs: str, in_article: bool) -> bool:
    """Whether role, hidden mark, class or id words say so; a header inside an article holds its title and stays."""
    words = UNWANTED - {"header"} if in_article else UNWANTED
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role" and value.strip() in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name in ("class", "id"):
            for word in value.split():
                if word in words or words & set(re.split(r"[-_]", word)):
                    return True
    return False


def blocks_of(html: str | None) -> tuple[list[str], bool]:
    """The text blocks of a page in page order, and whether they stem from an article (or main) element.

    Where there is an article its blocks are the text; else all blocks
    outside unwanted elements. A closing tag without its opening one is
    passed over; elements that stay open end with the page, but an embedded
    object that is never closed is passed over alone.
    """
    html = html or ""
    inside, outside = [], []
    part: list[str] = []
    boxes: list[tuple[str, bool, bool]] = []     # open elements: name, unwanted, article
    dropped = articles = 0
    endless: set[str] = set()                    # raw elements without a closing tag in the rest of the page
    at = 0

    def flush() -> None:
        if part:
            block = " ".join("".join(part).split())
            part.clear()
            if block:
                (inside if articles else outside).append(block)

    for m in iter(lambda: _TOKEN.search(html, at), None):
        if not dropped and m.start() > at:
            part.append(_entities.unescape(html[at:m.start()]))
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name in BLOCKS:
                flush()
            if name in BOXES and any(b[0] == name for b in boxes):
                while boxes:
                    box = boxes.pop()
                    dropped -= box[1]
                    articles -= box[2]
                    if box[0] == name:
                        break
            continue
        if name in RAW:
            if not m[3].endswith("/") and name not in endless:
                close = re.compile(rf"</{name}\s*>", re.I).search(html, at)
                if close:
                    at = close.end()
                elif name in EMBEDDED:
                    endless.add(name)
                else:
                    at = len(html)
            part.append(" ")
            continue
        if name == "br":
            part.append(" ")
        if name in BLOCKS:
            flush()
        if name in BOXES and not m[3].endswith("/"):
            bad = name in DROPPED or (name == "header" and not articles) or (bool(m[3]) and _unwanted(m[3], articles > 0))
            article = name in ("article", "main") and not bad
            boxes.append((name, bad, article))
            dropped += bad
            articles += article
    if not dropped and at < len(html):
        part.append(_entities.unescape(html[at:]))
    flush()
    return (inside, True) if inside else (outside, False)


def repeated(streams: list[list[int]], depth: int) -> tuple[list, list]:
    """For each token place of each page: the rank of the substring of ``depth`` tokens there, and on how many pages it is.

    The suffixes of the joined streams are sorted by prefix doubling up to
    ``depth`` tokens (a suffix array cut off there); equal ranks are
    substrings in common. Separators differ, so none runs over a page's end.
    """
    import numpy as np
    lengths = np.array([len(s) for s in streams])
    page = np.repeat(np.arange(len(streams)), lengths + 1)
    width = int(max((max(s, default=0) for s in streams), default=0)) + 1
    tokens = np.concatenate([np.append(np.asarray(s, dtype=np.int64), width + k) for k, s in enumerate(streams)])
    rank, step = tokens, 1
    while step < depth:
        ahead = np.full(len(rank), -1, dtype=np.int64)
        ahead[:-step] = rank[step:] if step < len(rank) else ahead[:-step]
        rank = np.unique(rank * (int(rank.max()) + 2) + ahead + 1, return_inverse=True)[1]
        step *= 2
    order = np.lexsort((page, rank))                            # the suffix array: by rank, then page
    new = np.ones(len(order), dtype=bool)
    new[1:] = (rank[order][1:] != rank[order][:-1]) | (page[order][1:] != page[order][:-1])
    pages = np.bincount(rank[order][new], minlength=int(rank.max()) + 1)[rank]
    ends = np.cumsum(lengths + 1)
    room = np.repeat(ends - 1, lengths + 1) - np.arange(len(tokens))   # tokens left on the page
    pages = np.where(room >= depth, pages, 0)
    cut = np.split(pages, ends[:-1])
    return [c[:-1] for c in cut], lengths.tolist()


def _cover(starts, depth: int):
    """Which tokens lie in a substring of ``depth`` tokens that starts at a marked place."""
    import numpy as np
    hit = np.zeros(len(starts) + 1, dtype=np.int64)
    start = np.flatnonzero(starts)
    np.add.at(hit, start, 1)
    np.add.at(hit, np.minimum(start + depth, len(starts)), -1)
    return np.cumsum(hit)[:-1] > 0


def _tokens(blocks) -> list[str]:
    return [w for b in blocks for w in b.split(" ")]


def _unpack_all(packed: pd.Series) -> pd.Series:
    return packed.map(_unpack)


def window_keys(tokens: list[str], hashes: dict[str, int], depth: int = DEPTH):
    """A 64-bit key of the ``depth`` tokens at each place of a page where so many are left, the same in every task."""
    import numpy as np
    for w in tokens:
        if w not in hashes:
            hashes[w] = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
    n = len(tokens) - depth + 1
    keys = np.zeros(max(n, 0), dtype=np.uint64)
    if n > 0:
        each = np.array([hashes[w] for w in tokens], dtype=np.uint64)
        for k in range(depth):
            keys = keys * np.uint64(0x9E3779B97F4A7C15) + each[k:k + n]
    return keys.view(np.int64)


_PARSED = ("page_id long, url string, host string, packed binary, article boolean, content string, chars long, "
           "first boolean")


def _pack(text: str) -> bytes:
    """A page's text as it is stored and shuffled: compressed, since every pass carries whole texts."""
    return zlib.compress(text.encode("utf-8"), 4)


def _unpack(packed: bytes) -> str:
    return zlib.decompress(packed).decode("utf-8")


def _blocks(packed: bytes) -> list[str]:
    text = _unpack(packed)
    return text.split("\n\n") if text else []


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of each page, a key of its text, and whether it is the task's first page of that host with that text."""
    seen: set[tuple[str, str]] = set()
    for pdf in batches:
        parsed = [blocks_of(h) for h in pdf["html"]]
        texts = ["\n\n".join(blocks) for blocks, _ in parsed]
        contents, first = [], []
        for host, text, (_, article) in zip(pdf["host"], texts, parsed, strict=True):
            contents.append(hashlib.md5(f"{int(article)}{text}".encode()).hexdigest())
            first.append((host, contents[-1]) not in seen)
            seen.add((host, contents[-1]))
        yield pd.DataFrame({"page_id": pdf["page_id"].astype("Int64"), "url": pdf["url"], "host": pdf["host"],
                            "packed": [_pack(t) for t in texts], "article": [a for _, a in parsed], "content": contents,
                            "chars": [len(t) for t in texts], "first": first})


def _frequent(pdf: pd.DataFrame) -> pd.DataFrame:
    """The substrings that are on the needed share of a group's pages, by the suffix array of the group."""
    import numpy as np
    host, part = pdf["host"].iloc[0], pdf["part"].iloc[0]
    words = [_tokens(_blocks(p)) for p in pdf["packed"]]
    vocabulary: dict[str, int] = {}
    counts = repeated([[vocabulary.setdefault(w, len(vocabulary)) for w in ws] for ws in words], DEPTH)[0]
    least = -(-len(pdf) * SHARE_PCT // 100)
    hashes: dict[str, int] = {}
    found: set[int] = set()
    for ws, pages in zip(words, counts, strict=True):
        often = np.flatnonzero(pages >= max(least, 1))
        if len(often):
            found.update(window_keys(ws, hashes)[often].tolist())
    return pd.DataFrame({"host": host, "part": part, "window": sorted(found)}).astype({"window": "int64", "part": "int64"})


def _count(pages: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """On how many pages of a group each asked substring is."""
    import numpy as np
    if not len(pages) or not len(asked):
        return pd.DataFrame({"host": pd.Series(dtype=object), "window": pd.Series(dtype="int64"), "pages": pd.Series(dtype="int64")})
    windows = np.unique(asked["window"].to_numpy())
    seen = np.zeros(len(windows), dtype=np.int64)
    hashes: dict[str, int] = {}
    for packed in pages["packed"]:
        keys = np.unique(window_keys(_tokens(_blocks(packed)), hashes))
        seen += np.isin(windows, keys)
    return pd.DataFrame({"host": pages["host"].iloc[0], "window": windows, "pages": seen})


def _clean(pages: pd.DataFrame, boilerplate: pd.DataFrame) -> pd.DataFrame:
    """The texts that change when the tokens covered by a host's boilerplate go."""
    import numpy as np
    out = []
    windows = boilerplate["window"].to_numpy()
    hashes: dict[str, int] = {}
    for host, content, packed, article in zip(pages["host"], pages["content"], pages["packed"], pages["article"], strict=True):
        blocks = _blocks(packed)
        tokens = _tokens(blocks)
        starts = np.zeros(len(tokens), dtype=bool)
        keys = window_keys(tokens, hashes)
        starts[:len(keys)] = np.isin(keys, windows)
        covered = _cover(starts, DEPTH)
        if not covered.any() or article and (~covered).sum() * 100 < len(covered) * ARTICLE_REST_PCT:
            continue
        kept, at = [], 0
        for b in blocks:
            words = b.split(" ")
            left = " ".join(w for w, c in zip(words, covered[at:at + len(words)], strict=True) if not c)
            at += len(words)
            if left:
                kept.append(left)
        out.append((host, content, "\n\n".join(kept)))
    return pd.DataFrame(out, columns=["host", "content", "cleaned"]).astype(object)


def _deal(parsed: DataFrame, hosts: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """The different pages of the hosts (of ``only``), dealt by their text into each host's groups.

    Copies go in their task where they are read, then after the one shuffle of the texts: rows equal in
    text share a group, and the aggregation there spills instead of gathering them.
    """
    pages = parsed.filter("first").select("host", "content", "packed", "article")
    if only is not None:
        pages = pages.join(only, "host", "left_semi")
    return (pages.join(hosts.select("host", "groups"), "host")
            .withColumn("part", F.pmod(F.xxhash64("content"), "groups")).drop("groups").repartition("host", "part")
            .groupBy("host", "part", "content").agg(F.first("packed").alias("packed"), F.first("article").alias("article")))


def host_boilerplate(parsed: DataFrame, hosts: DataFrame) -> DataFrame:
    """The substrings of ``DEPTH`` tokens on enough pages of their whole host: rows (host, window, groups).

    ``hosts`` holds the number of different pages and of groups of each host. What is on a share of a
    host's pages is on that share of at least one of its groups, so the groups' suffix arrays give all
    candidates; a second pass counts those on every group of the hosts that have any, and Spark adds the
    counts up. A longer repeated substring is covered by its windows of ``DEPTH`` tokens, each on as many pages.
    """
    asked = store(_deal(parsed, hosts).select("host", "part", "packed").groupBy("host", "part")
                  .applyInPandas(_frequent, "host string, part long, window long")
                  .select("host", "window").distinct().join(hosts, "host"), "page-asked")
    everywhere = asked.select("host", "window", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))
    pages = _deal(parsed, hosts, asked.select("host").distinct())
    counted = (pages.select("host", "part", "packed").groupBy("host", "part")
               .cogroup(everywhere.groupBy("host", "part")).applyInPandas(_count, "host string, window long, pages long")
               .groupBy("host", "window").agg(F.sum("pages").alias("pages")))
    return store(counted.join(hosts, "host").filter((F.col("pages") >= MIN_PAGES)
                                                    & (F.col("pages") * 100 >= F.col("n") * SHARE_PCT))
                 .select("host", "window", "groups"), "page-boilerplate")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page.

    Markup, menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles and reader comments go by their elements, classes and
    roles. Then the token streams of the different pages of a host are joined and a
    suffix array gives the substrings of ``DEPTH`` tokens or more that
    different pages share; tokens covered by those on ``MIN_PAGES`` and
    ``SHARE_PCT`` of the host's pages go, and unique runs stay. An article
    of which less than ``ARTICLE_REST_PCT`` would be left is a copy and stays whole.

    A host with many pages is dealt into groups, so no host lies in one
    task, and the counts of its groups are added up (:func:`host_boilerplate`): the result does not depend
    on the dealing. The html is read once; pages of equal text on a host count once and are cleaned once.

    Null and empty html: empty text. A null or unusual url is a host of its
    own kind (empty). Repeated rows give a result row each. No rows: no
    rows. Extra columns are ignored. Long pages are taken whole.

    Returns page_id, url, text, n_chars.
    """
    host = F.coalesce(F.lower(F.regexp_extract(url_col, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html"))
    parsed = store(rows.mapInPandas(_parse, _PARSED), "page-blocks")
    sizes = parsed.filter("first").groupBy("host", "content").agg(F.max("chars").alias("chars"))
    hosts = store(sizes.groupBy("host").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")).filter(F.col("n") >= MIN_PAGES)
                  .select("host", "n", F.greatest(F.ceil(F.col("n") / GROUP_PAGES), F.ceil(F.col("chars") / GROUP_CHARS),
                                                  F.lit(1)).cast("long").alias("groups")), "page-hosts")
    boilerplate = host_boilerplate(parsed, hosts)
    told = boilerplate.select("host", "window", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"))
    changed = (_deal(parsed, hosts, boilerplate.select("host").distinct()).groupBy("host", "part")
               .cogroup(told.groupBy("host", "part")).applyInPandas(_clean, "host string, content string, cleaned string"))
    out = parsed.join(store(changed, "page-changed"), ["host", "content"], "left")
    text = F.coalesce("cleaned", F.pandas_udf(_unpack_all, "string")(F.col("packed")))
    return out.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


def op7_host_suffix_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return extract_main_text(table(spark, sf_dir, "pages"))
