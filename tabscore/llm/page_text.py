"""Main text of web pages by equivalence-class template deduction.

Tokens of a page are its tags, told apart by their path of tags and classes, and its text chunks, told apart by path and text.  Per host, tokens
with the same occurrence vector (how often on which page) form an equivalence class.  The vector travels as a
sum of hashes of (page, count), which combines map-side, so a host with a third of all pages is no hot group.  A class
is valid if it is large (three tokens, two of them tags), frequent (on at least ``SUPPORT`` pages and on half of the host's)
and nested: its tokens hang below one other class.  Valid classes nest into the host's template; what is between their
tokens are slots.

A page's main text is the text in the slots of its article (``article``, else ``main``, else the body), without
slots of menus, headers, footers, sidebars, notices, adverts, forms and comments (by tag, role and class), and without blocks whose
text is part of the template.  A page that would lose most of its article to the template is one of several copies, not an
instance, and keeps it.

Defined results: null or empty html gives an empty text; pages without a host in the url share no template; repeated
rows give repeated rows; a null id or url stays null; extra columns are ignored; unclosed and stray tags, comments and quotes never
fail: what cannot be a tag is text.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscore.llm.common import keep, read

SUPPORT = 5
#: Template tokens (8 bytes each) of all hosts up to which they are sent to all executors (counted first).
BROADCAST_ROWS = 200_000

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
                 r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)""", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
CLASS = re.compile(r"""\bclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose content is no markup.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s",
          "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "picture", "source"}
#: Elements that end an open element of the second set.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ASIDE_TAGS = {"head", "nav", "header", "footer", "aside", "form", "button", "select", "option", "dialog", "svg", "object", "template", "menu", "canvas", "audio", "video"} | RAW
ASIDE_WORDS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "sponsors", "promo", "promotion", "banner", "nav", "navbar",
               "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "sidebars", "aside", "widget", "widgets", "footer", "header", "masthead", "cookie", "cookies", "consent", "gdpr", "notice",
               "notices", "notification", "alert", "popup", "modal", "newsletter", "subscribe", "subscription", "signup", "login", "search", "share", "sharing", "social", "related",
               "recommended", "recommendations", "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "pagination", "pager", "copyright", "disclaimer", "contentinfo",
               "complementary", "topbar", "toolbar", "skip"}
KEEPS = {"html", "body", "main", "article"}


class Parsed:
    """Tags' paths and text chunks of a page.  ``chunks``: (path, text, block number, aside, in article, in main)."""

    def __init__(self, page: str):
        self.tags: list[str] = []
        self.chunks: list[tuple] = []
        self.stack: list[tuple] = []  # (name, path, aside, article, main)
        self.block = 0
        at, end = 0, len(page)
        for m in iter(lambda: TAG.search(page, at), None):
            if m.start() > at:
                self.text(page[at:m.start()])
            at = m.end()
            name = m["name"] or m["name2"]
            if name:
                name = name.lower()
                if m["end"] or m["end2"]:
                    self.close(name)
                else:
                    rest = m["rest"] or m["rest2"] or ""
                    self.open(name, rest)
                    if name in RAW and not rest.endswith("/"):
                        stop = re.compile(f"</{name}[^>]*(?:>|\\Z)", re.I).search(page, at)
                        at = stop.end() if stop else end
                        self.stack.pop()
            elif at == m.start():
                break
        if at < end:
            self.text(page[at:])

    def open(self, name: str, rest: str) -> None:
        if name not in INLINE and name != "br":
            self.block += 1
            self.drop("p", stop=("table", "button", "object", "td", "th", "li"))
            if name in CLOSES:
                while self.stack and any(x[0] in CLOSES[name] for x in self.stack[-1:]):
                    self.stack.pop()
                if name in ("li", "dt", "dd"):
                    for i in range(len(self.stack) - 1, -1, -1):
                        if self.stack[i][0] in CLOSES[name]:
                            del self.stack[i:]
                            break
                        if self.stack[i][0] not in INLINE | {"p", "div"}:
                            break
        _, path, aside, article, main = self.stack[-1] if self.stack else ("", "", False, False, False)
        cls = CLASS.search(rest) if rest else None
        mark = f"{name}.{'.'.join((cls[1] or cls[2] or cls[3] or '').lower().split())}" if cls else name
        path = f"{path}/{mark}"
        self.tags.append(path)
        if name in VOID:
            if name == "br":
                self.text("\n")
            return
        if name not in KEEPS and not aside:
            aside = name in ASIDE_TAGS or any(w in ASIDE_WORDS for x in NAMES.findall(rest) for w in re.split(r"[^a-z0-9]+", "".join(x).lower()))
        elif name == "article" and not aside:  # a reader's comment may be an article of its own
            aside = any(w in ("comment", "comments", "reply", "related", "ad", "advert") for x in NAMES.findall(rest) for w in re.split(r"[^a-z0-9]+", "".join(x).lower()))
        main = main or name == "main" or bool(re.search(r"""\brole\s*=\s*["']?main\b""", rest, re.I))
        self.stack.append((name, path, aside, article or (name == "article" and not aside), main))

    def close(self, name: str) -> None:
        if name not in INLINE:
            self.block += 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                del self.stack[i:]
                return
            if name in INLINE and self.stack[i][0] not in INLINE:
                return  # a stray end of an inline element

    def drop(self, name: str, stop: tuple) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                del self.stack[i:]
                return
            if self.stack[i][0] in stop or self.stack[i][0] not in INLINE:
                return

    def text(self, raw: str) -> None:
        if raw and (not raw.isspace() or self.chunks):
            _, path, aside, article, main = self.stack[-1] if self.stack else ("", "", False, False, False)
            self.chunks.append((path, raw, self.block, aside, article, main))

    def tokens(self) -> dict[tuple[str, bool], int]:
        """How often each token occurs: (path, is a tag) or (path and text, no tag)."""
        out: dict = {}
        for path in self.tags:
            out[path, True] = out.get((path, True), 0) + 1
        for path, raw, *_ in self.chunks:
            if not raw.isspace():
                k = chunk_token(path, raw), False
                out[k] = out.get(k, 0) + 1
        return out

    def blocks(self) -> list[tuple[str, list[str]]]:
        """Text and chunk tokens of the article's blocks in page order."""
        wanted = [c for c in self.chunks if not c[3]]
        for place in (4, 5):
            if any(c[place] and not c[1].isspace() for c in wanted):
                wanted = [c for c in wanted if c[place]]
                break
        out, now = [], None
        for path, raw, block, *_ in wanted:
            if block != now:
                out.append(([], []))
                now = block
            out[-1][0].append(raw)
            if not raw.isspace():
                out[-1][1].append(chunk_token(path, raw))
        done = ((" ".join(entities.unescape("".join(a)).split()), b) for a, b in out)
        return [(t, b) for t, b in done if t]


def chunk_token(path: str, raw: str) -> str:
    return f"{path}\x00{' '.join(raw.split())}"


def number(token: str) -> int:
    """Signed 64-bit hash of a token."""
    import xxhash
    x = xxhash.xxh64_intdigest(token.encode("utf-8", "replace"))
    return x - (1 << 64) if x >> 63 else x


def main_text(page: str | None, template: frozenset = frozenset()) -> tuple[str, int, int]:
    """Text, number of blocks, and number of blocks left to the template."""
    blocks = Parsed(page).blocks() if page else []
    own = [t for t, tokens in blocks if not (template and all(number(x) in template for x in tokens))]
    if 2 * sum(map(len, own)) < sum(len(t) for t, _ in blocks):
        own = [t for t, _ in blocks]
    return "\n\n".join(own), len(own), len(blocks) - len(own)


# ---- template deduction ---------------------------------------------------------------------------------------------

def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#]*)", 1))


def token_counts(pages: DataFrame) -> DataFrame:
    """``(host, page, token, parent, is_tag, n)``: occurrences of each token on each page; ``parent``: the enclosing tag."""
    import pandas as pd

    def run(batches):
        for batch in batches:
            rows = []
            for host, page, source in zip(batch["host"], batch["page"], batch["html"]):
                for (token, is_tag), n in Parsed(source).tokens().items():
                    up = token.rpartition("/")[0] if is_tag else token.partition("\x00")[0]
                    rows.append((host, page, number(token if is_tag else token), number(up), is_tag, n))
            yield pd.DataFrame(rows, columns=["host", "page", "token", "parent", "is_tag", "n"]).astype({"page": "int64", "token": "int64", "parent": "int64", "n": "int64", "is_tag": "bool"})

    src = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"),
                       F.xxhash64(F.col("page_id").cast("string"), F.col("url").cast("string"), F.col("html").cast("string")).alias("page"))
    return src.where("host != '' and html is not null").mapInPandas(run, "host string, page long, token long, parent long, is_tag boolean, n long")


def templates(pages: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Template of each host, one row per token: host, token, is_tag, class_id, parent_class (null: outermost), support, n_pages."""
    counts = token_counts(pages)
    vector = F.sum(F.xxhash64("page", "n").cast("decimal(38,0)"))
    tokens = keep(counts.groupBy("host", "token").agg(vector.alias("vector"), F.count("*").alias("support"), F.first("parent").alias("parent"),
                                                      F.first("is_tag").alias("is_tag")))
    # every page has one html or first tag; a host's pages are its most frequent token's, at most
    size = tokens.groupBy("host").agg(F.max("support").alias("n_pages"))
    frequent = tokens.join(size, "host").where((F.col("support") >= support) & (2 * F.col("support") >= F.col("n_pages")))
    frequent = keep(frequent.withColumn("class_id", F.xxhash64("host", F.col("vector").cast("string"), "support")))
    up = frequent.where("is_tag").select("host", F.col("token").alias("parent"), F.col("class_id").alias("above"))
    placed = frequent.join(up, ["host", "parent"], "left")
    foreign = F.when(F.col("above") != F.col("class_id"), F.col("above"))
    classes = placed.groupBy("host", "class_id").agg(F.count("*").alias("size"), F.count_if("is_tag").alias("tags"), F.collect_set(foreign).alias("parents"))
    # outermost tokens of a class hang below one other class (or none): it is nested, not interleaved
    valid = classes.where("size >= 3 and tags >= 2").select("host", "class_id", F.when(F.size("parents") == 1, F.col("parents")[0]).alias("parent_class"), F.size("parents").alias("k"))
    return placed.join(valid, ["host", "class_id"]).where("k <= 1 or class_id = above or is_tag = false").select(
        "host", "token", "is_tag", "class_id", "parent_class", "support", "n_pages")


def extract(pages: DataFrame, support: int = SUPPORT) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks, n_template (blocks left to the template) of every page."""
    import pyarrow as pa
    # at most twice the tokens of a page per host: each is on half of its pages
    fixed = keep(templates(pages, support).where("not is_tag").groupBy("host").agg(F.collect_set("token").alias("fixed")))
    total = fixed.select(F.sum(F.size("fixed") + 10)).first()[0] or 0
    side = F.broadcast(fixed) if total <= BROADCAST_ROWS else fixed
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host")).join(side, "host", "left")

    def run(batches):
        for batch in batches:
            out = [main_text(source, frozenset(known or ())) for source, known in zip(batch.column("html").to_pylist(), batch.column("fixed").to_pylist())]
            if out:
                text, blocks, left = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64()),
                     pa.array(blocks, pa.int64()), pa.array(left, pa.int64())], names=["page_id", "url", "text", "n_chars", "n_blocks", "n_template"])

    kinds = dict(pages.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long, n_blocks long, n_template long")


def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages``: page_id, url, text, n_chars, n_blocks, n_template."""
    return extract(read(spark, sf_dir, "pages"))


QUERIES = {"op2_page_text": op2_page_text}
