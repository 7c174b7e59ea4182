"""Main text of web pages, by template deduction over the pages of a host.

A page is a sequence of tokens: the opening of each block element, named by
its path (the block elements around it with their class or id, digits
folded), and each block of text, named by its path and its words.  Over the
pages of a host, tokens with the same occurrence vector (how often on which
page) form an equivalence class.

A class is *valid* if it has two tokens or more and its pages have
``min_pages`` different main blocks or more.  (The main block of a page is the
longest text at one path that no name hides, so copies of one page have one vote and do
not make their text a template.)  Its texts count only if it is *ordered*: its
tokens come in one order on all its pages.  Valid classes are *nested*: the
innermost element around all tokens of a class has to open in a valid class on
at least as many pages, up to the page itself; a class that hangs in the air
is none.  The texts of nested, ordered classes are the template's own; what
lies between them are the slots, and these are extracted.

Names decide afterwards, on what the template left: slots inside menus,
headers, footers, sidebars, notices, adverts, forms and reader comments go.
On a page with an ``article`` or ``main`` element the slots outside it go as
well; a form or an element with such a name that holds one does not hide it;
of several articles those under the fewest such names are read, so a sidebar's
or a comment's give way to the page's own.  An article's own ``header`` holds
its title and stays.  Words that also name a part of an article (``related``,
``notice``, ``banner``, ``header``, ``footer``) hide one inside it only where
they are its whole class or id.

Inside an ``article`` or ``main`` element a text is template text only if it
stands once on every page of the host: passages that some articles share are
theirs.

Vectors are XORs of per-page hashes, so they combine before the shuffle and
no host's pages meet in one task.  Pages are parsed once; everything after
works on the parsed blocks.  What goes from a page is listed per page, so a
list is no longer than the page, whatever the host.  A host of one page has no
classes and is read by names alone.

Defined cases: null or empty html gives an empty text; null url has no host
and no template; markup that never closes ends with the page; repeated rows
are pages of their own.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from usagelens.llm.shared import arrow, stored

MIN_PAGES = 5

#: HTML's elements by what they mean for a text.
BLOCKS = frozenset("""html body main article section nav aside header footer div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd
    table thead tbody tfoot tr td th caption blockquote pre figure figcaption address form fieldset details summary
    hgroup hr menu dialog center search""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style".split())
HIDDEN = frozenset("""head title noscript template iframe object svg canvas audio video button select textarea nav
    header footer aside form menu dialog search""".split())
WRAPS = frozenset(["form"])  # of the hidden ones, what may also hold a whole page
CONTENT = frozenset("article main".split())
NAMES = frozenset("""ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie
    cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice popup promo related share
    sidebar social sponsored""".split())
AMBIGUOUS = frozenset("banner footer header notice related".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>", re.S)
_RAW_END = {tag: re.compile(f"</{tag}[^>]*+>?", re.I) for tag in RAW}
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORDS = re.compile(r"[^a-z0-9]+")
_DIGITS = re.compile(r"\d+")


class _Element:
    __slots__ = ("tag", "path", "never", "covered", "wraps", "content")

    def __init__(self, tag: str, attributes: str, around: _Element | None):
        names = [(k.lower(), (a or b or c).lower()) for k, a, b, c in _NAMED.findall(attributes)] if attributes else []
        words = {w for _, v in names for w in _WORDS.split(v)}
        self.tag = tag
        label = ".".join([tag, *[_DIGITS.sub("#", v).replace("/", "|") for k, v in names if k != "role"]])
        self.path = f"{around.path}/{label}" if around else label
        opens = tag in CONTENT or ("role", "main") in names
        inside = around.content if around else ""
        whole = {v.strip() for _, v in names}  # inside an article, ambiguous words count only alone
        known = (NAMES - AMBIGUOUS | whole & AMBIGUOUS) if inside else NAMES
        named = not opens and tag not in ("html", "body") and bool(words & known)
        part = named and inside and any(w in known for _, v in names for w in v.split())
        titled = tag == "header" and inside == "article"
        self.never = bool(around and around.never) or bool(part) or (tag in HIDDEN - WRAPS and not titled)
        self.covered = not opens and (bool(around and around.covered) or named or tag in WRAPS)
        self.wraps = (around.wraps if around else 0) + named
        self.content = ("article" if tag == "article" else "main") if opens else inside

    @property
    def hidden(self) -> bool:
        return self.never or self.covered


def blocks(page: str) -> Iterator[tuple[_Element, str]]:
    """(element around it, text) of the blocks of a page, in page order; an
    element that opens gives an empty text."""
    stack = [_Element("", "", None)]
    text: list[str] = []
    at, last = 0, page.rfind(">")  # nothing after the last one is markup

    def flush() -> Iterator[tuple[_Element, str]]:
        whole = " ".join("".join(text).split())
        text.clear()
        if whole:
            yield stack[-1], whole

    while at <= last and (m := _MARKUP.search(page, at)):
        if m.start() > at:
            text.append(entities.unescape(page[at:m.start()]))
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closes, attributes = m[1] or m[4], m[3] or m[6] or ""
        if tag in RAW and not closes:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag == "br":
            text.append(" ")
        elif tag in BLOCKS or tag in HIDDEN:
            yield from flush()
            if closes:
                k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
                if k:
                    del stack[k:]
            elif tag not in VOID:
                if stack[-1].tag == "p" or stack[-1].tag == tag == "li":
                    stack.pop()
                stack.append(_Element(tag, attributes, stack[-1]))
                yield stack[-1], ""
    text.append(entities.unescape(page[at:]))
    yield from flush()


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "://([^/?#]*)", 1))


def _digest(text: str) -> int:
    """Never 0, which stands for the opening of an element."""
    return int.from_bytes(blake2b(text.encode(errors="replace"), digest_size=8).digest(), "big", signed=True) or 1


#: What a page is parsed to.  ``blocks`` are the texts that names leave; ``t`` is
#: a text's digest, or 0 for an element; ``n`` counts a token on the page, ``at``
#: is where it comes first, ``shown`` tells whether it is among the blocks.
PARSED = ("blocks array<struct<path:string,t:long,text:string,content:boolean>>, "
          "tokens array<struct<path:string,t:long,n:int,at:int,shown:boolean>>, main long")
_BLOCK = pa.struct([("path", pa.string()), ("t", pa.int64()), ("text", pa.string()), ("content", pa.bool_())])
_TOKEN = pa.struct([("path", pa.string()), ("t", pa.int64()), ("n", pa.int32()), ("at", pa.int32()), ("shown", pa.bool_())])


def parse(page: str) -> tuple[list[tuple], list[tuple], int | None]:
    """(blocks, tokens, hash of the longest text at one path that no name
    hides) of a page."""
    seen, counts, first = [], Counter([("", 0)]), {("", 0): 0}
    framed, slots = False, {}
    for place, (element, text) in enumerate(blocks(page), 1):
        hidden = element.hidden
        framed |= bool(element.content) and not hidden  # a visible article or main element opens
        token = (element.path, _digest(text) if text else 0)
        counts[token] += 1
        first.setdefault(token, place)
        if text and not hidden:
            seen.append((element, token, text))
            slots.setdefault(element.path, []).append(text)
    least: dict[str, int] = {}
    for element, *_ in seen:
        least[element.content] = min(element.wraps, least.get(element.content, element.wraps))
    own = [(*token, text, bool(element.content)) for element, token, text in seen
           if not framed or (element.content and element.wraps == least[element.content])]
    shown = {x[:2] for x in own}
    tokens = [(*token, n, first[token], token in shown) for token, n in counts.items()]
    longest = max(("\n".join(texts) for texts in slots.values()), key=len, default="")
    return own, tokens, _digest(longest) if longest else None


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.names.index("html")
        found, tokens, main = [], [], []
        for source in batch.column(at):
            own = parse(source.as_py() or "")
            found.append([dict(zip(_BLOCK.names, x)) for x in own[0]])
            tokens.append([dict(zip(_TOKEN.names, x)) for x in own[1]])
            main.append(own[2])
        kept = [i for i in range(batch.num_columns) if i != at]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(i) for i in kept], pa.array(found, pa.list_(_BLOCK)), pa.array(tokens, pa.list_(_TOKEN)),
             pa.array(main, pa.int64())], names=[*[batch.schema.names[i] for i in kept], "blocks", "tokens", "main"])


def parsed_pages(pages: DataFrame) -> DataFrame:
    """Pages (page_id, url, html) -> (page, page_id, url, host) and PARSED;
    ``page`` numbers the rows."""
    rows = pages.select(F.monotonically_increasing_id().alias("page"), "page_id", F.col("url").cast("string").alias("url"),
                        F.coalesce(host(F.col("url").cast("string")), F.lit("")).alias("host"),
                        F.col("html").cast("string").alias("html"))
    kind = pages.schema["page_id"].dataType.simpleString()
    return stored(arrow(rows, _parsed, f"page long, page_id {kind}, url string, host string, {PARSED}"), "parsed", codec="zstd")


def page_tokens(parsed: DataFrame) -> DataFrame:
    """(page, host, main, path, t, n, at, shown) of every token of a host's page."""
    return parsed.where("host != ''").select("page", "host", "main", F.inline("tokens"))


def valid_tokens(tokens: DataFrame, min_pages: int) -> DataFrame:
    """(host, path, t, vector, n_pages): the tokens in valid classes, which
    are those of a host with one ``vector``."""
    # by main block first: copies are one row before they meet others
    each = tokens.groupBy("host", "path", "t", "main").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("x"), F.count(F.lit(1)).alias("n"))
    rows = stored(each.groupBy("host", "path", "t").agg(
        F.bit_xor("x").alias("vector"), F.sum("n").alias("n_pages"), F.count("main").alias("votes"))
        .where(F.col("votes") >= min_pages).drop("votes"), "tokens")
    classes = rows.groupBy("host", "vector").agg(F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    return stored(rows.join(classes, ["host", "vector"], "left_semi").select("host", "path", "t", "vector", "n_pages"), "valid")


def _around(low: Column, top: Column) -> Column:
    """The path of the innermost element around all paths between two (in
    the order of text, so that what the two share all share)."""
    a, b = F.split(low, "/"), F.split(top, "/")
    both = F.arrays_zip(a.alias("a"), b.alias("b"))
    unlike = F.array_position(F.transform(both, lambda x: x["a"].eqNullSafe(x["b"])), False)
    shared = F.when(unlike == 0, F.size(a) - 1).otherwise(unlike.cast("int") - 1)
    return F.array_join(F.slice(a, 1, shared), "/")


def nested(valid: DataFrame) -> DataFrame:
    """The valid tokens whose classes hang together: classes whose
    surrounding element is in no class left are taken out until none is."""
    while True:
        classes = valid.groupBy("host", "vector").agg(
            F.min("path").alias("low"), F.max("path").alias("top"), F.max("n_pages").alias("n_pages"))
        inside = classes.select("host", "vector", "n_pages", _around(F.col("low"), F.col("top")).alias("around"))
        elements = valid.where("t = 0").select(F.col("host").alias("of"), F.col("path").alias("element"),
                                               F.col("n_pages").alias("opens"))
        held = (F.col("host") == F.col("of")) & (F.col("around") == F.col("element")) & (F.col("opens") >= F.col("n_pages"))
        loose = stored(inside.where("around != ''").join(elements, held, "left_anti").select("host", "vector"), "loose")
        if loose.isEmpty():
            return valid
        valid = stored(valid.join(loose, ["host", "vector"], "left_anti"), "valid")


def template_texts(tokens: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page, path, t, shown, everywhere): the texts of each page that are its
    host's template; ``everywhere`` if they stand once on all its pages."""
    valid = nested(valid_tokens(tokens, min_pages))
    own = valid.withColumnsRenamed({"host": "of", "path": "own_path", "t": "own_t"})
    placed = stored(tokens.join(own, (F.col("host") == F.col("of")) & (F.col("path") == F.col("own_path"))
                                & (F.col("t") == F.col("own_t"))).select("page", "host", "vector", "path", "t", "at", "shown"), "placed", codec="zstd")
    sequence = F.array_sort(F.collect_list(F.struct("at", F.xxhash64("path", "t").alias("token"))))["token"]
    orders = placed.groupBy("host", "vector", "page").agg(F.xxhash64(sequence).alias("order"))
    whole = valid.where("path = '' and t = 0").select(F.col("host").alias("of"), F.col("vector").alias("all_pages"))
    ordered = orders.groupBy("host", "vector").agg(F.min("order").alias("low"), F.max("order").alias("top")).where("low = top")
    ordered = stored(ordered.join(whole, F.col("host") == F.col("of"), "left").select(
        "host", "vector", F.coalesce(F.col("vector") == F.col("all_pages"), F.lit(False)).alias("everywhere")), "ordered")
    return placed.where("t != 0").join(ordered, ["host", "vector"]).select("page", "path", "t", "shown", "everywhere")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """Pages (page_id, url, html) -> (page_id, url, text, n_chars, n_blocks,
    n_template): the text, and of the blocks that names leave how many the
    template takes."""
    parsed = parsed_pages(pages)
    # a page is listed only if the template takes something that names leave
    gone = template_texts(page_tokens(parsed), min_pages).where("shown").groupBy(F.col("page").alias("of")).agg(
        F.collect_set(F.struct("path", "t", "everywhere")).alias("template"))
    rows = parsed.select("page", "page_id", "url", "blocks").join(stored(gone, "template"), F.col("page") == F.col("of"), "left")
    template = F.coalesce("template", F.array().cast("array<struct<path:string,t:bigint,everywhere:boolean>>"))

    def stays(b: Column) -> Column:
        named = lambda everywhere: F.struct(b["path"].alias("path"), b["t"].alias("t"),
                                            F.lit(everywhere).alias("everywhere"))
        return ~F.array_contains(template, named(True)) & (b["content"] | ~F.array_contains(template, named(False)))

    left = F.when(F.col("template").isNull(), F.col("blocks")).otherwise(F.filter("blocks", stays))
    out = rows.select("page_id", "url", left.alias("left"), F.size("blocks").cast("long").alias("n_blocks"))
    return out.select("page_id", "url", F.array_join("left.text", "\n\n").alias("text"), "n_blocks",
                      (F.col("n_blocks") - F.size("left")).cast("long").alias("n_template")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_blocks", "n_template")


def main_text(page: str, template: frozenset[tuple[str, int]] = frozenset()) -> str:
    """The text of one page, for a template of (path, digest) texts known
    otherwise; ``extract`` does the same for a table."""
    return "\n\n".join(text for path, t, text, _ in parse(page)[0] if (path, t) not in template)
