"""Main text of web pages by equivalence-class template deduction (after EXALG, Arasu and Garcia-Molina 2003).

A page is a sequence of tokens: start tags and text segments, each told apart by its path of open elements.  Over the
pages of one host, tokens with the same occurrence vector (how often on which page) form an equivalence class.  Classes
that are large and frequent, hold a tag, and stand in the same order on the page are valid; together they are the host's
template (whether they nest in each other is not looked at).  Text of the template is dropped, but for blocks of an article
that are template text throughout, such as headings and standing sentences, which are the article's own; what remains are
the template's slots, and of these the slots of menus, headers, footers, sidebars, notices, adverts, forms, scripts and
comments, known by their elements, are left out.

Vectors are never built: the exclusive-or of a hash of (page, count) over the pages is a fingerprint of the vector, which
Spark combines before the shuffle, so a host with a third of all pages is not one task's work.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, save_table

#: A class is large with so many tokens, and frequent on so many pages and such a share of the host's pages.
LARGE, FREQUENT, SHARE = 3, 5, 0.5
#: Up to so many row ids, and so many template tokens, 8 bytes each and counted first, are broadcast, so pages are not shuffled;
#: beyond it pages are joined by a shuffle, whose hot hosts adaptive execution splits.
BROADCAST_IDS, BROADCAST_TOKENS = 2_000_000, 4_000_000

# Possessive, and no unquoted "<" inside a tag's attributes: nothing is read again from another start.
TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style|noscript|template|iframe|svg|xmp)\b.*?(?:</\1\s*>|$)|<[!?][^>]*+(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\"<>]++)*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|[^<]++|<", re.S | re.I)
UNCLOSED = re.compile(r"<(?:[!?]|(?:script|style|noscript|template|iframe|svg|xmp)\b)", re.I)
ATTRIBUTE = re.compile(r"(?<![a-zA-Z-])([a-zA-Z-]++)\s*+=\s*+(\"[^\"]*\"|'[^']*'|[^\s\"'>]++)")
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Opening one of these closes an open one of its group (HTML's implied end tags).
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, **{b: {"p"} for b in BLOCKS - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}}}
CLOSES["li"] = {"li", "p"}
HOLDS = frozenset("article section div main body table td th ul ol dl aside nav header footer form blockquote".split())
OUTSIDE = frozenset("head title nav footer aside form button select textarea dialog menu object audio video canvas map".split())
#: Words in class, id or role that say what an element is for (fixed list).
BOILERPLATE = frozenset(
    "nav navbar navigation menu submenu sidebar aside footer foot ad ads adv advert adverts advertisement sponsor sponsored promo "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login search "
    "searchbox share sharing social related recommended recommendations breadcrumb breadcrumbs pagination pager comment comments "
    "replies reply respond discussion disqus widget toolbar form contentinfo complementary dialog".split())
HEADERS = frozenset("header masthead banner topbar".split())
MAIN = frozenset("article main".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def host_of(url: Column) -> Column:
    """The host of an address in lower case, without user and port (empty if there is none)."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def _names(attributes: str) -> tuple[str, set[str], bool]:
    """Signature of class, id and role; their words; whether the element is hidden."""
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    signature = " ".join(f"{k}={found[k]}" for k in ("class", "id", "role") if k in found)
    words = {w.lower() for k in ("class", "id", "role") for w in WORDS.findall(found.get(k, ""))}
    style = found.get("style", "").replace(" ", "").lower()
    hidden = "display:none" in style or "visibility:hidden" in style or found.get("aria-hidden", "").lower() == "true" or bool(
        re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", QUOTED.sub("", attributes), re.I))
    return signature, words, hidden


def matches(page: str):
    """The page's tags and texts, as matches of TOKEN.  What follows the last ``>`` has no tags and is looked at once."""
    last = page.rfind(">") + 1
    m = None
    for m in TOKEN.finditer(page, 0, last):
        yield m
    if m and m[0].startswith("<!--") and not (len(m[0]) > 6 and m[0].endswith("-->")):
        return  # a comment that nothing closes
    if m and m[1] and not re.search(rf"</{m[1]}\s*+>\Z", m[0], re.I):
        return
    rest = page[last:]
    left_open = UNCLOSED.search(rest)
    if text := rest[: left_open.start()] if left_open else rest:
        yield re.compile(".+", re.S).match(text)


def parse(page: str):
    """Tokens in page order: (is tag, key text, path hash, block number, skipped, in an article, text).

    The block number grows at every block element's edge; text of one number is one block.
    """
    out, stack, block = [], [], 0  # stack: (name, path hash, skipped, in an article)
    held: Counter[str] = Counter()  # names on the stack, so it is not searched for what it does not hold

    def close(at: int) -> None:
        held.subtract(x[0] for x in stack[at:])
        del stack[at:]

    path, skipped, inside = 0, False, False
    for m in matches(page):
        if m.re is TOKEN and (m[3] or m[6]):
            closing, name, attributes = (m[2], m[3].lower(), m[4]) if m[3] else (m[5], m[6].lower(), m[7])
            if name in BLOCKS:
                block += 1
            if closing:
                for i in range(len(stack) - 1, -1, -1) if held[name] else ():
                    if stack[i][0] == name:
                        close(i)
                        break
                    if stack[i][0] in HOLDS and name not in HOLDS:
                        break  # the end tag of something outside this container
            else:
                for i in range(len(stack) - 1, -1, -1) if any(held[c] for c in CLOSES.get(name, ())) else ():
                    if stack[i][0] in CLOSES[name]:
                        close(i)
                        break
                    if stack[i][0] in HOLDS:
                        break
                path, skipped, inside = stack[-1][1:] if stack else (0, False, False)
                signature, words, hidden = _names(attributes) if attributes.strip() else ("", frozenset(), False)
                out.append((True, f"<{name} {signature}>", path, block, skipped, inside, ""))
                if name == "br":
                    out.append((False, "", path, block, skipped, inside, "\n"))
                if name not in VOID and not attributes.rstrip().endswith("/"):
                    inner = inside or name in MAIN or "main" in words
                    drop = (skipped or hidden or name in OUTSIDE or bool(words & BOILERPLATE)
                            or (not inner and (name == "header" or bool(words & HEADERS))))
                    if name in ("html", "body", "article", "main") and not hidden:
                        drop = skipped  # (a page's body may be called anything)
                    held[name] += 1
                    stack.append((name, hash_text(f"{path} {name} {signature}"), drop, inner))
            path, skipped, inside = stack[-1][1:] if stack else (0, False, False)
        elif m[0][0] != "<" or m[0] == "<" or m.re is not TOKEN:
            out.append((False, "", path, block, skipped, inside, m[0]))
    return out


def hash_text(text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace"))


def segments(tokens):
    """Joins neighbouring text of one block and place: (is tag, key, block, skipped, in an article, text)."""
    out = []
    for is_tag, name, path, block, skipped, inside, text in tokens:
        if is_tag:
            out.append([True, hash_text(f"{path} {name}"), block, skipped, inside, ""])
        elif out and not out[-1][0] and out[-1][2] == block and out[-1][6] == path:
            out[-1][5] += text
        else:
            out.append([False, 0, block, skipped, inside, text, path])
    for s in out:
        if not s[0]:
            s[5] = entities.unescape(s[5])
            squeezed = " ".join(s[5].split())
            s[1] = hash_text(f"{s[6]} {squeezed}") if squeezed else 0
    return out


def _occurrences(batches):
    """(host, key, is tag, pages, vector fingerprint, sum of first places) of the batch's pages, summed per host and key."""
    import pyarrow as pa

    for batch in batches:
        found: dict[tuple[str, int], list[int]] = {}
        for rid, host, page in zip(*(batch.column(c).to_pylist() for c in ("rid", "host", "html")), strict=True):
            on_page: dict[int, list[int]] = {}
            for place, s in enumerate(segments(parse(page))):
                if s[1]:
                    on_page.setdefault(s[1], [0, place, s[0]])[0] += 1
            keys = np.fromiter(on_page, np.uint64, len(on_page))
            counts = np.array([v[0] for v in on_page.values()], np.uint64)
            with np.errstate(over="ignore"):
                marks = mixed(mixed(np.uint64([rid & (1 << 64) - 1]) + np.uint64(1)) + counts)
            for key, mark, (_, place, tag) in zip(keys.tolist(), marks.tolist(), on_page.values(), strict=True):
                row = found.setdefault((host, key), [0, 0, 0, int(tag)])
                row[0] += 1
                row[1] ^= mark
                row[2] += place
        hosts, keys = zip(*found, strict=True) if found else ((), ())
        rows = np.array([[v[0], v[2], v[3]] for v in found.values()], np.int64).reshape(-1, 3)
        yield pa.record_batch([
            pa.array(hosts, pa.string()), pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(rows[:, 2].copy()),
            pa.array(rows[:, 0].copy()), pa.array(np.array([v[1] for v in found.values()], np.uint64).view(np.int64)),
            pa.array(rows[:, 1].copy())], names=["host", "key", "tag", "pages", "vector", "place"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, template): the text tokens and tags of all valid classes of the host as (key, class, tag), in page order.

    ``pages`` has ``rid``, ``host`` and ``html``.  Equal pages of a host count once, so copies do not look like a template.
    """
    once = pages.groupBy("host", F.xxhash64("html").alias("same")).agg(F.min("rid").alias("rid"))
    sizes = once.groupBy("host").agg(F.count("*").alias("host_pages")).filter(F.col("host_pages") >= FREQUENT)
    first = save_table(once.select("rid"), "template-pages")
    different = pages.join(F.broadcast(first) if first.count() <= BROADCAST_IDS else first, "rid", "left_semi")
    tokens = different.select("rid", "host", "html").mapInArrow(
        _occurrences, "host string, key long, tag long, pages long, vector long, place long")
    tokens = tokens.groupBy("host", "key").agg(
        F.max("tag").alias("tag"), F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), F.sum("place").alias("place"))
    tokens = tokens.filter(F.col("pages") >= FREQUENT).join(sizes, "host").filter(F.col("pages") >= SHARE * F.col("host_pages"))
    classes = tokens.groupBy("host", "pages", "vector").agg(
        F.sort_array(F.collect_list(F.struct((F.col("place") / F.col("pages")).alias("place"), "key", "tag"))).alias("tokens"))
    valid = classes.filter((F.size("tokens") >= LARGE) & F.exists("tokens", lambda t: t["tag"] == 1))
    return valid.groupBy("host").agg(F.collect_list(F.col("tokens.key")).alias("template"))


def main_text(page: str, template: list[list[int]] | None) -> str:
    """The blocks of a page's slots, without template text outside articles and beside other text; see the module's head."""
    tokens = segments(parse(page))
    fixed: set[int] = set()
    if template:
        places: dict[int, int] = {}
        for i, s in enumerate(tokens):
            if s[1]:
                places.setdefault(s[1], i)
        for signed in template:  # a class holds on this page if its tokens are there in order
            keys = [k & (1 << 64) - 1 for k in signed]
            here = [places[k] for k in keys if k in places]
            if len(here) == len(keys) and here == sorted(here):
                fixed.update(keys)
    blocks: dict[int, list] = {}
    for s in tokens:
        if not s[0] and not s[3]:
            own = blocks.setdefault(s[2], ["", "", False])
            own[0] += " " if s[1] in fixed else s[5]
            own[1] += s[5]
            own[2] |= s[4]
    texts = []  # (text, in an article, has text that is not the template's)
    for varied, whole, inside in blocks.values():
        text = " ".join(varied.split())
        texts.append((text or " ".join(whole.split()) if inside else text, inside, bool(text)))
    if any(inside and varied for _, inside, varied in texts):
        texts = [x for x in texts if x[1]]
    return "\n\n".join(text for text, _, _ in texts if text)


def _extracted(batches):
    import pyarrow as pa

    for batch in batches:
        texts = [main_text(page, template) for page, template in
                 zip(batch.column("html").to_pylist(), batch.column("template").to_pylist(), strict=True)]
        yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                               pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars (code points).

    NULL html counts as empty and gives an empty text; a NULL or odd url has the empty host; hosts of fewer than FREQUENT
    different pages have no template, so only the elements decide.  Repeated rows give repeated rows.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"), host_of(F.col("url")).alias("host"),
        F.monotonically_increasing_id().alias("rid"))
    known = save_table(templates(rows), "templates")
    size = known.agg(F.sum(F.aggregate("template", F.lit(0).cast("long"), lambda n, c: n + 1 + F.size(c)))).first()[0] or 0
    joined = rows.join(F.broadcast(known) if size <= BROADCAST_TOKENS else known, "host", "left")
    return joined.select("page_id", "url", "html", "template").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long")
