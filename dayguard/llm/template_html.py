"""Main text of web pages by equivalence-class template deduction.

Method: every page is cut into tag tokens (the path of containers, with class or id) and
text tokens (a container path and a block's hash). Tokens of a host that share their
occurrence vector (how often on which page; compared by a sum of hashes of (page, count))
form an equivalence class. A class is valid if it is large enough in pages; classes nest
by their paths into the host's template. Text tokens in a class with their own container
are constant template text, at their own path only. Pages of a host with the same blocks
(mirrored articles, repeated rows, one article under many URLs) are one page here, so
copies do not make an article look constant. The remaining slots hold the data: the slot
with the article (by element, then by name, then by text) is the host's main slot and its
blocks are the main text; inside an article, main or named content slot only boxes with a
name of their own (a div or section with a class or id) can be template text, headings,
paragraphs, lists, quotes and tables never are; containers that are menus, headers, footers, sidebars, notices, adverts, forms
or reader comments by element, role or class never are.

Counting is two partial aggregations, by (host, token, page content) and by (host, token),
so a host with most of the pages is spread over tasks; a host's model is one row, bounded by the blocks of one page.

Defined cases: null or empty html gives an empty text; a null url is a host of its own
(empty name); hosts with fewer than ``MIN_PAGES`` different pages have no constant text to deduce and each page's own
slots are used; repeated rows are extracted each; unclosed or stray tags are mended as
browsers do for paragraphs and list items, an unclosed comment or script hides the rest.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from dayguard.llm.common import slices, spool

MIN_PAGES, MIN_SHARE = 5, 0.9
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_SPLIT = re.compile(r"[\s_\-]+|(?<=[a-z])(?=[A-Z])")
# fixed values: element and attribute names of HTML and words that name page furniture
RAW = frozenset("script style noscript template textarea title iframe svg xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody "
                   "tfoot thead tr td th ul caption head button select option".split())
FURNITURE = frozenset("nav footer aside form menu dialog button select head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
WORDS = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
                  "gdpr notice notices popup modal overlay newsletter subscribe subscription sidebar widget widgets related "
                  "recommended share sharing social breadcrumb breadcrumbs menu nav navbar navigation masthead topbar footer "
                  "comment comments disqus replies reply respond login signup search toolbar pagination pager skip hidden".split())
NAMED = frozenset("content article post entry story main body text".split())
_ONE_P = frozenset(BLOCKS - {"html", "body", "head"})


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _is_furniture(tag: str, attrs: dict[str, str], words: set[str], in_main: bool) -> bool:
    if tag in FURNITURE or attrs.get("role", "").lower() in ROLES or "hidden" in attrs:
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    if tag in ("header",) or "header" in words:
        return not in_main and tag not in ("html", "body", "main", "article")
    if tag in ("html", "body", "main"):
        return False
    return bool(words & (WORDS if tag != "article" else {"comment", "comments", "reply", "ad", "advert", "sponsored", "related"}))


def blocks(page: str | None) -> tuple[list[tuple[str, str]], dict[str, int]]:
    """([(container path, block text)] without furniture in page order, {path: times}) of a page."""
    out: list[tuple[str, str]] = []
    seen: dict[str, int] = {}
    if not page:
        return out, seen
    stack: list[tuple[str, str, bool, bool]] = []  # element, path, furniture, inside article or main
    parts: list[str] = []

    def flush() -> None:
        if parts:
            words = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if words and not (stack and stack[-1][2]):
                out.append((stack[-1][1] if stack else "", words))

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            parts.append(page[at:])
            break
        if m.start() > at:
            parts.append(page[at:m.start()])
        at = m.end()
        name = m.group(2)
        if not name:
            continue
        tag = name.lower()
        if m.group(1):
            if tag in BLOCKS:
                flush()
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                parts.append(" ")
            continue
        if tag not in BLOCKS:
            continue
        flush()
        if tag in _ONE_P and stack and stack[-1][0] == "p":
            stack.pop()
        if tag == "li" and stack and stack[-1][0] == "li":
            stack.pop()
        attrs = {k.lower(): v.strip("\"'") for k, v in _ATTR.findall(m.group(3) or "")}
        label = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        words = {w.lower() for w in _SPLIT.split(label) if w}
        own = tag + "".join("." + w for w in sorted(words))
        up = stack[-1] if stack else ("", "", False, False)
        path = f"{up[1]}>{own}" if up[1] else own
        bad = up[2] or _is_furniture(tag, attrs, words, up[3])
        main = up[3] or (not bad and (tag in ("article", "main") or attrs.get("role", "").lower() == "main"))
        stack.append((tag, path, bad, main))
        if not bad:
            seen[path] = seen.get(path, 0) + 1
    flush()
    return out, seen


def rank(path: str) -> int:
    """How a container's name speaks for the article: lower is better."""
    own = path.rpartition(">")[2].split(".")
    if own[0] == "article":
        return 0
    if own[0] == "main":
        return 1
    return 2 if own[0] in ("div", "section", "td") and NAMED & set(own[1:]) else 3 if own[0] in ("body", "html") else 4


def best_slot(chars: dict[str, int]) -> str:
    """The main slot among containers with the text below them; outermost of the best rank."""
    full = {p: n for p, n in chars.items() if n and rank(p) < 4}
    if not full:
        return ""
    r = min(map(rank, full))
    same = [p for p in full if rank(p) == r]
    outer = [p for p in same if not any(p.startswith(q + ">") for q in same)]
    return min(outer, key=lambda p: (-full[p], p))


def _below(found: list[tuple[str, str]]) -> dict[str, int]:
    chars: dict[str, int] = {}
    for path, text in found:
        while path:
            chars[path] = chars.get(path, 0) + len(text)
            path = path.rpartition(">")[0]
    return chars


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def block_hash(path: str, text: str) -> int:
    return text_hash(f"{path}\n{text}")


def may_be_template(path: str, slot: str) -> bool:
    """Whether a block at ``path`` inside the main slot can be template text at all."""
    if rank(slot) > 2:  # the whole body: no element tells the article from its frame
        return True
    own = path.rpartition(">")[2].split(".")
    return path != slot and own[0] in ("div", "section") and len(own) > 1 and not NAMED & set(own[1:])


def extract(page: str | None, slot: str | None, constant: set[int]) -> str:
    found, _ = blocks(page)
    inside = [(p, t) for p, t in found if slot and (p == slot or p.startswith(slot + ">"))]
    if not inside:
        slot = best_slot(_below(found))
        inside = [(p, t) for p, t in found if not slot or p == slot or p.startswith(slot + ">")]
    return "\n".join(t for p, t in inside if not constant or not may_be_template(p, slot) or block_hash(p, t) not in constant)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, 1, most_rows=1_000):
        rows: list[tuple] = []
        for host, page in zip(*(part.column(i).to_pylist() for i in range(2))):
            found, seen = blocks(page)
            content = text_hash("\n".join(x for block in found for x in block))
            chars, texts = _below(found), {}
            for path, text in found:
                k = (path, block_hash(path, text))
                texts[k] = texts.get(k, 0) + 1
            rows.append((host, content, "", None, 1, 0))  # the page itself
            rows += [(host, content, p, None, n, chars.get(p, 0)) for p, n in seen.items()]
            rows += [(host, content, p, h, n, 0) for (p, h), n in texts.items()]
        cols = list(zip(*rows)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (
            pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
            names=["host", "content", "path", "text", "n", "chars"])


@F.pandas_udf(StringType())
def _slot_of(paths: pd.Series, chars: pd.Series) -> pd.Series:
    return pd.Series([best_slot(dict(zip(p, c))) for p, c in zip(paths, chars)], dtype=object)


def templates(pages: DataFrame, *, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, pages, slot, constant): the deduced template of every host, from (host, html);
    ``pages`` counts its different pages."""
    tokens = pages.select("host", "html").mapInArrow(
        _tokens, "host string, content long, path string, text long, n long, chars long")
    # pages of equal blocks may differ in empty containers: the most of each counts
    once = tokens.groupBy("host", "path", "text", "content").agg(F.max("n").alias("n"), F.max("chars").alias("chars"))
    per = spool(once.groupBy("host", "path", "text").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("chars").alias("chars"),
        # equal sums mean equal occurrence vectors
        F.sum(F.xxhash64("content", "n").cast("decimal(20,0)")).alias("vector")))
    of = per.where("path = '' AND text IS NULL").select("host", F.col("pages").alias("all_pages"))
    per = per.where("path <> ''")
    valid = per.join(of, "host").where(F.col("pages") >= F.greatest(F.lit(min_pages), F.lit(min_share) * F.col("all_pages")))
    tags = valid.where("text IS NULL")
    constant = (valid.where("text IS NOT NULL")
                .join(tags.select("host", "path", "pages", "vector"), ["host", "path", "pages", "vector"], "left_semi")
                .groupBy("host").agg(F.sort_array(F.collect_set("text")).alias("constant")))
    # the containers that at least half of the host's pages have (so no more than twice a page's): its frame
    frame = (per.where("text IS NULL").join(of, "host").where(F.col("pages") * 2 >= F.col("all_pages")).groupBy("host")
             .agg(F.collect_list("path").alias("paths"), F.collect_list("chars").alias("chars")))
    return spool(of.join(frame.select("host", _slot_of("paths", "chars").alias("slot")), "host", "left")
                 .join(constant, "host", "left").select("host", F.col("all_pages").alias("pages"), "slot", "constant"))


@F.pandas_udf(StringType())
def _extracted(page: pd.Series, slot: pd.Series, constant: pd.Series) -> pd.Series:
    return pd.Series([extract(p if isinstance(p, str) else None, s if isinstance(s, str) else None,
                              set() if c is None else set(c)) for p, s, c in zip(page, slot, constant)], dtype=object)


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of every row."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                        host_of(F.col(url_col)).alias("host"))
    model = templates(rows.select("host", "html"))
    return rows.join(model.select("host", "slot", "constant"), "host", "left").select(
        "page_id", "url", _extracted("html", "slot", "constant").alias("text"))
