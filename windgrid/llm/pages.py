"""Main text of web pages by template deduction over the pages of a host.

Tokens are elements (by path) and text nodes. Tokens with the same occurrence vector over a host's pages form an
equivalence class; vectors are compared by an order-free fingerprint, so a host is aggregated, never gathered. A class is
valid if each of its text nodes comes wherever its element does; copies of an article share a vector too, but lie in
slots, elements whose text differs from page to page. Valid classes, nested by path, are the template; what is on a page besides is
the text of its slots, and all of it is kept. Tags and names of menus, adverts and the like leave out what one page cannot tell.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windgrid.llm.common import stored

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|svg|textarea|select|object)\b[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-z][^\s/<>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[/!?a-z][^>]*(?:>|\Z)",
    re.S | re.I,
)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORD = re.compile(r"[a-z]+")
# Elements inside a line, elements without an end, elements and names of what is not the article.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img nobr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_BLOCK = "p"
BOILER_TAGS = frozenset("head nav footer aside menu button dialog title header".split())
BOILER_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation topnav footer header masthead comment comments disqus cookie cookies consent notice notices alert share sharing social related breadcrumb breadcrumbs subscribe newsletter popup modal widget toolbar pagination pager login signup search contentinfo complementary navigationbar".split()
)


# Words that stand beside such a name in one class without changing what it says.
BESIDE = frozenset("site page main top bottom left right primary secondary global box wrapper wrap container block area section slot list item items inner outer bar".split())


def names_boiler(value: str) -> bool:
    """Whether one of the names in a class, id or role says, as a whole, that the element is not the article."""
    for token in value.split():
        words = WORD.findall(token)
        if not BOILER_NAMES.isdisjoint(words) and all(w in BOILER_NAMES or w in BESIDE or len(w) == 1 for w in words):
            return True
    return False


def opened(tag: str, attributes: str, stack: list) -> tuple[str, bool, bool]:
    """The step of a path, whether what is inside is not the article's, and whether that is so unless it is most of the page."""
    step, named = tag, False
    if attributes and "=" in attributes:
        for key, *values in NAMED.findall(attributes):
            value = next((v for v in values if v), "").lower()
            named = named or names_boiler(value)
            if key.lower() != "role" and step == tag and (words := WORD.findall(value)):
                step = f"{tag}.{words[0]}"
    inside = any(s[0] in ("article", "main") for s in stack)
    if tag in BOILER_TAGS and not (tag == "header" and inside):
        return step, True, False
    return step, False, tag == "form" or (named and tag not in ("html", "body", "main", "article"))


def tokens(page: str | None) -> list[tuple[str, str | None, tuple[int, ...], bool]]:
    """(path, text, marks, in article or main) of the blocks outside menus, headers and the like, and the same with text None of each element.

    Marks tell which elements around it have a name of what is not the article. Ends that match no open element are ignored; elements left
    open end with the page, self-closed ones at once.
    """
    page = page or ""
    stack: list[tuple[str, str, bool, tuple[int, ...], bool]] = []  # tag, path, skipped, marks, in article or main
    out: list[tuple[str, str | None, tuple[int, ...], bool]] = []
    parts: list[str] = []
    at = marked = 0

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        _, path, skipped, marks, main = stack[-1] if stack else ("", "", False, (), False)
        if text and not skipped:
            out.append((path, text, marks, main))

    for found in TOKEN.finditer(page):
        if found.start() > at:
            parts.append(html.unescape(page[at : found.start()]))
        at = found.end()
        tag = (found[3] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br":
                parts.append(" ")
            continue
        flush()
        if found[2]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if depth is not None:
                del stack[depth:]
            continue
        if stack and stack[-1][0] == CLOSED_BY_BLOCK:
            stack.pop()
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == tag:
            stack.pop()
        if tag in VOID or found[4].endswith("/"):
            continue
        step, boiler, unless_most = opened(tag, found[4], stack)
        _, path, skipped, marks, main = stack[-1] if stack else ("", "", False, (), False)
        if unless_most:
            marked += 1
            marks = (*marks, marked)
        stack.append((tag, f"{path}/{step}", skipped or boiler, marks, main or tag in ("article", "main")))
        if not stack[-1][2]:
            out.append((stack[-1][1], None, marks, stack[-1][4]))
    parts.append(html.unescape(page[at:]))
    flush()
    return out


def blocks(page: str | None) -> list[tuple[str, str | None]]:
    """(path, text) of the blocks outside menus, headers, adverts and the like, and (path, None) of each element.

    An element with a name of those is a wrapper, and stays, if it holds most of the page's text and no article or main lies
    beside it. If names would leave out all text of a page, none is left out.
    """
    found = tokens(page)
    if not any(marks for _, _, marks, _ in found):
        return [(path, text) for path, text, _, _ in found]
    total = in_main = 0
    held: dict[int, list[int]] = {}
    for _, text, marks, main in found:
        size = len(text or "")
        total += size
        in_main += size * main
        for k in marks:
            entry = held.setdefault(k, [0, 0])
            entry[0] += size
            entry[1] += main
    out = {k for k, (size, main) in held.items() if 2 * size <= total or (in_main and not main)}
    kept = [(path, text) for path, text, marks, _ in found if out.isdisjoint(marks)]
    return kept if any(text for _, text in kept) else [(path, text) for path, text, _, _ in found]


def node_of(path: str, text: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(f"{path}\0{text}") >> 1 or 1


def main_text(page: str | None, template: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks that are not text of the template; empty if there are none."""
    return "\n\n".join(t for p, t in blocks(page) if t is not None and not (template and node_of(p, t) in template))


def host_of(url_column: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_column), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def token_counts(pages: DataFrame) -> DataFrame:
    """host, path, node (hash of a text node, 0 for an element), chars (its text's), pages, print (the fingerprint of the occurrence
    vector): added up over the pages of a batch, then over all."""

    def run(batches) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            total: dict[tuple[str, str, int, int], list[int]] = {}
            for host, page_key, page in zip(*(batch.column(k).to_pylist() for k in range(3))):
                own: dict[tuple[str, int, int], int] = {("", 0, 0): 1}
                for path, text in blocks(page):
                    key = (path, 0, 0) if text is None else (path, node_of(path, text), len(text))
                    own[key] = own.get(key, 0) + 1
                for key, times in own.items():
                    entry = total.setdefault((host, *key), [0, 0])
                    entry[0] += 1
                    entry[1] ^= xxhash.xxh3_64_intdigest(f"{page_key}:{times}") >> 1
            rows = [(*k, *v) for k, v in total.items()]
            types = (pa.string(), pa.string(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["host", "path", "node", "chars", "pages", "print"])

    counts = pages.mapInArrow(run, "host string, path string, node long, chars long, pages long, print long")
    return counts.groupBy("host", "path", "node", "chars").agg(F.sum("pages").alias("pages"), F.bit_xor("print").alias("print"))


def templates(counts: DataFrame, most: float = 0.9, least: int = 3) -> DataFrame:
    """host, template: the text nodes of the valid classes of a host.

    A path is a slot if any of its texts is missing on more than a share of 1 - ``most`` of the pages with the path; what a slot holds is
    never left out. Classes are those of texts on ``least`` pages or more, whatever the host's size. A class nests into the template by its
    texts' paths, and is valid if none of them is a slot (as with an advert on some pages, but not with copies of an article, which share
    slots with others), or if it is on a share of ``most`` of all pages.

    The article's element is any article or main, and the deepest element below body around at least half of the text in slots. Constant
    headings and bylines inside it are the article's: there only what interrupts it on less than half of the pages is left out, if it
    is no heading, paragraph, item or cell. Outside it all texts of valid classes are. A host without slots has no template.
    """
    # A host with most of the pages has many texts: one row a path, then the few texts that come again.
    text = F.when(F.col("node") != 0, F.col("pages"))
    mass = F.sum(F.when(F.col("node") != 0, F.col("pages") * F.col("chars")))
    paths = counts.groupBy("host", "path").agg(F.min(text).alias("rarest"), F.max(F.when(F.col("node") == 0, F.col("pages"))).alias("around"), mass.alias("mass"))
    paths = stored(paths.select("host", "path", (F.col("rarest") < most * F.col("around")).alias("slot"), "mass"), "paths")
    steps = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda k: F.array_join(F.slice(steps, 1, k), "/"))
    around = paths.filter("slot AND path <> ''").select("host", "mass", F.explode(above).alias("body")).groupBy("host", "body").agg(F.sum("mass").alias("mass"))
    whole = counts.filter("node = 0 AND path = ''").select("host", F.col("pages").alias("n"))
    total = around.filter("body = ''").select("host", F.col("mass").alias("total"))
    deep = F.struct(F.size(F.split("body", "/")).alias("depth"), "mass", "body")
    bodies = around.join(total, "host").filter("2 * mass >= total").groupBy("host").agg(F.max(deep).alias("x")).select("host", F.when(~F.col("x.body").rlike(r"^(/(html|body)(\.[a-z]+)?)*$"), F.col("x.body")).alias("body"))
    texts = counts.filter((F.col("node") != 0) & (F.col("pages") >= least)).join(whole.join(bodies, "host"), "host")
    texts = texts.join(paths.drop("mass"), ["host", "path"])
    inside = F.col("path").rlike(r"/(article|main)(\.[a-z]+)?(/|$)") | F.coalesce(F.startswith(F.concat("path", F.lit("/")), F.concat("body", F.lit("/"))), F.lit(False))
    interrupts = (2 * F.col("pages") < F.col("n")) & ~F.col("path").rlike(r"/(h[1-6]|p|li|dt|dd|td|th|pre|blockquote|figcaption|article|main)(\.[a-z]+)?$")
    fixed = F.collect_list(F.when(~F.col("slot") & (~inside | interrupts), F.col("node")))
    classes = texts.groupBy("host", "n", "print", "pages").agg(F.max("slot").alias("shared"), fixed.alias("nodes"))
    classes = classes.filter(~F.col("shared") | (F.col("pages") >= most * F.col("n"))).filter(F.size("nodes") > 0)
    return classes.groupBy("host").agg(F.flatten(F.collect_list("nodes")).alias("template"))


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per row of pages.

    A null or empty page has an empty text, and so has one whose blocks are all of the template. Rows without a readable host share one template. Repeated rows are pages of their own. The
    join of pages with their host's template can be split where one host has most pages; pages travel compressed.
    """
    given = pages.select(host_of(url_column).alias("host"), F.xxhash64(id_column, url_column).alias("page_key"), F.col(html_column).alias("html"))
    found = stored(templates(stored(token_counts(given), "tokens")), "templates")

    def squeeze(batches) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = pa.array([packer.compress((x.as_py() or "").encode()) for x in batch.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], z], ["page_id", "url", "host", "z"])

    def read(batches) -> Iterator[pa.RecordBatch]:
        import zstandard

        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            of_host: dict[str, set[int]] = {}
            texts = []
            for host, z, template in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4)):
                if host not in of_host:
                    of_host[host] = set(template.as_py() or ())
                texts.append(main_text(opener.decompress(z.as_py()).decode(), of_host[host]))
            columns = [*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    packed = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), host_of(url_column).alias("host"), F.col(html_column).alias("html"))
    packed = packed.mapInArrow(squeeze, "page_id long, url string, host string, z binary")
    joined = packed.join(found, "host", "left").select("page_id", "url", "host", "z", "template")
    return joined.mapInArrow(read, "page_id long, url string, text string, n_chars long")
