"""Main text of HTML pages by the maximum-scoring subsequence.

Method.  A page is read once as a sequence of tags and text runs.  Each text run scores its words times the weight of
the elements around it; each tag scores its own weight, which is negative.  One linear scan finds the
contiguous region with the largest sum.  The region's text, without runs of negative weight (an advert
or a form inside an article) is the result.

Weights come from labelled pages: pages with an ``article`` or ``main`` element, whose words are content.  For each
element (tag, with its class and id words) the log odds of its words being content are counted over a bounded sample
of SAMPLE pages.  A word weighs OUTSIDE if the innermost element that decides is against content, so a paragraph in an
advert counts as advert; any other word weighs the largest log odds of its elements.  A tag weighs TAG (a small
negative number); one that lies outside of content by the same counts weighs BOUNDARY.

Elements that the sample does not have fall back on names, then on the mean log odds of their words, then on those of
their tag.  A name is a tag in TAGS, or a whole class, role or id of words in BOILERPLATE (and PLAIN ones beside them):
``cookie-notice`` is one, ``post-title`` and ``social-policy`` are not; beside words of STRICT (comments, adverts) those of BESIDE change nothing either.  Only blocks have names, and a ``form``, a name or word that the
sample does not have decides only up to the next ``div`` or ``section`` with a class or id that is no name.  ``html``, ``body``, ``article``,
``main``, headings and what is in a heading never decide against content, nor does a tag without class or id that is not in
TAGS.  Within ``article`` or ``main`` only tags and classes that are names decide, and ids that are names with a word of STRICT (a
heading's id may be any word); ``header`` does not, nor does a paragraph whose name has EVERYDAY words alone; forms and names with a word of STRICT decide for all in them.

Text.  Character references are decoded, white space inside a block becomes one blank, blocks are trimmed, empty
ones left out, and the others joined in page order by two line feeds.  Inline tags and ``br`` do not part blocks
(``br`` is white space).  Beyond hidden elements and words that weigh
less than nothing, nothing is dropped or cut.

Text of HIDDEN elements is left out, that of ``math`` and ``object`` is kept.

Cases.  Null and empty pages, and pages without a region of positive score, give an empty text.  Broken HTML is
read as it stands: an unclosed script, style or comment runs to the end of the page; a self-closed element is empty, and
so is a hidden one that no end tag follows; a block ends an open button, select, textarea, title, svg or math; end tags
without a start are ignored; an end tag closes all that is open above its start.  Copies of a page count once in the sample.  Ties: the region that ends first, then the shortest.  Repeated rows are kept and
treated alike.  Other columns are not read.  Without labelled pages the weights of BOILERPLATE and CONTENT alone count.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levain.llm.common import prepare

#: The bound of the sample of labelled pages, picked by hash of the page.
SAMPLE = 400
#: Weights in words: of any tag, and of a tag that bounds content or lies outside.
TAG, BOUNDARY = -0.01, -40.0
#: Largest log odds that count; log odds from which an element decides; weights of a word outside of content, and at least of any other.
MOST, DECISIVE, OUTSIDE, LEAST = 4.0, 2.9, -1.0, 0.1
CONTENT = frozenset(("article", "main"))
BLOCKS = frozenset("address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose text a reader does not see as text, and those of them that no block lies in.
HIDDEN = frozenset("noscript template textarea svg iframe select button title".split())
FLAT = frozenset("textarea svg select button title math".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Tags that are not content unless the sample says so.
TAGS = frozenset("nav menu header footer aside form script style head title".split())
#: Words of names (class, id or role) that are not content unless the sample says so, and words that change nothing beside them.
BOILERPLATE = frozenset("""nav navigation navbar menu menubar footer aside sidebar ad ads advert adverts advertisement sponsored promo banner contentinfo complementary
    cookie cookies consent notice notices alert popup modal newsletter subscribe signup login breadcrumb breadcrumbs pagination pager share sharing social related
    recommended comment comments disqus reply replies widget toolbar copyright legal""".split())
PLAIN = frozenset("area bar block box buttons container icons inner items links list page posts primary secondary section site top bottom wrap wrapper".split())
#: Words of these that speak of readers' comments and adverts: also in ids within content, and beside more words that change nothing.
STRICT = frozenset("ad ads advert adverts advertisement advertising sponsored cookie cookies newsletter sidebar comment comments commentlist disqus respond replies".split())
BESIDE = frozenset("user users reader readers post article body content text author meta item slot unit form thread count title header avatar area new all".split())
#: Words of names that everyday paragraphs of an article have too, and tags of such paragraphs.
EVERYDAY = frozenset("legal notice notices alert social related".split())
PROSE = frozenset("p li dd dt blockquote figcaption td th tr pre".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?][^>]*>|[^<]+|<", re.S | re.I)
NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
Element = tuple[str, ...]


def named(name: str) -> bool:
    """Whether a whole class, id or role is a name of what is not content."""
    words = set(re.findall(r"[^\W_\d]+", name))
    return not words.isdisjoint(BOILERPLATE | STRICT) and words <= BOILERPLATE | STRICT | (PLAIN if words.isdisjoint(STRICT) else PLAIN | BESIDE)


def element(tag: str, attributes: str) -> Element:
    """The tag, "!" if a class or role is a name, else "#" if the id is one, else "", and the words of class, role and (with "#") id."""
    if not attributes or "=" not in attributes:
        return (tag, "")
    sign, words = "", []
    for kind, a, b, c in NAMES.findall(attributes):
        by_id, found = kind.lower() == "id", (a or b or c).lower()
        if tag in BLOCKS and sign != "!" and any(map(named, found.split())):
            sign = "#" if by_id else "!"
        words += ["#" * by_id + w for w in re.findall(r"[^\W_\d]+", found)]
    return (tag, sign, *words)


def is_named(e: Element, in_content: bool = False) -> bool:
    """Whether the element has a name that speaks against content, there or within ``article`` or ``main``."""
    if e[0] in CONTENT or e[0] in HEADINGS or e[0] in ("html", "body"):
        return False
    if e[0] in TAGS and not (in_content and e[0] == "header"):
        return True
    words = {w.lstrip("#") for w in e[2:]}
    if e[1] == "#":
        return not in_content or e[0] not in PROSE and not words.isdisjoint(STRICT)
    return e[1] == "!" and not (in_content and e[0] in PROSE and words & (BOILERPLATE | STRICT) <= EVERYDAY)


def lean(odds: float) -> float:
    """Log odds that do not decide."""
    return max(0.1 - DECISIVE, min(DECISIVE - 0.1, odds))


def parts(page: str) -> Iterator[tuple[str, Element | str, tuple[Element, ...]]]:
    """("open" | "close", element, path) for each tag and ("text", run, path) for each text run; ``path``: the open elements."""
    path: tuple[Element, ...] = ()
    last: dict[str, int] = {}  # where the last end tag of a hidden element starts
    for m in TOKEN.finditer(page):
        whole, tag = m.group(0), m.group(3)
        if tag is None:
            if whole[0] != "<" or len(whole) == 1:
                yield "text", whole, path
            elif m.group(1):  # what a reader does not see, as one element
                yield "open", (m.group(1).lower(), ""), path
            continue
        tag = tag.lower()
        if m.group(2):
            at = next((n for n in range(len(path) - 1, -1, -1) if path[n][0] == tag), None)
            if at is not None:
                gone, path = path[at], path[:at]
                yield "close", gone, path
            continue
        if tag in BLOCKS:  # a block ends an open paragraph, and the inline elements left open in it
            at = next((n for n in range(len(path) - 1, -1, -1) if path[n][0] in BLOCKS), None)
            if at is not None and path[at][0] == "p":
                path = path[:at]
            if path and "head" in (path[-1][0], path[0][0], path[1:2] and path[1][0]):  # its end tag may be left out
                path = path[:next(n for n, e in enumerate(path) if e[0] == "head")]
            at = next((n for n, e in enumerate(path) if e[0] in FLAT), None)  # and what holds no block
            if at is not None:
                path = path[:at]
        elif tag in HIDDEN and tag not in ("svg", "template"):  # nor do these lie in themselves
            at = next((n for n, e in enumerate(path) if e[0] == tag), None)
            if at is not None:
                path = path[:at]
        found = element(tag, m.group(4))
        yield "open", found, path
        if tag in HIDDEN and tag not in last:
            last[tag] = max((e.start() for e in re.finditer(rf"</{tag}(?=[\s/>])", page, re.I)), default=-1)
        if tag not in VOID and not m.group(4).endswith("/") and last.get(tag, m.end()) >= m.end():
            path = (*path, found)


def counts(page: str) -> dict[tuple[str, Element], list[int]]:
    """Of a labelled page: for each ("text" | "open" | "close", element) what lies in and out of content; nothing without a label."""
    out: dict[tuple[str, Element], list[int]] = {}
    each = list(parts(page))
    if not any(kind == "open" and what[0] in CONTENT for kind, what, _ in each):
        return out
    for kind, what, path in each:
        inside = any(e[0] in CONTENT for e in path)
        if kind == "text":
            n = 0 if any(e[0] in HIDDEN for e in path) else len(what.split())
            by_name = [e for e in path if is_named(e)]  # what a menu holds says nothing against lists and links
            each_of = by_name if by_name and not inside else path
            found = {("text", e) for e in each_of} | {("tag", (e[0],)) for e in each_of} | {("word", (w,)) for e in each_of for w in e[2:]}
            for x in found if n else ():
                out.setdefault(x, [0, 0])[not inside] += n
        else:
            out.setdefault((kind, what), [0, 0])[not inside] += 1
    return out


def learn(pages: DataFrame, html_col: str = "html", sample: int = SAMPLE) -> dict[tuple[str, Element], float]:
    """Weights from the ``sample`` distinct labelled pages with the smallest hashes."""
    prepare(pages.sparkSession)
    page = F.col(html_col).cast("string")
    labelled = pages.filter(page.rlike(r"(?i)<(article|main)\b")).select(page.alias("page")).withColumn("hash", F.xxhash64("page"))
    least = [r["hash"] for r in labelled.select("hash").distinct().orderBy("hash").limit(sample).collect()]  # at most ``sample`` numbers
    some = labelled.filter(F.col("hash").isin(least)).groupBy("hash").agg(F.min("page").alias("page")).select("page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            rows = [(kind, "\t".join(e), a, b) for p in x.column(0).to_pylist() for (kind, e), (a, b) in counts(p).items()]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["kind", "element", "inside", "outside"])

    found = some.mapInArrow(run, "kind string, element string, inside long, outside long").groupBy("kind", "element").agg(F.sum("inside").alias("a"), F.sum("outside").alias("b"))
    out = {}
    for kind, e, a, b in found.collect():  # the elements of at most ``sample`` pages
        odds = max(-MOST, min(MOST, math.log((a + 0.5) / (b + 0.5))))
        out[kind, tuple(e.split("\t"))] = odds if kind not in ("open", "close") else TAG if odds > 0 else BOUNDARY
    return out


def extract(page: str | None, weights: dict[tuple[str, Element], float]) -> str:
    """The main text of one page."""
    if not page:
        return ""
    scores: list[float] = []
    items: list[tuple[str, str | None]] = []  # (what, text run or None)
    known: dict[tuple[Element, ...], float] = {}

    def weight(e: Element, in_content: bool = False) -> float:
        if e[0] in CONTENT:
            return MOST
        if e[0] in HIDDEN:
            return -MOST
        by_name = is_named(e, in_content)
        if ("text", e) in weights:
            odds = weights["text", e]
        elif by_name:
            odds = -MOST
        elif of_words := [weights["word", (w,)] for w in e[2:] if ("word", (w,)) in weights]:
            odds = sum(of_words) / len(of_words)
        else:
            odds = lean(weights.get(("tag", (e[0],)), 0.0))
        mute = in_content or len(e) == 2 or e[0] in HEADINGS or e[0] in ("html", "body")
        return max(odds, lean(odds)) if mute and not by_name else odds

    def of_path(path: tuple[Element, ...]) -> float:
        if path not in known:
            content = next((n for n in range(len(path) - 1, -1, -1) if path[n][0] in CONTENT), -1)
            heading = next((n for n, e in enumerate(path) if n > content and e[0] in HEADINGS), len(path))
            inner = [weight(e, content >= 0) for e in path[content + 1:]]  # what is around the innermost content does not decide
            against = any(e[0] in HIDDEN for e in path)
            inside = False  # inside: of a nearer block with words of its own
            for e, w in reversed(list(zip(path[content + 1:heading], inner, strict=False))):
                sure = content >= 0 and is_named(e, True) and (e[0] == "form" or not STRICT.isdisjoint(w.lstrip("#") for w in e[2:]))
                weak = not sure and (e[0] == "form" or e[0] not in TAGS and ("text", e) not in weights)
                against |= w <= -DECISIVE and not (inside and weak)
                inside |= e[0] in ("div", "section") and len(e) > 2 and not is_named(e, content >= 0)
            known[path] = OUTSIDE if against else max(LEAST, *inner, *map(weight, path[:content + 1]), LEAST)
        return known[path]

    for kind, what, path in parts(page):
        if kind == "text":
            n = len(what.split())
            scores.append(n * of_path(path))
            items.append(("text", what if n == 0 or scores[-1] > 0 else None))
        else:
            within = any(weight(e) >= DECISIVE for e in path)  # a tag inside of content does not bound it, nor does an icon or a button
            scores.append(TAG if within or what[0] in HIDDEN and what[0] != "title" else weights.get((kind, what), BOUNDARY if weight(what) <= -DECISIVE else TAG))
            items.append(("break" if what[0] in BLOCKS else "space" if what[0] == "br" else "tag", None))
    best, run, first, last, start = 0.0, 0.0, 0, 0, 0
    for n, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, n
        run += s
        if run > best:
            best, first, last = run, start, n + 1
    blocks, now = [], []
    for what, text in items[first:last]:
        if what == "break":
            blocks.append(now)
            now = []
        elif what == "space":
            now.append(" ")
        elif text:
            now.append(text)
    texts = (" ".join(html.unescape("".join(b)).split()) for b in [*blocks, now])
    return "\n\n".join(t for t in texts if t)


def main_text(pages: DataFrame, weights: dict[tuple[str, Element], float], keep: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """The columns ``keep`` with ``text`` and ``n_chars`` of each page."""
    prepare(pages.sparkSession)
    rows = pages.select(*keep, F.col(html_col).cast("string").alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            found = [extract(p, weights) for p in x.column("__html").to_pylist()]
            yield pa.record_batch([*(x.column(c) for c in keep), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], [*keep, "text", "n_chars"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keep).schema)
    return rows.mapInArrow(run, f"{fields}, text string, n_chars long")
