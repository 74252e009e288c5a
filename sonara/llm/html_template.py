"""Main text of pages by equivalence-class template deduction.

Tokens of a page are its elements, told apart by their path of tags and classes, and its text
blocks. Over the pages of a host every token has an occurrence vector (how often it is in
each page). Tokens with the same vector form an equivalence class; vectors are compared by two
sums of (count x page hash), so no vector is ever gathered. A class is valid where it occurs
in at least half of the host's pages. The valid classes, nested by their paths, are the host's
template: the class of the page root holds what is once in every page, and the others hang
below it. The slots left between template elements are data. The main slot is the outermost
article or main of the template that is once in a page, however short its text; without one, the
outermost such element below the body that keeps nearly all text outside of menus, forms, adverts and the
like. Its blocks are the result. Outside of an article or main, a text block whose occurrence vector is the
page root's belongs to the template and goes, from two pages on, unless nothing at all would be left; inside, what
all articles share (a passage, a signature) is their text and stays.

Tag names say which elements are never data. Words in class, id and role condemn block containers
only (``BLOCKS``), never headings, paragraphs or inline elements: where a name consists of such
words and neutral ones (``STRICT``: "post-comments"), always; where it merely contains one
("search-algorithms"), outside of article and main, and only an element the template holds. Words do not
condemn html, body, main and article, nor an element that holds nearly all of its host's text
where no article or main does, nor the elements around it. A page without its host's main slot
gives all its blocks outside elements that are never data.

Defined results: null or empty html gives the empty text and is no page of its host's template; a null url is
the host ``""``; repeated pages each give a row; a literal ``<`` that opens no tag is text; an element that is
never data and has no end tag ends where the next container, heading or paragraph begins; an empty table gives
no rows; other columns are ignored; pages are read whole, in linear time, at any depth.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import staged

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var del".split())
CONTAINERS = frozenset("article main section div body html td center".split())
CLOSES = {"li": {"li"}, "p": {"p"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"},
          "dd": {"dt", "dd"}, "option": {"option"}, "body": {"head"}}
RAW = frozenset("script style textarea title noscript template iframe svg".split())
NEVER_TAGS = frozenset("nav header footer aside form script style noscript template button select textarea iframe svg menu "
                       "dialog head title object".split())
NEVER_WORDS = frozenset("ad ads advert advertisement advertising banner sponsor sponsored promo sidebar side menu nav navbar "
                        "navigation breadcrumb breadcrumbs header footer masthead cookie cookies consent notice notices popup "
                        "modal overlay share sharing social related recommended comment comments reply replies disqus "
                        "subscribe newsletter signup login search toolbar widget copyright pagination pager skip".split())
ROOTS = frozenset("html body main article".split())  # words never condemn these
OPEN_ENDED = ("nav", "header", "footer", "aside", "form", "menu", "dialog")  # never data; their end tag may be missing
BLOCKS = frozenset("aside center details div dl fieldset footer form header nav ol section table ul".split())  # words may condemn these
# words that leave the sense of a name as it is: "site-menu-box"
NEUTRAL = frozenset("area article bar block bottom box btn button buttons container entry global group holder icons inner item items left "
                    "link links list main nav outer page panel post posts primary right row secondary section site text top "
                    "user wrap wrapper".split())
# where an element without an end tag that is never data ends
RESUMES = frozenset("article center dl div fieldset h1 h2 h3 h4 h5 h6 main p pre section table".split())
DEEPEST = 200  # paths of deeper elements are those of their ancestor
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|"
                   r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SLOT_SHARE = 0.9


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


class Page:
    """Paths of a page's elements with their counts, and its text blocks in order.

    Words do not condemn the elements whose paths are in ``spared``; names that merely contain such a word
    condemn only the paths in ``held`` (None: any)."""

    def __init__(self, source: str, spared: frozenset = frozenset(), held: frozenset | None = None):
        self.spared, self.held = spared, held
        self.counts: dict[str, int] = {}
        self.blocks: list[tuple[str, str, bool]] = []  # path, text, never data
        self.condemned: list[tuple[str, str, str]] = []  # of blocks that words alone condemn: path, text, innermost such element
        # tag, path, never data by its tag, innermost element that words condemn, inside article or main
        self.stack: list[tuple[str, str, bool, str, bool]] = [("", "", False, "", False)]
        self.names: dict[str, int] = {}    # open elements by tag
        self.ends: dict[str, int] = {}     # where the last end tag of a never-data tag is
        self.text: list[str] = []
        at, low = 0, None
        while True:
            m = TOKEN.search(source, at)
            if not m:
                break
            self.text.append(source[at:m.start()])
            at = m.end()
            end, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                continue  # comment or declaration
            name = name.lower()
            if end:
                self.close(name)
                continue
            if name in RESUMES and any(self.names.get(t) for t in OPEN_ENDED):
                low = source.lower() if low is None else low
                self.resume(low, at)
            self.open(name, attributes)
            if name in RAW and not attributes.endswith("/"):
                low = source.lower() if low is None else low
                stop = low.find("</" + name, at) if len(low) == len(source) else source.find("</" + name, at)
                at = len(source) if stop < 0 else stop
                if name == "title" and stop < 0:
                    at = m.end()
        self.text.append(source[at:])
        self.flush()

    def flush(self) -> None:
        if self.text:
            text = " ".join(entities.unescape("".join(self.text)).split())
            if text:
                _, path, never, by_words, _ = self.stack[-1]
                self.blocks.append((path, text, never or by_words != ""))
                if by_words and not never:
                    self.condemned.append((path, text, by_words))
            self.text = []

    def open(self, name: str, attributes: str) -> None:
        if name in VOID:
            self.text.append(" ")
            return
        names = []
        if attributes and "=" in attributes:
            for kind, *value in ATTRIBUTE.findall(attributes):
                names += [[w for w in re.split(r"[^a-z0-9]+", n) if w] for n in "".join(value).lower().split()]
        words = {w for n in names for w in n}
        if name in INLINE:
            return
        self.flush()
        if self.stack[-1][0] in CLOSES.get(name, CLOSES["p"]):
            self.pop(len(self.stack) - 1)
        _, above, never, by_words, inside = self.stack[-1]
        path = f"{above}/{name}" + "".join(f".{w}" for w in sorted(words)) if len(self.stack) < DEEPEST else above
        bad = name in NEVER_TAGS and not (name == "header" and inside)
        self.counts[path] = self.counts.get(path, 0) + 1
        if name in BLOCKS and path not in self.spared and not NEVER_WORDS.isdisjoint(words):
            strict = any(NEUTRAL.union(NEVER_WORDS).issuperset(n) and not NEVER_WORDS.isdisjoint(n) for n in names)
            if strict or not inside and (self.held is None or path in self.held):
                by_words = path
        self.stack.append((name, path, never or bad, by_words, inside or name in ("article", "main")))
        self.names[name] = self.names.get(name, 0) + 1

    def pop(self, i: int) -> None:
        """Close the elements from the ``i``-th on."""
        for name, *_ in self.stack[i:]:
            self.names[name] -= 1
        del self.stack[i:]

    def close(self, name: str) -> None:
        if not self.names.get(name):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == name:
                self.flush()
                self.pop(i)
                return

    def resume(self, low: str, at: int) -> None:
        """Close the outermost open element that is never data and has no end tag from here on."""
        for i in range(1, len(self.stack)):
            name = self.stack[i][0]
            if name in OPEN_ENDED:
                if name not in self.ends:
                    self.ends[name] = low.rfind("</" + name)
                if self.ends[name] < at - 1:
                    self.flush()
                    self.pop(i)
                    return


def _text_token(path: str, text: str) -> str:
    return "#" + hashlib.blake2b(f"{path}\n{text}".encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()


def page_tokens(pages: DataFrame) -> DataFrame:
    """host, token, count, chars, own, r1, r2: every distinct token of every page, and the root token ''.

    chars: of the text inside that may be data; own: of the text that words of this element condemn."""

    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            for host, source, r in zip(*(b.column(i).to_pylist() for i in range(3))):
                page = Page(source or "")
                if not page.blocks and not page.counts:
                    continue
                chars: dict[str, int] = {}
                texts: dict[str, int] = {}
                for path, text, never in page.blocks:
                    if not never:
                        chars[path] = chars.get(path, 0) + len(text)
                        t = _text_token(path, text)
                        texts[t] = texts.get(t, 0) + 1
                own: dict[str, int] = {}
                for path, text, by_words in page.condemned:
                    own[by_words] = own.get(by_words, 0) + len(text)
                    t = _text_token(path, text)
                    texts[t] = texts.get(t, 0) + 1
                total: dict[str, int] = {"": 0}
                for path, n in chars.items():
                    while path:
                        total[path] = total.get(path, 0) + n
                        path = path.rpartition("/")[0]
                    total[""] += n
                r1, r2 = (r & 0x7FFFFFFF) + 1, (r >> 32 & 0x7FFFFFFF) + 1
                for token, n in [("", 1), *page.counts.items(), *texts.items()]:
                    rows.append((host, token, n, total.get(token, 0), own.get(token, 0), n * r1, n * r2))
            cols = list(zip(*rows)) or [()] * 7
            kinds = [pa.string(), pa.string()] + [pa.int64()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["host", "token", "n", "chars", "own", "r1", "r2"])

    return pages.select("host", "html", F.xxhash64("page_id", "url").alias("r")).mapInArrow(
        run, "host string, token string, n long, chars long, own long, r1 long, r2 long")


def templates(tokens: DataFrame) -> DataFrame:
    """host, pages, template: the tokens of the valid classes of each host."""
    vectors = (tokens.groupBy("host", "token")
               .agg(F.count(F.lit(1)).alias("support"), F.sum("n").alias("total"), F.sum("chars").alias("chars"), F.sum("own").alias("own"),
                    F.sum("r1").alias("v1"), F.sum("r2").alias("v2")))
    vectors = staged(vectors.where("token = '' OR support > 1 OR NOT startswith(token, '#')"), "vectors")
    hosts = vectors.where("token = ''").select("host", F.col("support").alias("pages"))
    valid = vectors.join(hosts, "host").where("2 * support >= pages")
    # at most twice the tokens of a page remain for each host
    return valid.groupBy("host", "pages").agg(
        F.sort_array(F.collect_list(F.struct("token", "support", "total", "chars", "own", "v1", "v2"))).alias("template"))


def _tag(path: str) -> str:
    return path.rpartition("/")[2].split(".")[0]


def spared_elements(template: list[dict]) -> frozenset:
    """Paths of the element that holds nearly all text though words condemn it, and of those around it."""
    known = any(t["total"] == t["support"] and t["chars"] > 0 and _tag(t["token"]) in ("article", "main") for t in template)
    most = max(template, key=lambda t: (t.get("own", 0), t["token"]), default={})
    own, free = most.get("own", 0), sum(t["chars"] for t in template if t["token"] == "")
    if known or not own or own < SLOT_SHARE * (own + free):
        return frozenset()
    steps = most["token"].split("/")
    return frozenset("/".join(steps[:i]) for i in range(2, len(steps) + 1))


def main_slot(template: list[dict], pages: int) -> tuple[str | None, frozenset, frozenset, frozenset]:
    """Path of the main slot, the text blocks that belong to the template, the elements that words do not condemn and those
    the template holds."""
    classes: dict[tuple, list[dict]] = {}
    for t in template:
        classes.setdefault((t["v1"], t["v2"]), []).append(t)
    root = next((k for k, ts in classes.items() if any(t["token"] == "" for t in ts)), None)
    fixed = frozenset(t["token"] for t in classes.get(root, []) if t["token"].startswith("#") and t["total"] == t["support"] and pages > 1)
    held = frozenset(t["token"] for t in template if t["token"][:1] == "/" and pages > 1)
    spared = spared_elements(template)
    if spared:
        return None, fixed, spared, held  # chars were counted without the spared element

    def slots(ts: list[dict]) -> list[dict]:
        return [t for t in ts if t["token"][:1] == "/" and t["total"] == t["support"] and t["chars"] > 0
                and _tag(t["token"]) in CONTAINERS]

    every = [s for ts in classes.values() for s in slots(ts)]
    named = [t["token"] for t in every if _tag(t["token"]) in ("article", "main")]
    if not named:
        nested = slots(classes.get(root, [])) or every
        most = max((t["chars"] for t in nested), default=0)
        full = [t["token"] for t in nested if t["chars"] >= SLOT_SHARE * most]
        named = [p for p in full if _tag(p) not in ("html", "body")] or full
    return min(named, key=lambda p: (p.count("/"), p), default=None), fixed, spared, held


def extract(source: str, slot: str | None, fixed: frozenset, spared: frozenset = frozenset(), held: frozenset | None = None) -> str:
    blocks = [(p, t) for p, t, never in Page(source, spared, held).blocks if not never]
    inside = [(p, t) for p, t in blocks if slot and (p == slot or p.startswith(slot + "/"))] or blocks
    if slot and _tag(slot) in ("article", "main") and inside is not blocks:
        return " ".join(t for _, t in inside)
    return " ".join(t for _, t in [(p, t) for p, t in inside if _text_token(p, t) not in fixed] or inside)


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    found = staged(templates(page_tokens(rows)), "templates")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches):
        last, slot = None, main_slot([], 0)
        for b in batches:
            out = []
            for source, host, n, template in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5))):
                if (host, n) != last:
                    last, slot = (host, n), main_slot(template or [], n or 0)
                out.append(extract(source or "", *slot))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())],
                                             names=["page_id", "url", "text"])

    joined = rows.join(found, "host", "left").select("page_id", "url", "html", "host", "pages", "template")
    return (joined.mapInArrow(run, f"page_id {kind}, url string, text string")
            .withColumn("n_chars", F.length("text").cast("long")))
