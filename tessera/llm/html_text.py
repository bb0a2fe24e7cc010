"""Operator 7: main text by template deduction from equivalence classes.

Pages of one host share a template.  Its tokens are the structural tags of a
page, told apart by their path of open elements.  Tokens with the same
occurrence vector (how often each occurs on every page of the host) form an
equivalence class; one aggregate finds the classes, since a vector is summed up
by the sum of a hash of (page, occurrences).  The largest class that occurs
once on most pages is the root of a template; all other tokens nest in the slots
between its tokens, and their text counts there.  In each slot they form classes
of their own, of records too, which nest by the elements that hold them; each
says which of its own slots hold content.  Pages off the root are a group of
their own with the next root.  Extraction walks a page along its root and takes
the text of the slots that hold content, of the innermost class.  Pages of a
host without a root are one slot as a whole.  Hosts of one page, and pages of
one slot with an article, are read by their own tags.  No host's pages meet in
one task.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Tables, broadcast_if_light, kept_table

MIN_PAGES = 2  # unequal pages; one page alone does not tell a template from an article
SUPPORT = 0.5  # a template class occurs on this share of the group's pages
MIN_CLASS = 3
WRAP = 1 << 62  # sums of hashes of nested classes are taken modulo this
WHOLE = ""  # the token of a root that is before a page; no tag has it
# ends of a slot's path that are blocks of an article, not the element that holds it
TEXT_BLOCKS = r"(/(p|h[1-6]|ul|ol|li|dl|dt|dd|blockquote|pre|figure|figcaption|table|thead|tbody|tr|td|th|br|hr|img)([.][a-z]+)?)+$"

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title", "select", "object")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output progress q rp rt ruby "
                   "s samp small span strike strong sub sup time tt u var wbr img input embed".split())
ENDS = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
        "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}
# Elements, and words of class or id, that are not the article.
BOILER_TAGS = frozenset("nav header footer aside form button menu dialog head".split()) | frozenset(RAW)
BOILER_WORDS = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
                         "gdpr notice notices popup modal overlay newsletter subscribe subscription menu nav navbar navigation breadcrumb "
                         "breadcrumbs sidebar widget widgets related recommended share sharing social comment comments disqus reply replies "
                         "respond footer header masthead login signin signup search pagination pager toolbar skip".split())
MAIN_TAGS = frozenset(("article", "main"))
NEVER_BOILER = MAIN_TAGS | {"html", "body"}
# Names that say what a page has or lacks; trailing words that only place or shape an element; heads of an article; never the article.
STATES = frozenset("no not has with without is hide hidden show".split())
SHAPES = frozenset("left right top bottom area bar box list item items link links wrap wrapper container section block inner post posts "
                   "button buttons primary secondary".split())
ARTICLE_WORDS = frozenset("article entry post story content".split())
TALK_WORDS = frozenset("comment comments disqus reply replies respond".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|[^<]+|<", re.S | re.I)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")


def _boiler_word(name: str, in_main: bool) -> str | None:
    """The boilerplate word that a class, id or role is named for: the whole name or the last word that is no shape."""
    words = _WORDS.findall(name)
    if not words or words[0] in STATES:
        return None
    while len(words) > 1 and words[-1] in SHAPES:
        words.pop()
    if words[-1] not in BOILER_WORDS or (words[-1] == "header" and (in_main or ARTICLE_WORDS & set(words))):
        return None
    return words[-1]


def _name(tag: str, attributes: str, in_main: bool = False) -> tuple[str, bool, bool]:
    """Label of an element, whether it is boilerplate, and whether it is so even if it holds most of the page."""
    names = [n for m in _NAMED.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").lower().split()] if "=" in attributes else []
    first = next((w for n in names for w in _WORDS.findall(n)), None)
    label = f"{tag}.{first}" if first else tag
    if tag in NEVER_BOILER:
        return label, False, False
    found = {w for n in names if (w := _boiler_word(n, in_main))}
    return label, (tag in BOILER_TAGS and not (tag == "header" and in_main)) or bool(found), bool(found & TALK_WORDS)


class _Element:
    __slots__ = ("tag", "path", "up", "flagged", "talk", "main", "chars", "main_chars", "boiler")

    def __init__(self, tag, label, up, flagged, talk):
        self.tag, self.up, self.flagged, self.talk = tag, up, flagged, talk
        self.path = f"{up.path}/{label}" if up.path else label
        self.main, self.chars, self.main_chars, self.boiler = up.main or tag in MAIN_TAGS, 0, 0, False


class _Top:
    """What holds the outermost elements."""
    tag, path, up, flagged, main, boiler = "", "", None, False, False, False

    def __init__(self):
        self.chars = self.main_chars = 0


def _parse(page: str) -> tuple[list[tuple], list[_Element], _Top]:
    """Events ("tag", token, element of the slot) and ("text", text, element, link), and all elements, outer ones first."""
    top = _Top()
    stack, events, elements, link = [top], [], [], 0
    for m in _TOKEN.finditer(page):
        s = m[0]
        if s[0] != "<" or s == "<":
            events.append(("text", s, stack[-1], link > 0))
            n = 0 if link else len(s.strip())
            stack[-1].chars += n
            stack[-1].main_chars += n if stack[-1].main else 0
            continue
        tag = (m[3] or "").lower()
        if m[1] or not tag:
            continue  # comments, declarations, raw elements
        if m[2]:
            if tag == "a":
                link = max(0, link - 1)
            if tag in INLINE:
                continue
            at = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), None)
            if at is not None:
                events.append(("tag", stack[at].path + "/", stack[at - 1]))
                del stack[at:]
            continue
        if tag == "a":
            link += 1
        if tag in INLINE:
            continue
        for end in ENDS.get(tag, ()):
            if stack[-1].tag == end:
                stack.pop()
        label, flagged, talk = _name(tag, m[4] or "", stack[-1].main)
        here = _Element(tag, label, stack[-1], flagged, talk)
        elements.append(here)
        events.append(("tag", here.path, here))
        if tag not in VOID:
            stack.append(here)
    return events, elements, top


def walk(page: str):
    """Events of a page: ("tag", token, boiler, in_main) for structural tags and ("text", text, boiler, in_main, link).

    An element named for boilerplate is none if it holds more than half of the
    text outside links: of the text in main and article, if there is any.
    """
    events, elements, top = _parse(page)
    for e in reversed(elements):
        e.up.chars += e.chars
        e.up.main_chars += e.main_chars
    for e in elements:
        held, whole = (e.main_chars, top.main_chars) if top.main_chars else (e.chars, top.chars)
        # inside an article an element is a part of it
        wraps = held * 2 > whole and not e.talk and not (top.main_chars and e.main)
        e.boiler = e.up.boiler or (e.flagged and not wraps)
    for e in events:
        if e[0] == "tag":
            yield "tag", e[1], e[2].boiler, e[2].main
        else:
            yield "text", e[1], e[2].boiler, e[2].main, e[3]


def profile(page: str) -> dict[str, list]:
    """token -> [occurrences, order of the first one, boiler, main]."""
    out: dict[str, list] = {}
    for e in walk(page):
        if e[0] == "tag":
            out.setdefault(e[1], [0, len(out), e[2], e[3]])[0] += 1
    return out


def _profiles(batches):
    names = ["id", "grp", "token", "n", "place", "boiler", "main"]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
    for batch in batches:
        ids, grps, pages = (batch.column(c).to_pylist() for c in ("id", "grp", "html"))
        for lo in range(0, len(ids), 64):
            rows = [(i, g, t, *v) for i, g, p in zip(ids[lo:lo + 64], grps[lo:lo + 64], pages[lo:lo + 64], strict=True)
                    for t, v in profile(p or "").items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _places(events: list[tuple], root: list[str]) -> dict[str, int] | None:
    """Slot of each token of the root, if the page has these tokens once each and in order."""
    place = {t: k for k, t in enumerate(root)}
    return place if WHOLE in place or [place[e[1]] for e in events if e[0] == "tag" and e[1] in place] == list(range(len(root))) else None


def slots(events: list[tuple], place: dict[str, int]) -> list[list[int]]:
    """[characters, of these in links, checksum] of the text of each slot, nested tokens' text included."""
    out = [[0, 0, 0] for _ in place]
    slot = place.get(WHOLE, -1)
    for e in events:
        if e[0] == "tag":
            slot = place.get(e[1], slot)
        elif slot >= 0 and not e[2]:
            text = e[1].strip()
            now = out[slot]
            now[0] += len(text)
            now[1] += len(text) if e[4] else 0
            now[2] = zlib.crc32(text.encode("utf-8", "surrogatepass"), now[2])
    return out


def nested(events: list[tuple], place: dict[str, int]) -> dict[tuple[int, str], list]:
    """(slot, token) of the tokens in the slots -> [occurrences, order of the first one, main (no boiler), characters, of these in
    links, checksum of the text after all occurrences, least and largest checksum of the text after one]."""
    out: dict[tuple[int, str], list] = {}
    slot, now, check = place.get(WHOLE, -1), None, 0
    for e in events:
        if e[0] == "tag":
            if now is not None:
                now[6:] = min(now[6], check), max(now[7], check)
            slot, now, check = place.get(e[1], slot), None, 0
            if slot >= 0 and e[1] not in place:
                now = out.setdefault((slot, e[1]), [0, len(out), e[3] and not e[2], 0, 0, 0, 1 << 32, -1])
                now[0] += 1
        elif now is not None and not e[2] and (text := e[1].strip()):
            now[3] += len(text)
            now[4] += len(text) if e[4] else 0
            data = text.encode("utf-8", "surrogatepass")
            now[5], check = zlib.crc32(data, now[5]), zlib.crc32(data, check)
    if now is not None:
        now[6:] = min(now[6], check), max(now[7], check)
    return out


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), signed=True)


def _held(token: str, known: dict[str, list[int]]) -> list[int]:
    """Hashes of a token and of the elements that hold it, inner ones first; ``known`` has these of elements met before."""
    outer = path = token.removesuffix("/").rpartition("/")[0]
    new = []
    while path and path not in known:
        new.append(path)
        path = path.rpartition("/")[0]
    for p in reversed(new):
        known[p] = [_hash(p), *known.get(p.rpartition("/")[0], ())]
    return [_hash(token), *known.get(outer, ())]


_MARKS = ("grp string, slot int, token string, chars bigint, links bigint, low bigint, high bigint, id string, html string, pages bigint, "
          "vector bigint, place bigint, main boolean, low_one bigint, high_one bigint, low_slot bigint, high_slot bigint, slot_chars bigint, held array<bigint>")


def _marks(batches):
    """Slots of the pages that follow their root and the tokens in these slots, summed up, and the pages that do not (slot -1)."""
    names, types = zip(*(c.split() for c in _MARKS.split(", ")), strict=True)
    kinds = [{"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "array<bigint>": pa.list_(pa.int64())}[t] for t in types]
    for batch in batches:
        sums: dict[tuple, list] = {}
        known: dict[str, list[int]] = {}
        rows = []
        for i, g, p, root in zip(*(batch.column(c).to_pylist() for c in ("id", "grp", "html", "root")), strict=True):
            events = list(walk(p or ""))
            place = _places(events, root)
            if place is None:
                rows.append((g, -1, None, 0, 0, 0, 0, i, p, *[None] * 10))
                continue
            parts = slots(events, place)
            for k, (chars, links, check) in enumerate(parts):
                now = sums.setdefault((g, k, None), [0, 0, check, check])
                now[:] = now[0] + chars, now[1] + links, min(now[2], check), max(now[3], check)
            hashes: dict[int, int] = {}
            for (k, token), (n, order, main, chars, links, check, low, high) in nested(events, place).items():
                if n not in hashes:
                    hashes[n] = _hash(f"{n} {i}") % WRAP
                whole, part = parts[k][0], parts[k][2]
                now = sums.get((g, k, token))
                if now is None:
                    sums[g, k, token] = [chars, links, check, check, 1, hashes[n], order, main, low, high, part, part, whole, _held(token, known)]
                else:
                    now[:-1] = (now[0] + chars, now[1] + links, min(now[2], check), max(now[3], check), now[4] + 1, (now[5] + hashes[n]) % WRAP,
                                now[6] + order, now[7] and main, min(now[8], low), max(now[9], high), min(now[10], part), max(now[11], part),
                                now[12] + whole)
        rows += [(*k, *v[:4], None, None, *(v[4:] or [None] * 10)) for k, v in sums.items()]
        for lo in range(0, len(rows), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[lo:lo + 256], strict=True), kinds, strict=True)], names=names)


def _sizes(pages: DataFrame, min_pages: int) -> DataFrame:
    """g and pages of each group.  Equal pages count as one, since they cannot tell a template from an article."""
    return kept_table(pages.groupBy("grp", F.xxhash64("html").alias("page")).agg(F.count(F.lit(1)).alias("n"))
                      .groupBy(F.col("grp").alias("g")).agg(F.sum("n").alias("pages"), F.count(F.lit(1)).alias("kinds"))
                      .where(F.col("kinds") >= min_pages))


def _classes(pages: DataFrame, sizes: DataFrame) -> DataFrame:
    """grp, support, vector and tokens of the classes that occur once on most pages of each group, from pages (id, grp, html)."""
    seen = pages.mapInArrow(_profiles, "id string, grp string, token string, n bigint, place bigint, boiler boolean, main boolean")
    tokens = seen.groupBy("grp", "token").agg(
        F.count(F.lit(1)).alias("support"), F.max("n").alias("most"),
        F.sum(F.xxhash64("id", "n").cast("decimal(38,0)")).alias("vector"),
        F.avg("place").alias("place"), F.max("boiler").alias("boiler"), F.min("main").alias("main"))
    # an equivalence class: same vector, so same support; the tokens of a group's template are few
    return (tokens.where("most = 1").join(sizes, F.col("grp") == F.col("g")).where(F.col("support") >= F.col("pages") * SUPPORT)
            .groupBy("grp", "support", "vector")
            .agg(F.sort_array(F.collect_list(F.struct("place", "token", "boiler", "main"))).alias("tokens"))
            .where(F.size("tokens") >= MIN_CLASS))


def _largest(classes: DataFrame, sizes: DataFrame) -> DataFrame:
    root = classes.groupBy("grp").agg(F.max(F.struct(F.size("tokens").alias("k"), "support", "vector", "tokens")).alias("r"))
    whole = F.array(F.struct(F.lit(0.0).alias("place"), F.lit(WHOLE).alias("token"), F.lit(False).alias("boiler"), F.lit(False).alias("main")))
    return sizes.join(root, F.col("grp") == F.col("g"), "left").select(F.col("g").alias("grp"), F.coalesce("r.tokens", whole).alias("t"))


def roots(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """grp and t (ordered tokens) of the largest class on most pages of each group, from pages (id, grp, html).

    Without such a class the root is the token before a page, so that the whole page is one slot.
    """
    sizes = _sizes(pages, min_pages)
    return _largest(_classes(pages, sizes), sizes)


def _ranks(batches):
    """Least and largest rank of the tokens of each class among them, on the pages that have the class."""
    names = ["grp", "support", "vector", "token", "low", "high"]
    kinds = (pa.string(), pa.int64(), pa.decimal128(38, 0), pa.string(), pa.int64(), pa.int64())
    for batch in batches:
        found: dict[tuple, list[int]] = {}
        for g, p, classes in zip(*(batch.column(c).to_pylist() for c in ("grp", "html", "classes")), strict=True):
            tags = [e[1] for e in walk(p or "") if e[0] == "tag"]
            for c in classes:
                wanted = set(c["tokens"])
                ordered = [t for t in tags if t in wanted]
                if len(ordered) == len(wanted) == len(set(ordered)):
                    for k, t in enumerate(ordered):
                        now = found.setdefault((g, c["support"], c["vector"], t), [k, k])
                        now[:] = min(now[0], k), max(now[1], k)
        rows = [(*k, *v) for k, v in found.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def ordered_roots(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """As ``roots``, for groups whose pages have the largest class in other orders: of each class the tokens that keep their
    rank in it on all its pages, so that all of these follow."""
    sizes = _sizes(pages, min_pages)
    classes = kept_table(_classes(pages, sizes))
    held = classes.groupBy(F.col("grp").alias("g")).agg(F.collect_list(F.struct(
        "support", "vector", F.transform("tokens", lambda x: x["token"]).alias("tokens"))).alias("classes"))
    held = broadcast_if_light(kept_table(held), F.length(F.to_json(F.struct("g", "classes"))))
    ranks = (pages.join(held, F.col("grp") == F.col("g")).select("grp", "html", "classes")
             .mapInArrow(_ranks, "grp string, support bigint, vector decimal(38,0), token string, low bigint, high bigint")
             .groupBy("grp", "support", "vector", "token").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low = high"))
    tokens = classes.select("grp", "support", "vector", F.explode("tokens").alias("x")).select("grp", "support", "vector", "x.token", "x.boiler", "x.main")
    kept = (tokens.join(ranks, ["grp", "support", "vector", "token"]).groupBy("grp", "support", "vector")
            .agg(F.sort_array(F.collect_list(F.struct(F.col("low").cast("double").alias("place"), "token", "boiler", "main"))).alias("tokens"))
            .where(F.size("tokens") >= MIN_CLASS))
    return _largest(kept, sizes)


def _contents(root: DataFrame, marks: DataFrame) -> DataFrame:
    """grp, root (ordered tokens), content (whether the slot after each token is content), has_main (whether an article says so); roots
    that no page follows have none."""
    sums = marks.where("slot >= 0 AND token IS NULL").groupBy("grp", "slot").agg(
        F.sum("chars").alias("chars"), F.sum("links").alias("links"), (F.min("low") != F.max("high")).alias("varies"))
    sums = sums.groupBy(F.col("grp").alias("g")).agg(F.sort_array(F.collect_list(F.struct("slot", "chars", "links", "varies"))).alias("s"))
    root = _with_content(root.join(sums, F.col("grp") == F.col("g")).withColumn("heavy", F.lit(True)))
    root = root.withColumn("root", F.transform("t", lambda x: x["token"]))
    content = F.when(F.array_contains("root", WHOLE), F.array(F.lit(True))).otherwise(F.col("content"))
    return root.select("grp", "root", content.alias("content"), "has_main")


def _with_content(root: DataFrame) -> DataFrame:
    """``root`` with the columns content and has_main, from t (ordered tokens), s (text of the slot after each) and heavy: whether the
    slot with most text counts even if its text is the same on all pages."""
    # content slots: inside the article where the template has one; else all from the first to the last slot whose text,
    # mostly outside links, differs between pages, and all of the element that holds the slot with most of it
    root = root.withColumn("has_main", F.exists("t", lambda x: x["main"] & ~x["boiler"]))
    root = root.withColumn("own", F.transform("t", lambda x, i: F.when(x["boiler"], F.lit(-1)).otherwise(
        F.get("s", i)["chars"] - 2 * F.get("s", i)["links"])))
    root = root.withColumn("best", F.array_max("own"))
    root = root.withColumn("at", F.filter(F.transform("t", lambda x, i: F.when(
        (F.get("own", i) > 0) & (F.get("s", i)["varies"] | (F.col("heavy") & (F.get("own", i) == F.col("best")))), i)),
        lambda i: i.isNotNull()))
    top = F.get("t", (F.array_position("own", F.col("best")) - 1).cast("int"))["token"]
    holder = F.regexp_replace(F.regexp_replace(top, "(^|/)[^/]+/$", ""), TEXT_BLOCKS, "")
    root = root.withColumn("holder", F.when((F.col("best") > 0) & ~holder.rlike(r"(^|/)(html|body)?([.][a-z]+)?$"), holder))

    def inside(x):
        return F.coalesce((x["token"] == F.col("holder")) | (x["token"].startswith(F.concat("holder", F.lit("/"))) & (x["token"] != F.concat("holder", F.lit("/")))),
                          F.lit(False))
    content = F.transform("t", lambda x, i: ~x["boiler"] & F.when(F.col("has_main"), x["main"]).otherwise(
        (F.size("at") > 0) & (((i >= F.array_min("at")) & (i <= F.array_max("at"))) | inside(x))))
    return root.withColumn("content", content)


def _nested(root: DataFrame, marks: DataFrame, min_pages: int) -> DataFrame:
    """grp and nested, an array of (slot, token, content): whether the text after a token of a class in a slot of the root is content.

    Classes in a slot are tokens with the same occurrence vector, of records too, on ``min_pages`` pages whose text in the slot is not
    the same.  Text after another token is that of the nearest element of a class that holds it; after the last end tag of a class it
    is outside the class.  Text that is the same wherever it occurs is the template's, unless the class holds most of its slot.  Slots
    in which no class says other than the root have no row; where the root has an article that says what is content.
    """
    tokens = kept_table(marks.where("token IS NOT NULL").groupBy("grp", "slot", "token", "held").agg(
        F.sum("pages").alias("support"), (F.sum(F.col("vector").cast("decimal(38,0)")) % WRAP).alias("vector"),
        (F.sum("place") / F.sum("pages")).alias("place"), F.min("main").alias("main"), F.sum("chars").alias("chars"), F.sum("links").alias("links"),
        ((F.min("low") != F.max("high")) & (F.min("low_one") != F.max("high_one"))).alias("varies"),
        (F.min("low_slot") != F.max("high_slot")).alias("unequal"), F.sum("slot_chars").alias("slot_chars")))
    own = ["grp", "slot", "support", "vector"]
    classes = (tokens.where("unequal").where(F.col("support") >= min_pages).groupBy(*own)
               .agg(F.sort_array(F.collect_list(F.struct("place", "token", "main", F.get("held", F.lit(0)).alias("h")))).alias("t"), F.max("slot_chars").alias("slot_chars"))
               .where(F.size("t") >= MIN_CLASS))
    members = classes.select(*own, "slot_chars", F.size("t").alias("k"), F.posexplode("t").alias("i", "x"))
    members = kept_table(members.select(*own, "slot_chars", "i", "x.token", "x.main", "x.h",
                                        ((F.col("i") == F.col("k") - 1) & F.col("x.token").endswith("/")).alias("last")))
    # the text after each token goes to the nearest member that holds it; it differs too if not all pages of the class have the token
    texts = tokens.where("chars > 0").select("grp", "slot", F.get("held", F.lit(0)).alias("own"), F.col("support").alias("n"), "chars", "links",
                                             "varies", F.posexplode("held").alias("up", "h"))
    holders = members.where("NOT last").select("grp", "slot", "h", "support", "vector")
    texts = texts.join(holders, ["grp", "slot", "h"]).groupBy("grp", "slot", "own", "n", "chars", "links", "varies").agg(
        F.min_by(F.struct("support", "vector", "h"), "up").alias("c"))
    texts = texts.groupBy("grp", "slot", "c.support", "c.vector", "c.h").agg(
        F.sum("chars").alias("chars"), F.sum("links").alias("links"), F.max(F.col("varies") | (F.col("n") < F.col("c.support"))).alias("varies"))
    zero = F.lit(0).cast("bigint")
    classes = members.join(texts, [*own, "h"], "left").groupBy(*own).agg(
        F.sort_array(F.collect_list(F.struct("i", "token", "main", F.lit(False).alias("boiler"), "last"))).alias("t"),
        F.sort_array(F.collect_list(F.struct("i", F.coalesce("chars", zero).alias("chars"), F.coalesce("links", zero).alias("links"),
                                             F.coalesce("varies", F.lit(False)).alias("varies")))).alias("s"),
        (F.sum("chars") * 2 > F.max("slot_chars")).alias("heavy")).withColumn("heavy", F.coalesce("heavy", F.lit(False)))
    found = _with_content(classes).select("grp", "slot", F.explode(F.arrays_zip(F.col("t"), F.col("content"))).alias("x"))
    found = found.where("NOT x.t.last").select("grp", "slot", "x.t.token", "x.content")
    outer = root.where("NOT has_main").select(F.col("grp").alias("g"), F.posexplode("content").alias("k", "outer"))
    found = found.join(outer, (F.col("grp") == F.col("g")) & (F.col("slot") == F.col("k"))).groupBy("grp", "slot").agg(
        F.collect_list(F.struct("slot", "token", "content")).alias("nested"), F.max(F.col("content") != F.col("outer")).alias("differs"))
    return found.where("differs").groupBy(F.col("grp").alias("g")).agg(F.flatten(F.collect_list("nested")).alias("nested"))


_TEMPLATES = "array<struct<step int, root array<string>, content array<boolean>, nested array<struct<slot int, token string, content boolean>>>>"


def templates(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """grp and templates, an array of (step, root, content, nested), from pages (id, grp, html).

    The pages that do not follow their group's root are a group of their own,
    and so on until no root is left: a root is on half of the pages at least,
    so the steps are about as many as the logarithm of a group's pages; a group
    without a root is one slot and done.  A root that no page follows, since its
    tokens have no common order, is made again of those that have one.
    """
    tables, step, rest, found, old, lost = Tables(pages.sparkSession), 0, pages, None, None, None
    while True:
        root = roots(rest, min_pages)
        if lost is not None:
            root = root.join(lost, "grp", "left_anti").union(ordered_roots(rest.join(lost, "grp", "left_semi"), min_pages))
        root = kept_table(root)
        if root.isEmpty():
            break
        light = broadcast_if_light(root.select(F.col("grp").alias("g"), F.transform("t", lambda x: x["token"]).alias("root")),
                                   F.length(F.to_json(F.struct("g", "root"))))
        marks = tables.keep(rest.join(light, F.col("grp") == F.col("g")).select("id", "grp", "html", "root").mapInArrow(_marks, _MARKS))
        if old is not None:
            tables.drop(old)
        now = kept_table(_contents(root, marks))
        inner = kept_table(_nested(now, marks, min_pages))
        now = kept_table(now.join(inner, F.col("grp") == F.col("g"), "left")
                         .select("grp", F.struct(F.lit(step).alias("step"), "root", "content", "nested").alias("r")))
        found = now if found is None else found.union(now)
        # a root in order that no page follows is the last of its group
        missed = root.select("grp").join(now, "grp", "left_anti")
        missed = kept_table(missed if lost is None else missed.join(lost, "grp", "left_anti"))
        lost = None if missed.isEmpty() else missed
        on = now.select("grp") if lost is None else now.select("grp").union(lost)
        rest = marks.where("slot < 0").select("id", "grp", "html").join(on, "grp", "left_semi").select("id", "grp", "html")
        step, old = step + 1, marks
    if old is not None:
        tables.drop(old)
    if found is None:
        return pages.sparkSession.createDataFrame([], f"grp string, templates {_TEMPLATES}")
    return found.groupBy("grp").agg(F.sort_array(F.collect_list("r")).alias("templates"))


def _blocks(events) -> str:
    """Text of ("text", s) and ("break",) events: blocks with single blanks, joined by line ends."""
    out, now = [], []
    for e in events:
        if e[0] == "text":
            now.append(e[1])
        else:
            out.append(" ".join(entities.unescape("".join(now)).split()))
            now = []
    out.append(" ".join(entities.unescape("".join(now)).split()))
    return "\n".join(b for b in out if b)


def _content_at(nested: dict[str, bool], token: str, outer: bool) -> bool:
    """Whether the text after a token in a slot is content: as the token says, or the nearest element that holds it, or the slot."""
    passed = []
    while token and token not in nested:
        passed.append(token)
        token = token.removesuffix("/").rpartition("/")[0]
    found = nested[token] if token else outer
    nested.update(dict.fromkeys(passed, found))  # not looked for again
    return found


def main_text(page: str | None, found: list[dict] | None = None) -> str:
    """The article of one page, along the first of its host's templates (root, content, nested) that it follows."""
    if not page:
        return ""
    events = list(walk(page))
    has_main = any(e[0] == "text" and e[3] and not e[2] and e[1].strip() for e in events)
    for t in found or ():
        place = _places(events, t["root"])
        if place is not None and not (WHOLE in place and has_main):
            inner: dict[int, dict[str, bool]] = {}
            for n in t["nested"] or ():
                inner.setdefault(n["slot"], {})[n["token"]] = n["content"]
            slot = place.get(WHOLE, -1)
            here, take = slot >= 0, []
            for e in events:
                if e[0] == "tag":
                    slot = place.get(e[1], slot)
                    here = slot >= 0 and t["content"][slot]
                    if slot in inner and e[1] not in place:
                        here = _content_at(inner[slot], e[1], here)
                    take.append(("break",))
                elif here and not e[2]:
                    take.append(e)
            return _blocks(take)
    return _blocks([("break",) if e[0] == "tag" else e for e in events if e[0] == "tag" or (not e[2] and (e[3] or not has_main))])


def _extract(batches):
    for batch in batches:
        ids, pages, found = (batch.column(c).to_pylist() for c in ("row", "html", "templates"))
        for lo in range(0, len(ids), 64):
            text = [main_text(p, t) for p, t in zip(pages[lo:lo + 64], found[lo:lo + 64], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[lo:lo + 64], pa.string()), pa.array(text, pa.string())], names=["row", "text"])


def extract(pages: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages`` (page_id, url, html).

    A null or empty page has an empty text.  A page without a host in its url
    is read by its own tags.  Repeated rows are all extracted, ids may be null
    or repeat; other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.to_json(F.struct("page_id", "url"), {"ignoreNullFields": "false"}).alias("row"),
                        F.concat_ws(" ", F.col("page_id").cast("string"), F.xxhash64("html").cast("string")).alias("id"),  # ids may repeat or be null
                        host.alias("grp"), F.col("html").alias("html"))
    found = kept_table(templates(rows.where("grp <> ''").select("id", "grp", "html"), min_pages).withColumnRenamed("grp", "g"))
    found = broadcast_if_light(found, F.length(F.to_json(F.struct("g", "templates"))))
    out = (rows.join(found, F.col("grp") == F.col("g"), "left").select("row", "html", "templates")
           .mapInArrow(_extract, "row string, text string"))
    kinds = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string"
    out = out.select(F.from_json("row", kinds).alias("row"), "text")
    return out.select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))
