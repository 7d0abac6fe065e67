"""Main text of web pages by template deduction (operator 8).

Pages of one host are compared: a token is a tag at its path, or a block of
text at its path. Tokens with the same occurrence vector over the host's
pages form an equivalence class; a class that is frequent, has several tokens
and keeps their order in every occurrence on every page is valid. Of two valid
classes that are not nested (one always in the same place of the other, or
never in it) the weaker goes; the rest is the host's template. Its tokens cut
every page into slots, and a page's text is taken from its slots: text that is
itself a template token lies in none. The tags are a filter on slots: menus,
headers, footers and the like are left out by the tags and names of their
place. On a page with article or main elements the text is what they hold,
without those that are template from end to end; within the others text that
repeats stays. On a page without, the slots that hold articles on other pages
of the host are taken, if most of its own text is there, else all slots.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitwise.llm.common import staged

#: Parts of a group of copies that holds a thousandth of all pages or more.
SALTS = 64
#: A class shows on a page that it is template by at most this many times the page's own text.
OWN_TIMES = 4

_MARKUP = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|title|select|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>?"
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"<]*"|'[^'<]*')*+>|[^>]*>?)""",
    re.DOTALL | re.IGNORECASE,
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags that begin and end a block of text.
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
#: An open tag of the key is ended by the opening of one of these.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}}
#: Tags, roles and words of class or id whose text is no part of an article.
_ASIDE_TAGS = frozenset("nav footer aside form button head menu dialog".split())
_ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
_ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion banner cookie cookies consent gdpr "
    "notice notices notification newsletter subscribe subscription popup modal overlay nav navbar navigation menu menus breadcrumb "
    "breadcrumbs sidebar sidebars widget widgets related recommended share sharing social comment comments disqus respond reply replies "
    "footer header masthead topbar toolbar login signup pagination pager".split()
)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)


#: Parts of a class or id that tell of a layout around the article ("no-sidebar").
_LAYOUT_PARTS = frozenset("no non has have with without".split())
_IN_NAME = re.compile(r"[^a-z0-9]+")


def _is_aside(tag: str, attrs: str) -> bool:
    """Whether the tag or its role says so."""
    if tag in _ASIDE_TAGS:
        return True
    roles = [value for name, value in _ATTR.findall(attrs) if name.lower() == "role"]
    return any(_ASIDE_ROLES & set(_IN_NAME.split(value.lower())) for value in roles)


def _mark(attrs: str, in_main: bool) -> str:
    """``word`` if a class or id is one of the words, ``part`` if names only hold one, else empty.

    In an article the word header says nothing: its title is there.
    """
    words = _ASIDE_WORDS - {"header"} if in_main else _ASIDE_WORDS
    found = ""
    for attr, value in _ATTR.findall(attrs):
        if attr.lower() != "role":
            for name in value.lower().split():
                parts = [x for x in _IN_NAME.split(name) if x]
                if words.intersection(parts) and not _LAYOUT_PARTS.intersection(parts):
                    if len(parts) == 1:
                        return "word"
                    found = "part"
    return found


def _token(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode(), digest_size=8).digest(), "little", signed=True)


class Block(NamedTuple):
    token: int
    place: str
    text: str
    at: int  # its place among the page's tokens
    unit: int  # number of the outermost article or main element around; 0 in none


def parse(page: str | None) -> tuple[list[Block], list[int]]:
    """``(blocks, tokens)`` of a page: its blocks of text, and the tokens of tags and blocks, in its order.

    A block's place is ``main`` in an article or main element, ``aside`` in what an article never holds, else ``body``.
    A class or id alone makes an aside only of an element around no article or
    main element; an article in an article, or in such an element after one,
    is a comment or a teaser and no reason to keep the element. A page without
    either whose text is all below names that only hold a word keeps it.
    Text in references is decoded; white space within a block is one space.
    Scripts, styles, comments and their like are passed over.
    """
    if not page:
        return [], []
    stack: list[tuple[str, str, tuple[int, ...], int]] = []  # open tags with their place, the marked elements around and the unit
    path = ""
    found: list[tuple[Block, tuple[int, ...]]] = []
    marks: list[str] = []
    kept: set[int] = set()  # marked elements that are no aside after all
    tokens: list[int] = []
    text: list[str] = []
    begin = 0  # place of the open block among the tokens
    article_seen = False
    units = 0

    def add(part: str) -> None:
        nonlocal begin
        if not text:
            begin = len(tokens)
        if text or not part.isspace():
            text.append(part)

    def flush() -> None:
        if text:
            words = html.unescape("".join(text)).split()
            text.clear()
            if words:
                line = " ".join(words)
                _, place, around, unit = stack[-1] if stack else ("", "body", (), 0)
                token = _token("text", path, line)
                found.append((Block(token, place, line, begin, unit), around))
                tokens.insert(begin, token)

    def pop_to(i: int) -> None:
        nonlocal path
        del stack[i:]
        path = "/".join(x[0] for x in stack)

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _BLOCK:
            flush()
        elif tag == "br":
            add(" ")
        if m[2]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
            continue
        if tag in _VOID:
            continue
        if tag in _BLOCK:
            while stack and (stack[-1][0] not in _BLOCK or stack[-1][0] == "p") and any(x[0] == "p" for x in stack):
                pop_to(len(stack) - 1)
            if stack and tag in _ENDS.get(stack[-1][0], ()):
                pop_to(len(stack) - 1)
        role = "main" if re.search(r"""\brole\s*=\s*["']?main\b""", m[4], re.IGNORECASE) else ""
        is_main = tag in ("article", "main") or role
        if is_main:  # an unclosed menu or header does not swallow the article
            for i, x in enumerate(stack):
                if x[0] in ("nav", "header", "head"):
                    pop_to(i)
                    break
        _, place, around, unit = stack[-1] if stack else ("", "body", (), 0)
        outside = place != "main"
        if place != "aside":
            in_article = any(x[0] == "article" for x in stack)
            if _is_aside(tag, m[4]) or (tag == "header" and place != "main"):
                place = "aside"
            elif is_main and not in_article:
                if tag != "article" or not article_seen:
                    kept.update(around)
                article_seen |= tag == "article" and kept.issuperset(around)
                place = "main"
            else:
                mark = "" if tag == "header" else _mark(m[4], place == "main")
                if mark:
                    around = (*around, len(marks))
                    marks.append(mark)
                if is_main:
                    place = "main"
        if tag == "body":
            place, around = "body", ()
        if place != "main":
            unit = 0
        elif outside:
            units += 1
            unit = units
        stack.append((tag, place, around, unit))
        path = f"{path}/{tag}" if path else tag
        tokens.append(_token("tag", path))
    if at < len(page):
        add(page[at:])
    flush()
    if not any(b.place == "main" or (b.place == "body" and kept.issuperset(around)) for b, around in found):
        kept.update(i for i, mark in enumerate(marks) if mark == "part")
    return [b if kept.issuperset(around) else b._replace(place="aside") for b, around in found], tokens


def wanted(blocks: list[Block]) -> list[Block]:
    """The blocks in article or main elements; on a page without those outside of asides."""
    place = "main" if any(b.place == "main" for b in blocks) else "body"
    return [b for b in blocks if b.place == place]


#: A page's distinct tokens, the places of each, characters of its text (none for a tag or in an aside);
#: then place, unit and characters of its wanted blocks.
_TOKENS = "tokens array<long>, at array<array<long>>, chars array<long>, block_at array<long>, block_unit array<long>, block_chars array<long>"


def _parse_tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for page in pdf["html"]:
            blocks, tokens = parse(page)
            at: dict[int, list[int]] = {}
            for i, t in enumerate(tokens):
                at.setdefault(t, []).append(i)
            chars = {b.token: len(b.text) for b in blocks if b.place != "aside"}
            own = wanted(blocks)
            out.append((list(at), list(at.values()), [chars.get(t) or 0 for t in at], [b.at for b in own], [b.unit for b in own], [len(b.text) for b in own]))
        columns = ["tokens", "at", "chars", "block_at", "block_unit", "block_chars"]
        lists = pd.DataFrame(out, columns=columns, index=pdf.index)
        yield pd.concat([pdf[["uid", "host"]], lists], axis=1)


def distinct_pages(pages: DataFrame) -> DataFrame:
    """``host, uid, copies, page``: each text of a host's ``pages`` once, with its tokens.

    ``uid`` stands for the text alone: copies under other ids or addresses and
    repeated rows are one page. They combine in the map tasks.
    """
    parsed = pages.mapInPandas(_parse_tokens, f"uid long, host string, {_TOKENS}")
    page = F.struct("tokens", "at", "chars", "block_at", "block_unit", "block_chars")
    return staged(parsed.groupBy("host", "uid").agg(F.count("*").alias("copies"), F.first(page).alias("page")), "distinct-pages")


def _parse_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = pdf[["page_id", "url", "host", "uid"]].copy()
        out["page_id"] = out["page_id"].astype("Int64")
        out["blocks"] = [[b.text for b in wanted(parse(x)[0])] for x in pdf["html"]]
        yield out


def template_tokens(pages: DataFrame, *, least_pages: int = 3) -> DataFrame:
    """``host, uid, cls, n, size, at``: the template's classes on each page, with the places of their tokens there.

    ``pages`` are the ``distinct_pages``: copies are no further evidence.
    A host's equivalence classes are its tokens grouped by occurrence vector,
    of which a fingerprint is enough. Of those on ``least_pages`` pages or
    more, however large the host, the classes of two tokens or more that come
    in one order, occurrence after occurrence, on every page are valid. Near
    copies of a page share their text like a template, too, but have little of
    their own: a class is valid only if on ``least_pages`` pages the text that
    fewer pages share times ``OWN_TIMES`` is at least as long as the class's.
    Valid classes that are not nested go (``not_nested``). ``at`` has an array
    per token, in the order of the class. Tokens are rows throughout; only a
    page's own are gathered.
    """
    page = F.arrays_zip(*[F.col(f"page.{c}").alias(c) for c in ("tokens", "at", "chars")])
    tokens = pages.select("host", "uid", F.inline(page)).withColumnRenamed("tokens", "token")
    vectors = tokens.groupBy("host", "token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("uid", F.size("at"))).alias("vector"))
    frequent = vectors.where(F.col("n") >= least_pages)
    placed = tokens.join(frequent, ["host", "token"])
    ordered = F.array_sort(F.collect_list(F.struct("at", "token")))
    by_page = placed.groupBy("host", "uid", "n", "vector").agg(ordered.alias("placed"), F.sum("chars").alias("chars"))
    by_page = by_page.select("host", "uid", "n", "vector", "chars", F.xxhash64("placed.token").alias("order"), F.col("placed.at").alias("at"))
    by_page = staged(by_page, "page-classes")  # read twice
    times = F.sequence(F.lit(0), F.size(F.col("at")[0]) - 1)
    occurrences = F.flatten(F.transform(times, lambda i: F.transform("at", lambda a: F.get(a, i))))
    straight = occurrences == F.array_sort(occurrences)
    shared = F.sum("chars").over(W.partitionBy("host", "uid").orderBy(F.desc("n")).rangeBetween(W.unboundedPreceding, W.currentRow))
    evidence = by_page.select("host", "uid", "n", "vector", "chars", "order", straight.alias("straight"), F.size("at").alias("size"))
    evidence = evidence.withColumn("shared", shared).where("size > 1")
    whole = pages.select("host", "uid", F.aggregate("page.chars", F.lit(0).cast("long"), lambda a, c: a + c).alias("whole"))
    shows = (F.col("whole") - F.col("shared")) * OWN_TIMES >= F.col("chars")
    valid = evidence.join(whole, ["host", "uid"]).groupBy("host", "n", "vector")
    valid = valid.agg(
        F.min("order").alias("o0"), F.max("order").alias("o1"), F.every("straight").alias("straight"), F.count_if(shows).alias("shown")
    )
    valid = valid.where((F.col("o0") == F.col("o1")) & F.col("straight") & (F.col("shown") >= least_pages)).select("host", "n", "vector")
    classes = by_page.join(valid, ["host", "n", "vector"])
    classes = classes.select("host", "uid", F.xxhash64("n", "vector").alias("cls"), "n", F.size("at").alias("size"), "at")
    classes = staged(classes, "valid-classes")  # read twice
    return classes.join(not_nested(classes), ["host", "cls"], "left_anti")


def _gathered(classes: DataFrame) -> DataFrame:
    """``host, uid, classes``: a page's classes in one row."""
    return classes.groupBy("host", "uid").agg(F.collect_list(F.struct("cls", "n", "size", "at")).alias("classes"))


def _events(classes: list) -> list[tuple[int, int, int]]:
    """``place, number of the class, number of the token in it`` of a page's template tokens, in the page's order."""
    return sorted((p, c, k) for c, x in enumerate(classes) for k, places in enumerate(x["at"]) for p in places)


def nesting(classes: list) -> tuple[Counter, set[tuple[int, int]]]:
    """How a page's classes lie in each other: ``(inside, crossed)``, classes by number.

    ``inside`` counts the occurrences of a class that begin after token ``k``
    of an open occurrence of another, by ``(class, other, k)``, and all by
    ``(class, class, -1)``. ``crossed`` has the pairs of which a token of the
    first lies in an occurrence of the second that began within the first.
    """
    inside: Counter = Counter()
    crossed: set[tuple[int, int]] = set()
    around: list[tuple[int, int]] = []
    for _, c, k in _events(classes):
        if k == 0:
            inside.update((c, *x) for x in around)
            inside[c, c, -1] += 1
            around.append((c, 0))
            continue
        i = next(i for i in range(len(around) - 1, -1, -1) if around[i][0] == c)
        crossed.update((c, d) for d, _ in around[i + 1 :])
        if k + 1 < len(classes[c]["at"]):
            around[i] = (c, k)
        else:
            del around[i]
    return inside, crossed


_PAIRS = "host string, cls long, other long, k int, inside long, crossed long, weaker boolean"


def _parse_nesting(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        pairs: dict[tuple, list[int]] = {}
        for host, classes in zip(pdf["host"], pdf["classes"], strict=True):
            strength = [(x["n"], x["size"], x["cls"]) for x in classes]
            inside, crossed = nesting(classes)
            found = [(x, n, 0) for x, n in inside.items()] + [((c, d, -1), 0, 1) for c, d in crossed]
            for (c, d, k), n, m in found:
                sums = pairs.setdefault((host, strength[c][2], strength[d][2], k, strength[c] < strength[d]), [0, 0])
                sums[0] += n
                sums[1] += m
        out = [(host, c, d, k, n, m, weaker) for (host, c, d, k, weaker), (n, m) in pairs.items()]
        yield pd.DataFrame(out, columns=["host", "cls", "other", "k", "inside", "crossed", "weaker"])


def not_nested(classes: DataFrame) -> DataFrame:
    """``host, cls``: of each two classes that are not nested the one on fewer pages, then of fewer tokens.

    Two classes are nested if all occurrences of the one lie after the same
    token of the other, within its occurrences, or none of either lies in the other.
    """
    pairs = _gathered(classes).mapInPandas(_parse_nesting, _PAIRS)
    pairs = pairs.groupBy("host", "cls", "other", "k", "weaker").agg(F.sum("inside").alias("inside"), F.sum("crossed").alias("crossed"))
    whole = F.max(F.when(F.col("cls") == F.col("other"), F.col("inside"))).over(W.partitionBy("host", "cls"))
    pairs = pairs.withColumn("whole", whole).where("cls != other and (crossed > 0 or inside < whole)")
    return pairs.select("host", F.when(F.col("weaker"), F.col("cls")).otherwise(F.col("other")).alias("cls")).distinct()


def cut(classes: list, places: list[int]) -> list[int | None]:
    """The slot of each of a page's blocks at ``places`` (ascending); None for a template token.

    A slot is what follows a token of an occurrence of a class, up to the
    next and outside of classes nested in it; what lies in no class is slot 0.
    """
    out: list[int | None] = []
    around: list[tuple[int, int]] = []
    events = _events(classes)
    i = 0
    for place in places:
        at_token = False
        while i < len(events) and events[i][0] <= place:
            p, c, k = events[i]
            at_token = p == place
            if k:
                around.pop()
            if k + 1 < len(classes[c]["at"]):
                around.append((c, k))
            i += 1
        slot = _token("slot", str(classes[around[-1][0]]["cls"]), str(around[-1][1])) if around else 0
        out.append(None if at_token else slot)
    return out


_SLOTS = (
    "host string, uid long, has_main boolean, left_out boolean, slots array<long>, "
    "held array<struct<slot:long,chars:long>>"
)


def _parse_slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The slots of the wanted blocks, None for those left out, and what is held by each.

    In article and main elements the template's text stays, unless it is all
    that an element holds and another holds more.
    """
    for pdf in batches:
        out = []
        for host, uid, places, units, chars, classes in zip(*[pdf[c] for c in ("host", "uid", "block_at", "block_unit", "block_chars", "classes")], strict=True):
            slots = cut([] if classes is None else list(classes), list(places))
            held: Counter = Counter()
            for slot, n in zip(slots, chars, strict=True):
                if slot is not None:
                    held[slot] += n
            has_main = any(units)
            if has_main:
                own = {u for u, slot in zip(units, slots, strict=True) if slot is not None}
                slots = [(slot or 0) if u in own or not own else None for u, slot in zip(units, slots, strict=True)]
            held_rows = [{"slot": s, "chars": n} for s, n in held.items()]
            out.append((host, uid, has_main, None in slots, slots, held_rows))
        yield pd.DataFrame(out, columns=["host", "uid", "has_main", "left_out", "slots", "held"])


def choose(pages: DataFrame, classes: DataFrame) -> DataFrame:
    """``host, uid, slots, chosen``: the pages that do not keep all of their wanted blocks.

    ``slots`` has the slot of each wanted block, null for one left out;
    ``chosen`` the slots that are taken, null for all. A slot of a host is an
    article's if it holds text in an article or main element on some page. A
    page without such an element takes those, if they hold half of its own
    text or more. Slot 0 is no slot of the template and so never an article's.
    """
    blocks = pages.select("host", "uid", "page.block_at", "page.block_unit", "page.block_chars")
    slots = blocks.join(_gathered(classes), ["host", "uid"], "left").mapInPandas(_parse_slots, _SLOTS)
    slots = staged(slots, "slots")  # read three times
    held = slots.select("host", "uid", "has_main", F.inline("held"))
    article = held.where("has_main and slot != 0").select("host", "slot").distinct().withColumn("article", F.lit(True))
    votes = held.where("not has_main").join(article, ["host", "slot"], "left").groupBy("host", "uid")
    hit = F.col("article")
    votes = votes.agg(F.sum("chars").alias("all"), F.sum(F.when(hit, F.col("chars"))).alias("hit"), F.collect_set(F.when(hit, F.col("slot"))).alias("chosen"))
    votes = votes.where("hit * 2 >= all").select("host", "uid", "chosen")
    out = slots.select("host", "uid", "left_out", "slots").join(votes, ["host", "uid"], "left")
    return out.where("left_out or chosen is not null").drop("left_out")


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``.

    ``text`` is the blocks of the article, one a line; empty for a null or
    empty page. Pages with an article or main element give its text, others
    what lies in the slots outside the left-out places (``choose``). A page
    with a null url, or one without a host, shares the host "". Repeated rows
    come back as often. An empty table gives no row. A page of any length is
    parsed as a whole in one task and is one row; its distinct tokens are
    rows. Of equal blocks all are template or none. Other columns are not read.
    """
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), F.col(html_col).alias("html"))
    rows = rows.withColumn("uid", F.xxhash64("html"))
    pages = distinct_pages(rows.select("uid", "host", "html"))
    choice = choose(pages, template_tokens(pages))
    kind = "page_id long, url string, host string, uid long, blocks array<string>"
    parsed = rows.mapInPandas(_parse_blocks, kind)
    # Pages of which copies are a thousandth of all rows or more, a thousand
    # at most, are dealt to SALTS parts each.
    total = pages.agg(F.sum("copies").alias("total")).first()["total"] or 0
    hot = pages.where(F.col("copies") * 1000 >= total).select("host", "uid", F.lit(True).alias("hot"))
    salted = lambda df, parts: df.join(F.broadcast(hot), ["host", "uid"], "left").withColumn("salt", F.when(F.col("hot"), parts)).drop("hot")
    none = F.lit(0)
    parsed = salted(parsed, F.pmod(F.xxhash64("page_id", "url", F.spark_partition_id()), F.lit(SALTS)).cast("int")).fillna(0, ["salt"])
    choice = salted(choice, F.sequence(none, F.lit(SALTS - 1)))
    choice = choice.withColumn("salt", F.explode(F.coalesce("salt", F.array(none))))
    joined = parsed.join(choice, ["host", "uid", "salt"], "left")
    taken = lambda b, i: F.get("slots", i).isNotNull() & (F.col("chosen").isNull() | F.array_contains("chosen", F.get("slots", i)))
    kept = F.when(F.col("slots").isNull(), F.col("blocks")).otherwise(F.filter("blocks", taken))
    out = joined.withColumn("text", F.array_join(kept, "\n"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
