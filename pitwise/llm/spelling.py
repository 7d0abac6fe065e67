"""Spelling variants by pivotal grams (operator 11).

Two words are near if one code point is inserted, deleted or replaced. One such
edit touches at most two of a word's bigrams, so a word's three rarest bigrams
(its prefix, with all that are as frequent as the third) and two disjoint ones
among them (its pivots, the cheapest pair by dynamic programming) are enough:
of two near words, take the one whose prefix ends earlier in the order of the
bigrams; one of its pivots is in the other's prefix.

Where it is follows from where the edit is, so the position limits are exact.
If the edit is not before the second pivot, everything up to the end of the
first pivot is the same in both words: the first pivot is looked up by the
beginning that it ends, with the last bigram of the word. If it is, everything
from the second pivot on is the same, and the second pivot is looked up by the
end that it begins, with the first bigram. An edit in the last or first bigram
itself leaves all but that bigram: these words are looked up by the rest.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import staged

#: Runs of letters in lower-cased UTF-8: a-z, and U+00E0 to U+00FF or U+00C0 to U+00DF.
RUN = re.compile(rb"(?:[a-z]+|(?:\xc3[\x80-\xbf])+)+")
#: Words that a Python worker counts before it hands the counts over.
HELD = 300_000
BATCH = 65_536

#: What a word is looked up by, in the order in which a pair is taken: a beginning
#: or an end at a pivot, with the bigram at the other end, or all but an end's bigram.
HEAD, BEGIN, TAIL, END = range(4)
KEYS = "probe boolean, key string, way int, word string, n long, top int, letters long, head int, tail int"


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters, A-Z lower-cased."""
    return RUN.findall(text.encode("utf-8", "replace").lower())


def misspelt(run: bytes, begin: int, rate: int) -> str:
    """The run, without one code point where its checksum is divisible by ``rate``; ``begin`` is the checksum of what stands before."""
    h = zlib.crc32(run, begin)
    word = run.decode()
    if h % rate:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(min_chars: int, rate: int):
    """Counts of words, combined over documents as far as ``HELD`` reaches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return (pdf for pdf in counted(batches) if len(pdf))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[bytes | str] = Counter()

        def out() -> pd.DataFrame:
            # Bytes are whole runs, strings are runs that lost a code point.
            total: Counter[str] = Counter()
            for word, n in held.items():
                word = word if isinstance(word, str) else word.decode()
                if len(word) >= min_chars:
                    total[word] += n
            held.clear()
            return pd.DataFrame({"word": list(total.keys()), "n": list(total.values())})

        for pdf in batches:
            for id_, text in zip(pdf["id"].astype("Int64"), pdf["text"], strict=True):
                begin = zlib.crc32(b":" if id_ is pd.NA else b"%d:" % id_)
                own = Counter(runs(text))
                if rate:
                    changed = [w for w in own if zlib.crc32(w, begin) % rate == 0]
                    for w in changed:
                        held[misspelt(w, begin, rate)] += own.pop(w)
                held.update(own)
                if len(held) >= HELD:
                    yield out()
        yield out()

    return run


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, least: int = 3, rate: int = 0) -> DataFrame:
    """``word, n`` of the words with at least ``min_chars`` code points found at least ``least`` times.

    With a ``rate``, a run loses a code point wherever the CRC-32 of
    ``<id>:<run>`` is divisible by it (made misspellings, to test with).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counts = rows.mapInPandas(_count(min_chars, rate), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _gram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: Counter[str] = Counter()
    for pdf in batches:
        for word in pdf["word"]:
            total.update({word[i : i + 2] for i in range(len(word) - 1)})
    if total:
        yield pd.DataFrame({"gram": list(total.keys()), "n": list(total.values())})


def pivots(places: list[int], weights: list[int]) -> tuple[int, int]:
    """The two disjoint bigrams (two apart or more) of least total weight.

    ``places`` ascend. Over places, the best single one that ends before the
    present one is kept, and the best pair. Ties go to the earlier places.
    """
    single, pair, behind = None, None, 0
    for i, p in enumerate(places):
        while places[behind] <= p - 2:
            if single is None or weights[behind] < weights[single]:
                single = behind
            behind += 1
        if single is not None and (pair is None or weights[single] + weights[i] < pair[0]):
            pair = (weights[single] + weights[i], places[single], p)
    assert pair is not None, "three bigrams always hold two disjoint ones"
    return pair[1], pair[2]


def letter_set(word: str) -> int:
    """The letters of a word as 64 bits (those 64 code points apart share one); an edit changes two at most."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def _keys(rank: dict[str, int], weight: dict[str, int]):
    """Rows to look up (two pivots, two ends) and rows to be found (the bigrams of the prefix, three ends each way)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []

        def out() -> pd.DataFrame:
            pdf = pd.DataFrame(rows, columns=["probe", "key", "way", "word", "n", "top", "letters", "head", "tail"])
            rows.clear()
            return pdf

        for pdf in batches:
            for word, n in zip(pdf["word"], pdf["n"], strict=True):
                size, first, last = len(word), word[:2], word[-2:]
                grams = [word[i : i + 2] for i in range(size - 1)]
                ranks = [rank[g] for g in grams]
                top = sorted(ranks)[2]
                places = [i for i, r in enumerate(ranks) if r <= top]
                one, two = pivots(places, [weight[grams[i]] for i in places])
                own = (word, n, top, letter_set(word), one + 2, two)
                # Spaces part what no word holds; the length that is looked up stands with the ends.
                rows.append((True, f"{HEAD} {word[: one + 2]} {last}", HEAD, *own))
                rows.append((True, f"{BEGIN} {word[:-2]} {size}", BEGIN, *own))
                rows.append((True, f"{TAIL} {first} {word[two:]}", TAIL, *own))
                rows.append((True, f"{END} {size} {word[2:]}", END, *own))
                for i in places:
                    rows.append((False, f"{HEAD} {word[: i + 2]} {last}", HEAD, *own))
                    rows.append((False, f"{TAIL} {first} {word[i:]}", TAIL, *own))
                for other in (size - 1, size, size + 1):
                    rows.append((False, f"{BEGIN} {word[: other - 2]} {other}", BEGIN, *own))
                    rows.append((False, f"{END} {other} {word[size - other + 2 :]}", END, *own))
                if len(rows) >= BATCH:
                    yield out()
        if rows:
            yield out()

    return run


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, other, other_n``: each pair of near words once, of ``word, n`` rows.

    Words are distinct and have five letters or more, so that three bigrams
    are never all. A pair is met from the word whose prefix ends earlier in the
    order of the bigrams (ties: the smaller word), and taken on the first of
    the ways on which it is met. The order of the bigrams is by the number of
    words that hold them; there are as many as pairs of letters (8,100), which
    go to the driver.
    """
    grams = words.mapInPandas(_gram_counts, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    weight = {g.gram: g.n for g in grams}
    rank = {g: i for i, g in enumerate(sorted(weight, key=lambda g: (weight[g], g)))}
    keys = staged(words.mapInPandas(_keys(rank, weight), KEYS), "spelling-keys")
    probe = keys.where("probe").select("key", "way", "word", "n", "top", "letters", "head", "tail")
    found = keys.where("not probe").select(
        "key", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("top").alias("other_top"), F.col("letters").alias("other_letters")
    )
    word, other, size = F.col("word"), F.col("other"), F.length("word")
    later = (F.col("other_top") > F.col("top")) | ((F.col("other_top") == F.col("top")) & (other > word))
    close = (F.abs(size - F.length("other")) <= 1) & (F.bit_count(F.col("letters").bitwiseXOR(F.col("other_letters"))) <= 2)
    near = F.levenshtein(word, other, 1) == 1
    begins = lambda n: F.startswith(other, F.substring(word, F.lit(1), n))
    ends = lambda start: F.endswith(other, F.substring(word, start + 1, size))
    by_head = begins(F.col("head")) & ends(size - 2)
    by_begin = begins(size - 2)
    by_tail = ends(F.col("tail")) & begins(F.lit(2))
    way = F.col("way")
    first = (way == HEAD) | (~by_head & ((way == BEGIN) | (~by_begin & ((way == TAIL) | ~by_tail))))
    return probe.join(found, (probe["key"] == found["key"]) & later & close & near & first).select("word", "n", "other", "other_n")


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``word, root`` from ``word, form``: forms followed to the last.

    A form is at least twice as frequent as its word, so a way has at most
    ``log2(most)`` steps; each round follows as many as all before it, until
    nothing moves.
    """
    at = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(max(1, most).bit_length().bit_length()):
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = staged(moved, "spelling-roots")
        at = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            break
    return at


def spelling_variants(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 5,
    least: int = 3,
    times: int = 2,
    rate: int = 0,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n``: words and what they are variants of.

    Words are the maximal runs of ``A-Z a-z`` and U+00C0 to U+00FF, A-Z
    lower-cased, with at least ``min_chars`` code points (five or more) and
    ``least`` occurrences (``n``). A word's form is its near word of largest
    ``n`` (ties: the smallest in code point order) if that is at least
    ``times`` (two or more) its own, else null; its root is where forms lead.

    Null and empty texts have no words; a null id stands as the empty string
    in ``rate``'s checksum and plays no other part; repeated rows count as
    often as they come; an empty table, or one without words, gives no row.
    Texts of any length are counted a document at a time, words are handed on
    300,000 at a time. Other columns are not read.

    The only groups are words, bigrams and keys. A hot word or bigram is summed
    before the shuffle; a hot key meets in an inner join, which adaptive
    execution may split, and only near words leave the join.
    """
    if min_chars < 5 or times < 2:
        raise ValueError("words need five code points, forms twice the count")
    words = staged(word_counts(docs, id_col=id_col, text_col=text_col, min_chars=min_chars, least=least, rate=rate), "spelling-words")
    pairs = near_words(words)
    side = lambda a, b: F.struct(F.col(a).alias("word"), F.col(b[0]).alias("other"), F.col(b[1]).alias("other_n"))
    both = pairs.select(F.inline(F.array(side("word", ("other", "other_n")), side("other", ("word", "n")))))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    found = words.join(best, "word", "left")
    is_form = -F.col("best")["less"] >= times * F.col("n")
    found = found.select(
        "word",
        F.when(is_form, F.col("best")["other"]).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best")["less"]).alias("form_n"),
    )
    found = staged(found, "spelling-forms")
    most = found.agg(F.max("n")).first()[0] or 1
    roots = _roots(found.where(F.col("form").isNotNull()), most)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
