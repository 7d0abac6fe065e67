"""Near-duplicate groups by min-max hashing (operator 3).

A document's set of word shingles is signed by the smallest and the largest
value under each of ``PERMUTATIONS`` permutations, so each permutation is
evaluated once for two values that agree with the chance of the sets'
Jaccard similarity. Bands of the signature give candidates, every link is
confirmed on the full sets, and links are followed to components.

Documents of equal sets form a class and are handled as one. In a bucket of a
band, members are compared with a few hubs rather than with each other. What
hubs leave in different components is settled exactly by a prefix filter:
sets as similar as asked share one of their rarest shingles.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwise.llm.common import staged

#: 64 permutations give 128 values in 32 bands of 4: a pair of similarity 0.8
#: shares no band with a chance of (1 - 0.8 ** 4) ** 32 = 5e-8.
PERMUTATIONS, BAND = 64, 4

#: Texts are shingled about so many bytes at a time.
CHUNK = 1 << 21

_ODD = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(20240607)
_TIMES = _random.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Each text's distinct ``k``-word shingles as sorted 64-bit hashes.

    A-Z are lower-cased; words are separated by spaces and the ASCII controls
    9-13 (what ``bytes.lower`` and ``bytes.split`` do). A text of fewer words
    has its whole sequence as its one shingle; without words it has none.
    """
    split = [(t or "").encode().lower().split() for t in texts]
    counts = np.array([len(w) for w in split], dtype=np.int64)
    words = [w for ws in split for w in ws]
    if not words:
        return [np.empty(0, np.uint64)] * len(texts)
    hashes = pd.util.hash_array(np.array(words, dtype=object))
    rolled = hashes.copy()
    for i in range(1, k):
        rolled = rolled[:-1] * _ODD + hashes[i:] if len(rolled) > 1 else rolled[:0]
    rolled = _mix(rolled)
    out, at = [], 0
    for n in counts.tolist():
        if n >= k:
            out.append(np.unique(rolled[at : at + n - k + 1]))
        elif n:
            short = reduce(lambda a, b: a * _ODD + b, hashes[at : at + n, None])
            out.append(_mix(short + np.uint64(n)))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of smallest, then largest values per non-empty set."""
    if not sets:
        return np.empty((0, 2 * PERMUTATIONS), np.uint64)
    values = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint64)
    for j in range(PERMUTATIONS):
        permuted = values * _TIMES[j] + _PLUS[j]
        out[:, j] = np.minimum.reduceat(permuted, starts)
        out[:, PERMUTATIONS + j] = np.maximum.reduceat(permuted, starts)
    return out


def band_keys(signed: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, with the band's number in it."""
    bands = signed.reshape(len(signed), 2 * PERMUTATIONS // BAND, BAND)
    keys = np.broadcast_to(np.arange(bands.shape[1], dtype=np.uint64), bands.shape[:2])
    for i in range(BAND):
        keys = _mix(keys * _ODD + bands[:, :, i])
    return keys


def _class_of(values: np.ndarray) -> int:
    """A set's name: 64 bits of a digest of its sorted shingles."""
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _sign(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            for a, b in _chunks(texts):
                sets = shingle_sets(texts[a:b], k)
                some = [s for s in sets if len(s)]
                keys = iter(band_keys(signatures(some)).view(np.int64))
                out = pdf.iloc[a:b][["doc_id", "key"]].copy()
                out["doc_id"] = out["doc_id"].astype("Int64")
                out["n"] = [len(s) for s in sets]
                out["cls"] = pd.array([_class_of(s) if len(s) else None for s in sets], dtype="Int64")
                out["bands"] = [next(keys) if len(s) else None for s in sets]
                yield out

    return run


def _sets(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, wanted = pdf["text"].tolist(), pdf["cls"].tolist()
            for a, b in _chunks(texts):
                rows = [(c, s.view(np.int64)) for c, s in zip(wanted[a:b], shingle_sets(texts[a:b], k), strict=True) if _class_of(s) == c]
                yield pd.DataFrame({"cls": pd.Series([c for c, _ in rows], dtype="int64"), "shingles": [s for _, s in rows]})

    return run


@F.pandas_udf(T.LongType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    """The size of the intersection of two arrays without repeats."""
    return pd.Series([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b, strict=True)], dtype="int64")


def _similar(n_both: Column, n_a: Column, n_b: Column, percent: int) -> Column:
    return 100 * n_both >= percent * (n_a + n_b - n_both)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` (with sizes ``n_a, n_b``) whose sets are as similar as asked."""
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("cls").alias(side), F.col("shingles").alias(f"s_{side}")), side)
    both = pairs.withColumn("n_both", _common("s_a", "s_b"))
    return both.where(_similar(F.col("n_both"), F.col("n_a"), F.col("n_b"), percent)).select("a", "b")


def _pairs_with(members: DataFrame, hubs: list[str], sizes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs ``a < b`` of a member and each of its bucket's hubs, with sizes.

    Sets whose sizes alone rule a link out are left out.
    """
    pairs = [members.where(F.col("cls") != F.col(h)).select("cls", "n", F.col(h).alias("hub")) for h in hubs]
    pairs = reduce(DataFrame.union, pairs).distinct().join(sizes.select(F.col("cls").alias("hub"), F.col("n").alias("n_hub")), "hub")
    pairs = pairs.where(100 * F.least("n", "n_hub") >= percent * F.greatest("n", "n_hub"))
    first = F.col("cls") < F.col("hub")
    sized = [F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in (("n", "n_hub"), ("n_hub", "n"))]
    return pairs.select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b"), sized[0].alias("n_a"), sized[1].alias("n_b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``v, label`` of every end of ``links`` (``a, b``): the smallest reachable.

    Each round takes the smallest label of the neighbours and then the label's
    own label, so long chains shorten fast. Rounds are written to the shared
    folder; the driver sees the number of changes only.
    """
    both = staged(links.union(links.select("b", "a")).toDF("v", "w").distinct(), "links")
    labels = staged(both.groupBy("v").agg(F.min("w").alias("m")).select("v", F.least("v", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("w"), F.col("label").alias("m")), "w").groupBy("v").agg(F.min("m").alias("m"))
        near = staged(labels.join(near, "v").select("v", F.col("label").alias("was"), F.least("label", "m").alias("label")), "labels")
        onward = near.select(F.col("v").alias("label"), F.col("label").alias("onward"))
        labels = staged(near.join(onward, "label").select("v", "was", F.least("label", "onward").alias("label")), "labels")
        if labels.where("label != was").isEmpty():
            return labels.select("v", "label")
        labels = labels.select("v", "label")


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``v, label`` after ``links``, given those before, for classes with links."""
    old = labels.select(F.col("v").alias("x"), F.col("label").alias("y"))
    for side in "ab":
        links = links.join(old, F.col(side) == F.col("x"), "left").withColumn(side, F.coalesce("y", side)).drop("x", "y")
    new = components(links.where("a != b"))
    moved = labels.join(new.select(F.col("v").alias("x"), F.col("label").alias("y")), F.col("label") == F.col("x"), "left")
    moved = moved.select("v", F.coalesce("y", "label").alias("label"))
    return staged(moved.union(new.join(labels, "v", "left_anti")), "labels")


def _undecided(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold several components and untested pairs.

    In a bucket of two classes the one pair has the hub in it.
    """
    known = members.join(labels, F.col("cls") == F.col("v"), "left").withColumn("label", F.coalesce("label", "cls")).select("bucket", "cls", "n", "label")
    mixed = known.groupBy("bucket").agg(F.count("*").alias("size"), F.min("label").alias("l0"), F.max("label").alias("l1"))
    mixed = mixed.where("size > 2 and l0 != l1").select("bucket")
    return staged(known.join(mixed, "bucket"), "undecided")


def _rare_pairs(left: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of different labels that share a rare shingle, as similar sets must.

    With shingles ordered by how many of these sets hold them, sets of ``n``
    shingles share one of their first ``n - ceil(n * percent / 100) + 1``; the
    places of the first shared one bound the intersection. Only members
    outside their bucket's largest component look for partners.
    """
    parts = left.groupBy("bucket", "label").agg(F.count("*").alias("size"))
    largest = parts.groupBy("bucket").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
    seeking = left.join(largest, "bucket").where("label != main").select("cls").distinct().withColumn("seeks", F.lit(True))
    own = left.select("cls", "n", "label").distinct().join(seeking, "cls", "left")
    tokens = staged(own.join(sets, "cls").select("cls", "label", "n", "seeks", F.explode("shingles").alias("s")), "tokens")
    rarity = tokens.groupBy("s").agg(F.count("*").alias("df"))
    place = F.row_number().over(W.partitionBy("cls").orderBy("df", "s"))
    prefix = tokens.join(rarity, "s").withColumn("i", place)
    prefix = staged(prefix.where(100 * (F.col("n") - F.col("i") + 1) >= percent * F.col("n")).where("df > 1"), "prefixes")
    x = prefix.where("seeks").select("s", F.col("cls").alias("x"), F.col("label").alias("lx"), F.col("n").alias("nx"), F.col("i").alias("ix"))
    y = prefix.select("s", F.col("cls").alias("y"), F.col("label").alias("ly"), F.col("n").alias("ny"), F.col("i").alias("iy"))
    most = 1 + F.least(F.col("nx") - F.col("ix"), F.col("ny") - F.col("iy"))
    possible = (F.col("lx") != F.col("ly")) & _similar(most, F.col("nx"), F.col("ny"), percent)
    found = x.join(y, (x["s"] == y["s"]) & possible)
    first = F.col("x") < F.col("y")
    sized = [F.when(first, F.col(x)).otherwise(F.col(y)) for x, y in (("nx", "ny"), ("ny", "nx"))]
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), sized[0].alias("n_a"), sized[1].alias("n_b")).distinct()


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, class_id, component_id, group_id, key, kept`` per row.

    Documents are linked if their sets of ``k``-word shingles have
    ``100 * intersection >= percent * union``. ``component_id`` is the
    smallest id that links reach, the row's own included; ``class_id`` names
    the set, ``group_id`` the component, ``key`` the row's id and text;
    ``kept`` is whether ``doc_id`` is ``component_id``.

    Null, empty and wordless texts have no shingles, no class and no links:
    their component is their own id. A row with a null id takes part and gets
    its component's smallest id, null if there is none, and is not kept.
    Repeated rows are all in one class, and all kept if they have the
    smallest id. An empty table gives no row. A text of any length is signed
    as a whole in one task; its set is one row. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text"))
    signed = staged(rows.mapInPandas(_sign(k), "doc_id long, key long, n long, cls long, bands array<long>"), "signatures")

    # One row per class; its text is that of the row with the smallest key.
    classes = signed.where("cls is not null")
    one = classes.groupBy("cls").agg(F.min("key").alias("key"), F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    sizes = staged(one, "classes")
    firsts = classes.join(sizes.select("cls", "key"), ["cls", "key"], "left_semi").select("cls", "n", "bands")
    exploded = firsts.select(F.explode("bands").alias("bucket"), "cls", "n")
    shared = exploded.groupBy("bucket").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo < hi")
    members = staged(exploded.join(shared.select("bucket", "lo"), "bucket").distinct(), "members")

    wanted = members.select("cls").distinct().join(sizes.select("cls", "key"), "cls")
    texts = rows.select("key", "text").join(wanted, "key")
    sets = staged(texts.mapInPandas(_sets(k), "cls long, shingles array<long>").dropDuplicates(["cls"]), "sets")

    links = staged(_links(_pairs_with(members, ["lo"], sizes, percent), sets, percent), "links")
    labels = components(links)
    left = _undecided(members, labels)
    if not left.isEmpty():
        # Two more hubs per bucket: the smallest after flipping some bits.
        seeds = [int(x) for x in _random_flips(2)]
        flipped = [F.min(F.col("cls").bitwiseXOR(F.lit(s))).bitwiseXOR(F.lit(s)).alias(f"h{i}") for i, s in enumerate(seeds)]
        hubs = left.groupBy("bucket").agg(*flipped)
        pairs = _pairs_with(left.join(hubs, "bucket"), [f"h{i}" for i in range(len(seeds))], sizes, percent)
        links = staged(_links(_apart(pairs, labels), sets, percent), "links")
        labels = _relabelled(labels, links)
        left = _undecided(members, labels)
        if not left.isEmpty():
            links = staged(_links(_rare_pairs(left, sets, percent), sets, percent), "links")
            labels = _relabelled(labels, links)

    grouped = sizes.join(labels, F.col("cls") == F.col("v"), "left").withColumn("label", F.coalesce("label", "cls"))
    smallest = grouped.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_class = grouped.select("cls", "label").join(smallest, "label").select(F.col("cls").alias("c"), "label", "component_id")
    # Rows without a class look for their own key, which spreads them.
    out = signed.drop("bands").join(by_class, F.coalesce("cls", "key") == F.col("c"), "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    group = F.coalesce("label", "key").alias("group_id")
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.col("cls").alias("class_id"), component.alias("component_id"), group, "key")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def deduplicated(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates.

    That of the smallest id (a null id only if there is no other), then of
    the smallest key. Rows without words are in no group and all stay.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, k=k, percent=percent)
    best = F.min_by("key", F.struct(F.col("doc_id").isNull(), "doc_id", "key"))
    stay = found.where("class_id is not null").groupBy("group_id").agg(best.alias("__stays")).select("__stays")
    text = F.coalesce(F.col(text_col), F.lit(""))
    has_word = text.rlike(r"[^\x20\x09-\x0D]")
    keyed = docs.where(has_word).withColumn("__key", F.xxhash64(F.col(id_col).cast("long"), text)).dropDuplicates(["__key"])
    return keyed.join(stay, F.col("__key") == F.col("__stays")).select(*docs.columns).union(docs.where(~has_word))


def _random_flips(n: int) -> np.ndarray:
    return np.random.default_rng(11).integers(-(1 << 62), 1 << 62, n)


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    for side in "ab":
        own = labels.select(F.col("v").alias(side), F.col("label").alias(f"l_{side}"))
        pairs = pairs.join(own, side, "left").withColumn(f"l_{side}", F.coalesce(f"l_{side}", side))
    return pairs.where("l_a != l_b").drop("l_a", "l_b")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_shingles", "component_id", "kept")
