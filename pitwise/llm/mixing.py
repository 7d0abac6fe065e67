"""Mixing sources to target weights by a hypergeometric splitting tree (operator 7).

A source's documents are permuted by a hash and cut into blocks; a target is a
number of whole passes over the blocks and a part of one more. A tree divides
the drawn blocks among output shards: each node draws, without replacement,
which of its blocks go left, source by source, so every level keeps the exact
quotas. A shard's blocks of a source are the next run of the source's
permutation, disjoint from every other shard's, and are shuffled within the
shard. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pitwise.llm.common import OWN, staged, word_count


def uniform(*cols: Column) -> Column:
    """A repeatable number in [0, 1) from the values."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def targets(totals: DataFrame, *, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``source, source_size, docs, target`` from ``source, source_size, docs``.

    Sources, ordered by code point with null last, take ``weights`` in turn.
    The targets sum to ``share`` of all sizes (or as much as fits) in
    proportion to the weights, but none exceeds ``most`` times its source's
    size: with the sources ordered by size per weight, those up to some place
    stop there, and the others divide the rest by weight. One row a source.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    # Strings compare by bytes, which is the order of code points in UTF-8.
    rows = totals.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (F.row_number().over(order) - 1) % len(weights)))
    rows = rows.withColumn("top", most * F.col("source_size"))
    by_need = W.orderBy(F.col("top") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_need.rowsBetween(W.unboundedPreceding, -1)
    all_rows = W.partitionBy()
    rows = rows.withColumns(
        {
            "full": F.coalesce(F.sum("top").over(before), F.lit(0.0)),
            "open": F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            "budget": share * F.sum("source_size").over(all_rows),
        }
    )
    level = (F.col("budget") - F.col("full")) / F.col("open")
    rows = rows.withColumn("level", F.when(F.col("top") > level * F.col("weight"), level))
    # The first source in order that is not full sets the level for all.
    rows = rows.withColumn("level", F.first("level", ignorenulls=True).over(by_need.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.least(F.col("top"), F.coalesce(F.col("level") * F.col("weight"), F.col("top")))
    return rows.select("source", "source_size", "docs", target.alias("target"))


#: Chance that a double from ``uniform`` cannot tell from none, as a logarithm: 2 ** -54.
_UNSEEN = 54 * 0.6931471805599453
#: Runs of sources that a row of the tree holds, about: 2 ** BITS.
BITS = 6


def hypergeometric(u: Column, total: Column, good: Column, draws: Column) -> Column:
    """How many of ``draws`` without replacement from ``total`` are among the ``good``.

    ``u`` is uniform in [0, 1). Inverse transform outwards from the mode: the
    weights of both sides follow from the mode's by their ratios, are summed,
    and walked again until they reach ``u`` of their sum. A side has so many
    steps that the rest is less likely than what ``u`` can resolve (Serfling's
    bound), about four roots of the draws, so a draw from 10 million takes some
    thousand steps.
    """
    low = F.greatest(F.lit(0).cast("long"), draws + good - total)
    high = F.least(good, draws)
    mode = F.floor((draws + 1.0) * (good + 1.0) / (total + 2.0))
    least = F.least(draws, good, total - draws, total - good)
    # Any of the four is the sample, by symmetry; a sample of nearly all varies little.
    spread = least * (1.0 - (least - 1.0) / F.greatest(total, F.lit(1)))
    reach = F.ceil(F.sqrt(F.greatest(spread, F.lit(0.0)) * (_UNSEEN / 2))) + 1
    given = F.struct(
        u.alias("u"),
        total.cast("double").alias("n"),
        good.cast("double").alias("k"),
        draws.cast("double").alias("d"),
        F.greatest(low, F.least(high, mode)).cast("long").alias("mode"),
        F.least(reach, high - low).cast("long").alias("reach"),
    )

    def walk(g: Column) -> Column:
        rest = g["n"] - g["k"] - g["d"]  # of the others that are not drawn, less the good drawn

        def up(w: Column, x: Column) -> Column:
            return w * (g["k"] - x) * (g["d"] - x) / ((x + 1.0) * (rest + x + 1.0))

        def down(w: Column, x: Column) -> Column:
            return w * x * (rest + x) / ((g["k"] - x + 1.0) * (g["d"] - x + 1.0))

        def sides(a: Column, i: Column) -> list[Column]:
            """From the weights of ``mode + i - 1`` and ``mode - i`` to the next."""
            return [up(a["up"], g["mode"] + i - 1.0).alias("up"), down(a["down"], g["mode"] - i + 0.0).alias("down")]

        begin = [F.lit(1.0).alias("up"), down(F.lit(1.0), g["mode"] + 0.0).alias("down")]
        steps = F.sequence(F.lit(1).cast("long"), g["reach"] + 1)
        weight = F.aggregate(
            steps, F.struct(*begin, F.lit(0.0).alias("sum")), lambda a, i: F.struct(*sides(a, i), (a["sum"] + a["up"] + a["down"]).alias("sum")), lambda a: a["sum"]
        )

        def look(a: Column, i: Column) -> Column:
            at = F.when(a["at"].isNotNull(), a["at"]).when(a["left"] < a["up"], g["mode"] + i - 1).when(a["left"] < a["up"] + a["down"], g["mode"] - i)
            return F.struct(*sides(a, i), (a["left"] - a["up"] - a["down"]).alias("left"), at.alias("at"))

        first = F.struct(*begin, (g["u"] * weight).alias("left"), F.lit(None).cast("long").alias("at"))
        return F.coalesce(F.aggregate(steps, first, look, lambda a: a["at"]), g["mode"])

    return F.get(F.transform(F.array(given), walk), 0)


def _shares(parts: Column, size: str, places: Column, *seeds: Column) -> Column:
    """The places that each entry of ``parts`` gets, an array: a multivariate hypergeometric draw.

    Entry by entry, its share is drawn from the places and entries that are left.
    """
    total = F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a + p[size])
    long = lambda x: x.cast("long")
    begin = F.struct(
        total.alias("left"), long(places).alias("places"), long(F.lit(0)).alias("last"), F.array().cast("array<bigint>").alias("taken")
    )

    def draw(a: Column, p: Column) -> Column:
        # The last share is taken off here, so that a draw stands in one place of the expression.
        left = a["places"] - a["last"]
        n = hypergeometric(uniform(*seeds, p["key"]), a["left"], p[size], left)
        taken = F.concat(a["taken"], F.array(a["last"]))
        return F.struct((a["left"] - p[size]).alias("left"), left.alias("places"), n.alias("last"), taken.alias("taken"))

    return F.aggregate(parts, begin, draw, lambda a: F.slice(F.concat(a["taken"], F.array(a["last"])), F.lit(2), F.size(a["taken"])))


def split_tree(quotas: DataFrame, depth: int, seed: int, bits: int = BITS) -> DataFrame:
    """``shard, source, start, blocks``: each of ``2 ** depth`` shards' run of drawn blocks.

    ``quotas`` has ``source`` and its number of drawn ``blocks``. The tree's
    rows are ``node, source`` with the source's run of blocks in that node. A
    node passes half of its blocks to the left; how many of each source is a
    multivariate hypergeometric draw, each number drawn at once.

    A draw depends on those before it in its node, so sources meet in rows of
    about ``2 ** bits``, dealt by a hash. With more sources than that, the rows
    are summed to parts of so many rows, these again, up to one row a node;
    from there places go down, part by part, to the rows. No row holds more
    than about ``2 ** bits`` entries, and one level of the tree is one shuffle
    per step of the sums, whatever the number of blocks.
    """
    bits_of = F.shiftrightunsigned(F.xxhash64("source"), 1)
    rows = quotas.where("blocks > 0").select(
        F.lit(0).cast("long").alias("node"), "source", F.lit(0).cast("long").alias("start"), F.col("blocks").cast("long").alias("blocks")
    )
    rows = rows.withColumn("hash", bits_of)
    sources = rows.count()
    steps = 0
    while sources > 1 << (bits * (steps + 1)):
        steps += 1

    def part(step: int) -> Column:
        return F.col("hash").bitwiseAND(F.lit((1 << (bits * step)) - 1)).alias("part")

    for level in range(depth):
        # Step by step, the rows that meet: at the last step a node is one row.
        run = F.struct(F.col("source").alias("key"), F.col("start").alias("start"), F.col("blocks").alias("blocks"), F.col("hash").alias("hash"))
        own = rows.groupBy("node", part(steps)).agg(F.array_sort(F.collect_list(run)).alias("runs"), F.sum("blocks").alias("size"))
        sums = [own.select("node", "part", "size")]
        for step in range(steps - 1, -1, -1):
            below = F.struct(F.col("part").alias("key"), F.col("size").alias("blocks"))
            upper = F.col("part").bitwiseAND(F.lit((1 << (bits * step)) - 1)).alias("upper")
            met = sums[-1].groupBy("node", upper).agg(F.array_sort(F.collect_list(below)).alias("parts"), F.sum("size").alias("size"))
            sums.append(met.withColumnRenamed("upper", "part"))
        places = None
        for step in range(steps):
            top = sums[steps - step]
            half = top.withColumn("places", F.floor((F.col("size") + 1) / 2)) if places is None else top.join(places, ["node", "part"])
            taken = _shares(F.col("parts"), "blocks", F.col("places"), F.lit(seed), F.lit(level), F.lit(step), F.col("node"))
            dealt = half.select("node", F.inline(F.arrays_zip(F.col("parts")["key"].alias("part"), taken.alias("places"))))
            places = staged(dealt, "mix-places")
        own = own.withColumn("places", F.floor((F.col("size") + 1) / 2)) if places is None else own.join(places, ["node", "part"])
        taken = _shares(F.col("runs"), "blocks", F.col("places"), F.lit(seed), F.lit(level), F.lit(steps), F.col("node"))
        split = own.select("node", F.inline(F.arrays_zip(F.col("runs").alias("run"), taken.alias("left"))))
        left = F.struct(
            (F.col("node") * 2).alias("node"), F.col("run")["key"].alias("source"), F.col("run")["start"].alias("start"), F.col("left").alias("blocks"),
            F.col("run")["hash"].alias("hash"),
        )
        right = F.struct(
            (F.col("node") * 2 + 1).alias("node"), F.col("run")["key"].alias("source"), (F.col("run")["start"] + F.col("left")).alias("start"),
            (F.col("run")["blocks"] - F.col("left")).alias("blocks"), F.col("run")["hash"].alias("hash"),
        )
        rows = staged(split.select(F.inline(F.array(left, right))).where("blocks > 0"), "mix-tree")
    return rows.select(F.col("node").alias("shard"), "source", "start", "blocks")


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))


def _words_before(blocks: DataFrame, span: int = 1024) -> DataFrame:
    """``words_before``: the words of a source's earlier blocks, by prefix sums in two levels.

    ``span`` blocks at a time are summed first, so no window holds more than
    ``span`` blocks or one row per ``span`` blocks of a source.
    """
    part = F.floor(F.col("block") / span)
    sums = blocks.groupBy(F.col("source").alias("s"), part.alias("p")).agg(F.sum("words").alias("w"))
    over = lambda keys, by: W.partitionBy(*keys).orderBy(by).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("w").over(over(["s"], "p")), F.lit(0))).drop("w")
    joined = blocks.withColumn("part", part).join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    own = F.coalesce(F.sum("words").over(over(["source", "part"], "block")), F.lit(0))
    return joined.withColumn("words_before", F.col("before") + own).drop("s", "p", "part", "before")


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: int = 2,
    block_docs: int = 256,
    depth: int = 4,
    seed: int = 7,
) -> DataFrame:
    """What the mix takes of each document, one row per row of ``docs``.

    ``doc_id, source, size, copy, source_size, target, times, taken, shards``:
    ``size`` is the number of words (null text: 0); the document is taken
    whole ``times`` times, 0 to ``most``, so ``taken`` is ``times * size``;
    ``shards`` has an entry ``shard, place`` for each time, ``place`` being its
    order within the shard. A source's taken words differ from its target by
    at most half the smallest document that the last block has left over.

    Documents without words are never taken. Rows of equal id, source and
    size are told apart by ``copy``, from 1. Null sources are one source,
    ranked last; null ids take part. An empty table gives no row. The result
    depends on the rows' values only, not on partitions or task order.
    Blocks have about ``block_docs`` documents, whatever a source's share;
    sources are named collections: ``targets`` orders all of them in one
    window, a row per source. A text of any length is one row; only its number
    of words goes on.
    """
    same = _sizes(docs, id_col, text_col, source_col).groupBy("doc_id", "source", "size").agg(F.count("*").alias("copies"))
    rows = same.select("doc_id", "source", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    rows = staged(rows.withColumn("u", uniform(F.lit(seed), "doc_id", "source", "size", "copy")), "mix-sizes")

    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    size = F.col("source_size")
    # Whole passes over a source, and the words of one more that is cut short.
    passes = F.when(size > 0, F.least(F.floor(F.col("target") / size), F.lit(most))).otherwise(0).cast("long")
    plan = targets(totals, weights=weights, share=share, most=float(most)).withColumn("passes", passes)
    plan = plan.withColumn("rest", F.round(F.col("target") - F.col("passes") * size).cast("long"))
    plan = staged(plan.withColumn("n_blocks", F.ceil(F.col("docs") / block_docs).cast("long")), "mix-plan")

    blocks_of = plan.select(F.col("source").alias("src"), "n_blocks")
    rows = rows.join(blocks_of, F.col("source").eqNullSafe(F.col("src")))
    rows = staged(rows.withColumn("block", F.floor(F.col("u") * F.col("n_blocks"))).drop("src", "n_blocks"), "mix-blocks")

    blocks = _words_before(rows.groupBy("source", "block").agg(F.sum("size").alias("words")))
    by_plan = plan.withColumnRenamed("source", "src").drop("docs")
    blocks = blocks.join(by_plan, F.col("source").eqNullSafe(F.col("src"))).drop("src")
    blocks = staged(blocks.withColumn("room", F.col("rest") - F.col("words_before")).drop("words_before"), "mix-room")

    # The one block of a source in which the rest ends is drawn document by
    # document: in the order of the permutation, each that still fits.
    key = F.struct("u", "doc_id", "copy", "size")
    last = blocks.where((F.col("room") > 0) & (F.col("words") > F.col("room")))
    last = last.select(F.col("source").alias("s"), F.col("block").alias("b"), "room")
    same_block = F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b"))
    inside = rows.where("size > 0").join(last, same_block).groupBy("source", "block", "room").agg(F.array_sort(F.collect_list(key)).alias("docs"))
    kind = dict(inside.dtypes)["docs"]
    start = F.struct(F.col("room").alias("room"), F.array().cast(kind).alias("taken"))

    def fit(acc, d):
        more = F.struct((acc["room"] - d["size"]).alias("room"), F.concat(acc["taken"], F.array(d)).alias("taken"))
        return F.when(d["size"] <= acc["room"], more).otherwise(acc)

    def nearest_end(acc):
        """One more, the smallest left, if going beyond the target is nearer to it."""
        left = F.filter("docs", lambda d: ~F.array_contains(acc["taken"], d))
        smallest = F.array_min(F.transform(left, lambda d: F.struct(d["size"].alias("size"), d.alias("d"))))
        return F.when(smallest["size"] < 2 * acc["room"], F.concat(acc["taken"], F.array(smallest["d"]))).otherwise(acc["taken"])

    chosen = inside.select(F.col("source").alias("s"), F.col("block").alias("b"), F.aggregate("docs", start, fit, nearest_end).alias("chosen"))
    blocks = blocks.join(chosen, same_block, "left").drop("s", "b")

    # A source's drawn blocks are numbered: all of them once per whole pass,
    # then as far as the rest reaches. The tree deals the numbers to shards.
    part = blocks.groupBy("source").agg(F.max(F.when(F.col("room") > 0, F.col("block") + 1)).alias("part"))
    drawn = F.col("passes") * F.col("n_blocks") + F.coalesce("part", F.lit(0))
    quotas = part.join(by_plan, F.col("source").eqNullSafe(F.col("src"))).select("source", drawn.alias("blocks"))
    runs = split_tree(quotas, depth, seed).groupBy(F.col("source").alias("src"))
    runs = runs.agg(F.array_sort(F.collect_list(F.struct("start", "blocks", "shard"))).alias("runs"))
    blocks = blocks.join(runs, F.col("source").eqNullSafe(F.col("src")), "left")

    def shard_of(k):
        at = k * F.col("n_blocks") + F.col("block")
        return F.get(F.filter("runs", lambda r: (r["start"] <= at) & (at < r["start"] + r["blocks"])), 0)["shard"]

    dealt = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(most).cast("long")), shard_of)
    blocks = blocks.select(
        F.col("source").alias("s"), F.col("block").alias("b"), "source_size", "target", "passes", "room", "words", "chosen", dealt.alias("dealt")
    )

    rows = rows.join(blocks, same_block).drop("s", "b")
    whole = F.col("words") <= F.col("room")
    more = (F.col("room") > 0) & (whole | F.coalesce(F.array_contains("chosen", key), F.lit(False)))
    times = F.when(F.col("size") > 0, F.col("passes") + more.cast("long")).otherwise(0).cast("long")
    place = lambda s, k: F.struct(s.alias("shard"), uniform(F.lit(seed + 1), F.col("u"), k).alias("place"))
    rows = rows.withColumn("times", times)
    shards = F.transform(F.slice("dealt", F.lit(1), F.col("times").cast("int")), place)
    return rows.select(
        "doc_id", "source", "size", "copy", "source_size", "target", "times", (F.col("times") * F.col("size")).alias("taken"), shards.alias("shards")
    )


def mixed_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    shard_col: str = "shard",
    place_col: str = "place",
    **options,
) -> DataFrame:
    """``docs`` as often as the mix takes them, with ``shard_col`` and ``place_col``.

    Sorting by shard and place gives the shuffled output shards. Rows of equal
    id, source and size take their turns in the order of their texts. Columns
    of ``docs`` of the two names are replaced; all others come along.
    """
    taken = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options).where("times > 0")
    taken = taken.select(
        F.col("doc_id").alias(f"{OWN}id"), F.col("source").alias(f"{OWN}source"), F.col("size").alias(f"{OWN}n"), F.col("copy").alias(f"{OWN}k"),
        F.transform("shards", lambda s: F.struct(s["shard"].alias(shard_col), s["place"].alias(place_col))).alias(f"{OWN}shards"),
    )
    turn = W.partitionBy(id_col, source_col, f"{OWN}size").orderBy(text_col)
    rows = docs.drop(shard_col, place_col).withColumn(f"{OWN}size", word_count(F.col(text_col))).withColumn(f"{OWN}copy", F.row_number().over(turn))
    same = (
        F.col(id_col).eqNullSafe(F.col(f"{OWN}id"))
        & F.col(source_col).eqNullSafe(F.col(f"{OWN}source"))
        & (F.col(f"{OWN}size") == F.col(f"{OWN}n"))
        & (F.col(f"{OWN}copy") == F.col(f"{OWN}k"))
    )
    rows = rows.join(taken, same)
    return rows.select(*[F.col(c) for c in docs.columns if c not in (shard_col, place_col)], F.inline(f"{OWN}shards"))


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "source", "size", "source_size", "target", "taken", "shards")
