"""Quality rules: a learned decision list (operator 5).

Statistics of each text are Spark expressions. Sequential covering learns an
ordered list of rules from labelled statistics: each rule is a conjunction of
at most ``max_terms`` thresholds, grown on one part of the labels, pruned on
the other, and what it covers is set aside before the next is grown. The
list is a chain of conditional expressions. The counts that learning needs are
aggregations in Spark; the driver sees one row of counts per step.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import SPACES, staged

#: Statistics that rules may test: name and expression over the counts.
FEATURES = {
    "n_words": "n_words",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_word_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_word_share": "n_distinct_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "exclaims_per_word": "n_exclaims / greatest(n_words, 1)",
}


@dataclass(frozen=True)
class Term:
    """``feature <= bound`` or, if not ``below``, ``feature > bound``."""

    feature: str
    below: bool
    bound: float

    def column(self) -> Column:
        f = F.col(self.feature)
        return f <= self.bound if self.below else f > self.bound

    def __str__(self) -> str:
        return f"{self.feature} {'<=' if self.below else '>'} {self.bound:g}"


Rule = tuple[Term, ...]


def _holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [t.column() for t in rule])


def _left(text: Column, outside: str) -> Column:
    """The number of characters of ``text`` without the runs of ``outside``."""
    return F.length(F.regexp_replace(text, outside, ""))


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words within windows of three words that the text holds twice or more.

    ``hashes`` has a hash per window. Without two equal hashes there is no
    repeated window; else the windows are sorted by hash, and neighbours of
    one hash are compared word by word.
    """
    n = F.size(words)
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(pairs: Column) -> Column:
        def same(p, q):
            equal = F.slice(words, p["i"] + 1, 3) == F.slice(words, q["i"] + 1, 3)
            return F.when(p["h"] == q["h"], equal).otherwise(False)

        return F.transform(
            F.filter(pairs, lambda p, k: same(p, F.get(pairs, k - 1)) | same(p, F.get(pairs, k + 1))), lambda p: p["i"]
        )

    def covered(pairs: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(starts(pairs), lambda i: F.array(i, i + 1, i + 2)))))

    # transform over one element binds the sorted pairs, so they are made once
    exact = F.get(F.transform(F.array(pairs), covered), 0)
    return F.when((n >= 4) & (F.size(F.array_distinct(hashes)) < F.size(hashes)), exact).otherwise(0)


def text_stats(docs: DataFrame, *, text_col: str = "text", keep: list[Column]) -> DataFrame:
    """``keep`` and the counts that the rules use, one row per row of ``docs``.

    Words are separated by spaces and the ASCII controls 9-13. A null or empty
    text has 0 everywhere. Lines are split at line feeds; only lines with a
    word count, and one is a duplicate if an earlier line is equal to it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.struct(*keep).alias("keep"),
        text.alias("text"),
        F.filter(F.split(text, SPACES), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    words = F.col("words")
    # What the character counts look at, taken out of the text in one pass.
    rows = rows.withColumn("marks", F.regexp_replace("text", r"[^#*$%&|<>!0-9\p{Lu}]++", ""))
    marks = F.col("marks")
    first = F.when(F.size(words) > 2, F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0)))).otherwise(F.array().cast("array<string>"))
    hashes = F.transform(first, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    rows = rows.withColumn("hashes", hashes)
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": _left(marks, r"[^#*$%&|<>]++"),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _repeat_words(words, F.col("hashes")),
        "n_distinct_words": F.size(F.array_distinct(words)),
        "n_upper": _left(marks, r"[^\p{Lu}]++"),
        "n_digits": _left(marks, r"[^0-9]++"),
        "n_exclaims": _left(marks, r"[^!]++"),
    }
    # A generated row, so that a filter on a count does not count again.
    return rows.select("keep", F.inline(F.array(F.struct(*[c.cast("long").alias(k) for k, c in counts.items()]))))


def with_features(stats: DataFrame) -> DataFrame:
    return stats.withColumns({f: F.expr(x).cast("double") for f, x in FEATURES.items()})


def _log2_share(p: int, n: int) -> float:
    return math.log2(p / (p + n)) if p else -math.inf


def learn_rules(
    labelled: DataFrame,
    *,
    reject_col: str = "reject",
    key_col: str = "doc_id",
    max_rules: int = 8,
    max_terms: int = 3,
    steps: int = 32,
    least_precision: float = 0.95,
    least_covered: int = 5,
) -> list[Rule]:
    """Rules that reject, in order, by sequential covering.

    ``labelled`` has the features and a boolean ``reject_col`` (null: not
    used). Two thirds of the rows, by a hash of ``key_col``, grow rules, the
    rest prunes them. Bounds are ``steps`` quantiles of each feature within
    each class. A rule grows by the term of highest information gain until it
    covers no kept row; it is cut back to the prefix with the best balance on
    the pruning rows and accepted if its precision there is at least
    ``least_precision`` with ``least_covered`` rows or more on both parts.
    After a rule that fails, another first feature is tried; the list ends
    when none is left. No labels or one class only: no rules.
    All labelled rows count; the driver sees counts by feature and bin only.
    """
    names = list(FEATURES)
    rows = labelled.where(F.col(reject_col).isNotNull())
    shares = [i / steps for i in range(steps)] + [1.0]
    quantiles = rows.groupBy(reject_col).agg(*[F.percentile_approx(f, shares, 10_000).alias(f) for f in names]).collect()
    if len(quantiles) < 2:
        return []
    bounds = [sorted({float(x) for q in quantiles for x in q[f]}) for f in names]

    def bin_of(f: str, own: list[float]) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, own)), lambda b: F.col(f) > b))

    part = F.pmod(F.xxhash64(F.coalesce(F.col(key_col).cast("string"), F.lit(""))), F.lit(3)) == 0
    binned = staged(
        rows.select(F.col(reject_col).alias("reject"), part.alias("prune"), F.array(*map(bin_of, names, bounds)).alias("bins")),
        "decision-list",
    )

    def holds(rule: tuple[tuple[int, bool, int], ...]) -> Column:
        at = lambda i: F.get("bins", F.lit(i))
        return reduce(lambda a, b: a & b, [at(i) <= k if below else at(i) > k for i, below, k in rule], F.lit(True))

    def best_term(left: DataFrame, rule, tried: set[int]):
        """The term of highest gain on the growing rows that ``rule`` covers.

        A first term is of a feature that no failed rule began with.
        """
        cells = left.where(~F.col("prune") & holds(rule)).select("reject", F.posexplode("bins").alias("i", "bin"))
        counts = [[[0, 0] for _ in range(len(b) + 1)] for b in bounds]
        for r in cells.groupBy("i", "bin", "reject").count().collect():
            counts[r["i"]][r["bin"]][not r["reject"]] = r["count"]
        p0, n0 = (sum(c[k] for c in counts[0]) for k in (0, 1))
        found = None
        for i, own in enumerate(counts):
            if not rule and i in tried:
                continue
            p = n = 0
            for k in range(len(own) - 1):
                p, n = p + own[k][0], n + own[k][1]
                for below, (a, b) in ((True, (p, n)), (False, (p0 - p, n0 - n))):
                    gain = a * (_log2_share(a, b) - _log2_share(p0, n0)) if a >= least_covered else 0.0
                    # Of bounds that part the rows alike, the one that rejects least.
                    if gain > 1e-9 and (found is None or gain > found[0] or gain == found[0] and found[1][0] == i and not below):
                        found = (gain, (i, below, k), b)
        return found

    rules, left, tried = [], binned, set()
    while len(rules) < max_rules:
        rule: tuple[tuple[int, bool, int], ...] = ()
        while len(rule) < max_terms and (found := best_term(left, rule, tried)):
            rule = (*rule, found[1])
            if not found[2]:
                break
        if not rule:
            break
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        sums = [F.count(F.when(holds(x) & (F.col("reject") == side), 1)) for x in prefixes for side in (True, False)]
        got = left.where("prune").agg(*[c.alias(f"c{k}") for k, c in enumerate(sums)]).first()
        score = [(got[2 * k] - got[2 * k + 1]) / (got[2 * k] + got[2 * k + 1]) if got[2 * k] >= least_covered else -1.0 for k in range(len(rule))]
        k = max(range(len(rule)), key=lambda k: (score[k], -k))
        if score[k] < 2 * least_precision - 1:
            tried.add(rule[0][0])
            continue
        rules.append(tuple(Term(names[i], below, bounds[i][b]) for i, below, b in prefixes[k]))
        left, tried = left.where(~holds(prefixes[k])), set()
    return rules


def first_rule(rules: list[Rule]) -> Column:
    """The number (from 1) of the first rule that holds, as ordered conditions; null if none does."""
    out = None
    for i, rule in enumerate(rules, 1):
        out = F.when(_holds(rule), i) if out is None else out.when(_holds(rule), i)
    return F.lit(None).cast("int") if out is None else out.otherwise(None).cast("int")


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """The rules from ``stats`` (``doc_id``, counts, features) and ``labels`` (``doc_id``, ``quality``)."""
    marks = labels.select(F.col("doc_id").alias("__id"), (F.col("quality") == 0).alias("reject")).where("reject is not null")
    return learn_rules(stats.join(marks, F.col("doc_id") == F.col("__id")))


def decided(stats: DataFrame, rules: list[Rule], *, min_words: int = 50) -> DataFrame:
    """``stats`` with ``base_failed``, ``rule`` (the first that holds) and ``kept``."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = stats.withColumn("base_failed", failed).withColumn("rule", first_rule(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def _staged_stats(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    own = with_features(text_stats(docs, text_col=text_col, keep=[F.col(id_col).alias("doc_id")]))
    return staged(own.select("keep.doc_id", *[c for c in own.columns if c != "keep"]), "text-stats")


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``rule`` and ``kept`` per row of ``docs``.

    The base fails a text of under ``min_words`` words or with more than half
    of its words in repeated windows; the learned list is asked about the
    rest. ``labels`` has ``doc_id`` and ``quality`` (0: reject, null: not
    used); a document that two labels name counts twice. Rows with a null id
    are judged, but can have no label. Equal rows are judged alike, one by one;
    of terms or rules that are equally good, the first in the order of the
    features and bounds is taken. A text of any length is counted as a whole,
    in arrays of its words and lines. An empty table gives an empty result.
    The counts are written to the shared folder, so texts are read once.
    """
    stats = _staged_stats(docs, id_col, text_col)
    return decided(stats, learn(stats, labels), min_words=min_words)


def filtered(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, most_labels: int = 65_536
) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns.

    The rules are those of ``judge``, learned from at most ``most_labels``
    labels, the first by a hash of their id; their ids are broadcast (8 bytes
    each), so only labelled texts are counted to learn. All texts are then
    counted once, beside the text, and none is shuffled. Rows with a null id
    and repeated rows are judged one by one; an empty table stays empty.
    """
    known = labels.where("doc_id is not null and quality is not null").select("doc_id", "quality")
    used = staged(known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most_labels), "labels-used")
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    own = own.join(F.broadcast(used.select("doc_id").distinct()), "doc_id", "left_semi")
    rules = learn(_staged_stats(own, "doc_id", "text"), used)
    stats = with_features(text_stats(docs, text_col=text_col, keep=[F.col(c) for c in docs.columns]))
    return decided(stats, rules, min_words=min_words).where("kept").select("keep.*")


def digest(judged: DataFrame) -> DataFrame:
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *[F.col(c).cast("long").alias(c) for c in counts], "base_failed", "kept", "rule")
