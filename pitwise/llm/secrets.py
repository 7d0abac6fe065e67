"""Secret scans over an incremental blob ledger (operator 2).

Every version of a text is addressed by its content. Only pairs of a blob and
a rule version that the ledger does not hold are scanned; findings are joined
back to every path that holds the blob.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import staged


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches whose ``group`` has ``least`` characters or more.

    A shorter match is dropped, but what it matched is not searched again.
    Bump ``version`` whenever ``pattern`` or ``least`` changes.
    """

    kind: str
    version: int
    pattern: str
    least: int = 1
    group: int = 0
    any_case: bool = False


#: The base kinds, in the order of the digest (fixed values).
BASE = (
    Rule("assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2, True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 16),
    Rule("hex", 1, r"[0-9a-f]+", 32),
)
#: Further kinds: private key headers, and tokens with a known prefix.
ADDED = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("prefixed", 1, r"(?:ghp|gho|ghs|ghu|ghr|glpat|xoxb|xoxp|sk_live)[_-][A-Za-z0-9_-]+", 20),
)
#: The rules of the query, whose SQL holds the same patterns.
RULES = BASE + ADDED

_KEY_END = r"-----END\x20[A-Z ]*PRIVATE KEY-----"
#: Between the lines of a key: white space, escaped line ends and marks of quoting.
_KEY_GAP = r"""\s|\\[nrt]|["'`,>#|*\\]|<br\s*/?>"""
_KEY_HEADER = r"Proc-Type:\s*\d,[A-Z]+|DEK-Info:\s*[A-Z0-9-]+,[0-9A-Fa-f]+"
#: A private key from its first line to its last. Without an end it reaches to
#: the last base64 line: 16 characters or more, and a short one that ends them.
PRIVATE_KEY = Rule(
    "pem",
    2,
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    rf"(?:(?:{_KEY_GAP}|{_KEY_HEADER}|[A-Za-z0-9+/=]++)*+{_KEY_END}"
    rf"|(?:(?:(?:{_KEY_GAP}|\+\s)*+(?:{_KEY_HEADER}|[A-Za-z0-9+/]{{16,}}+={{0,2}}))++"
    rf"(?:(?:{_KEY_GAP})++(?:(?:[A-Za-z0-9+/]{{4}})*+(?:[A-Za-z0-9+/]{{2}}==|[A-Za-z0-9+/]{{3}}=)|(?:[A-Za-z0-9+/]{{4}})++(?![^\r\n\\])|[A-Za-z0-9+/]++=*\Z))?)?)",
)
#: The rules for text that is to be clean of secrets: with whole private keys.
WHOLE = tuple(PRIVATE_KEY if r.kind == "pem" else r for r in RULES)

FINDINGS = "blob string, kind string, version int, spans array<struct<start:int,end:int>>"


def _searcher(rule: Rule):
    pattern, least, group = rule.pattern, rule.least, rule.group
    # A run of one class that is too short holds no other match, so the run's
    # length can go into the pattern, which skips it faster.
    if group == 0 and pattern.endswith("]+") and pattern.count("[") == 1:
        head = len(pattern[: pattern.index("[")])
        pattern, least = pattern[:-1] + f"{{{max(1, least - head)},}}", 1
    found = re.compile(pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0)).finditer
    return lambda text: [m.span() for m in found(text) if m.end(group) - m.start(group) >= least]


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = {(r.kind, r.version): _searcher(r) for r in rules}
        for pdf in batches:
            out = {"blob": [], "kind": [], "version": [], "spans": []}
            for blob, text, todo in zip(pdf["blob"], pdf["text"], pdf["todo"], strict=True):
                for pair in todo:
                    kind, version = pair["kind"], pair["version"]
                    out["blob"].append(blob)
                    out["kind"].append(kind)
                    out["version"].append(version)
                    out["spans"].append([{"start": a, "end": b} for a, b in search[kind, version](text)])
            yield pd.DataFrame(out)

    return run


def scan_blobs(docs: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, *, text_col: str = "text") -> DataFrame:
    """New ledger rows ``blob, kind, version, spans``: one per blob and rule not in ``ledger``.

    ``blob`` is the SHA-256 of a text (null counts as empty). One text of each
    blob is kept, map tasks first, so thousands of copies of one text leave a
    row per map task; a blob that the ledger holds for every rule is not
    shuffled with its text beyond the join. A pair without findings is
    recorded too, with an empty array, so that it is never scanned again.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    blobs = docs.select(F.sha2(text, 256).alias("blob"), text.alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    if ledger is None:
        todo = blobs.withColumn("todo", wanted)
    else:
        pair = F.struct(F.col("kind").alias("kind"), F.col("version").alias("version"))
        done = ledger.groupBy("blob").agg(F.collect_set(pair).alias("done"))
        todo = blobs.join(done, "blob", "left").select(
            "blob", "text", F.when(F.col("done").isNull(), wanted).otherwise(F.array_except(wanted, F.col("done"))).alias("todo")
        )
        todo = todo.where(F.size("todo") > 0)
    return todo.mapInPandas(_scan(rules), FINDINGS)


def find_secrets(
    docs: DataFrame,
    ledger: DataFrame | None = None,
    rules: tuple[Rule, ...] = RULES,
    *,
    text_col: str = "text",
    into: str = "secrets",
) -> tuple[DataFrame, DataFrame]:
    """``(found, new)``: ``docs`` with ``into``, and the rows to append to the ledger.

    ``into`` is an array of ``kind, start, end`` (code points, end
    exclusive) over all ``rules``, by start and then in the order of the
    rules. Every row of ``docs`` comes back once, with all its columns: a null
    or empty text has an empty array, copies share what was found in their
    blob, and an empty table gives an empty result. ``new`` is written to the
    shared folder, so the scan runs once. A column of ``docs`` of the name
    ``into`` is replaced.
    """
    new = staged(scan_blobs(docs, ledger, rules, text_col=text_col), "secret-ledger")
    known = new if ledger is None else ledger.select(*new.columns).unionByName(new)
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    known = known.where((F.size("spans") > 0) & (current[F.col("kind")] == F.col("version")))
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order[F.col("kind")].alias("k"), s["end"].alias("end"), F.col("kind").alias("kind")))
    # A ledger holds a blob's pair once; a pair that two runs added counts once.
    by_blob = known.dropDuplicates(["blob", "kind"]).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list(spans))).alias("s"))
    by_blob = by_blob.select(F.col("blob").alias("__blob"), F.transform("s", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("__secrets"))
    blob = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    empty = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    found = docs.drop(into).withColumn("__blob", blob).join(by_blob, "__blob", "left")
    return found.withColumn(into, F.coalesce("__secrets", empty)).drop("__blob", "__secrets"), new


def find_with_ledger(docs: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, *, text_col: str = "text") -> DataFrame:
    """``find_secrets`` against the ledger at ``path``, to which new rows are added.

    The first run begins the ledger; later ones scan only what is new.
    """
    spark = docs.sparkSession
    try:
        ledger = spark.read.schema(FINDINGS).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        ledger = None
    found, new = find_secrets(docs, ledger, rules, text_col=text_col)
    new.write.mode("append").parquet(path)
    return found


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each of ``spans`` (sorted by start) replaced by ``[KIND]``.

    Overlapping spans are replaced once, as far as the furthest end reaches.
    """
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc, s):
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        before = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], before, mark)).otherwise(acc["out"])
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    def finish(acc):
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, finish))


def digest(found: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """The columns of the query: counts of the base kinds, their digest, all spans."""
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"].isin(*[r.kind for r in BASE]))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        F.col(id_col).alias("doc_id"),
        *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
