"""Operator 13 against a brute-force version."""

from collections import Counter, defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from pitwise.llm import line_dedup
from tests.llm.helpers import SF, docs_frame, lower

BLANK = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=20, least=3):
    """(doc_id, kept text, lines, dropped) of each row."""
    holders = defaultdict(set)
    key = lambda line: lower(line.strip(BLANK))
    rank = lambda i: (i is not None, i or 0)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    keeper = {k: max(v, key=rank) for k, v in holders.items() if len(v) >= least}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if keeper.get(key(x), i) == i]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return Counter(out)


def got(df):
    return Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect())


def test_the_table(spark):
    from pitwise.llm.registry import queries

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = Counter((i, n, d, sha256(t.encode()).hexdigest()) for (i, t, n, d), c in brute(rows).items() for _ in range(c))
    out = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in queries()["op13_line_dedup"](spark, SF).collect())
    assert out == want and sum(d * c for (_, _, d, _), c in out.items()) > 0


def test_blanks_case_order_and_the_threshold(spark):
    long, other = "A shared line of words É", "another line that is long"
    rows = [
        (1, f"{long}\nown\n\x0b {long.lower().replace('é', 'É')}\t\r\nlast\n"),
        (2, f"\n{long.upper()}"),  # É stays É: only A-Z are lower-cased
        (3, f"x\n{long}\n{long}"),
        (4, f"{long.replace('É', 'é')}\n{other}"),  # another key
        (5, f"{other}\n{'b' * 19}"),
        (6, "b" * 19),
        (7, "b" * 19),
        (8, " " + long),  # no blank of the contract
        (9, "ä" * 19 + "\n" + "é" * 20),
        (10, "ä" * 19 + "\n" + "é" * 20),
        (11, "ä" * 19 + "\n" + "é" * 20),
    ]
    out = line_dedup.dedup_lines(docs_frame(spark, rows))
    assert got(out) == brute(rows)
    by_id = {r.doc_id: r for r in out.collect()}
    assert (by_id[1].text, by_id[1].n_dropped) == ("own\nlast\n", 2) and by_id[3].text == f"x\n{long}\n{long}"
    assert by_id[2].text == "" and by_id[9].n_dropped == 1 and by_id[4].n_dropped == 0


def test_nulls_repeated_rows_one_id_with_two_texts_and_clashing_columns(spark):
    line = "a line of at least twenty characters"
    rows = [(1, None), (2, ""), (None, line), (None, f"{line}\nz"), (3, line), (3, line), (3, f"y\n{line}"), (4, f"{line}\nx"), (-5, line)]
    df = docs_frame(spark, rows).withColumns({c: F.lit("clash") for c in ("line", "pos", "id", "text_id", "lost", "n_lines", "keeper", "docs")})
    assert got(line_dedup.dedup_lines(df)) == brute(rows)
    # one id alone is one document, however many rows it has
    alone = [(1, line), (1, line), (1, f"{line}\n"), (2, line)]
    assert got(line_dedup.dedup_lines(docs_frame(spark, alone))) == brute(alone)


def test_a_hot_line_a_very_long_text_and_an_empty_table(spark):
    hot = "the same footer stands under every page"
    many = "\n".join([f"a line of its own, number {i}" for i in range(60_000)] + [hot] * 40_000)
    rows = [(i, f"text {i}\n{hot}") for i in range(600)] + [(700, many), (5000, f"{hot}\nend"), (701, "w " * 400_000)]
    assert got(line_dedup.dedup_lines(docs_frame(spark, rows).repartition(7))) == brute(rows)
    assert line_dedup.dedup_lines(docs_frame(spark, [])).count() == 0
