"""The pipeline's stages against brute force, each on its own input."""

import os
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitwise.llm import packing, quality, secrets
from pitwise.llm.common import staged, tokenizer_path
from tests.llm.helpers import SF, docs_frame, linked_components, words
from tests.llm.test_mixing import shared_out
from tests.llm.test_secrets import ASSIGN
from tests.llm.test_tokens import check_packing


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], SF), "test-pipeline"))
    return out


def test_stages_keep_the_columns_of_documents(results):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near-dedup", "secret scans", "mixing", "packing"]
    for df in results[1:-1]:
        assert df.schema.simpleString() == results[0].schema.simpleString()


def test_quality_stage(spark, results):
    kept = quality.judge(results[0], spark.read.parquet(f"{SF}/labels.parquet")).where("kept")
    assert {r.doc_id for r in results[1].collect()} == {r.doc_id for r in kept.collect()}


def test_dedup_stage(results):
    rows = [(r.doc_id, r.text) for r in results[1].collect()]
    assert sorted(r.doc_id for r in results[2].collect()) == sorted(set(linked_components(rows, 5).values()))


def test_secret_stage_redacts_and_keeps_all(results):
    before = {r.doc_id: r for r in results[2].collect()}
    after = {r.doc_id: r for r in results[3].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not any(len(m[2]) >= 8 for m in ASSIGN.finditer(r.text))
        assert r.n_chars == len(r.text)
        if not any(m for m in ASSIGN.finditer(before[i].text)) and "[" not in r.text:
            assert r.text == before[i].text


def test_secret_stage_redacts_whole_private_keys(spark):
    line = "MIIEpAIBAAKCAQEA7x+/" + "Ab3/" * 11
    head, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    key = f"{head}\n{line}\n{line}\nQUJDRA==\n"
    texts = [
        f"a\n{key}{end}\nThe rest",
        f"a\n{key}The rest, with no end",
        f"a\n{key}{end}\n".replace("\n", "\\n") + '"',
        f"a\n{key}{end}\nThe rest".replace("\n", " "),
        f"{head}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0AF3\n\n{line}\n{end}\nz",
        f"the line {head} begins a key",
    ]
    want = ["a\n[PEM]\nThe rest", "a\n[PEM]\nThe rest, with no end", 'a\\n[PEM]\\n"', "a [PEM] The rest", "[PEM]\nz", "the line [PEM] begins a key"]
    out = {r.doc_id: r for r in corpus_pipeline.secret_scan(spark, docs_frame(spark, list(enumerate(texts))), SF).collect()}
    assert [out[i].text for i in range(len(texts))] == want
    assert all(r.n_chars == len(r.text) for r in out.values())


def test_mixing_stage(results):
    sizes, largest, taken, copies = {}, {}, {}, {}
    for r in results[3].collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(words(r.text))
        largest[r.source] = max(largest.get(r.source, 0), len(words(r.text)))
    for r in results[4].collect():
        taken[r.source] = taken.get(r.source, 0) + len(words(r.text))
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    assert max(copies.values()) <= 2
    for s, t in shared_out(sizes).items():
        assert abs(taken.get(s, 0) - t) <= largest[s] / 2 + 1  # whole documents, a few a source here


def test_packing_stage(results):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    once = results[4].dropDuplicates(["doc_id"])
    pieces = packing.pack_documents(once, tokenizer_path("byte_bpe_50k.json")).collect()
    check_packing(pieces, {r.doc_id: [*library.encode(r.text, add_special_tokens=False).ids, 1] for r in once.collect()}, 2048)
    total = results[5].groupBy().sum("length").first()[0]
    want = sum(len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in results[4].collect())
    assert total == want


def test_stages_on_an_empty_table(spark):
    docs = docs_frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


CLASHES = ("secrets", "shard", "place", "size", "copy", "block", "key", "keep", "words", "blob", "kept", "rule", "n_words", "times", "n")


def test_stages_keep_columns_of_any_name_and_rows_with_nulls(spark):
    body = " ".join(f"w{i}{chr(97 + i % 26)}" for i in range(70))
    rows = [(1, body, "a"), (1, body, "a"), (2, f"{body} tail of its own with password=abcdefgh1", None), (3, None, "a"), (4, "", None), (None, " ".join(f"x{i}" for i in range(90)), "b")]
    df = docs_frame(spark, rows)
    for i, c in enumerate(CLASHES):
        df = df.withColumn(c, F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    counts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.schema.simpleString() == df.schema.simpleString(), name
        got = out.collect()
        for r in got:
            assert all(r[c] == f"{c} of {'none' if r.doc_id is None else r.doc_id}" for c in CLASHES), name
        counts[name] = sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in got)
    assert [x[1] for x in counts["quality rules"]] == [1, 1, 2, 0]  # the wordless go, equal rows stay
    assert sorted(x[1] for x in counts["near-dedup"]) == [0, 1, 3, 4]  # 2 is near 1; texts without words stay
    assert [x[2] for x in counts["secret scans"]] == [body, body, f"{body} tail of its own with [ASSIGN]", "", "", rows[5][1]]
    assert {x[1] for x in counts["mixing"]} <= {0, 1, 2} and max(Counter(counts["mixing"]).values()) <= 4
    packed = packing.pack_documents(df, tokenizer_path("byte_bpe_50k.json"), in_order=True).collect()
    assert sum(p.start == 0 for p in packed) == len(rows)


def test_mixing_stage_is_in_the_order_of_the_shards(spark):
    rows = [(i, "w " * 5, "ab"[i % 2]) for i in range(3000)]
    out = corpus_pipeline.mix_sources(spark, docs_frame(spark, rows), SF).select("doc_id").collect()
    ids = [r.doc_id for r in out]
    assert sum(a < b for a, b in zip(ids, ids[1:], strict=False)) < 0.6 * len(ids)  # shuffled, not in the order of the table
    again = corpus_pipeline.mix_sources(spark, docs_frame(spark, rows).repartition(7), SF).select("doc_id").collect()
    assert Counter(ids) == Counter(r.doc_id for r in again)


def test_packing_in_order_keeps_neighbours_together(spark):
    docs = docs_frame(spark, [(i, f"text {i}") for i in range(100)]).coalesce(1)
    pieces = packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), capacity=16, block_docs=10, in_order=True).collect()
    blocks = {}
    for p in pieces:
        blocks.setdefault(p.sequence_id >> 32, set()).add(p.doc_id // 10)
    assert len(blocks) == 10 and all(len(b) == 1 for b in blocks.values())


def test_folders_of_a_stage_go_when_its_result_is_written(spark, monkeypatch):
    from pitwise.llm import common

    root = common.shared_dir(spark).removeprefix("file:") + "/pitwise-llm"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    out = corpus_pipeline.run(spark, SF)
    left = set(os.listdir(root)) - before
    assert out.count() > 0 and len(left) == 1 and next(iter(left)).startswith("pipeline-mixing")


def test_run_gives_the_last_stage(spark, results):
    assert corpus_pipeline.run(spark, SF).groupBy().sum("length").first()[0] == results[5].groupBy().sum("length").first()[0]
    assert corpus_pipeline.ORACLE_SQL is None and "corpus_pipeline" in sys.modules and secrets.RULES
