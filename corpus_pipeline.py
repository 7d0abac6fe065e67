"""A corpus pipeline over ``documents``: clean, deduplicate, redact, mix, pack.

``STAGES`` lists the stages in order; each is ``(spark, docs, sf_dir) ->
DataFrame`` and works on all that the stage before it kept. All but the last
return the columns of ``documents``. ``run`` writes each stage's result to the
shared folder and reads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwise.llm import mixing, near_dedup, packing, quality, registry, secrets
from pitwise.llm.common import OWN, scratch, ship, staged, table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or a learned rule go.

    A null or empty text has no words and goes. Equal rows are judged alike and
    all stay or all go; a null id has no label. An empty table stays empty, and
    without labels only the base decides.
    """
    ship(spark)
    return quality.filtered(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, 0.8).

    The one of the smallest id; of rows that share it, one. Texts without words
    are linked with nothing and stay. An empty table stays empty.
    """
    ship(spark)
    return near_dedup.deduplicated(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets, private keys to their last line, are replaced by their kind in brackets; every document stays.

    Repeated rows are redacted alike; a null text stays null, a text without
    secrets stays as it is, and so does ``n_chars`` then. Overlapping secrets
    are replaced once. Other columns, of any name, come along unchanged.
    """
    ship(spark)
    own = f"{OWN}secrets"
    found, _ = secrets.find_secrets(docs, rules=secrets.WHOLE, into=own)
    clean = found.withColumn("text", secrets.redacted(F.col("text"), F.col(own)))
    changed = F.when(F.size(own) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them, not at all up to twice, shard by shard and shuffled within.

    Null sources are one source, the last; documents without words are never
    taken; repeated rows are documents of their own. Each partition holds
    whole runs of shards in the order of ``place``, which packing keeps. Other
    columns, of any name, come along unchanged. An empty table stays empty.
    """
    shard, place = f"{OWN}shard", f"{OWN}place"
    mixed = mixing.mixed_documents(docs, shard_col=shard, place_col=place)
    # A shard is dealt to 64 parts by place, so no task holds a whole one.
    part = F.floor(F.col(place) * 64)
    return mixed.repartition(shard, part).sortWithinPartitions(shard, place).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequences, packed in the order of the rows.

    A null or empty text is its end token; repeated rows are packed as often as
    they come. An empty table gives no row.
    """
    ship(spark)
    return packing.pack_documents(docs, tokenizer_path(registry.BYTE_BPE), in_order=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup_stage),
    ("secret scans", secret_scan),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Learning, components and token ids have no SQL form; tests hold every stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        # What the stage has staged, and its input, go when its result is written.
        with scratch(spark) as made:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
            kept = made.pop()
            made += last
        last = [kept]
    return STAGES[-1][1](spark, docs, sf_dir)
