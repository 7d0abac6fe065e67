"""Language-model scores from a subword lattice (operator 6).

The pieces of an existing subword vocabulary get unigram scores from the
training documents; a word's probability is the sum over all its
segmentations into pieces, by a forward recursion in log space. A document's
probability is the product over its words and one end. Pieces never cross
words: the pieces that begin with the word mark begin words, the others
continue them.

A vocabulary file of merges scores its pieces by rank, which is no
probability, so the scores are learned here and only the list of pieces is
taken from the file.

The commonest words (a bounded number) are looked up in every task; all others
are joined, so neither the words of the corpus nor a document's words have to
fit anywhere at once.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwise.llm.common import staged

#: The mark of a word's beginning in the vocabulary's pieces (fixed value).
MARK = "▁"
#: The commonest words that every task holds.
COMMON = 1 << 16
#: Words are counted about so many bytes of text at a time.
CHUNK = 1 << 23
LN10 = math.log(10.0)


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept from training: CRC-32 of its id as text, modulo 5, is 1."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


@lru_cache(maxsize=2)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def pieces_of(path: str) -> tuple[dict[str, int], list[int]]:
    """The pieces' numbers, without control pieces, and those of the 256 byte pieces."""
    p = _processor(path)
    plain = {p.id_to_piece(i): i for i in range(p.vocab_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))}
    return plain, [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def _count_words() -> object:
    """Texts to words with their training and total counts, a chunk at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        train: Counter = Counter()
        rest: Counter = Counter()
        size = 0

        def out() -> pd.DataFrame:
            words = [*train, *(w for w in rest if w not in train)]
            n = np.array([train.get(w, 0) for w in words], dtype="int64")
            both = n + np.array([rest.get(w, 0) for w in words], dtype="int64")
            return pd.DataFrame({"word": [w.decode() for w in words], "train": n, "n": both})

        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                raw = text.encode().lower()
                (rest if held_out(None if pd.isna(doc_id) else int(doc_id)) else train).update(raw.split())
                size += len(raw)
                if size >= CHUNK:
                    yield out()
                    train.clear(), rest.clear()
                    size = 0
        if train or rest:
            yield out()

    return run


def _count_pieces(path: str):
    """Training words to the counts of the pieces that the vocabulary cuts them into."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        processor, total = _processor(path), np.zeros(0, dtype="int64")
        total = np.zeros(processor.vocab_size(), dtype="int64")
        for pdf in batches:
            ids = processor.encode(pdf["word"].tolist(), num_threads=1)
            lengths = np.fromiter(map(len, ids), dtype="int64", count=len(ids))
            flat = np.fromiter((i for own in ids for i in own), dtype="int64", count=int(lengths.sum()))
            np.add.at(total, flat, np.repeat(pdf["train"].to_numpy(), lengths))
        some = np.flatnonzero(total)
        yield pd.DataFrame({"piece": some, "n": total[some]})

    return run


class Lattice:
    """Unigram scores over pieces; natural logarithms inside."""

    def __init__(self, path: str, counts: dict[int, int], ends: int) -> None:
        plain, bytes_ = pieces_of(path)
        total = sum(counts.values()) + ends
        floor = total + 0.5 * (len(plain) + len(bytes_) + 1)
        score = lambda n: math.log((n + 0.5) / floor)
        self.score = {p: score(counts.get(i, 0)) for p, i in plain.items()}
        self.byte = [score(counts.get(i, 0)) for i in bytes_]
        self.end = score(ends)
        # What a piece begins with, and the score of what is a piece itself.
        self.steps: dict[str, float | None] = {p[:k]: None for p in self.score for k in range(1, len(p))}
        self.steps.update(self.score)

    def word(self, word: str) -> float:
        """The logarithm of the sum over all segmentations of ``word``.

        ``alpha`` is that of the first ``i`` characters; the pieces that go on
        from there are followed as far as some piece begins so. A character
        that is no piece is spelled in bytes.
        """
        s, steps, exp = MARK + word, self.steps, math.exp
        n = len(s)
        ends: list[list[float]] = [[] for _ in range(n + 1)]
        ends[0].append(0.0)
        for i in range(n + 1):
            terms = ends[i]
            if len(terms) == 1:
                alpha = terms[0]
            else:
                top = max(terms)
                alpha = top + math.log(sum([exp(t - top) for t in terms]))
            if i == n:
                return alpha
            found = steps.get(s[i])
            if found is None:
                ends[i + 1].append(alpha + sum(self.byte[b] for b in s[i].encode()))
                if s[i] not in steps:
                    continue
            else:
                ends[i + 1].append(alpha + found)
            for j in range(i + 2, n + 1):
                found = steps.get(s[i:j], 0)
                if found == 0:
                    break
                if found is not None:
                    ends[j].append(alpha + found)
        return alpha


def _score_words(model: Broadcast):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = model.value
        for pdf in batches:
            pdf["log10"] = [lattice.word(w) / LN10 for w in pdf["word"]]
            yield pdf[["word", "train", "n", "log10"]]

    return run


SCORED = "row long, doc_id long, word string, n long, n_tokens long, n_known long, base double, log10 double"


def _score_documents(common: Broadcast):
    """Documents to one row of sums over common words and ends, and rows of other words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, end = common.value
        for pdf in batches:
            ids = pdf["doc_id"].astype("Int64").tolist()
            rows, size = [], 0
            for row, doc_id, text in zip(pdf["row"].tolist(), ids, pdf["text"].tolist(), strict=True):
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                words = text.encode().lower().split()
                n_known, base, log10 = end
                for w, n in Counter(words).items():
                    found = known.get(w)
                    if found is None:
                        rows.append((row, None, w.decode(), n, 0, 0, 0.0, 0.0))
                    else:
                        n_known += n * found[0]
                        base += n * found[1]
                        log10 += n * found[2]
                # A word never holds a space, so this row meets none in the join.
                rows.append((row, doc_id, f" {row}", 0, len(words) + 1, n_known, base, log10))
                size += len(text)
                if size >= CHUNK:
                    yield _frame(rows)
                    rows, size = [], 0
            yield _frame(rows)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["row", "doc_id", "word", "n", "n_tokens", "n_known", "base", "log10"])
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def score_documents(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row.

    Tokens are the words, A-Z lower-cased, and one end. ``base_score`` is the
    sum over tokens of ``log10((c + 0.5) / (N + 0.5 * (V + 1)))`` with the
    counts of the training documents, ``n_known`` the number of tokens with
    ``c > 0``, ``train_tokens`` N. ``score`` is the lattice model's log10
    probability.

    A null or empty text is one token, the end. A null id counts as the empty
    text in the choice of training documents. Repeated rows are scored and
    counted as so many documents. Without any training document all counts are
    0 and every score comes from the smoothing. An empty table gives no row. A
    word that holds the mark that begins words (U+2581) is spelled with it like
    with any other character, so it may use pieces that begin words inside. A
    text of any length is counted as a whole; a word's cost grows with its
    length times that of the longest piece. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = rows.mapInPandas(_count_words(), "word string, train long, n long")
    words = staged(counted.groupBy("word").agg(F.sum("train").alias("train"), F.sum("n").alias("n")), "words")

    out_of_training = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    ends = rows.where(~out_of_training).count()
    sums = words.agg(F.sum("train").alias("n"), F.count(F.when(F.col("train") > 0, 1)).alias("v")).first()
    train_tokens, distinct = (sums["n"] or 0) + ends, sums["v"] + (ends > 0)
    floor = train_tokens + 0.5 * (distinct + 1)

    # At most one count per piece of the vocabulary comes to the driver.
    pieces = words.where("train > 0").mapInPandas(_count_pieces(path), "piece long, n long")
    counts = {r["piece"]: r["n"] for r in pieces.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    lattice = Lattice(path, counts, ends)
    model = spark.sparkContext.broadcast(lattice)
    scored = words.mapInPandas(_score_words(model), "word string, train long, n long, log10 double")
    base = F.log10((F.col("train") + 0.5) / F.lit(floor))
    scored = staged(scored.select("word", "n", (F.col("train") > 0).cast("long").alias("known"), base.alias("base"), "log10"), "word-scores")

    # The commonest words, by levels of eight to a doubling of the count: as
    # many whole levels as COMMON words fill, so no task sends more.
    level = F.floor(F.log2(F.col("n")) * 8)
    room, lowest = COMMON, math.inf
    for r in scored.groupBy(level.alias("level")).agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        if r["words"] > room:
            break
        room, lowest = room - r["words"], r["level"]
    top = scored.where(level >= lowest) if lowest < math.inf else scored.limit(0)
    end = (int(ends > 0), math.log10((ends + 0.5) / floor), lattice.end / LN10)
    common = spark.sparkContext.broadcast(
        ({r["word"].encode(): (r["known"], r["base"], r["log10"]) for r in top.collect()}, end)
    )

    parts = rows.withColumn("row", F.monotonically_increasing_id()).mapInPandas(_score_documents(common), SCORED)
    of_word = scored.select(F.col("word").alias("w"), "known", F.col("base").alias("w_base"), F.col("log10").alias("w_log10"))
    joined = parts.join(of_word, F.col("word") == F.col("w"), "left")
    times = lambda c: F.coalesce(F.col("n") * F.col(c), F.lit(0))
    by_row = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum(F.col("n_tokens")).alias("n_tokens"),
        F.sum(F.col("n_known") + times("known")).alias("n_known"),
        F.sum(F.col("base") + times("w_base")).alias("base_score"),
        F.sum(F.col("log10") + times("w_log10")).alias("score"),
    )
    return by_row.select(
        "doc_id",
        out_of_training.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
