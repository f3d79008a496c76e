"""Language identification by language-bitmask n-gram filters.

A text is its letters, lower-cased, words joined by one space; its n-grams are
runs of four UTF-8 bytes of that.  Counts per (language, n-gram) over all
learning documents decide which n-grams are common in a language; each language
then has a Bloom filter of them.  The filters are bit-sliced: one table of
slots whose bit ``l`` belongs to language ``l`` (a slot has a word for every 63
languages, whatever their number), so the AND of the slots of an
n-gram's hashes returns all languages that contain it at once.  Per document
the bits of each language are counted over all n-grams, false positives are
taken out with the language's own rate, and the largest share decides.

A filter holds every n-gram of its language, however rare, so text that strays into a
corpus of another language is in its filter as well.  A second filter of the same form
marks the n-grams that are common in a language: at least ``MIN_SHARE`` of its n-grams, and ``RELATIVE`` of the
share that they have where they are commonest.  Counts of the second decide first; the first
decides between equals and where no n-gram is common in any language, and it alone says how much
of a text a language covers.  A table has
``PER_GRAM`` slots for each n-gram of the largest language, between ``LEAST`` and ``MOST`` slots
(67 MB for every 63 languages and filter); where that is too few, filters fill up and say so:
the rates of false positives rise and are taken out, and no n-gram is left out.
It is built by Spark, slot by slot, and only slots reach the driver.

Cases: ``und`` with score 0 for a null text or one without a letter, and for
every text when nothing could be learned; a text of letters that no filter
knows gets the language with most n-grams, at score 0; ties go to the first
language by name; null languages are not learned from; repeated rows each
have a row; an empty table gives an empty table; only doc_id, text (and lang, for
learning) are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc32_of_id, mix64, packed, prepared, written

MIN_SHARE, RELATIVE = 1e-5, 0.2
PER_GRAM, LEAST, MOST = 12, 1 << 16, 1 << 23
HASHES = 3
#: Languages of one word of a slot: a signed long holds them in Spark.
BITS = 63

#: What lies between words: all but letters and the marks that belong to them.
_letters = regex.compile(r"[^\p{L}\p{M}]+")


def grams(text: str | None) -> np.ndarray:
    """4-byte n-grams of the letters of a text (empty: no letter)."""
    words = _letters.sub(" ", text).strip() if text else ""
    if not any(map(str.isalpha, words)):  # marks alone are no letters
        return np.empty(0, np.uint32)
    b = np.frombuffer(f"  {words.lower()}  ".encode(), np.uint8)[1:].astype(np.uint32)
    return b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24


def slots(gram: np.ndarray, size: int) -> np.ndarray:
    """(HASHES, n) slots of each n-gram in a table of ``size`` (a power of two)."""
    h = mix64(gram.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = mix64(h) | np.uint64(1)
    return np.stack([(h + np.uint64(k) * step) & np.uint64(size - 1) for k in range(HASHES)]).astype(np.int64)


def gram_counts(learn: DataFrame) -> DataFrame:
    """(lang, gram, n) of (lang, text) rows; counted in tasks, then summed."""
    def run(batches):
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": gram.astype(np.int64), "n": n})

        for pdf in batches:
            for lang, text in zip(pdf["lang"].tolist(), pdf["text"].tolist()):
                g = grams(text)
                held.setdefault(lang, []).append(g)
                size += len(g)
            if size > 4_000_000:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    got = learn.select("lang", "text").mapInPandas(run, "lang string, gram long, n long")
    return got.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """What is sent to the executors: names, the slot tables of all and of common n-grams,
    false-positive rates."""

    def __init__(self, names: list[str], table: np.ndarray, common: np.ndarray, most: int):
        self.names, self.table, self.common, self.most = names, table, common, most
        self.false = [np.minimum((self._held(t) / len(t)) ** HASHES, 0.999) for t in (table, common)]

    def _held(self, hit: np.ndarray) -> np.ndarray:
        """How many of the slots have the bit of each language."""
        one = hit.dtype.type
        return np.array([np.count_nonzero(hit[:, k // BITS] >> one(k % BITS) & one(1)) for k in range(len(self.names))])

    def decide(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, share of the n-grams that it holds)."""
        g = grams(text)
        if not len(g) or not self.names:
            return "und", 0.0, 0.0
        at = slots(g, len(self.table))
        every, common = (self._counted(t, at, false) for t, false in zip((self.table, self.common), self.false, strict=True))
        if every.sum() <= 0:
            return self.names[self.most], 0.0, 0.0
        first = common if common.sum() > 0 else every
        best = int(np.lexsort((-np.arange(len(first)), every, first))[-1])
        return self.names[best], float(first[best] / first.sum()), float(min(1.0, every[best] / len(g)))

    def _counted(self, table: np.ndarray, at: np.ndarray, false: np.ndarray) -> np.ndarray:
        """For each language, how many of the n-grams it holds, without its false positives."""
        hit = table[at[0]]
        for k in range(1, HASHES):
            hit = hit & table[at[k]]
        return np.maximum(0, (self._held(hit) - at.shape[1] * false) / (1 - false))


def learn(docs: DataFrame) -> Filters:
    """Filters of all documents with a language whose crc32(doc_id) mod 4 is not 2."""
    prepared(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & (crc32_of_id() % 4 != 2))
    counts = written(gram_counts(rows), "lang-grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count("*").alias("grams")).orderBy("lang").collect()
    names = [r["lang"] for r in totals]
    if not names:
        return Filters([], np.zeros((LEAST, 1), np.uint64), np.zeros((LEAST, 1), np.uint64), 0)
    size = LEAST
    while size < min(MOST, PER_GRAM * max(r["grams"] for r in totals)):
        size *= 2
    words = -(-len(names) // BITS)
    of = docs.sparkSession.createDataFrame([(r["lang"], r["total"], k // BITS, 1 << k % BITS) for k, r in enumerate(totals)],
                                           "lang string, total long, word int, bit long")
    share = F.col("n") / F.col("total")
    top = F.max("share").over(Window.partitionBy("gram"))  # a row for each language
    is_common = (F.col("share") >= MIN_SHARE) & (F.col("share") >= RELATIVE * top)
    marked = (counts.join(F.broadcast(of), "lang").select("gram", "word", "bit", share.alias("share"))
              .select("gram", "word", "bit", F.when(is_common, F.col("bit")).otherwise(F.lit(0)).alias("common")))

    def placed(batches):
        for pdf in batches:
            at = slots(pdf["gram"].to_numpy(), size)
            yield pd.DataFrame({"slot": at.reshape(-1), **{c: np.tile(pdf[c], HASHES) for c in ("word", "bit", "common")}})

    # at most one row for each slot and word of the tables
    found = (marked.mapInPandas(placed, "slot long, word int, bit long, common long")
             .groupBy("slot", "word").agg(F.bit_or("bit").alias("bit"), F.bit_or("common").alias("common"))).toPandas()
    # a word is as wide as the languages need: every worker holds the tables
    word = next((t for t in (np.uint8, np.uint16, np.uint32) if len(names) <= 8 * t().itemsize), np.uint64)
    table, common = np.zeros((2, size, words), word)
    for t, name in ((table, "bit"), (common, "common")):
        t[found["slot"].to_numpy(), found["word"].to_numpy()] = found[name].to_numpy().astype(word)
    return Filters(names, table, common, int(np.argmax([r["total"] for r in totals])))


def predictor(docs: DataFrame):
    """A column function: text -> struct(lang_pred, score, cover)."""
    spark = prepared(docs.sparkSession)
    sent = spark.sparkContext.broadcast(learn(docs))  # 2 x MOST x 8 bytes for every BITS languages at most

    @F.pandas_udf("lang_pred string, score double, cover double")
    def predict(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sent.value.decide(t) for t in text.tolist()], columns=["lang_pred", "score", "cover"])

    return predict


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, cover of every document."""
    predict = predictor(docs)
    return (docs.select("doc_id", (crc32_of_id() % 4 == 2).alias("held_out"), predict("text").alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score", "p.cover"))


def accepted(docs: DataFrame, min_cover: float = 0.0) -> DataFrame:
    """``docs`` without the texts that no learned language holds: ``und``, or not more than
    ``min_cover`` of the n-grams in the best language's filter."""
    predict = predictor(docs)
    got = docs.select(packed(docs), predict("text").alias("p"))
    return got.where((F.col("p.lang_pred") != "und") & (F.col("p.cover") > min_cover)).select("doc.*")
