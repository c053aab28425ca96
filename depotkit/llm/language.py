"""Language of a text: known words by their frequency, unseen ones by ever shorter character n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotkit.llm.common import written

#: What parts words; a word is a run of letters.
NO_LETTERS = r"\P{L}+"
LONGEST = 5
#: Bounds of the model that is sent to every task: languages, words of each, n-grams of each length.
LANGUAGES, WORDS, GRAMS = 32, 10_000, 3_000
#: Labelled texts of each language that the model is fitted on, about; chosen by hash.
SAMPLE_DOCS = 10_000
#: Words whose scores a worker keeps from one block of texts to the next, and characters of a block.
KEPT_WORDS, BLOCK_CHARS = 100_000, 2_000_000
#: What an entry is taken to occur in a language where it was not seen.
UNSEEN = 0.5
#: Longest word that is looked at as a whole; longer runs of letters are cut into pieces of this size.
WORD_CHARS = 64


def word_lists(texts: pa.Array) -> pa.ListArray:
    """The lower-cased words of each text, among empty ones where a text begins or ends without a letter."""
    return pc.split_pattern_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")), NO_LETTERS)


def blocks(batch: pa.RecordBatch, text: str):
    """Slices of a batch of about BLOCK_CHARS bytes of text, of one text at least."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(upto, (upto[start - 1] if start else 0) + BLOCK_CHARS)) + 1
        yield batch.slice(start, end - start)
        start = end


def pieces(word: str) -> list[str]:
    """A word, or its parts of WORD_CHARS."""
    return [word[i:i + WORD_CHARS] for i in range(0, len(word), WORD_CHARS)]


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word between marks of its ends."""
    marked = f"<{word}>"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


def _entries(sample: DataFrame) -> DataFrame:
    """(lang, size, entry, n): words as size 0, n-grams by their length."""

    def words(batches):
        for batch in batches:
            for lang in batch.column("lang").unique().to_pylist():
                mine = batch.filter(pc.equal(batch.column("lang"), lang))
                for block in blocks(mine, "text"):
                    counts = pc.value_counts(word_lists(block.column("text")).flatten())
                    found = [(p, n) for w, n in zip(counts.field("values").to_pylist(), counts.field("counts").to_pylist()) for p in pieces(w)]
                    entries, n = zip(*found) if found else ((), ())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(entries, pa.string()), pa.array(n, pa.int64())], ["lang", "entry", "n"])

    counted = sample.mapInArrow(words, "lang string, entry string, n long").groupBy("lang", "entry").agg(F.sum("n").alias("n"))
    counted = written(counted, "words")

    def parts(batches):
        for batch in batches:
            found: dict[tuple, int] = {}
            for lang, word, n in zip(*[c.to_pylist() for c in batch.columns]):
                for size in range(1, LONGEST + 1):
                    for g in grams(word, size):
                        found[lang, size, g] = found.get((lang, size, g), 0) + n
            langs, sizes, entries = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(entries, pa.string()), pa.array(list(found.values()), pa.int64())],
                ["lang", "size", "entry", "n"])

    shorter = counted.mapInArrow(parts, "lang string, size int, entry string, n long").groupBy("lang", "size", "entry").agg(F.sum("n").alias("n"))
    return counted.select("lang", F.lit(0).alias("size"), "entry", "n").unionByName(shorter)


class Model:
    """Log frequencies of words and n-grams in each language.

    ``table`` holds, for each entry and language, the log of its share among the entries of its size
    there; ``words`` and ``parts`` name its rows. ``langs`` are in the order of their documents, most
    first, then by name.
    """

    def __init__(self, langs: list[str], words: dict[str, int], parts: dict[str, int], table: np.ndarray):
        self.langs, self.words, self.parts, self.table = langs, words, parts, table
        self._forget()

    def _forget(self) -> None:
        self._rows: dict[str, int] = {"": 0}
        self._scores = np.zeros((1024, len(self.langs)))

    def _known(self, word: str) -> list[int]:
        """The rows of a word: its own, or those of its known n-grams of the longest size that has any."""
        at = self.words.get(word)
        if at is not None:
            return [at]
        known = self.parts
        for size in range(LONGEST, 0, -1):
            rows = [known[g] for g in grams(word, size) if g in known]
            if rows:
                return rows
        return []

    def score_words(self, words: list[str]) -> np.ndarray:
        """A known word's log frequencies; else the mean over its known n-grams of the longest size
        that has any; zero if none is known. Longer words than WORD_CHARS are the sum of their pieces."""
        rows = [self._known(w) if len(w) <= WORD_CHARS else [] for w in words]
        sizes = np.array([len(r) for r in rows], np.int64)
        out = np.zeros((len(words), len(self.langs)))
        flat = np.array([row for r in rows for row in r], np.int64)
        if len(flat):
            known = sizes > 0
            out[known] = np.add.reduceat(self.table[flat], (np.cumsum(sizes) - sizes)[known], axis=0) / sizes[known][:, None]
        for i, word in enumerate(words):
            if len(word) > WORD_CHARS:
                out[i] = self.score_words(pieces(word)).sum(axis=0)
        return out

    def _rows_of(self, words: list[str]) -> np.ndarray:
        """Where the scores of these words are kept; row 0 is that of no word."""
        if len(self._rows) > KEPT_WORDS:
            self._forget()
        fresh = [w for w in words if w not in self._rows]
        first = len(self._rows)
        while len(self._scores) < first + len(fresh):
            self._scores = np.concatenate([self._scores, np.zeros_like(self._scores)])
        self._scores[first:first + len(fresh)] = self.score_words(fresh)
        self._rows.update(zip(fresh, range(first, first + len(fresh))))
        return np.array([self._rows[w] for w in words], np.int64)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The language of each text and its share of the likelihood, all languages weighed alike.
        Each distinct word of the texts is looked up once."""
        if not self.langs or not len(texts):
            return ["und"] * len(texts), np.zeros(len(texts))
        lists = word_lists(texts)
        words = lists.flatten().dictionary_encode()
        rows = self._rows_of(words.dictionary.to_pylist())[words.indices.to_numpy()]
        starts = (lists.offsets.to_numpy() - lists.offsets[0].as_py())[:-1]
        total = np.add.reduceat(self._scores[rows], starts, axis=0)
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        some = np.add.reduceat((rows > 0).astype(np.int64), starts) > 0
        return [self.langs[b] if s else "und" for b, s in zip(best.tolist(), some.tolist())], np.where(some, share, 0.0)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model of the rows with a language; none of them gives a model that knows no language.

    Of each language about ``sample_docs`` rows are used, chosen by a hash of the text; equal texts
    of a language count once. The LANGUAGES with the most rows are learned; of each the WORDS most
    frequent words and the GRAMS most frequent n-grams of each length up to LONGEST. That is the bound
    of what the driver gets and broadcasts.
    """
    rows = labelled.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")).filter("lang is not null")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()
    if not sizes:
        return Model([], {}, {}, np.zeros((0, 0)))
    share = F.lit(None).cast("double")
    for row in sizes:
        share = F.when(F.col("lang") == row["lang"], sample_docs / row["n"]).otherwise(share)
    chosen = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share * (1 << 20)
    entries = written(_entries(rows.filter(chosen).distinct()), "entries")
    totals = entries.groupBy("lang", "size").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    first = W.partitionBy("lang", "size").orderBy(F.desc("n"), "entry")
    top = entries.withColumn("place", F.row_number().over(first)).filter(
        ((F.col("size") == 0) & (F.col("place") <= WORDS)) | ((F.col("size") > 0) & (F.col("place") <= GRAMS)))
    top = top.join(totals, ["lang", "size"]).select("lang", "size", "entry", "n", "total", "kinds").toPandas()
    langs = [row["lang"] for row in sizes]
    which = top["lang"].map({name: i for i, name in enumerate(langs)}).to_numpy()
    size, n = top["size"].to_numpy(), top["n"].to_numpy()
    all_of, kinds = np.zeros((LONGEST + 1, len(langs))), np.ones((LONGEST + 1, len(langs)))
    all_of[size, which], kinds[size, which] = top["total"], top["kinds"]
    rest = np.log(UNSEEN / (all_of + UNSEEN * (kinds + 1)))
    rows_of: dict[tuple, int] = {}
    at = np.array([rows_of.setdefault(key, len(rows_of)) for key in zip(size.tolist(), top["entry"])], np.int64)
    table = np.zeros((len(rows_of), len(langs)))
    for (s, _), row in rows_of.items():
        table[row] = rest[s]
    table[at, which] = np.log((n + UNSEEN) / (all_of[size, which] + UNSEEN * (kinds[size, which] + 1)))
    words = {entry: row for (s, entry), row in rows_of.items() if s == 0}
    return Model(langs, words, {entry: row for (s, entry), row in rows_of.items() if s}, table)


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of every row (all but the text, if not given), then lang_pred and score.

    ``und`` and 0 if the text is null or has no letter, or if no language was learned. A text of which
    no letter is known gets the language with the most labelled rows at the share of a guess.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    kept = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("kept")
    rows = docs.select(kept, F.col(f"`{text}`").cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.words, model.parts, model.table))

    def run(batches):
        mine = Model(*shared.value)
        for batch in batches:
            for block in blocks(batch, "text"):
                langs, scores = mine.predict(block.column("text"))
                yield pa.RecordBatch.from_arrays([block.column("kept"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["kept", "lang_pred", "score"])

    out = T.StructType([rows.schema["kept"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, out).select(*[F.col(f"kept.`{c}`").alias(c) for c in keep], "lang_pred", "score")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the documents that a model must not learn from; rows without an id are learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op12_query(spark, sf_dir: str) -> DataFrame:
    """The predicted language of all documents, learned from three quarters of them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = fit(docs.filter(~held_out()))
    found = identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
