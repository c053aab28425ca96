"""Importance resampling towards a target: hashed n-gram features, bucket gains, a Gumbel top-k draw."""

from __future__ import annotations

import hashlib
import math
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depotkit.llm.common import written
from depotkit.operators.ordering import row_index

#: A word: ASCII letters and digits, and every character from U+0080 on.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
MAX_RUN = 3
#: Bytes of bucket numbers that a worker holds before it hands them on.
HELD_BYTES = 8_000_000


def splitter():
    """The untrained pre-tokeniser: words with their offsets, what stands between them removed."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def run_buckets(words: list[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every run of 1 to MAX_RUN words.

    A window is the pair of offsets of its first and last word in the words joined by one blank. Its
    CRC goes on from the CRC of the window that ends one word earlier.
    """
    n, tails = len(words), [b" " + w for w in words]
    out = [np.fromiter(map(crc32, words), np.uint32, n)]
    for size in range(2, min(MAX_RUN, n) + 1):
        out.append(np.fromiter(map(crc32, tails[size - 1:], out[-1].tolist()), np.uint32, n - size + 1))
    return (np.concatenate(out) % buckets).astype("<u2")


def _features(docs: DataFrame, text: str, keep: list[str], buckets: int) -> DataFrame:
    """(kept, n_words, buckets): every text's bucket numbers, two bytes each."""
    row = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep]).alias("kept")
    rows = docs.select(row, F.col(f"`{text}`").cast("string").alias("text"))
    out = T.StructType([rows.schema["kept"], T.StructField("n_words", T.LongType()), T.StructField("buckets", T.BinaryType())])

    def run(batches):
        split = splitter().pre_tokenize_str
        for batch in batches:
            at, n_words, found, size = 0, [], [], 0
            for i, raw in enumerate(batch.column("text").cast(pa.binary())):
                pieces = split((raw.as_py() or b"").lower().decode())
                words = " ".join([w for w, _ in pieces]).encode().split(b" ") if pieces else []
                n_words.append(len(words))
                found.append(run_buckets(words, buckets).tobytes())
                size += len(found[-1])
                if size >= HELD_BYTES or i + 1 == batch.num_rows:
                    kept = batch.column("kept").slice(at, i + 1 - at)
                    yield pa.RecordBatch.from_arrays([kept, pa.array(n_words, pa.int64()), pa.array(found, pa.binary())], ["kept", "n_words", "buckets"])
                    at, n_words, found, size = i + 1, [], [], 0

    return rows.mapInArrow(run, out)


def _histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs: tasks send one count a bucket, the driver gets ``buckets`` numbers."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for item in batch.column(0):
                total += np.bincount(np.frombuffer(item.as_py(), "<u2"), minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(total[hit])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in features.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The smoothed log ratio of target to corpus in each bucket, in thousandths, rounded down."""
    of_corpus, of_target = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array(
        [math.floor(1000 * math.log((t + 1) * of_corpus / ((s + 1) * of_target))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id, seed: int) -> int:
    """Gumbel noise of a document in thousandths, from a hash of the seed and its id ("null" without one)."""
    name = "null" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    share_percent: int = 5,
    min_words: int = 20,
    seed: int = 42,
    buckets: int = BUCKETS,
    text: str = "text",
    doc_id: str = "doc_id",
    target_text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """Every document: the columns ``keep`` (its id, if not given), then n_words, n_features, weight,
    score and rank.

    Features are runs of one to three words. weight is the sum of the gains of its features' buckets,
    score adds the noise of its id; ``rank`` counts from 1 in the order of scores among those drawn:
    ``share_percent`` of the documents with at least ``min_words`` words, highest scores first, ties
    to the smaller id. Others have no rank.

    Bucket numbers are made in one pass and written (two bytes a feature); the histogram and the
    weights read them back. What is sent to the driver and from there to all tasks is one number a
    bucket. Ranks come from a range partitioning, so no task orders all documents.

    Null and empty texts have no features and weight 0. Documents without an id share their noise and
    stand behind those with one. Repeated rows are documents of their own. An empty table gives an
    empty result; without target texts every gain is that of an empty target.
    """
    if buckets > 65536:
        raise ValueError("buckets are stored in two bytes")
    keep = [doc_id] if keep is None else keep
    made = written(_features(docs, text, [doc_id, *[c for c in keep if c != doc_id]], buckets), "features")
    gains = bucket_gains(_histogram(made, buckets), _histogram(_features(target, target_text, [], buckets), buckets))

    def run(batches):
        for batch in batches:
            ids = batch.column("kept").field(doc_id).to_pylist()
            found = [np.frombuffer(item.as_py(), "<u2") for item in batch.column("buckets")]
            weight = np.array([int(gains[b].sum()) for b in found], np.int64)
            score = weight + np.array([noise(i, seed) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("kept"), batch.column("n_words"), pa.array(np.array([len(b) for b in found], np.int64)), pa.array(weight), pa.array(score)],
                ["kept", "n_words", "n_features", "weight", "score"])

    fields = ("n_words", "n_features", "weight", "score")
    scored = made.mapInArrow(run, T.StructType([made.schema["kept"], *[T.StructField(c, T.LongType()) for c in fields]]))
    scored = written(scored.withColumn("open", F.col("n_words") >= min_words), "scores")
    drawn = scored.filter("open").count() * share_percent // 100
    order = [F.desc("open"), F.desc("score"), F.col(f"kept.`{doc_id}`").asc_nulls_last(), F.asc("n_words"), F.asc("weight")]
    placed = row_index(scored, order, "place")
    rank = F.when(F.col("open") & (F.col("place") < drawn), F.col("place") + 1)
    return placed.select(*[F.col(f"kept.`{c}`").alias(c) for c in keep], *fields, rank.cast("long").alias("rank"))


def op11_query(spark, sf_dir: str) -> DataFrame:
    """A twentieth of all documents, drawn towards the benchmark's texts."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


#: CRC-32 from its polynomial: a table of 256 remainders, then one step a byte.
OP11_SQL = r"""
with t as (select row_number() over () as id, doc_id, 'd' as kind, text from documents
  union all select row_number() over () as id, null, 'b', text from benchmark),
w as (select kind, id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from t),
f as (select kind, id, unnest(list_concat(words,
  list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]),
  list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))) as feature from w),
counted as (select kind, id, feature, count(*) as n from f group by all),
rule as (select list(list_reduce([i::ubigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384::ubigint)) order by i) as r from range(256) x(i)),
hashed as (select feature, (xor(list_reduce(list_concat([4294967295::ubigint],
    list_transform(range(1, strlen(feature) + 1), lambda k: ('0x' || substr(hex(encode(feature)), 2 * k - 1, 2))::ubigint)),
    lambda c, b: xor(c >> 8, r[((xor(c, b) & 255) + 1)::bigint])), 4294967295::ubigint) % 10000)::bigint as bucket
  from (select distinct feature from counted), rule),
buckets as (select bucket, sum(n) filter (kind = 'd') as s, sum(n) filter (kind = 'b') as t from counted join hashed using (feature) group by bucket),
sums as (select sum(s) as s_all, sum(t) as t_all from buckets),
gains as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * (coalesce(s_all, 0) + 10000)::double
  / ((coalesce(s, 0) + 1)::double * (coalesce(t_all, 0) + 10000)::double)))::bigint as gain from buckets, sums),
weights as (select id, sum(n) as n_features, sum(n * gain) as weight from counted join hashed using (feature) join gains using (bucket) where kind = 'd' group by id),
scored as (select doc_id, len(words) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
  coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from w left join weights using (id) where kind = 'd'),
placed as (select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last, n_words, weight) as place,
  5 * count(*) filter (n_words >= 20) over () // 100 as drawn from scored)
select doc_id, n_features, weight, score, case when n_words >= 20 and place <= drawn then place end::bigint as rank from placed
"""
