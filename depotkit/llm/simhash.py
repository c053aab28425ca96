"""SimHash near-dedup: fingerprints, links by covering bit masks, connected groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotkit.llm.common import written

BITS = 64
SEED = 42
#: Distinct fingerprints in a bucket that are compared pair by pair; larger buckets go another way.
BUCKET = 64
BLOCK = 1 << 16


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The signed 64-bit fingerprint of a whole text. Bytes are lower-cased and split as ASCII."""
    from xxhash import xxh64_digest

    found = (text or "").encode().lower().split()
    if not found:
        return 0
    if len(found) < shingle:
        pieces = [b" ".join(found)]
    else:
        pieces = map(b" ".join, zip(*(found[i:] for i in range(shingle)), strict=False))
    digests = b"".join([xxh64_digest(piece, SEED) for piece in pieces])
    hashes = np.frombuffer(digests, np.uint8).reshape(-1, BITS // 8)
    ones = sum(np.unpackbits(hashes[a:a + BLOCK], axis=1).sum(axis=0, dtype=np.int64) for a in range(0, len(hashes), BLOCK))
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def content(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, content, fp) of every row; content is a hash of the text."""

    def run(batches):
        for batch in batches:
            fps = [fingerprint_of(t.as_py(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["doc_id", "content", "fp"])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), content(text).alias("content"), F.col(text).alias("text"))
    return own.mapInArrow(run, "doc_id long, content long, fp long")


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 masks over 64 bits; any ``radius`` bits are left out by one of them.

    Bit i gets a nonzero vector of radius+1 bits; mask v keeps the bits whose vector has an odd
    number of bits in common with v. ``radius`` equations always leave such a v over.
    """
    top = 1 << (radius + 1)
    vectors = [i % (top - 1) + 1 for i in range(BITS)]
    masks = [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, top)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def near_links(nodes: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """(a, b) with a < b: links whose connected groups are those of all pairs within ``radius``.

    ``nodes`` has distinct fingerprints ``fp``. Each goes to one bucket per mask. Buckets of up to
    ``bucket`` fingerprints are compared inside. Fingerprints of larger buckets are linked through
    their neighbourhoods instead: two are within radius 2 exactly if they share a value one bit
    away at most, and at most 65 fingerprints share one; all of those are within radius 2 of each
    other, so links to the smallest keep them connected. Every link is a pair within the radius.
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    keyed = F.array(*[F.struct(F.lit(n).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for n, m in enumerate(covering_masks(radius))])
    dealt = nodes.select("fp", F.explode(keyed).alias("k")).select("fp", "k.mask", "k.key")
    sizes = dealt.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1")
    held = written(dealt.join(sizes, ["mask", "key"]), "buckets")
    small = held.filter(F.col("n") <= bucket).groupBy("mask", "key").agg(F.sort_array(F.collect_list("fp")).alias("g"))
    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= radius
    inside = F.flatten(F.transform("g", lambda x, i: F.transform(
        F.filter(F.slice("g", i + 2, F.size("g")), lambda y: near(x, y)),
        lambda y: F.struct(x.alias("a"), y.alias("b")))))
    links = small.select(F.explode(inside).alias("p")).select("p.a", "p.b")
    hot = held.filter(F.col("n") > bucket).select("fp").distinct()
    flips = [F.col("fp")] + [F.col("fp").bitwiseXOR(F.lit((1 << i) if i < BITS - 1 else -(1 << i))) for i in range(BITS)]
    around = hot.select("fp", F.explode(F.array(*flips)).alias("z")).groupBy("z").agg(F.sort_array(F.collect_set("fp")).alias("g"))
    around = around.filter(F.size("g") > 1)
    if radius == 2:
        stars = around.select(F.col("g")[0].alias("a"), F.explode(F.slice("g", 2, BITS)).alias("b"))
    else:
        stars = around.select(F.explode(inside).alias("p")).select("p.a", "p.b")
    return links.unionByName(stars).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected group, for nodes with a link.

    Alternating large and small stars: every node passes the smallest of its neighbourhood on to
    its larger neighbours, then to its smaller ones, until nothing changes. Each round is a table.
    """
    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = written(small.filter("a != b").distinct(), "stars")
        now = state(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def simhash_groups(
    docs: DataFrame, shingle: int = 3, radius: int = 2, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """(doc_id, content, fp, component_id) for every row: its fingerprint and the smallest doc_id that links
    of at most ``radius`` differing bits reach from it.

    Texts are taken whole; a null or blank text has fingerprint zero and is linked like any other.
    Copies share a fingerprint and are folded before any comparison. Repeated rows each get their
    row. A null doc_id never names a group unless the group has no other. Empty in, empty out.
    """
    marked = written(fingerprints(docs, shingle, text, doc_id), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = written(components(near_links(nodes.select("fp"), radius)), "roots")
    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp")
    named = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_linked = written(linked.join(named, "root").select("fp", "component_id"), "components")
    owner = nodes.join(of_linked, "fp", "left").select("fp", F.coalesce("component_id", "first_id").alias("component_id"))
    return marked.join(owner, "fp").select("doc_id", "content", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One document of each group, that with the smallest doc_id, with the columns it came with.

    Rows that repeat both doc_id and text are one document and stay together; of groups without
    any doc_id all rows stay, as nothing names one of them.
    """
    groups = simhash_groups(docs, shingle, radius)
    gone = groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "content").distinct()
    gone = written(gone, "near-copies").alias("g")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (content("d.text") == F.col("g.content"))
    return docs.alias("d").join(gone, same, "left_anti")


def op10_query(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return simhash_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
