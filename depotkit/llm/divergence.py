"""How far the sources of a language differ in their terms, with every distinct text tokenised once."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from depotkit.llm.common import written

#: A term: ASCII letters and every character from U+0080 on; in UTF-8, bytes of 0x80 and more.
TERM = re.compile(rb"[A-Za-z\x80-\xFF]+")
SCALE, PRIOR = 1_000_000_000, 5
#: Term counts a worker holds, sources on a side of a block of pair sums, and blocks it holds.
HELD_TERMS, BLOCK, HELD_BLOCKS = 300_000, 256, 128


def collapse(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(lang, source, ix) of all groups, numbered in each language, and (lang, sources, text) of the
    distinct texts; ``sources`` lists the numbers of a text's sources with its copies in each.

    Copies fold before they move, and of a group of copies one text moves a task.
    """
    value = lambda c, name: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
    rows = docs.select(value(lang, "lang"), value(source, "source"), value(text, "text"))
    rows = rows.withColumn("key", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    copies = written(rows.groupBy("lang", "key", "source").agg(F.count("*").alias("copies")), "copies")
    groups = copies.select("lang", "source").distinct()
    groups = written(groups.withColumn("ix", F.row_number().over(W.partitionBy("lang").orderBy("source")).cast("long") - 1), "groups")
    lists = copies.join(groups, ["lang", "source"]).groupBy("lang", "key").agg(F.collect_list(F.struct("ix", "copies")).alias("sources"))
    texts = rows.groupBy("lang", "key").agg(F.first("text").alias("text"))
    return groups, texts.join(lists, ["lang", "key"]).select("lang", "sources", "text")


def term_counts(texts: DataFrame) -> DataFrame:
    """(lang, term, docs, n, found): documents with a term and its occurrences, copies counted each;
    ``found`` lists them by source. A task sends one row a source and term it meets, so that no term
    has more rows than others by its frequency, and one shuffle by term does."""

    def run(batches):
        held, size = defaultdict(dict), 0

        def flush():
            for (lang, ix), terms in held.items():
                sums = np.array(list(terms.values()), np.int64).reshape(-1, 2)
                names = pa.array(list(terms), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array(np.full(len(terms), ix, np.int64)), names, pa.array(sums[:, 0]), pa.array(sums[:, 1])],
                    ["lang", "ix", "term", "docs", "n"])

        for batch in batches:
            for lang, sources, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                own: dict[bytes, int] = {}
                for term in TERM.findall(text.as_py().lower()):
                    own[term] = own.get(term, 0) + 1
                for entry in sources:
                    terms, copies = held[lang, entry["ix"]], entry["copies"]
                    size -= len(terms)
                    for term, n in own.items():
                        sums = terms.get(term)
                        if sums is None:
                            terms[term] = [copies, n * copies]
                        else:
                            sums[0] += copies
                            sums[1] += n * copies
                    size += len(terms)
                    if size > HELD_TERMS:
                        yield from flush()
                        held, size = defaultdict(dict), 0
        yield from flush()

    made = texts.mapInArrow(run, "lang string, ix long, term string, docs long, n long")
    summed = made.repartition("lang", "term").groupBy("lang", "term", "ix").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))
    return summed.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("ix", "docs", "n")).alias("found"))


def _p(n: str, total: str, kept: str) -> Column:
    """The smoothed share of a count, in billionths, in whole numbers of up to 38 digits."""
    share = f"cast({SCALE} as decimal(10,0)) * cast({n} + {PRIOR} as decimal(20,0)) div cast({total} + {PRIOR} * {kept} as decimal(20,0))"
    return F.expr(f"case when {kept} > 0 then 1 + {share} else 0 end").cast("long")


def _both(present: DataFrame) -> DataFrame:
    """(lang, a, b, value) with a < b, over the terms that both have: what their true difference is
    more than the sum that takes the other's share as that of an absent term."""

    def run(batches):
        held: dict[tuple, np.ndarray] = {}

        def flush():
            for (lang, i, j), block in held.items():
                a, b = np.nonzero(block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(a), pa.string()), pa.array(a + i * BLOCK, pa.int64()), pa.array(b + j * BLOCK, pa.int64()), pa.array(block[a, b])],
                    ["lang", "a", "b", "value"])

        for batch in batches:
            lists, fields = batch.column(1), batch.column(1).flatten()
            ix, p, none = (fields.field(c).to_numpy(zero_copy_only=False) for c in ("ix", "p", "p0"))
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)).tolist()
            start = 0
            for lang, end in zip(batch.column(0).to_pylist(), ends):
                order = np.argsort(ix[start:end]) + start
                start = end
                of = ix[order] // BLOCK
                for i in np.unique(of).tolist():
                    for j in np.unique(of[of >= i]).tolist():
                        x, y = order[of == i], order[of == j]
                        px, py, nx, ny = p[x][:, None], p[y], none[x][:, None], none[y]
                        part = abs(px - py) - abs(px - ny) - abs(py - nx) + abs(nx - ny)
                        block = held.get((lang, i, j))
                        if block is None:
                            if len(held) >= HELD_BLOCKS:
                                yield from flush()
                                held = {}
                            block = held[lang, i, j] = np.zeros((BLOCK, BLOCK), np.int64)
                        block[(ix[x] % BLOCK)[:, None], ix[y] % BLOCK] += np.triu(part, 1) if i == j else part
        yield from flush()

    lists = present.groupBy("lang", "term").agg(F.collect_list(F.struct("ix", "p", "p0")).alias("found"))
    made = lists.select("lang", "found").mapInArrow(run, "lang string, a long, b long, value long")
    return made.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def _alone(present: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, own, base) of every two sources: ``own``, the sum over a's terms of how much more
    they differ from b's share of an absent term than a's share of one does; ``base``, that difference
    times the kept terms. A source's terms come as their distinct shares with a count of each."""
    shares = present.groupBy("lang", "ix", "p").agg(F.count("*").alias("m"))
    shares = shares.groupBy("lang", "ix").agg(F.collect_list(F.struct("p", "m")).alias("shares"))
    others = groups.groupBy("lang").agg(F.collect_list(F.struct("ix", "p0")).alias("others"))
    sides = groups.select("lang", "ix", "p0", "kept").join(shares, ["lang", "ix"], "left").join(others, "lang")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                b, q = (np.array([o[c] for o in row["others"]], np.int64) for c in ("ix", "p0"))
                p, m = (np.array([s[c] for s in row["shares"] or []], np.int64) for c in ("p", "m"))
                order = np.argsort(p)
                p, m = p[order], m[order]
                n, total = (np.concatenate([[0], np.cumsum(x)]) for x in (m, m * p))
                at = np.searchsorted(p, q)
                apart = (q * n[at] - total[at]) + (total[-1] - total[at]) - q * (n[-1] - n[at])
                gap = abs(q - row["p0"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(b), pa.string()), pa.array(np.full(len(b), row["ix"], np.int64)), pa.array(b), pa.array(apart - n[-1] * gap), pa.array(row["kept"] * gap)],
                    ["lang", "a", "b", "own", "base"])

    made = sides.select("lang", "ix", "p0", "kept", "shares", "others").mapInArrow(run, "lang string, a long, b long, own long, base long")
    return made.filter("a != b")


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) of every two sources of a language and of each source's
    most marked terms.

    Equal texts of a language are folded with their copies in each source and tokenised once. A
    language keeps the terms in at least ``min_docs`` of its documents; a source's share of a term is
    smoothed over them and held in billionths. Part ``pair`` ranks the other sources by the sum of
    absolute differences of shares; part ``term`` the ``top`` terms by how far the source's share is
    above its language's.

    Pair sums are taken sparsely: a source's terms against the other's share of an absent term come
    from its distinct shares, and only terms that both have are looked at one by one, summed in blocks
    of sources inside the task. What grows with the square of the sources is the result itself.

    Null text, lang and source count as ''. A source without terms has a row for each other source; a
    language with one source has no pairs; one without kept terms has values of 0. Repeated rows count
    each. An empty table gives an empty result.
    """
    groups, texts = collapse(docs, text, lang, source)
    kept = written(term_counts(texts).filter(F.col("docs") >= min_docs), "kept")
    found = kept.select("lang", "term", F.col("n").alias("of_lang"), F.explode("found").alias("one")).select("lang", "term", "of_lang", "one.ix", "one.n")
    sums = found.groupBy("lang", "ix").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    groups = groups.join(sums, ["lang", "ix"], "left").join(langs, "lang", "left")
    groups = groups.fillna(0, ["total", "kept", "lang_total"]).withColumn("none", F.lit(0))
    groups = written(groups.withColumn("p0", _p("none", "total", "kept")), "sums")

    present = found.join(groups, ["lang", "ix"])
    present = written(present.select("lang", "source", "ix", "term", "p0", _p("n", "total", "kept").alias("p"), _p("of_lang", "lang_total", "kept").alias("q")), "present")
    alone, both = written(_alone(present, groups), "alone"), written(_both(present), "both")
    parts = alone.select("lang", "a", "b", (F.col("own") + F.col("base")).alias("value"))
    for more in (alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), F.col("own").alias("value")), both, both.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value")):
        parts = parts.unionByName(more)
    name = groups.select("lang", "ix", "source")
    pairs = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = pairs.join(name.withColumnRenamed("ix", "a"), ["lang", "a"]).join(name.select("lang", F.col("ix").alias("b"), F.col("source").alias("item")), ["lang", "b"])
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    terms = present.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.filter("value > 0").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return pairs.unionByName(terms)


def op13_query(spark, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
with d as (select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as terms from documents),
w as (select id, lang, source, unnest(terms) as term from d),
kept as (select lang, term from w group by all having count(distinct id) >= 30),
n as (select lang, source, term, count(*)::hugeint as n from w semi join kept using (lang, term) group by all),
v as (select lang, count(*)::hugeint as v from kept group by all),
g as (select g.lang, g.source, coalesce(v, 0) as v, coalesce((select sum(n) from n where n.lang = g.lang and n.source = g.source), 0)::hugeint as total
  from (select distinct lang, source from d) g left join v using (lang)),
p as (select g.lang, g.source, kept.term, coalesce(n.n, 0) as n, 1 + 1000000000 * (coalesce(n.n, 0) + 5) // (g.total + 5 * g.v) as p
  from g join kept using (lang) left join n on n.lang = g.lang and n.source = g.source and n.term = kept.term),
q as (select lang, term, 1 + 1000000000 * (c + 5) // (sum(c) over (partition by lang) + 5 * count(*) over (partition by lang)) as q
  from (select lang, term, sum(n)::hugeint as c from n group by all)),
s as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from p a join p b using (lang, term) where a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join s on s.lang = a.lang and s.source = a.source and s.item = b.source),
marked as (select lang, source, 'term' as part, term as item, p - q as value from p join q using (lang, term) where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (from pairs union all from marked))
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= 50
"""
