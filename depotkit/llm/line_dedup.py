"""Line dedup by the share of a host's pages that carry a line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depotkit.llm.common import SPACE, key128, let, written


def _key(line):
    return key128(F.btrim(line, F.lit(SPACE)))


def boilerplate(pages: DataFrame, text: str, host: str, max_ratio: float, min_pages: int) -> DataFrame:
    """(host, lines): keys of lines on more than ``max_ratio`` of the host's pages, and on at least
    ``min_pages`` of them. A host has fewer than (mean lines per page) / max_ratio such lines."""
    body = F.split(F.coalesce(F.col(text), F.lit("")), "\n")
    keys = F.array_distinct(F.transform(F.filter(body, lambda line: F.btrim(line, F.lit(SPACE)) != ""), _key))
    own = pages.select(F.col(host).alias("host"), keys.alias("keys"))
    totals = written(pages.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("pages")), "host-pages")
    counted = (
        own.select("host", F.explode("keys").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_pages)
    )
    over = counted.alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
    over = over.filter(F.col("n") / F.col("pages") > max_ratio)
    return written(over.groupBy("c.host").agg(F.collect_list("line").alias("lines")), "boilerplate")


def _members(own: DataFrame, bad: DataFrame) -> DataFrame:
    """(host, spared): marks of the pages that keep the lines of a group of near copies."""
    pages = own.alias("p").join(bad.alias("b"), F.col("p.host").eqNullSafe(F.col("b.host")))
    every = F.filter(F.split(F.col("body"), "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")
    chars = lambda lines: F.aggregate(lines, F.lit(0).cast("long"), lambda a, x: a + F.length(F.btrim(x, F.lit(SPACE))))
    shared = F.filter(every, lambda x: F.array_contains(F.col("lines"), _key(x)))
    found = pages.select(F.col("p.host").alias("host"), "mark", let(shared, lambda x: F.struct(
        F.array_distinct(F.transform(x, _key)).alias("keys"), chars(x).alias("chars"), (F.size(x) == F.size(every)).alias("whole"))).alias("x"),
        chars(every).alias("chars")).filter(F.size("x.keys") > 0)
    # a page of nothing else stays anyway and comes first
    first = F.struct(~F.col("x.whole"), "mark")
    carried = found.select("host", first.alias("first"), (F.col("x.chars") * 2 > F.col("chars")).alias("mostly"), F.explode("x.keys").alias("line"))
    lost = carried.groupBy("host", "line").agg(
        F.count("*").alias("n"), F.count_if("mostly").alias("alike"), F.min(F.when(F.col("mostly"), F.col("first"))).alias("first"))
    return written(lost.filter("alike * 2 > n").groupBy("host").agg(F.collect_set("first.mark").alias("spared")), "spared-pages")


def site_line_dedup(
    pages: DataFrame, text: str = "text", host: str = "source", max_ratio: float = 0.1, min_pages: int = 5,
    spare_whole: bool = True, spare_one: str | None = None,
) -> DataFrame:
    """Each page without its host's boilerplate lines: ``row`` (all input columns as a struct),
    clean (the text that stays), n_lines, n_dropped.

    With ``spare_whole`` a page made of nothing but such lines keeps them all: it is one of many
    copies of a page rather than a page with boilerplate, and emptying every copy would lose it.

    ``spare_one`` names the id column: a line whose pages mostly have more than half of their text in
    such lines belongs to a group of near copies, and the page of the smallest id among these keeps all.

    Lines are compared without outer white space; blank lines always stay. A page counts once for
    a line however often it has it; repeated rows are pages of their own. Null texts stay null and
    hold no line. Null hosts form one host; an empty table gives an empty result.
    """
    bad = boilerplate(pages, text, host, max_ratio, min_pages)
    own = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
                       F.col(host).alias("host"), F.col(text).alias("body"))
    spared = F.lit(False)
    if spare_one is not None:
        own = own.withColumn("mark", F.struct(F.col("row")[spare_one].alias("id"), key128(F.col("body")).alias("content")))
        members = _members(own, bad)
        own = own.alias("o").join(members.alias("m"), F.col("o.host").eqNullSafe(F.col("m.host")), "left").select("o.*", "m.spared")
        spared = F.coalesce(F.array_contains("spared", F.col("mark")), F.lit(False))
    own = own.alias("p").join(bad.alias("b"), F.col("p.host").eqNullSafe(F.col("b.host")), "left")
    lines = F.split(F.col("body"), "\n")
    blank = lambda x: F.btrim(x, F.lit(SPACE)) == ""
    good = lambda every: F.filter(every, lambda x: blank(x) | ~F.array_contains(F.col("lines"), _key(x)))
    whole = lambda x: F.lit(spare_whole) & ~F.exists(x, lambda line: ~blank(line))
    as_came = F.struct(F.col("body").alias("clean"), F.lit(0).alias("gone"))
    cut = lambda every, x: F.struct(F.array_join(x, "\n").alias("clean"), (F.size(every) - F.size(x)).alias("gone"))
    kept = F.when(F.col("lines").isNull() | F.col("body").isNull() | spared, as_came).otherwise(
        let(lines, lambda every: let(good(every), lambda x: F.when(whole(x), as_came).otherwise(cut(every, x)))))
    n_lines = F.when(F.col("body").isNull(), 0).otherwise(F.size(lines)).cast("long")
    return own.select("row", n_lines.alias("n_lines"), kept.alias("kept")).select(
        "row", F.col("kept.clean").alias("clean"), "n_lines", F.col("kept.gone").cast("long").alias("n_dropped"))


def drop_lines(docs: DataFrame, spare_one: str = "doc_id", **settings) -> DataFrame:
    """The documents with cleaned texts and their new lengths; other columns as they came. One
    member of a group of near copies keeps its lines."""
    done = site_line_dedup(docs, spare_one=spare_one, **settings)
    renewed = {"text": F.col("clean"), "n_chars": F.length("clean").cast("long")}
    return done.select(*[renewed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


OP5_SQL = r"""
with p as (select row_number() over () as r, doc_id, source, text from documents),
l as (select r, source, unnest(string_split(text, chr(10))) as line,
             unnest(range(len(string_split(text, chr(10))))) as i from p),
k as (select *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as key from l),
per as (select source, key, count(distinct r) as n from k where key <> '' group by source, key),
hosts as (select source, count(*) as pages from p group by source),
bad as (select per.source, per.key from per join hosts on per.source is not distinct from hosts.source
        where n >= 5 and n::double / pages > 0.1e0),
m as (select k.*, bad.key is not null as gone
      from k left join bad on k.source is not distinct from bad.source and k.key = bad.key),
w as (select *, bool_and(gone or key = '') over (partition by r) as whole from m),
t as (select r, count(*) as n_lines, count(*) filter (gone and not whole) as n_dropped,
             string_agg(line, chr(10) order by i) filter (whole or not gone) as clean from w group by r)
select doc_id, clean, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped
from p left join t on p.r = t.r
"""


def op5_query(spark, sf_dir: str) -> DataFrame:
    """All documents without the boilerplate lines of their source."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return site_line_dedup(docs).select("row.doc_id", "clean", "n_lines", "n_dropped")
