"""Quality rules: counts of one text, and lines that recur across a host's documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotkit.llm.common import SPACE, SPACE_RUN, key128, let, words, written

WINDOW = 8


def _repeated_window_words(found: Column, n: Column) -> Column:
    """Words inside windows of WINDOW words that occur twice or more in the text.

    Windows are compared by a 64-bit hash built by doubling: word, 2, 4, 8 words. Only texts with
    a repeated hash sort their windows; each repeated start covers up to the next one.
    """
    shifted = lambda step: lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step)))

    def covered(windows):
        in_order = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s):
            same = lambda e, k: (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"])
            return F.array_sort(F.transform(F.filter(s, same), lambda e: e["i"]))

        def total(starts):
            spans = F.transform(starts, lambda p, k: F.least(F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
            return F.aggregate(spans, F.lit(0).cast("long"), lambda a, x: a + x)

        repeats = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(repeats, let(let(in_order, repeated), total)).otherwise(F.lit(0).cast("long"))

    eights = let(let(let(F.transform(found, lambda w: F.xxhash64(w)), shifted(1)), shifted(2)), shifted(4))
    return F.when(n > WINDOW, let(F.slice(eights, 1, n - (WINDOW - 1)), covered)).otherwise(F.lit(0).cast("long"))


def _lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")


def _normal(text: Column) -> Column:
    """Lower-case lines without outer white space, inner runs of it as one blank."""
    return F.transform(_lines(F.lower(text)), lambda line: F.regexp_replace(F.btrim(line, F.lit(SPACE)), SPACE_RUN, " "))


def text_counts(text: Column) -> dict[str, Column]:
    """Expressions of the counts of one text, given non-null; ``found`` is its array of words."""
    found = words(text)
    lines = _lines(text)
    return {
        "n_words": F.size(found).cast("long"),
        "word_chars": F.length(F.array_join(found, "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": let(found, lambda w: _repeated_window_words(w, F.size(w))),
    }


def frequent_lines(docs: DataFrame, text: str, host: str, min_docs: int, max_share: float) -> DataFrame:
    """(host, lines): keys of normalised lines in more than ``min_docs`` documents of the host and
    more than ``max_share`` of them. Documents count by content, so exact copies count once.

    A host keeps fewer than (mean lines per document) / max_share keys, whatever its size.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(host).alias("host"), key128(body).alias("content"), body.alias("body"))
    totals = written(own.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("docs")), "host-docs")
    keys = F.array_distinct(F.transform(_normal(F.col("body")), key128))
    counted = (
        own.select("host", "content", F.explode(keys).alias("line")).distinct()
        .groupBy("host", "line").agg(F.count("*").alias("n"))
        .filter(F.col("n") > min_docs)
    )
    over = counted.alias("c").join(totals.alias("t"), F.col("c.host").eqNullSafe(F.col("t.host")))
    over = over.filter(F.col("n") > F.col("docs") * max_share)
    return written(over.groupBy("c.host").agg(F.collect_list("line").alias("lines")), "frequent-lines")


def quality_rules(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    min_words: int = 20,
    max_repeat_percent: int = 30,
    min_docs: int = 10,
    max_share: float = 0.25,
    min_left: float = 0.2,
) -> DataFrame:
    """Counts and the verdict for each document: ``row`` (all input columns as a struct) and
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, words_left, kept.

    A document fails at once with fewer than ``min_words`` words, or with more than
    ``max_repeat_percent`` of them in repeated windows. Of the others, lines above the limits of
    ``frequent_lines`` are taken out; one left with fewer than ``min_words`` words, or less than
    ``min_left`` of them, is depleted and not kept.

    A null text counts as empty and is not kept. Null hosts form one host. Repeated rows are
    judged alike, each for itself; an empty table gives an empty result.
    """
    return _judged(docs, text, host, min_words, max_repeat_percent, min_docs, max_share, min_left).drop("host", "mark", "shared")


def _judged(docs: DataFrame, text: str, host: str, min_words: int, max_repeat_percent: int, min_docs: int, max_share: float,
            min_left: float, doc_id: str | None = None) -> DataFrame:
    """The columns of ``quality_rules`` with host, mark (id and content) and shared (keys of the frequent lines)."""
    frequent = frequent_lines(docs, text, host, min_docs, max_share)
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(host).alias("host"), body.alias("body"))
    own = own.alias("d").join(frequent.alias("f"), F.col("d.host").eqNullSafe(F.col("f.host")), "left")
    normal = _normal(F.col("body"))
    taken = F.aggregate(
        F.filter(normal, lambda line: F.array_contains(F.col("lines"), key128(line))),
        F.lit(0).cast("long"),
        lambda a, line: a + F.size(F.split(line, " ")),
    )
    shared = F.array_intersect(F.transform(normal, key128), F.col("lines"))
    named = F.lit(None).cast("long") if doc_id is None else F.col("row")[doc_id]
    counted = own.select("row", F.col("d.host").alias("host"), F.struct(named.alias("id"), key128(F.col("body")).alias("content")).alias("mark"),
                         shared.alias("shared"), *[c.alias(n) for n, c in text_counts(F.col("body")).items()],
                         F.when(F.col("lines").isNull(), F.lit(0).cast("long")).otherwise(taken).alias("taken"))
    n, left = F.col("n_words"), F.col("n_words") - F.col("taken")
    failed = (n < min_words) | (F.col("n_repeat_words") * 100 > n * max_repeat_percent)
    return counted.select(
        "row", "host", "mark", "shared", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), left.alias("words_left"),
        (~failed & (left >= min_words) & (left >= n * min_left)).alias("kept"),
    )


def drop_rejected(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    min_words: int = 20,
    max_repeat_percent: int = 30,
    min_docs: int = 10,
    max_share: float = 0.25,
    min_left: float = 0.2,
    doc_id: str = "doc_id",
) -> DataFrame:
    """The kept documents, with the columns they came with, and members of groups that would be lost whole.

    A frequent line that no kept document of its host carries would go with the depleted ones. The
    depleted document of the smallest id that carries it stays, so near copies leave one of them.
    """
    judged = _judged(docs, text, host, min_words, max_repeat_percent, min_docs, max_share, min_left, doc_id)
    carried = judged.filter(~F.col("base_failed") & (F.size("shared") > 0)).select("host", "mark", "kept", F.explode("shared").alias("line"))
    lost = carried.groupBy("host", "line").agg(F.max("kept").alias("stays"), F.min("mark").alias("mark")).filter(~F.col("stays"))
    spared = written(lost.groupBy("host").agg(F.collect_set("mark").alias("spared")), "spared-documents")
    both = judged.alias("j").join(spared.alias("s"), F.col("j.host").eqNullSafe(F.col("s.host")), "left")
    stays = F.col("kept") | (~F.col("base_failed") & F.coalesce(F.array_contains("spared", F.col("mark")), F.lit(False)))
    return both.filter(stays).select("row.*")


OP7_SQL = r"""
with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from d),
win as (
  select r, i, array_to_string(ws[i:i + 7], ' ') as g
  from w, lateral (select unnest(range(1, len(ws) - 6)) as i)
),
starts as (select r, i from (select r, i, count(*) over (partition by r, g) as n from win) where n > 1),
rep as (
  select r, sum(least(8, coalesce(nxt - i, 8))) as n_repeat
  from (select r, i, lead(i) over (partition by r order by i) as nxt from starts) group by r
),
l as (select r, source, t, unnest(string_split(t, chr(10))) as line from d),
lw as (select r, source, t, line, trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')) as norm
       from l where regexp_matches(line, '[^\x20\x09-\x0D]')),
dup as (select r, count(*) - count(distinct line) as n_dup from lw group by r),
per as (select source, norm, count(distinct t) as n from lw group by source, norm),
hosts as (select source, count(distinct t) as docs from d group by source),
bad as (select p.source, p.norm from per p join hosts h on p.source is not distinct from h.source
        where p.n > 10 and p.n > h.docs * 0.25e0),
taken as (select r, sum(len(string_split(lw.norm, ' '))) as n
          from lw join bad on lw.source is not distinct from bad.source and lw.norm = bad.norm group by r),
c as (
  select w.doc_id, cast(len(ws) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(coalesce(n_dup, 0) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat, 0) as bigint) as n_repeat_words,
    coalesce(taken.n, 0) as taken
  from w left join dup on w.r = dup.r left join rep on w.r = rep.r left join taken on w.r = taken.r
),
f as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and n_words - taken >= 20 and n_words - taken >= n_words * 0.2e0 as kept
from f
"""


def op7_query(spark, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_rules(docs).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
