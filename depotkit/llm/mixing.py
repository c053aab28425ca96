"""Mixing sources to target weights: budgets down a tree, then a seeded prefix of each leaf."""

from __future__ import annotations

from fractions import Fraction
from math import lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from depotkit.llm.common import written

#: Documents in a bucket of a leaf's seeded order, on average; only the bucket of the cut is sorted.
BUCKET_DOCS = 4096
WIDE = "decimal(19,0)"


def _path(levels: list[str]) -> Column:
    """A node's name: its values from the root down, as JSON, so that nulls are values too."""
    if not levels:
        return F.lit("[]")
    return F.to_json(F.array(*[F.col(f"`{c}`").cast("string") for c in levels]))


def _whole(weights: dict[str, float]) -> tuple[dict[str, int], int]:
    """A level's weights, and the weight of values without one, as whole numbers in the same
    proportions: 0.7 and 0.3 are 7 and 3 beside 10. Negative weights, or such that need a factor
    above a million, are an error."""
    exact = {value: Fraction(str(weight)) for value, weight in weights.items()}
    factor = lcm(*(w.denominator for w in exact.values()))
    if factor > 10**6 or any(w < 0 for w in exact.values()):
        raise ValueError(f"weights must be at least zero and have six decimals at most: {weights}")
    return {value: int(w * factor) for value, w in exact.items()}, factor


def _weight(level: str, weights: dict[str, dict[str, float]]) -> Column:
    whole, one = _whole(weights.get(level, {}))
    out = F.lit(one)
    for value, weight in whole.items():
        out = F.when(F.col(f"`{level}`").cast("string") == value, F.lit(weight)).otherwise(out)
    return out.cast("long")


def _shares(nodes: DataFrame) -> DataFrame:
    """Adds ``budget`` to (parent, node, w, cap, given): siblings share ``given`` by weight, none
    above its cap. In the order of cap / w, a sibling is full if its share of what is left there
    reaches its cap; the others share the rest by running integer parts, which add up exactly."""
    order = W.partitionBy("parent").orderBy(F.col("cap") / F.col("w"), "node")
    wide = lambda c: F.col(c).cast(WIDE)
    nodes = nodes.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    nodes = nodes.withColumn("w_on", F.sum("w").over(order.rowsBetween(0, W.unboundedFollowing)))
    full = wide("cap") * wide("w_on") <= (F.col("given") - F.col("before")).cast(WIDE) * wide("w")
    nodes = nodes.withColumn("full", full)
    own = W.partitionBy("parent")
    nodes = nodes.withColumn("left", F.col("given") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(own), F.lit(0)))
    nodes = nodes.withColumn("w_open", F.sum(F.when(~F.col("full"), F.col("w"))).over(own))
    nodes = nodes.withColumn("w_to", F.sum(F.when(~F.col("full"), F.col("w"))).over(order.rowsBetween(W.unboundedPreceding, 0)))
    part = F.expr(
        f"cast(cast(left as {WIDE}) * cast(w_to as {WIDE}) div cast(w_open as {WIDE}) as long) - "
        f"cast(cast(left as {WIDE}) * cast(w_to - w as {WIDE}) div cast(w_open as {WIDE}) as long)")
    return nodes.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.least(part, F.col("cap"))))


def leaf_budgets(
    leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, float]], budget: int, max_epochs: int
) -> DataFrame:
    """(leaf, tokens, docs, budget) of leaves with a share, from (levels, tokens, docs).

    A node can hold what its children can; a leaf, its tokens times ``max_epochs``. A parent's
    budget goes to its children by weight; what some can't hold goes to their siblings, and only
    what all of them can't hold to the parent's own siblings. Values without a weight have 1;
    those of weight 0 and leaves without tokens get nothing.
    """
    tree = leaves.withColumn("cap", F.col("tokens") * max_epochs).filter("tokens > 0")
    for level in levels:
        tree = tree.withColumn(f"w_{level}", _weight(level, weights)).filter(F.col(f"w_{level}") > 0)
    given = tree.groupBy().agg(F.least(F.lit(budget).cast("long"), F.coalesce(F.sum("cap"), F.lit(0))).alias("budget"))
    given = given.select(_path([]).alias("node"), "budget")
    for depth in range(1, len(levels) + 1):
        nodes = tree.groupBy(_path(levels[:depth - 1]).alias("parent"), _path(levels[:depth]).alias("node")).agg(
            F.first(f"w_{levels[depth - 1]}").alias("w"), F.sum("cap").alias("cap"))
        nodes = nodes.join(given.select(F.col("node").alias("parent"), F.col("budget").alias("given")), "parent")
        given = _shares(nodes).select("node", "budget")
    sized = tree.select(_path(levels).alias("leaf"), "tokens", "docs")
    return sized.join(given.withColumnRenamed("node", "leaf"), "leaf")


def _position(doc_id: str, epoch: Column, seed: int) -> Column:
    """A document's place in the seeded order of an epoch."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name).cast("binary"))


def _bucket(position: Column, buckets: Column) -> Column:
    return F.shiftright(F.conv(F.substring(position, 1, 8), 16, 10).cast("long") * buckets, 32)


def mix(
    docs: DataFrame,
    levels: list[str],
    weights: dict[str, dict[str, float]],
    share_percent: int,
    max_epochs: int,
    seed: int = 42,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Documents of the mix: ``row`` (all input columns as a struct), tokens, epochs.

    The budget is ``share_percent`` of all tokens (words between white space), shared out by
    ``leaf_budgets`` over the tree of ``levels``. A leaf gives whole epochs while its budget lasts
    and then a prefix of the next epoch's seeded order: the longest that fits. ``epochs`` tells how
    often a document is in the mix; those with none are left out. Each leaf's cut is one row of a
    small table, so choosing is a filter on the documents and their texts need no shuffle.

    Null values of a level are one node of their own. A null text has no tokens. Rows with the same
    doc_id (all without one, too) share a place in the order and come in or stay out together.
    An empty table, or one without tokens, gives an empty result.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = own.select("row", _path([f"row`.`{c}" for c in levels]).alias("leaf"),
                     F.regexp_count(F.coalesce(F.col("row")[text], F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"))
    light = written(own.select(F.col("row")[doc_id].alias("doc_id"), *[F.col("row")[c].alias(c) for c in levels], "leaf", "tokens"), "tokens")
    leaves = written(light.groupBy(*levels).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    shares = leaf_budgets(leaves, levels, weights, total * share_percent // 100, max_epochs)
    shares = shares.withColumn("whole", F.expr("budget div tokens")).withColumn("rest", F.expr("budget % tokens"))
    shares = written(shares.withColumn("buckets", F.expr(f"(docs + {BUCKET_DOCS - 1}) div {BUCKET_DOCS}")), "shares")

    placed = light.select("doc_id", "leaf", "tokens").join(shares.select("leaf", "whole", "rest", "buckets"), "leaf")
    placed = placed.withColumn("position", _position("doc_id", F.col("whole"), seed))
    placed = placed.withColumn("bucket", _bucket(F.col("position"), F.col("buckets")))
    sums = placed.groupBy("leaf", "rest", "bucket").agg(F.sum("tokens").alias("n"))
    run = W.partitionBy("leaf").orderBy("bucket")
    sums = sums.withColumn("to", F.sum("n").over(run)).filter("to > rest")
    cut = sums.groupBy("leaf").agg(F.min(F.struct("bucket", (F.col("to") - F.col("n")).alias("before"))).alias("c"))
    cut = written(cut.select("leaf", F.col("c.bucket").alias("cut"), "c.before"), "cuts")
    near = placed.join(cut, "leaf").filter("bucket = cut")
    upto = W.partitionBy("leaf").orderBy("position").rangeBetween(W.unboundedPreceding, W.currentRow)
    near = near.withColumn("to", F.col("before") + F.sum("tokens").over(upto)).filter("to <= rest")
    last = near.groupBy("leaf").agg(F.max("position").alias("last"))
    plan = written(shares.join(cut, "leaf", "left").join(last, "leaf", "left").select("leaf", "whole", "buckets", "cut", "last"), "mix")

    chosen = own.join(plan, "leaf")
    position = _position("__id", F.col("whole"), seed)
    chosen = chosen.withColumn("__id", F.col("row")[doc_id]).withColumn("__at", position)
    bucket = _bucket(F.col("__at"), F.col("buckets"))
    inside = F.coalesce((bucket < F.col("cut")) | ((bucket == F.col("cut")) & (F.col("__at") <= F.col("last"))), F.lit(False))
    return chosen.select("row", "tokens", (F.col("whole") + inside.cast("long")).alias("epochs")).filter("epochs > 0")


#: Production weights of the domain and language levels; sources weigh alike.
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANGUAGE_WEIGHTS = {"en": 4, "de": 2, "fr": 2, "es": 1}


def domain_name(docs: DataFrame) -> str:
    """A name for the domain level that no column of ``docs`` has."""
    taken, name = {c.lower() for c in docs.columns}, "domain"
    while name in taken:
        name += "_"
    return name


def mix_domains(docs: DataFrame, domain: str, share_percent: int, max_epochs: int) -> DataFrame:
    """The mix over domain, language and source, with the domain added to the rows as ``domain``:
    documents name none, so it is the remainder of the source's number by four."""
    number = F.regexp_extract("source", r"([0-9]{1,9})$", 1)
    docs = docs.withColumn(domain, F.when(number != "", F.concat(F.lit("d"), (number.cast("long") % 4).cast("string"))))
    weights = {domain: DOMAIN_WEIGHTS, "lang": LANGUAGE_WEIGHTS}
    return mix(docs, [domain, "lang", "source"], weights, share_percent, max_epochs)


def mix_sources(docs: DataFrame, share_percent: int = 90, max_epochs: int = 1) -> DataFrame:
    """The documents of the mix with the columns they came with, each as often as its epochs."""
    mixed = mix_domains(docs, domain_name(docs), share_percent, max_epochs)
    again = mixed.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("epochs")))) if max_epochs > 1 else mixed
    return again.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op2_query(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents at half of their tokens, up to four epochs a leaf."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    domain = domain_name(docs)
    mixed = mix_domains(docs, domain, share_percent=50, max_epochs=4)
    return mixed.select("row.doc_id", F.col("row")[domain].alias("domain"), "row.lang", "row.source", "tokens", "epochs")


def _level_sql(n: int, columns: list[str], parent: list[str], w: str) -> str:
    """Shares of one level; ties of cap / w fall in the order of the node's values as JSON."""
    mine, above = ", ".join(columns), ", ".join(parent)
    on = " and ".join(f"x.{c} is not distinct from g.{c}" for c in parent) or "true"
    over = f"partition by {above}" if parent else ""
    node = "to_json([" + ", ".join(columns) + "])"
    return f"""
n{n} as (select {mine}, any_value({w}) as w, sum(cap)::hugeint as cap, {node}::varchar as node from tree group by {mine}),
o{n} as (select x.*, g.budget as given from n{n} x join b{n - 1} g on {on}),
p{n} as (select *, coalesce(sum(cap) over ({over} order by cap::double / w, node rows between unbounded preceding and 1 preceding), 0) as before,
  sum(w) over ({over} order by cap::double / w, node rows between current row and unbounded following) as w_on from o{n}),
q{n} as (select *, cap * w_on <= (given - before) * w as is_full from p{n}),
r{n} as (select *, given - coalesce(sum(cap) filter (is_full) over ({over}), 0) as rest_of,
  sum(w) filter (not is_full) over ({over}) as w_open,
  sum(w) filter (not is_full) over ({over} order by cap::double / w, node rows between unbounded preceding and current row) as w_to from q{n}),
b{n} as (select {mine}, (case when is_full then cap else least(cap,
  rest_of * w_to // w_open - rest_of * (w_to - w) // w_open) end)::hugeint as budget from r{n}),"""


def op2_sql(share_percent: int, max_epochs: int) -> str:
    """The mix of ``documents`` at these settings."""
    return (r"""
with d as (select doc_id, lang, source,
    case when regexp_matches(source, '[0-9]{1,9}$') then 'd' || (regexp_extract(source, '([0-9]{1,9})$', 1)::bigint % 4) end as domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as tokens from documents),
leaves as (select domain, lang, source, sum(tokens)::hugeint as tokens from d group by all),
tree as (select *, tokens * EPOCHS as cap,
    case domain when 'd0' then 4 when 'd1' then 3 when 'd2' then 2 else 1 end as w1,
    case lang when 'en' then 4 when 'de' then 2 when 'fr' then 2 else 1 end as w2, 1 as w3
  from leaves where tokens > 0),
b0 as (select least((select sum(tokens) from d) * SHARE // 100, sum(cap))::hugeint as budget from tree),"""
    + _level_sql(1, ["domain"], [], "w1")
    + _level_sql(2, ["domain", "lang"], ["domain"], "w2")
    + _level_sql(3, ["domain", "lang", "source"], ["domain", "lang"], "w3")
    + """
s as (select d.*, (b.budget // t.tokens)::bigint as whole, (b.budget % t.tokens)::bigint as rest
  from d join b3 b on d.domain is not distinct from b.domain and d.lang is not distinct from b.lang and d.source is not distinct from b.source
  join tree t on d.domain is not distinct from t.domain and d.lang is not distinct from t.lang and d.source is not distinct from t.source),
c as (select *, sum(tokens) over (partition by domain, lang, source
    order by md5('42:' || whole || ':' || coalesce(doc_id::varchar, 'null')) range between unbounded preceding and current row) as upto from s)
select doc_id, domain, lang, source, tokens, whole + case when upto <= rest then 1 else 0 end as epochs
from c where whole + case when upto <= rest then 1 else 0 end > 0
""").replace("EPOCHS", str(max_epochs)).replace("SHARE", str(share_percent))


OP2_SQL = op2_sql(50, 4)
