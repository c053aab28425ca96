"""Quality rules, line dedup and mixing against SQL, on awkward documents and the driver's."""

import pytest

from depotkit.llm import line_dedup, mixing, quality
from depotkit.llm.queries import ORACLES, QUERIES
from tests.llm.helpers import by_sql, documents, same

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, folder, name):
    tables = {t: spark.read.parquet(f"{folder}/{t}.parquet").toArrow() for t in ("documents", "benchmark")}
    same(QUERIES[name](spark, folder), by_sql(ORACLES[name], **tables))


@pytest.mark.parametrize("rows", [None, []])
def test_quality_on_awkward_rows(spark, rows):
    docs = documents(spark, rows)
    got = quality.quality_rules(docs).select("row.doc_id", *COUNTS)
    same(got, by_sql(quality.OP7_SQL, documents=docs.select("doc_id", "text", "source").toArrow()))
    assert quality.drop_rejected(docs).columns == docs.columns


def test_quality_counts_by_hand(spark):
    words = [f"w{i}" for i in range(30)]
    text = " ".join(words) + "\n" + " ".join(words[:9]) + "\n#*$ %&|<>\n#*$ %&|<>"
    row = quality.quality_rules(documents(spark, [(1, text, "en", "a")])).first()
    # nine words again make two windows, in both places
    assert (row.n_words, row.n_repeat_words, row.n_dup_lines, row.n_symbols) == (43, 18, 1, 16)
    assert row.base_failed and not row.kept


def test_quality_rejects_depleted_documents(spark):
    line = " ".join(f"common{i}" for i in range(25))
    rows = [(i, f"{line}\nshort tail {i}", "en", "a") for i in range(20)]
    rows += [(100 + i, "\n".join(" ".join(f"own{i}x{j}x{k}" for k in range(12)) for j in range(3)), "en", "a") for i in range(20)]
    got = {r.row.doc_id: r.kept for r in quality.quality_rules(documents(spark, rows)).collect()}
    assert not any(got[i] for i in range(20)) and all(got[100 + i] for i in range(20))
    copies = [(i, "\n".join(" ".join(f"own{j}x{k}" for k in range(12)) for j in range(3)), "en", "a") for i in range(50)]
    assert all(r.kept for r in quality.quality_rules(documents(spark, copies)).collect())  # copies count once


@pytest.mark.parametrize("rows", [None, []])
def test_line_dedup_on_awkward_rows(spark, rows):
    docs = documents(spark, rows)
    got = line_dedup.site_line_dedup(docs).select("row.doc_id", "clean", "n_lines", "n_dropped")
    same(got, by_sql(line_dedup.OP5_SQL, documents=docs.select("doc_id", "text", "source").toArrow()))


def test_line_dedup_drops_boilerplate_only(spark):
    rows = [(i, f"  menu home about \nstory {i}\n\nmore of {i}", "en", "a") for i in range(10)] + [(10, "menu home about", "en", "a"), (11, "menu home about\nx", "en", "b")]
    docs = documents(spark, rows)
    got = {r.doc_id: (r.text, r.n_chars) for r in line_dedup.drop_lines(docs).collect()}
    assert got[3] == ("story 3\n\nmore of 3", 18)
    assert got[10][0] == "menu home about"  # nothing else on the page
    assert got[11][0] == "menu home about\nx"  # another host
    assert line_dedup.drop_lines(docs).dtypes == docs.dtypes


@pytest.mark.parametrize(("share", "epochs"), [(50, 4), (90, 1), (100, 1), (300, 3)])
def test_mix_on_awkward_rows(spark, share, epochs):
    docs = documents(spark)
    got = mixing.mix_domains(docs, "domain", share, epochs).selectExpr("row.doc_id", "row.domain", "row.lang", "row.source", "tokens", "epochs")
    same(got, by_sql(mixing.op2_sql(share, epochs), documents=docs.select("doc_id", "text", "lang", "source").toArrow()))


def test_mix_of_nothing(spark):
    for rows in ([], [(1, None, "en", "src0"), (2, "  ", "en", "src1")]):
        docs = documents(spark, rows)
        assert mixing.mix_sources(docs).count() == 0
        assert mixing.mix_sources(docs).columns == docs.columns


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame([("a", "x", 10, 1), ("a", "y", 1000, 1), ("b", "z", 1000, 1), ("b", "w", 1000, 1)], "top string, leaf_of string, tokens long, docs long")
    got = mixing.leaf_budgets(leaves, ["top", "leaf_of"], {}, 400, 1)
    assert {r.leaf: r.budget for r in got.collect()} == {'["a","x"]': 10, '["a","y"]': 190, '["b","z"]': 100, '["b","w"]': 100}
    tight = mixing.leaf_budgets(leaves, ["top", "leaf_of"], {"top": {"a": 9}}, 2000, 1)  # a can't hold 1800
    assert {r.leaf: r.budget for r in tight.collect()} == {'["a","x"]': 10, '["a","y"]': 1000, '["b","z"]': 495, '["b","w"]': 495}
    none = mixing.leaf_budgets(leaves, ["top", "leaf_of"], {"top": {"a": 0}}, 400, 1)
    assert {r.leaf: r.budget for r in none.collect()} == {'["b","z"]': 200, '["b","w"]': 200}


def test_mix_keeps_a_prefix_of_each_leaf(spark):
    rows = [(i, " ".join(["w"] * 10), "en", "src0") for i in range(30000)]
    got = mixing.mix_domains(documents(spark, rows), "domain", 33, 1)  # several buckets
    assert got.count() == 9900


def test_mix_leaves_columns_named_like_its_levels(spark):
    docs = documents(spark).selectExpr("*", "'own' as Domain", "n_chars as domain_")
    got = mixing.mix_sources(docs, share_percent=100)
    assert got.columns == docs.columns
    assert got.selectExpr("count_if(Domain != 'own') as a", "count_if(not domain_ <=> n_chars) as b").first() == (0, 0)


def test_weights_below_one_keep_their_proportions(spark):
    leaves = spark.createDataFrame([("a", 1000, 9), ("b", 1000, 9), ("c", 1000, 9)], "top string, tokens long, docs long")
    shares = lambda weights, n: {r.top: r.budget for r in mixing.leaf_budgets(leaves, ["top"], {"top": weights}, n, 1)
                                 .join(leaves.selectExpr("top", "to_json(array(top)) as leaf"), "leaf").collect()}
    assert shares({"a": 0.7, "b": 0.3, "c": 0}, 400) == {"a": 280, "b": 120}
    assert shares({"a": 0.5, "b": 0.5}, 400) == {"a": 100, "b": 100, "c": 200}  # without a weight: 1
    assert shares({"a": 7, "b": 3, "c": 0}, 400) == {"a": 280, "b": 120}
    for wrong in ({"a": -1}, {"a": 1 / 3}):
        with pytest.raises(ValueError, match="weights"):
            mixing.leaf_budgets(leaves, ["top"], {"top": wrong}, 400, 1)
