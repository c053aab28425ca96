import re

import pytest

from depotkit.operators import quality as qa
from depotkit.schemas import CONTRACTS


def audit(df):
    return {r.check: (r.status, r.rows_in, r.rows_out, r.detail) for r in df.collect()}


def products(spark, rows):
    ddl = "product_id int, sku string, product_name string, category string, unit_cost string, unit_price double, " \
          "lead_time_days int, reorder_point int, reorder_quantity int"
    return spark.createDataFrame(rows, ddl)


def sales(spark, rows):
    return spark.createDataFrame(
        rows, "sale_id int, product_id int, sale_date string, quantity_sold string, unit_price double, discount_pct double"
    )


def test_product_checks_in_contract_order(spark):
    rows = [(i, f"s{i}", "n", "c", "-1" if i < 3 else "n/a", 1.0, 1, 1, 1) for i in range(1234)]
    rows += [(None, "s", "n", None, None, 1.0, 1, 1, 1), (None, "s", "n", None, None, 1.0, 1, 1, 1)]
    out = qa.validate("products", products(spark, rows))
    names = [r.check for r in out.collect()]
    want = ["required_cols", "pk_unique"] + [f"not_null:{c}" for c in CONTRACTS["products"].not_null]
    want += [f"non_neg:{c}" for c in CONTRACTS["products"].non_negative] + ["row_count"]
    assert names == want
    got = audit(out)
    assert got["pk_unique"] == ("WARN", 1236, 1236, "1 duplicate PKs in 'product_id'")
    assert got["not_null:product_id"] == ("WARN", 1236, 0, "2 nulls (0.2%)")
    assert got["not_null:unit_price"] == ("PASS", 1236, 0, "0 nulls (0.0%)")
    assert got["non_neg:unit_cost"] == ("WARN", 1236, 0, "3 negative values")
    assert got["row_count"] == ("PASS", 1236, 1236, "1,236 rows")


def test_null_share_above_ten_percent_fails(spark):
    rows = [(i, "s", "n", None if i < 2 else "c", "1", 1.0, 1, 1, 1) for i in range(10)]
    assert audit(qa.validate("products", products(spark, rows)))["not_null:category"] == ("FAIL", 10, 0, "2 nulls (20.0%)")


def test_foreign_keys_and_ranges(spark):
    prod = products(spark, [(1, "s", "n", "c", "1", 1.0, 1, 1, 1)])
    df = sales(spark, [(1, 1, "d", "1", 1.0, 150.0), (2, 9, "d", "x", 1.0, None), (3, None, "d", "1", 1.0, -1.0)])
    got = audit(qa.validate("sales", df, {"products": prod}))
    assert got["fk:product_id"] == ("WARN", 3, 0, "2 orphaned FK values")
    assert got["range:discount_pct"] == ("WARN", 3, 0, "2 values outside [0,100]")
    with_null = products(spark, [(1, "s", "n", "c", "1", 1.0, 1, 1, 1), (None, "s", "n", "c", "1", 1.0, 1, 1, 1)])
    assert audit(qa.validate("sales", df, {"products": with_null}))["fk:product_id"][3] == "1 orphaned FK values"
    assert "fk:product_id" not in audit(qa.validate("sales", df))


def test_empty_table_reaches_the_row_count_failure(spark):
    got = audit(qa.validate("products", products(spark, [])))
    assert got["row_count"] == ("FAIL", 0, 0, "0 rows")
    assert got["not_null:sku"][0] == "PASS"


def test_missing_columns_raise(spark):
    with pytest.raises(ValueError, match="reorder_quantity"):
        qa.validate("products", products(spark, []).drop("reorder_quantity"))


def test_summary(spark):
    parts = [qa.audit_row(spark, "t", "s", "c", s, 0, 0, "") for s in ("PASS", "WARN", "PASS")]
    assert {r.status: r.entries for r in qa.audit_summary(qa.combine(parts)).collect()} == {"PASS": 2, "WARN": 1}


def test_keys_are_shuffled_once_and_rows_may_violate_any_set_of_checks(spark):
    prod = products(spark, [(1, "s", "n", "c", "-1", 1.0, 1, 1, 1), (1, None, "n", None, "1", -1.0, 1, 1, -1)])
    df = sales(spark, [(1, 1, None, "-1", -1.0, 150.0), (1, 9, None, "1", 1.0, 150.0), (None, None, "d", "1", 1.0, 1.0), (None, 1, "d", "-2", 1.0, None)])
    out = qa.validate_all({"products": prod, "sales": df}, {"products": prod})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(pool#\d+L?, key#", plan)) == 1
    got = {(r.table, r.check): (r.rows_in, r.detail.split()[0]) for r in out.collect()}
    assert got["products", "pk_unique"] == (2, "1") and got["sales", "pk_unique"] == (4, "2")
    assert got["products", "not_null:sku"] == (2, "1") and got["products", "not_null:category"] == (2, "1")
    assert got["sales", "not_null:sale_date"] == (4, "2") and got["sales", "range:discount_pct"] == (4, "2")
    assert got["sales", "non_neg:quantity_sold"] == (4, "2") and got["sales", "fk:product_id"] == (4, "2")
