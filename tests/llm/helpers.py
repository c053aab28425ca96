"""Fixtures of the training-data tests: documents with every awkward case, and oracles by DuckDB."""

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa

from check_oracles import shape

#: Columns whose names operators use inside.
CLASHES = "row host body lines kept fp content blob spans tokens leaf epochs position bucket _length _part length n clean"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES.split())


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), 5)) for _ in range(n))


def awkward_rows():
    """(doc_id, text, lang, source): nulls, empty, blank and long texts, copies, repeated rows, ties."""
    rows = [(i, "\n".join(sentence(100 * i + j, 15) for j in range(4)), ["en", "de", None][i % 3], f"src{i % 3}") for i in range(1, 25)]
    common = "read more on our site"
    rows = [(i, f"{common}\n{t}\n\n{t.splitlines()[0]}", lang, source) for i, t, lang, source in rows]
    rows += [(40 + i, rows[3][1], "en", "src0") for i in range(6)]  # copies
    rows += [rows[0], rows[0]]  # repeated rows
    rows += [(50, None, "en", "src0"), (51, "", None, None), (52, " \t\n \r\n", "en", "src1"), (53, "one", "en", "src1"), (54, "One\x0bTWO", "fr", None)]
    rows += [(None, sentence(7, 40), "en", "src2"), (None, None, None, None), (56, sentence(8, 30000), "es", "src9")]
    rows += [(57, " ".join(["again and again the same eight words here"] * 30), "en", "src1"), (58, "Ünïcödé ſ K 日本 " + sentence(9, 30), "en", "srcx")]
    return rows


def documents(spark, rows=None):
    rows = awkward_rows() if rows is None else rows
    full = [(*r, len(r[1]) if r[1] is not None else None, *["x"] * len(CLASHES.split())) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def by_sql(sql, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df if isinstance(df, pa.Table) else pa.Table.from_pandas(df))
    return con.execute(sql).df()


def same(got, want):
    a, b = shape(got if isinstance(got, pd.DataFrame) else got.toPandas()), shape(want)
    assert a[0] == b[0]
    assert a[1] == b[1]
