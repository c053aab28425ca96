import csv
import io

import numpy as np
import pytest

from depotkit.sources import readers

HEADER = ["product_id", "sku", "note"]


def plain(text):
    """Rows and rejected records as Python's own reader sees them."""
    rows, bad = [], 0
    for row in list(csv.reader(io.StringIO(text, newline="")))[1:]:
        if len(row) > 3:
            bad += 1
        elif row:
            rows.append(tuple([*row, "", ""][:3]))
    return rows, bad


def awkward(n=400, seed=0):
    rng = np.random.default_rng(seed)
    kinds = ['plain', 'two\nlines', 'a "quoted" word', 'comma, inside', 'end\n\n\nof "many"\nlines', '"', '\n', 'tail\r\nreturn', "é日", ""]
    out = io.StringIO(newline="")
    write = csv.writer(out, lineterminator="\n")
    write.writerow(HEADER)
    for i in range(n):
        write.writerow([i, kinds[rng.integers(len(kinds))], kinds[rng.integers(len(kinds))]])
        if i % 37 == 5:
            out.write("\n")
        if i % 41 == 7:
            out.write(f'{i},x,y,"surplus ""{i}"""\n')
        if i % 43 == 9:
            out.write(f"{i}\n")
    return out.getvalue()


def shown(df):
    return sorted(tuple(v or "" for v in r) for r in df.select(*HEADER).collect())


@pytest.mark.parametrize("split", [64, 700, 10_000_000])
def test_like_a_reader_of_the_whole_file(spark, tmp_path, split):
    text = awkward()
    (tmp_path / "products.csv").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        scan = readers.scan_raw(spark, "products", str(tmp_path))
        rows, bad = plain(text)
        assert shown(scan.rows) == sorted(rows)
        got = scan.rejected.collect()
        assert len(got) == bad and {r._reason for r in got} == {"surplus fields"} and all("surplus" in r._record for r in got)
        ordered = [r.product_id for r in scan.rows.orderBy(*readers.arrival_order()).collect()]
        assert ordered == [r[0] for r in rows]
        assert scan.rows.columns == [*HEADER, *readers.ARRIVAL]
        tasks = spark.read.text(str(tmp_path / "products.csv")).rdd.getNumPartitions()
        assert tasks > 50 if split == 64 else tasks >= 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_folder_of_parts_and_returns(spark, tmp_path):
    part = tmp_path / "products.csv"
    part.mkdir()
    (part / "a.csv").write_bytes(b'product_id,sku,note\r\n1,a,"x\r\ny"\r\n2,b,\r\n')
    (part / "b.csv").write_bytes(b'product_id,sku,note\n3,"c",last')
    got = readers.read_raw(spark, "products", str(tmp_path))
    assert sorted(tuple(r) for r in got.collect()) == [("1", "a", "x\r\ny"), ("2", "b", None), ("3", "c", "last")]


def test_a_quote_that_is_not_closed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "MAX_LINES", 5)
    lines = ["product_id,sku,note", "1,a,b", '2,"stray,b', *[f"{i},c,d" for i in range(3, 30)]]
    (tmp_path / "products.csv").write_text("\n".join(lines))
    scan = readers.scan_raw(spark, "products", str(tmp_path))
    assert shown(scan.rows) == [("1", "a", "b")]
    got = scan.rejected.orderBy(*readers.arrival_order()).collect()
    assert [r._record for r in got] == lines[2:] and {r._reason for r in got} == {"unclosed quote"}
    (tmp_path / "products.csv").write_text('product_id,sku,note\n1,a,"open\n2,b,c\n')
    assert readers.scan_raw(spark, "products", str(tmp_path)).rejected.count() == 2


def test_empty_files(spark, tmp_path):
    (tmp_path / "products.csv").write_text("product_id,sku,note\n")
    scan = readers.scan_raw(spark, "products", str(tmp_path))
    assert scan.rows.columns[:3] == HEADER and scan.rows.count() == 0 and scan.rejected.count() == 0
