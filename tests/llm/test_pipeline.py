"""The pipeline, stage by stage, against SQL and plain loops; and that the rest does without it."""

import os
import subprocess
import sys

import pytest

import corpus_pipeline
from depotkit.llm import line_dedup, mixing, quality
from tests.llm.helpers import by_sql, documents, same, sentence
from tests.llm.test_packing import check_places, slow_ids
from tests.llm.test_simhash import slow_fingerprint, slow_groups


def follow(spark, docs, folder):
    """Runs the stages, holding each against another way to its result; returns the last one's rows."""
    columns = docs.columns
    quality_rows, lines, simhash, mix, pack = (f for _, f in corpus_pipeline.STAGES)
    a = quality_rows(spark, docs, folder).persist()
    verdicts = by_sql(quality.OP7_SQL, documents=docs.toArrow())
    assert a.columns == columns
    assert sorted(r.doc_id for r in a.collect()) == sorted(verdicts[verdicts.kept].doc_id)
    b = lines(spark, a, folder).persist()
    assert b.columns == columns
    same(b.selectExpr("doc_id", "text as clean"), by_sql(f"select doc_id, clean from ({line_dedup.OP5_SQL})", documents=a.toArrow()))
    c = simhash(spark, b, folder).persist()
    before = sorted(((r.doc_id, r.text) for r in b.collect()))
    groups = slow_groups([slow_fingerprint(t) for _, t in before], 2)
    assert c.columns == columns
    assert sorted(r.doc_id for r in c.collect()) == [before[i][0] for i in sorted(set(groups))]
    d = mix(spark, c, folder).persist()
    assert d.columns == columns
    want = by_sql(mixing.op2_sql(90, 1), documents=c.toArrow())
    assert sorted(r.doc_id for r in d.collect()) == sorted(want.doc_id)
    e = pack(spark, d, folder).collect()
    check_places(e, {r.doc_id: slow_ids(r.text) for r in d.collect()})
    return e


def test_stages_and_run(spark, folder):
    rows = follow(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert rows
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.start, r.ids_crc32) for r in rows)


@pytest.mark.parametrize("rows", [None, []])
def test_stages_take_awkward_rows(spark, rows):
    docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), stage(spark, docs, "").schema)
    assert docs.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert bool(docs.count()) == (rows is None)


def test_the_rest_does_without(tmp_path):
    """With the folders and the pipeline gone, other queries are still registered; other import errors are not hidden."""
    top = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for name in os.listdir(top):
        if name in ("__spark_entry__.py", "depotkit"):
            continue
        if name.endswith(".py") and name != "corpus_pipeline.py":
            (tmp_path / name).symlink_to(f"{top}/{name}")
    (tmp_path / "__spark_entry__.py").write_text(open(f"{top}/__spark_entry__.py").read())
    (tmp_path / "depotkit").mkdir()
    for name in os.listdir(f"{top}/depotkit"):
        if name not in ("llm", "__pycache__"):
            (tmp_path / "depotkit" / name).symlink_to(f"{top}/depotkit/{name}")
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and not [x for x in q if x.startswith('op')]; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module_here")
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, stderr=subprocess.DEVNULL).returncode


@pytest.mark.parametrize(("members", "others"), [(20, 40), (8, 42)])
def test_near_copies_leave_one_whole(spark, members, others):
    """Groups of a third and of a sixth of a host, above the shares of the quality rules and of line dedup."""
    shared = [sentence(70 + j, 15) for j in range(9)]
    rows = [(i, "\n".join([*shared[:5], sentence(500 + i, 6), *shared[5:]]), "en", "a") for i in range(members)]
    rows += [(100 + i, "\n".join(sentence(1000 + 10 * i + j, 15) for j in range(4)), "en", "a") for i in range(others)]
    docs = documents(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = spark.createDataFrame(stage(spark, docs, "").collect(), docs.schema)
    left = {r.doc_id: r.text for r in docs.collect()}
    assert [i for i in left if all(line in left[i] for line in shared)] == [0] and left[0] == rows[0][1]
    assert sum(any(line in t for line in shared) for t in left.values()) == 1
    assert all(left[100 + i] == rows[members + i][1] for i in range(others))
