"""Token ids, token counts and packing against the tokenizer and plain loops."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from depotkit.llm import packing, token_counts
from depotkit.llm.queries import QUERIES
from depotkit.llm.tokens import encoder
from tests.llm.helpers import awkward_rows, documents


def slow_ids(text):
    return encoder().whole.encode(text or "", add_special_tokens=False).ids


ODD = ["", " ", "  a", "a  b", "a\nb", "a \nb", "a\n b", "a\n\nb", "\na", "a\n", "don't 'tis x's", "a\tb c", "\0 a b", "<|endoftext|> x",
       "日本語 の テスト", "x\u0085 y z", "a\x1cb \x1c c", "½ x½y Ⅷ", "é" * 500 + " a", "🙂 🙂🙂 a", "a b c\r\nd", "ﬁ ǆ"]


def test_ids_are_the_tokenizers(spark, folder):
    texts = ODD + [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()] + [None]
    for text, ids in zip(texts, encoder().encode(texts), strict=True):
        assert ids.tolist() == slow_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \n\t'abBé1,.日 \r\0-"), max_size=30) | st.text(max_size=20), min_size=1, max_size=5))
def test_ids_of_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [ids.tolist() for ids in encoder().encode(texts)] == [slow_ids(t) for t in texts]


def check_places(rows, want_ids):
    """Each document's ids lie in exactly one piece each; sequences have no gap and are not too long."""
    spent, sequences = {}, {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        spent.setdefault(r.doc_id, []).append(r)
    for doc_id, ids in want_ids.items():
        ids = np.array([*ids, 0], "<u4")
        at = 0
        for r in sorted(spent.pop(doc_id), key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    assert not spent
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    return len(sequences)


def test_query_packs_all_ids(spark, folder):
    rows = QUERIES["op9_packing"](spark, folder).collect()
    ids = {r.doc_id: slow_ids(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    n = check_places(rows, ids)
    assert sum(r.length for r in rows) > 0.95 * n * packing.CAPACITY


def test_packing_awkward_rows(spark):
    named = [r for r in awkward_rows() if r[0] is not None]
    named = list({r[0]: r for r in named}.values())
    check_places(packing.pack_documents(documents(spark, named)).collect(), {r[0]: slow_ids(r[1]) for r in named})
    every = packing.pack_documents(documents(spark)).collect()  # with repeated rows and rows without doc_id
    assert sum(r.length for r in every) == sum(len(slow_ids(r[1])) + 1 for r in awkward_rows())
    assert packing.pack_documents(documents(spark, [])).count() == 0


@pytest.mark.parametrize("parts", [1, 7, 20])
def test_rounds_of_merging(spark, parts):
    rng = random.Random(parts)
    rows = [(i, rng.randint(1, 1024), "x") for i in range(1500)]
    pieces = spark.createDataFrame(rows, "id long, length long, _window string").repartition(parts)
    got = packing.pack(pieces, open_windows=8, fan_in=3).selectExpr("row.id", "row.length", "row._window", "sequence_id", "offset").collect()
    assert sorted((r.id, r.length, r._window) for r in got) == sorted(rows)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r[1] for r in rows) > 0.85 * 1024 * len(sequences)


def test_lengths_that_take_no_room_and_too_long_ones(spark):
    got = packing.pack(spark.createDataFrame([(None,), (0,), (5,)], "length long")).collect()
    assert sorted((r.row.length or 0, r.offset is None) for r in got) == [(0, True), (0, True), (5, False)]
    with pytest.raises(Exception, match="longer than a sequence"):
        packing.pack(spark.createDataFrame([(1025,)], "length long")).collect()


def test_windows_fill_best_and_emit_the_fullest():
    windows = packing.Windows(10, 2)
    assert windows.place(6) == (0, 0, [])
    assert windows.place(7) == (1, 0, [])
    assert windows.place(3) == (1, 7, [1])  # fits both; fills the second
    assert windows.place(5) == (2, 0, [])
    assert windows.place(8) == (3, 0, [0])  # none has room: the fullest goes


def slow_histogram(lengths):
    total = sum(lengths)
    return sorted(
        (x, lengths.count(x), x * lengths.count(x), sum(v >= x for v in lengths), sum(v for v in lengths if v >= x), sum(v < x for v in lengths),
         total - sum(v for v in lengths if v >= x), sum(min(v, x) for v in lengths))
        for x in set(lengths))


def test_histogram_equals_plain_sums(spark, folder):
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op4_token_counts"](spark, folder).collect()) == slow_histogram([len(slow_ids(t)) for t in texts])


def test_histogram_of_awkward_rows(spark):
    lengths = [len(slow_ids(r[1])) for r in awkward_rows()]
    found = token_counts.length_histogram(documents(spark))
    assert sorted(tuple(r) for r in found.collect()) == slow_histogram(lengths)
    for limit in (0, 1, 50, 10**6):
        assert tuple(token_counts.truncated_total(found, limit).first()) == (limit, len(lengths), sum(lengths), sum(min(x, limit) for x in lengths))
    got = {r.share: r.length for r in token_counts.quantiles(found, [0.1, 0.5, 1.0]).collect()}
    assert got == {s: sorted(lengths)[int(np.ceil(s * len(lengths))) - 1] for s in (0.1, 0.5, 1.0)}
    none = token_counts.length_histogram(documents(spark, []))
    assert none.count() == 0
    assert tuple(token_counts.truncated_total(none, 5).first()) == (5, 0, 0, 0)
    assert none.select(F.col("length")).dtypes == [("length", "bigint")]
