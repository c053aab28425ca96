import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from depotkit.llm.resampling import OP11_SQL, resample, run_buckets, splitter
from tests.llm.helpers import awkward_rows, by_sql, documents, same

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain(rows, targets, share=5, min_words=20, seed=42, buckets=10_000):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    found = [plain_features(text) for _, text in rows]
    s, t = Counter(bucket(f) for _, fs in found for f in fs), Counter(bucket(f) for x in targets for f in plain_features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for (doc_id, _), (words, fs) in zip(rows, found):
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, fs))
        h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[1], r[3]))
    for i, r in enumerate(able[:share * len(able) // 100]):
        r[5] = i + 1
    return sorted(map(tuple, out), key=repr)


TARGETS = ["the abc def of the abc", "Again AND again the same", None, "", "日本 é"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


def target_table(spark, texts=TARGETS):
    return spark.createDataFrame([(t,) for t in texts], "text string")


@pytest.mark.parametrize("share", [0, 5, 60, 100])
def test_like_a_plain_loop(spark, share):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    got = resample(documents(spark), target_table(spark), share_percent=share)
    assert rows_of(got) == plain(rows, TARGETS, share)


def test_sql_says_the_same(spark):
    docs = documents(spark)
    got = resample(docs, target_table(spark)).select("doc_id", "n_features", "weight", "score", "rank")
    frame = docs.select("doc_id", "text").toArrow()
    same(got, by_sql(OP11_SQL, documents=frame, benchmark=target_table(spark).toArrow()))


def test_words_and_windows():
    text = "Ünï-code_x 12 a\x7fb \x80 日本,語 <tag>"
    low = text.encode().lower().decode()
    pieces = splitter().pre_tokenize_str(low)
    assert [w for w, _ in pieces] == WORD.findall(low)
    assert all(low[a:b] == w for w, (a, b) in pieces)
    words, features = plain_features(text)
    assert sorted(run_buckets([w.encode() for w in words], 9973).tolist()) == sorted(zlib.crc32(f.encode()) % 9973 for f in features)
    for n in range(4):
        assert len(run_buckets([b"a"] * n)) == [0, 1, 3, 6][n]


def test_texts_like_the_target_are_drawn(spark):
    rng = np.random.default_rng(5)
    name = lambda k: " ".join(f"{k}{i}" for i in rng.integers(0, 50, 60))
    rows = [(i, name("w" if i % 10 else "goal")) for i in range(300)]
    got = resample(spark.createDataFrame(rows, "doc_id long, text string"), target_table(spark, [name("goal") for _ in range(20)]), share_percent=10)
    drawn = [r["doc_id"] for r in got.filter("rank is not null").collect()]
    assert len(drawn) == 30 and all(i % 10 == 0 for i in drawn)


def test_ties_fall_to_the_smaller_id(spark):
    docs = spark.createDataFrame([(None, " ".join(["x"] * 25))] * 3 + [(7, " ".join(["x"] * 25))] * 4, "doc_id long, text string")
    got = rows_of(resample(docs, target_table(spark), share_percent=60))
    assert [r[5] for r in got if r[5]] and got == plain([(None, " ".join(["x"] * 25))] * 3 + [(7, " ".join(["x"] * 25))] * 4, TARGETS, 60)


def test_kept_columns_and_empty_tables(spark):
    docs = documents(spark)
    got = resample(docs, target_table(spark, []), keep=["text", "n", "doc_id"])
    assert got.columns == ["text", "n", "doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(r["text"] or "" for r in got.select("text").collect()) == sorted(r[1] or "" for r in awkward_rows())
    assert resample(docs.limit(0), target_table(spark)).collect() == []
    assert rows_of(resample(docs, target_table(spark, []))) == plain([(r[0], r[1]) for r in awkward_rows()], [])
    with pytest.raises(ValueError):
        resample(docs, target_table(spark), buckets=70_000)
