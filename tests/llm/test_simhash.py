"""SimHash groups against brute force."""

import itertools
import random
import re

import pytest
import xxhash

from depotkit.llm import simhash
from depotkit.llm.queries import QUERIES
from tests.llm.helpers import awkward_rows, documents


def slow_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(fps, radius):
    """The smallest index reachable from each fingerprint."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= radius:
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_every_pair_within_the_radius_shares_a_bucket():
    for radius in (1, 2, 3):
        masks = [m % (1 << 64) for m in simhash.covering_masks(radius)]
        assert len(masks) == 2 ** (radius + 1) - 1
        for bits in itertools.combinations(range(64), min(radius, 2)):
            assert any(not any(m >> b & 1 for b in bits) for m in masks)


@pytest.mark.parametrize("radius", [1, 2])
@pytest.mark.parametrize("bucket", [2, 64])  # 2: nearly all buckets go the way of large ones
def test_groups_equal_brute_force(spark, radius, bucket):
    rng = random.Random(radius)
    fps = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(250):  # chains and dense spots
        fps.append(rng.choice(fps) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3))))
    fps = sorted(set(fps), key=signed)
    nodes = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = simhash.near_links(nodes, radius, bucket)
    assert all((r.a ^ r.b) % (1 << 64) and ((r.a ^ r.b) % (1 << 64)).bit_count() <= radius for r in links.collect())
    got = {r.node: r.root for r in simhash.components(links).collect()}
    want = slow_groups(fps, radius)
    assert [got.get(signed(f), signed(f)) for f in fps] == [signed(fps[w]) for w in want]


def test_query_equals_brute_force(spark, folder):
    got = QUERIES["op10_simhash"](spark, folder).toPandas().sort_values("doc_id")
    text = spark.read.parquet(f"{folder}/documents.parquet").toPandas().sort_values("doc_id").text
    fps = [slow_fingerprint(t) for t in text]
    assert [f"{f:016x}" for f in fps] == got.fingerprint.tolist()
    ids = got.doc_id.tolist()
    assert [ids[r] for r in slow_groups(fps, 2)] == got.component_id.tolist()


def test_awkward_rows(spark):
    rows = awkward_rows()
    got = simhash.simhash_groups(documents(spark)).collect()
    assert len(got) == len(rows)
    fps = [slow_fingerprint(r[1]) for r in rows]
    roots = slow_groups(fps, 2)
    want = []
    for (name, *_), fp, root in zip(rows, fps, roots, strict=True):
        ids = [r[0] for r, other in zip(rows, roots, strict=True) if other == root and r[0] is not None]
        want.append((name, signed(fp), min(ids, default=None)))
    order = lambda x: tuple((v is not None, v or 0) for v in x)
    assert sorted([(r.doc_id, r.fp, r.component_id) for r in got], key=order) == sorted(want, key=order)


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.drop_near_copies(docs)
    assert kept.dtypes == docs.dtypes
    ids = [r.doc_id for r in kept.collect()]
    assert 4 in ids and not set(range(40, 46)) & set(ids)  # copies of 4
    assert ids.count(1) == 3  # one document, repeated
    assert 50 in ids and not {51, 52} & set(ids)  # no word, fingerprint zero
    assert simhash.drop_near_copies(documents(spark, [])).count() == 0
    other = documents(spark, [(1, "a b c d e", "en", "s"), (2, "a b c d e", "en", "s"), (2, "quite another text here now", "en", "s")])
    assert sorted((r.doc_id, r.text[:1]) for r in simhash.drop_near_copies(other).collect()) == [(1, "a"), (2, "q")]
