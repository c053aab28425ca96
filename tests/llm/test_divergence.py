import re
from collections import Counter, defaultdict

import pytest

from depotkit.llm import divergence
from depotkit.llm.divergence import OP13_SQL, audit, collapse, term_counts
from tests.llm.helpers import awkward_rows, by_sql, documents, same, sentence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, min_docs, top=50):
    rows = [(text or "", lang or "", source or "") for _, text, lang, source in rows]
    out = []
    for lang in {r[1] for r in rows}:
        mine = [(Counter(terms_of(t)), s) for t, of, s in rows if of == lang]
        df = Counter(t for c, _ in mine for t in c)
        kept = sorted(t for t, n in df.items() if n >= min_docs)
        count = defaultdict(Counter)
        for c, s in mine:
            count[s].update({t: n for t, n in c.items() if t in set(kept)})
            count[None].update({t: n for t, n in c.items() if t in set(kept)})
        p = {s: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept} for s, c in count.items()}
        for s in count.keys() - {None}:
            pairs = [(x, sum(abs(p[s][t] - p[x][t]) for t in kept)) for x in count.keys() - {None, s}]
            marked = [(t, p[s][t] - p[None][t]) for t in kept if count[s][t] and p[s][t] > p[None][t]]
            for part, items, limit in (("pair", pairs, len(pairs)), ("term", marked, top)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items[:limit])]
    return sorted(out)


def got_rows(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.mark.parametrize("min_docs", [1, 2, 5, 30, 1000])
def test_like_a_plain_loop(spark, min_docs):
    assert got_rows(audit(documents(spark), min_docs)) == plain(awkward_rows(), min_docs)


def many(sources=9, n=150):
    rows = [(i, sentence(i % 40, 5 + i % 30) + " Common word ÄÖ é " + "x" * (i % 7), ["en", "de"][i % 2], f"s{i * i % sources}") for i in range(n)]
    return rows + [(900, "12 34", "en", "digits"), (901, None, "en", None), (902, "solo solo", "xx", "only")]


def test_blocks_and_flushes_change_nothing(spark, monkeypatch):
    want = plain(many(), 3, 4)
    frame = documents(spark, many())
    assert got_rows(audit(frame, 3, 4)) == want
    for name, value in (("HELD_TERMS", 7), ("BLOCK", 2), ("HELD_BLOCKS", 2)):
        monkeypatch.setattr(divergence, name, value)
    assert got_rows(audit(frame, 3, 4)) == want


def test_sql_says_the_same(spark):
    rows = many(n=400) + [(i, "Copy of the same TEXT", "en", f"s{i % 4}") for i in range(1000, 1100)]
    docs = documents(spark, rows)
    same(audit(docs), by_sql(OP13_SQL, documents=docs.select("doc_id", "text", "lang", "source").toArrow()))


def test_copies_are_tokenised_once(spark):
    docs = documents(spark, [(i, "one Two two", "en", f"s{i % 3}") for i in range(30)] + [(99, "one Two two", "de", "s0")])
    groups, texts = collapse(docs)
    assert texts.count() == 2 and sorted(map(tuple, groups.collect())) == [("de", "s0", 0), ("en", "s0", 0), ("en", "s1", 1), ("en", "s2", 2)]
    counted = {(r["lang"], r["term"]): (r["docs"], r["n"], sorted(map(tuple, r["found"]))) for r in term_counts(texts).collect()}
    assert counted["en", "two"] == (30, 60, [(0, 10, 20), (1, 10, 20), (2, 10, 20)])
    assert counted["de", "one"] == (1, 1, [(0, 1, 1)]) and len(counted) == 4


def test_empty_and_termless(spark):
    docs = documents(spark)
    assert audit(docs.limit(0)).collect() == []
    bare = documents(spark, [(1, None, None, None), (2, "1", None, "b"), (3, "", None, "c")])
    assert got_rows(audit(bare)) == plain([(1, None, None, None), (2, "1", None, "b"), (3, "", None, "c")], 30)
    assert len(got_rows(audit(bare))) == 6
