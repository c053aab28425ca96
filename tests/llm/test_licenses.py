"""License scans: planted notices, alignment by hand."""

import re

from depotkit.llm import licenses
from depotkit.llm.queries import QUERIES
from tests.llm.helpers import awkward_rows, documents, sentence


def test_alignment():
    a, b = "x a b c d y".split(), "a b q c d".split()
    assert licenses.align(a, b) == [(1, 0), (2, 1), (3, 3), (4, 4)]
    assert licenses.align([], b) == [] and licenses.align(a, []) == []
    # "the" is no anchor, but is found in the gap between two
    assert licenses.align("the one the two".split(), "one the two".split()) == [(1, 0), (2, 1), (3, 2)]
    moved = licenses.align("d e f a b c g h".split(), "a b c d e f g h".split())
    assert len(moved) == 5 and all(x < u and y < v for (x, y), (u, v) in zip(moved, moved[1:], strict=False))


def test_finds_whole_and_worn_notices(spark):
    mit, apache = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Apache-2.0-header"]
    worn = re.sub(r"\b(software|notice|copies)\b", "work", mit)
    rows = [
        (1, f"{sentence(1, 500)} {mit.upper()} {sentence(2, 500)}", "en", "s"),
        (2, "# " + apache.replace(" the ", "\n#  the "), "en", "s"),
        (3, worn, "en", "s"), (4, sentence(3, 20000), "en", "s"), (5, " ".join(mit.split()[:40]), "en", "s"),
        (6, "İ Licensed under CC BY-NC 4.0. And later: released UNDER the mit license!", "en", "s"),
        (7, "the license " + "under x y z version " * 30, "en", "s"),
    ]
    got = {}
    for r in licenses.scan_licenses(documents(spark, rows)).collect():
        got.setdefault(r.doc_id, {})[r.license] = r
    assert got[1]["MIT"].coverage == 1.0 and got[1]["MIT"].start_word == 500
    text = rows[0][1]
    assert text[got[1]["MIT"].start:got[1]["MIT"].end] == mit.upper().rstrip(".")
    assert got[2]["Apache-2.0-header"].coverage == 1.0 and 0.8 <= got[3]["MIT"].coverage < 1.0
    assert set(got[6]) == {"CC-BY-NC-4.0-notice", "MIT-notice"} and rows[5][1][got[6]["MIT-notice"].start:][:8] == "released"
    assert not {4, 5, 7} & set(got)


def test_query_finds_the_planted_lines(spark, folder):
    got = {(r.doc_id, r.license) for r in QUERIES["op3_licenses"](spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        for name, line in licenses.TEMPLATES.items():
            if line in r.text:
                assert (r.doc_id, name) in got
    assert all(name.split("-")[0] in ("Apache", "MIT", "GPL", "CC") for _, name in got)


def test_awkward_rows(spark):
    rows = [*awkward_rows(), (None, licenses.TEMPLATES["MIT-notice"], "en", "s"), (8, "Released " * 3 + "under the MIT License", "en", "s")]
    got = sorted((r.doc_id or 0, r.license, r.coverage) for r in licenses.scan_licenses(documents(spark, rows)).collect())
    assert got == [(0, "MIT-notice", 1.0), (8, "MIT-notice", 1.0)]
    assert licenses.scan_licenses(documents(spark, [])).count() == 0
    assert licenses.scan_licenses(documents(spark, rows), templates={}).count() == 0


def test_finds_each_of_several_copies(spark):
    t = licenses.TEMPLATES
    mit, apache, notice = t["MIT"], t["Apache-2.0-header"], t["MIT-notice"]
    worn = re.sub(r"\b(software|notice|copies)\b", "work", mit)
    spread = re.sub(r"(\w+)", r"\1 q q q q q", t["GPL-3.0-header"])
    rows = [
        (1, f"the {notice} the {notice} the", "en", "s"), (2, f"{mit}\n{mit}\n{mit}", "en", "s"),
        (3, f"{apache} of the {apache}", "en", "s"), (4, f"{worn} {mit} and the {worn}", "en", "s"),
        (5, f"{notice} {'of the license under which it was released, to the mit, ' * 40}{notice}", "en", "s"),
        (6, f"{spread} {t['GPL-3.0-header']}", "en", "s"), (7, f"{mit} {apache} {mit} {apache}", "en", "s"),
    ]
    got = {}
    for r in licenses.scan_licenses(documents(spark, rows)).collect():
        got.setdefault((r.doc_id, r.license), []).append((r.start_word, r.end_word, r.coverage))
    whole = {k: [(a, b) for a, b, c in sorted(x) if c == 1.0] for k, x in got.items()}
    n, m = len(licenses.WORD.findall(mit.lower())), len(licenses.WORD.findall(apache.lower()))
    assert whole[1, "MIT-notice"] == [(1, 6), (7, 12)] and whole[2, "MIT"] == [(0, n), (n, 2 * n), (2 * n, 3 * n)]
    assert whole[3, "Apache-2.0-header"] == [(0, m), (m + 2, 2 * m + 2)]
    assert len(got[4, "MIT"]) == 3 and whole[4, "MIT"] == [(n, 2 * n)]
    assert len(whole[5, "MIT-notice"]) == 2
    assert len(got[6, "GPL-3.0-header"]) == 2
    assert len(whole[7, "MIT"]) == 2 and len(whole[7, "Apache-2.0-header"]) == 2
    for found in got.values():
        assert all(x[1] <= y[0] for x, y in zip(sorted(found), sorted(found)[1:], strict=False))


def test_many_copies_are_all_found():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8, 8)
    assert len([x for x in scanner.scan((licenses.TEMPLATES["MIT"] + "\n") * 200) if x[0] == "MIT"]) == 200
    assert len([x for x in scanner.scan((licenses.TEMPLATES["MIT-notice"] + "\n") * 3000) if x[0] == "MIT-notice"]) == 3000
