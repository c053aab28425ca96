"""Secret scans: base rules against plain loops, and the ledger."""

import hashlib
import re

from depotkit.llm import secrets
from depotkit.llm.common import folder_for
from depotkit.llm.queries import QUERIES
from tests.llm.helpers import awkward_rows, documents

TEXTS = [
    "token = abcdefghijkl", "TOKEN: 'abcdefghijk'", "token=api_key=abcdefghijkl", "token: api_key: abcdefghijklm", "ſecret=abcdefghijklm toKen=abcdefghijklm",
    "日本 passwd\"  : \"Zm9vYmFyYmF6cXV4", "AKIA" + "A" * 14, "AKIA" + "A" * 13, "xAKIAAKIA" + "9" * 20, "0123456789abcdef", "0123456789abcde", "F0123456789abcdefF",
    "password=" + "0123456789abcdef" * 3, "apikey\t=abcdefghijklmn", "secret=AKIA" + "B" * 16, "", None,
]


def slow(text):
    text, out = text or "", []
    pattern = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for k, (kind, rule, least) in enumerate([("assign", pattern, 12), ("access", "(())AKIA[A-Z0-9]+", 18), ("hex", "(())[0-9a-f]+", 16)]):
        for m in re.finditer(rule, text):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


def checked(got, texts):
    """Digest columns of each doc_id against the plain loop."""
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        spans = slow(texts[r.doc_id])
        kinds = [s.split(":")[0] for s in spans.split(",") if s]
        assert (r.spans, r.n_assign, r.n_access, r.n_hex) == (spans, kinds.count("assign"), kinds.count("access"), kinds.count("hex"))
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()


def test_query_equals_plain_loop(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    checked(QUERIES["op6_secrets"](spark, folder).collect(), texts)


def spans_of(df):
    return sorted(((r.path is not None, r.path or 0), ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans)) for r in df.collect())


def test_rules_and_awkward_rows(spark):
    rows = awkward_rows() + [(200 + i, t, "en", "s") for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "en", "s"), (None, "secret=onlywithoutanid", "en", "s")]
    docs = documents(spark, rows)
    got = secrets.scan_versions(docs, secrets.Ledger(spark, folder_for(docs, "test-ledger")))
    assert spans_of(got) == sorted(((r[0] is not None, r[0] or 0), slow(r[1])) for r in rows)
    assert any("assign" in slow(t) for t in TEXTS) and any("access" in slow(t) for t in TEXTS)


def test_ledger_scans_only_the_unseen(spark):
    first = documents(spark, [(1, TEXTS[0], "en", "s"), (2, TEXTS[0], "en", "s"), (3, TEXTS[6], "en", "s")])
    ledger = secrets.Ledger(spark, folder_for(first, "test-ledger"))
    count = lambda: spark.read.parquet(ledger.path).count()
    secrets.scan_versions(first, ledger)
    assert count() == 2
    second = documents(spark, [(1, TEXTS[6], "en", "s"), (4, TEXTS[9], "en", "s"), (None, TEXTS[0], "en", "s"), (5, None, "en", "s")])
    none_known = lambda text: 1 / 0 if text in (TEXTS[0], TEXTS[6]) else secrets.find_secrets(text)
    got = secrets.scan_versions(second, ledger, find=none_known)
    assert spans_of(got) == sorted([((True, 1), slow(TEXTS[6])), ((True, 4), slow(TEXTS[9])), ((False, 0), slow(TEXTS[0])), ((True, 5), "")])
    assert count() == 4
    more = lambda text: [("access", 0, len(text))]
    assert spans_of(secrets.scan_versions(first, ledger, rules="next", find=more))[0][1] == f"access:0:{len(TEXTS[0])}"  # new rules scan anew
    assert count() == 6
    assert spans_of(secrets.scan_versions(first, ledger)) == spans_of(secrets.scan_versions(first, secrets.Ledger(spark, folder_for(first, "test-ledger"))))
    assert count() == 6
    assert secrets.scan_versions(documents(spark, []), ledger).count() == 0


def test_ledger_goes_on_in_a_later_run(spark):
    docs = documents(spark, [(1, TEXTS[0], "en", "s"), (2, TEXTS[6], "en", "s"), (3, "", "en", "s")])
    path = folder_for(docs, "test-ledger")
    first = spans_of(secrets.scan_versions(docs, secrets.Ledger(spark, path)))
    scans = lambda text: 1 / 0
    assert spans_of(secrets.scan_versions(docs, secrets.Ledger(spark, path), find=scans)) == first
    assert spark.read.parquet(path).count() == 3
