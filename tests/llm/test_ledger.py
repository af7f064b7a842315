from __future__ import annotations

import hashlib
import re
from dataclasses import replace

import pytest

from tillmark.llm.ledger import ASSIGN, RULES, read_ledger, scan, scan_new

SECRETS = [
    (1, 'x password = "hunter22" and 0123456789abcdef01234567 end', None, None),
    (2, "token=abc secret: abcdef API_KEY:'zzzzzzz'", None, None),
    (3, "AKIA" + "A1" * 10 + " AKIAshort", None, None),
    (4, "ünï 漢😀 passwd:geheim99 ", None, None),
    (5, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 20, None, None),
    (6, None, None, None), (7, "", None, None), (8, 'x password = "hunter22" and 0123456789abcdef01234567 end', None, None),
    (8, "secret=token: abcdefgh", None, None), (None, "a" * 30 + " " + "token=" + "Z" * 5000, None, None)]


def plain(text):
    out = []
    for rank, rule in enumerate(RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), rank, m.end(), rule.kind))
    return sorted(out)


@pytest.fixture
def ledger(tmp_path):
    return f"file://{tmp_path}/ledger"


def spans_of(frame):
    return sorted(((r.doc_id, [tuple(s) for s in r.spans]) for r in frame.collect()), key=repr)


def test_spans_equal_brute_force(make, ledger):
    docs = make(SECRETS)
    assert spans_of(scan(docs, ledger)) == sorted([(i, plain(t)) for i, t, _, _ in SECRETS], key=repr)


def test_odd_rows_and_no_rows(odd, none, ledger, tmp_path):
    assert spans_of(scan(odd, ledger)) == sorted([(r.doc_id, plain(r.text)) for r in odd.collect()], key=repr)
    assert scan(none, f"file://{tmp_path}/other").isEmpty()


def test_only_unseen_blobs_and_changed_rules_are_scanned(spark, make, ledger):
    first, more = make(SECRETS[:3]), make(SECRETS)
    scan_new(first, ledger)
    assert read_ledger(spark, ledger).count() == 3 * len(RULES)
    scan_new(first, ledger)
    assert read_ledger(spark, ledger).count() == 3 * len(RULES)
    scan_new(more, ledger)
    blobs = len({hashlib.sha256((t or "").encode()).hexdigest() for _, t, _, _ in SECRETS})
    assert read_ledger(spark, ledger).count() == blobs * len(RULES)
    # A new version of one rule is scanned on all blobs, and replaces the old one's findings.
    wider = [replace(r, version=2, least=2) if r.kind == "assign" else r for r in RULES]
    found = {r.doc_id: r for r in scan(more, ledger, wider).collect()}
    assert read_ledger(spark, ledger).count() == blobs * (len(RULES) + 1)
    assert [s.kind for s in found[2].spans] == ["assign"] * 3


def test_copies_share_one_scan(spark, make, ledger):
    docs = make([(i, "token=abcdefgh", None, None) for i in range(50)])
    assert all([tuple(s) for s in r.spans] == plain("token=abcdefgh") for r in scan(docs, ledger).collect())
    assert read_ledger(spark, ledger).count() == len(RULES)


def test_a_failing_match_is_not_tried_again():
    assert re.search(ASSIGN, "secret=token: abcdefgh")[2] == "token" and plain("secret=token: abcdefgh") == []
