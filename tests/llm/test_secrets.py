import random
import re
import time

import pytest

from mealmarts.llm import secrets as S
from mealmarts.session import scratch_path

KEY = "AKIA" + "ABCDEFGH12345678"
ROWS = [
    (1, 'é token = "24be64439e3e49cf46b2d7c90f3602a3"'), (2, f"{KEY} and {KEY}"), (3, "secret: token: abcdefghijkl"), (4, None), (5, ""),
    (6, f"x {KEY}"), (7, f"x {KEY}"), (7, f"x {KEY}"), (None, "PASSWD=0123456789ab"), (8, "paſſword=0123456789abcdef0"),
    (9, "-----BEGIN RSA PRIVATE KEY-----"), (10, "nothing here"), (11, "api_key='" + "k" * 40 + "' " + "0f" * 2000),
]


def base(text):
    found = [(m.start(), 0, "assign", m.end()) for m in re.finditer(S.ASSIGN, text, re.I | re.A) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(found)]


@pytest.fixture
def ledger(spark):
    return scratch_path(spark, "test-ledger")


def test_base_spans(docs, ledger):
    frame = docs(ROWS)
    S.update_ledger(frame, ledger)
    rows = S.report(S.findings(frame, ledger)).collect()
    got = sorted((r.doc_id or 0, [s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex")]) for r in rows)
    assert got == sorted((i or 0, base(t or "")) for i, t in ROWS)
    assert "private_key:0:31" in {r.spans for r in rows}


def test_only_unseen_pairs_are_scanned(spark, docs, ledger):
    first, later = docs(ROWS[:6]), docs(ROWS)
    S.update_ledger(first, ledger)
    before = S.read_ledger(spark, ledger).count()
    S.update_ledger(first, ledger)
    assert S.read_ledger(spark, ledger).count() == before == len({t or "" for _, t in ROWS[:6]}) * len(S.RULES)
    S.update_ledger(later, ledger)
    blobs = len({t or "" for _, t in ROWS})
    assert S.read_ledger(spark, ledger).count() == blobs * len(S.RULES)
    changed = (S.RULES[0]._replace(version=2, least=200), *S.RULES[1:])
    S.update_ledger(later, ledger, changed)
    assert S.read_ledger(spark, ledger).count() == blobs * (len(S.RULES) + 1)
    assert S.report(S.findings(later, ledger, changed)).filter("n_assign > 0").count() == 0
    assert S.report(S.findings(later, ledger)).filter("n_assign > 0").count() == 3


def test_redaction(docs, ledger):
    frame = docs(ROWS).selectExpr("*", "1 as spans", "2 as blob", "3 as _x")
    S.update_ledger(frame, ledger)
    clean = S.redact(frame, ledger)
    assert clean.columns == frame.columns
    texts = {r.doc_id: r.text for r in clean.collect()}
    assert texts[1] == 'é [SECRET]"' and texts[2] == "[SECRET] and [SECRET]" and texts[4] is None and texts[10] == "nothing here"
    S.update_ledger(clean, ledger)
    assert S.report(S.findings(clean, ledger)).filter("spans <> ''").count() == 0


def test_redaction_with_clashing_names(docs, ledger):
    frame = docs(ROWS).selectExpr("*", "1 as _spans", "2 as _blob", "3 as row", "4 as clean", "5 as blob", "6 as `a.b`", "7 as spans")
    S.update_ledger(frame, ledger)
    clean = S.redact(frame, ledger)
    assert clean.columns == frame.columns
    assert {tuple(r[5:]) for r in clean.collect()} == {(1, 2, 3, 4, 5, 6, 7)}
    assert {r.doc_id: r.text for r in clean.collect()}[2] == "[SECRET] and [SECRET]"


def _scanned(monkeypatch, docs, ledger):
    """The (blob, rules) rows that reach the scanner."""
    plans = []
    monkeypatch.setattr(S, "map_batches", lambda df, *more: plans.append(df) or kept(df, *more))
    S.update_ledger(docs, ledger)
    return plans


kept = S.map_batches


def test_known_texts_do_not_move(spark, docs, ledger, monkeypatch):
    first, later = docs(ROWS[:6]), docs(ROWS)
    assert [p.count() for p in _scanned(monkeypatch, first, ledger)] == [len({t or "" for _, t in ROWS[:6]})]
    assert _scanned(monkeypatch, first, ledger) == []  # all is known: nothing is read but hashes
    scan = _scanned(monkeypatch, later, ledger)[0]
    assert scan.count() == len({t or "" for _, t in ROWS} - {t or "" for _, t in ROWS[:6]})
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert plan.index("LeftSemi") > plan.index("hashpartitioning(blob")  # known texts stop below the shuffle of texts


def test_empty_table(docs, ledger):
    frame = docs(ROWS).limit(0)
    S.update_ledger(frame, ledger)
    assert S.findings(frame, ledger).count() == 0


def body(rng, n):
    return "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(n))


@pytest.mark.parametrize("line", ["\n", "\r\n", "\\n", "\n> ", " "])
@pytest.mark.parametrize("kind", ["RSA ", "", "ENCRYPTED ", "OPENSSH "])
def test_nothing_is_left_of_a_private_key(line, kind):
    rng = random.Random(3)
    rows = [body(rng, 64) for _ in range(25)]
    begin, end = f"-----BEGIN {kind}PRIVATE KEY-----", f"-----END {kind}PRIVATE KEY-----"
    rule = next(r for r in S.RULES if r.kind == "private_key")
    attributes = ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0123ABCD", ""]
    for inner in (rows, [*rows, "Qw=="], [*rows, "q1Z"], [*attributes, *rows] if line != " " else rows, ["short1+", "a9="]):
        key = line.join([begin, *inner, end])
        text = f"before it {key} and after it"
        assert S.matches(rule, text) == [(10, 10 + len(key))], inner[-1]
        assert S.matches(rule, f"{key}\n{key}") == [(0, len(key)), (len(key) + 1, 2 * len(key) + 1)]
        cut = key[: -len(line + end)]  # no END line
        assert S.matches(rule, f"before it {cut}") == [(10, 10 + len(cut))] or (line == " " and inner[0] == "short1+")
        if line != " ":
            assert S.matches(rule, f"before it {cut}\n\nand so on, it is over.") == [(10, 10 + len(cut))], inner[-1]


def test_prose_after_a_bare_header_stays():
    rule = next(r for r in S.RULES if r.kind == "private_key")
    begin = "-----BEGIN PRIVATE KEY-----"
    for rest in (" is how such a file begins", "\nis how\nit begins", "\nApples\nPEARS\nplums\n", ", -----", " -----BEGIN", ""):
        assert S.matches(rule, begin + rest) == [(0, len(begin))], rest


def test_many_headers_take_linear_time():
    rule = next(r for r in S.RULES if r.kind == "private_key")
    for unit in ("-----BEGIN PRIVATE KEY-----\n" + "- a" * 20, "-----BEGIN PRIVATE KEY-----\n" + "Aa1 " * 20, "-----BEGIN PRIVATE KEY-----" + "\n" * 60):
        start = time.process_time()
        assert len(S.matches(rule, unit * 20_000)) == 20_000
        assert time.process_time() - start < 10


def test_redaction_takes_the_whole_key(docs, ledger):
    rng = random.Random(4)
    rows = [body(rng, 64) for _ in range(20)]
    key = "\n".join(["-----BEGIN RSA PRIVATE KEY-----", *rows, "Zz9=", "-----END RSA PRIVATE KEY-----"])
    frame = docs([(1, f"one\n{key}\ntwo {key} three"), (2, key[:-30]), (3, "no key")])
    S.update_ledger(frame, ledger)
    texts = {r.doc_id: r.text for r in S.redact(frame, ledger).collect()}
    assert texts == {1: "one\n[SECRET]\ntwo [SECRET] three", 2: "[SECRET]", 3: "no key"}


def test_outcomes_of_the_old_key_rule_are_scanned_again(docs, ledger):
    frame = docs([(1, "-----BEGIN PRIVATE KEY-----\nMIIEabc123\n-----END PRIVATE KEY-----")])
    old = tuple(r._replace(version=1, pattern="-----BEGIN PRIVATE KEY-----") if r.kind == "private_key" else r for r in S.RULES)
    S.update_ledger(frame, ledger, old)
    S.update_ledger(frame, ledger)
    assert [r.text for r in S.redact(frame, ledger).collect()] == ["[SECRET]"]
