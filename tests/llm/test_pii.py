"""Personal data against a plain search in Python."""

from __future__ import annotations

import hashlib
import re

from odd import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from subledger.llm import pii
from subledger.llm.queries import op11_pii

SF = "/root/testdata/sf0.001"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(text):
    total = 0
    for at, digit in enumerate(reversed(re.sub("[^0-9]", "", text))):
        n = int(digit) * (1 + at % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def holds(kind, text):
    size = len(re.sub("[^0-9]", "", text))
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 12 <= size <= 19 and luhn(text)
    return kind == "email" or 9 <= size <= 15


def base_spans(text):
    found = [
        (m.start(), n, m.end(), kind)
        for n, (kind, pattern) in enumerate(BASE.items()) for m in re.finditer(pattern, text or "") if holds(kind, m[0])
    ]
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in sorted(found))


def expected(text):
    names = base_spans(text)
    kinds = [s.split(":")[0] for s in names.split(",")]
    return *map(kinds.count, BASE), hashlib.sha256(names.encode()).hexdigest()


def base_of(spans):
    return ",".join(s for s in spans.split(",") if s.split(":")[0] in BASE)


def check(df):
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in pii.report(df).collect():
        assert tuple(r)[1:6] == expected(texts[r.doc_id]), texts[r.doc_id]
        assert base_of(r.spans) == base_spans(texts[r.doc_id])


HARD = [
    "a@b.c_d@e.f.g x@y z@.b q@w..e a.b@c-d.e. +1 (814) 555-5574", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.0000255 1.2.3 1..2.3.4",
    "4404303280215809 4404 3032 8021 5809 4404-3032-8021-5809x 4404  303280215809 000000000000 0-0-0", "👍 é 9@x.y 中+49 30 1234567890.",
    "+1+23 456 789 012 +1() 5 +12 3.", "1.2.3.4@5.6 +1.2.3.4-5678901 1-1.1.1.1", "@@a@@b.c@d.e@f.g", "1 2 3 4 5 6 7 8 9 0 1 2 8",
    "9" * 40 + ".1.1.1", "a" * 50 + "@" + "b" * 50 + "@" + "c.d",
]


def test_hard_texts(spark):
    check(spark.createDataFrame(list(enumerate(HARD)), "doc_id bigint, text string"))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab0123456789.@+-_ ()\n中👍", max_size=60), min_size=50, max_size=150))
def test_any_text(spark, texts):
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))


def test_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = op11_pii(spark, SF).collect()
    assert len(found) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in found) > 10
    assert {r.doc_id: tuple(r)[1:6] for r in found} == {i: expected(t) for i, t in texts.items()}


ADDED = [
    ("Konto DE89 3704 0044 0532 0130 00.", "iban:6:33"), ("GB82WEST12345698765432", "iban:0:22"), ("DE88 3704 0044 0532 0130 00", ""),
    ("xDE89370400440532013000", ""), ("DE893704004405320130001", ""), ("NO9386011117947 FR1420041010050500013M02606", "iban:0:15,iban:16:43"),
    ("My SSN is 123-45-6789", "ssn:10:21"), ("Part 123-45-6789", ""), ("SSN 000-45-6789", ""), ("social security: 1-123-45-6789", ""),
    ("Call (814) 555-5574 now", "tel:5:19"), ("call 814.555.5574", "tel:5:17"), ("sum 814 555 5574", ""), ("call +1 (814) 555-5574", "phone:5:22"),
    ("call order 8145555574", ""), ("call 8145555574", "tel:5:15"), ("phone 8145555574124", ""), ("tel a8145555574 x@8145555574.de", "email:16:31"),
]


def test_added_kinds(spark):
    found = pii.report(spark.createDataFrame([(n, text) for n, (text, _) in enumerate(ADDED)], "doc_id int, text string")).collect()
    assert [(ADDED[r.doc_id][0], r.spans) for r in found] == ADDED


def test_context_adjusts_scores_and_base_spans_stay(spark):
    rows = [(1, "visa 4404303280215809"), (2, "4404303280215809"), (3, "order 4404303280215809"), (4, "order 1.2.3.4")]
    found = pii.find(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    scores = {r.doc_id: [s.score for s in r.spans if s.kind in ("card", "ip")] for r in found}
    assert scores[1][0] > scores[2][0] > scores[3][0] >= pii.THRESHOLD and scores[4] == [pii.THRESHOLD]
    assert found[0].spans[0].text == "4404303280215809"


def test_very_many_matches(spark):
    """Beyond several blocks of matches; places count code points, not bytes."""
    check(spark.createDataFrame([(1, "é 1.2.3.4 a@b.cd 👍" * 1500), (2, "1." * 3000), (3, "1 " * 4000), (4, "a" * 3000)], "doc_id bigint, text string"))


def test_long_runs_take_time_in_proportion(spark):
    """Runs on which a pattern that is tried anew at each letter, as the plain search here does, would take hours."""
    long = ["a" * 1_000_000, "1" * 1_000_000, "1 " * 300_000, "a@" + "b." * 300_000, "+1" + "(" * 500_000, "a@" * 300_000]
    found = {r.doc_id: tuple(r)[1:5] for r in pii.report(spark.createDataFrame(list(enumerate(long)), "doc_id bigint, text string").repartition(4)).collect()}
    assert found == {0: (0, 0, 0, 0), 1: (0, 0, 0, 0), 2: (0, 0, 0, 0), 3: (1, 0, 0, 0), 4: (0, 0, 0, 0), 5: (0, 0, 0, 0)}


def test_odd_rows(spark, odd_documents):
    found = pii.report(odd_documents)
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert found.count() == odd_documents.count() and {r.spans for r in found.collect()} == {""}
    assert {r.base_sha256 for r in found.collect()} == {hashlib.sha256(b"").hexdigest()}
    assert pii.report(odd_documents.limit(0)).collect() == []
    twice = spark.createDataFrame([(1, "a@b.cd"), (1, "a@b.cd"), (None, "a@b.cd")], "doc_id int, text string")
    assert [r[-1] for r in rows_of(pii.report(twice))] == ["email:0:6"] * 3


def test_nothing_leaves_the_jvm(spark):
    df = op11_pii(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
