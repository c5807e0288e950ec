import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from editscope.llm import pii

from . import odd


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        worth = int(c) * (2 if k % 2 else 1)
        total += worth - 9 if worth > 9 else worth
    return total % 10 == 0


def base(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(out))


def found(spark, texts):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    only = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    rows = pii.find(docs).select("doc_id", pii._joined(only).alias("b"), pii._joined(F.col("pii")).alias("a"), "pii").collect()
    return sorted(rows, key=lambda r: r.doc_id)


ODD = [
    "a@b.c_d@e.f x", "1.2.3.4.5.6.7.8 1.2.3.400.5", "4111 1111 1111 1111-4111111111111111", "a😀b x@y.zz 4111-1111-1111-1111",
    "", None, "+1 (555) 123-4567)) +12", "+1+1 555 000 1111 2", "1" * 40, "0001.002.255.256 000.0.0.000 99999999999999999999.1.1.1",
    "a@b.c.@d.e.f@g.h..i@j", "4111 1111 1111  1111 4111111111111111 2", ".@a.b%@c-.d", "a@b.cd@e.f+1 555 000 1111",
    "x" * 100_000 + "@a." + "b.c" * 20_000, " ".join(f"10.0.0.{k % 300}" for k in range(1500)), odd.LONG,
]


def test_base_spans_of_odd_texts(spark):
    for row, text in zip(found(spark, ODD), ODD):
        assert row.b == base(text), text and text[:80]


@pytest.mark.parametrize("seed", range(3))
def test_base_spans_of_random_texts(spark, seed):
    rng = random.Random(seed)
    parts = ["1", "23", "4111111111111111", "5500 0000 0000 0004", "@", ".", "-", " ", "+", "(", ")", "a", "é", "255", "300", "x_y", "\n"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(300)]
    for row, text in zip(found(spark, texts), texts):
        assert row.b == base(text), text


def test_query_equals_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in odd.plain(spark, sf_dir).collect()}
    got = pii.op6_pii(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        want = base(texts[r.doc_id])
        kinds = [s.split(":")[0] for s in want.split(",") if s]
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds.count(k) for k in pii.BASE)
        assert [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE] == [s for s in want.split(",") if s]


def test_checksums_and_context(spark):
    texts = ["GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33", "DE89370400440532013000.", "ssn 123-45-6789", "123-45-6789",
             "ssn 000-45-6789", "my card 4111111111111111"]
    rows = found(spark, texts)
    assert [r.a for r in rows] == ["iban:0:27", "", "iban:0:22", "ssn:4:15", "", "", "card:8:24"]
    assert rows[6].pii[0].score == pytest.approx(1.0)


def test_redaction_of_odd_documents(spark):
    docs = odd.documents(spark)
    got = pii.redact(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    text = {r.doc_id: r.text for r in got.collect() if r.doc_id is not None}
    assert text[17] == "call <PHONE> or mail <EMAIL>, card <CARD>"
    assert text[0] is None and text[18] == odd.TEXTS[18]
    assert text[11].endswith("amet <EMAIL> <IP>") and len(text[11]) > 200_000
    assert pii.redact(odd.empty(spark)).count() == 0 and pii.find(odd.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = pii.op6_pii(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_matches_take_time_in_proportion(spark):
    """Tens of thousands of matches in one text, also beyond the basic plane: same spans, no quadratic copying."""
    import time

    texts = {
        n: " ".join(f"\U0001f600 10.0.{k % 300}.7 a{k}@b.example +1 555 000 {k % 9000 + 1000}" for k in range(n // 3)) for n in (3000, 30_000, 100_000)
    }
    took = {}
    for n, text in texts.items():
        began = time.time()
        row = found(spark, [text])[0]
        took[n] = time.time() - began
        assert row.b == base(text)
    assert took[100_000] < 40
    text = texts[30_000]
    began = time.time()
    got = pii.redact(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().text
    assert time.time() - began < 20
    assert got == plain_redact(text)


def plain_redact(text):
    at, out = 0, []
    for span in sorted((int(s.split(":")[1]), int(s.split(":")[2]), s.split(":")[0]) for s in base(text).split(",") if s):
        if span[0] >= at:
            out += [text[at : span[0]], f"<{span[2].upper()}>"]
        at = max(at, span[1])
    return "".join(out) + text[at:]


def test_context_on_either_side(spark):
    rows = found(spark, ["078-05-1120", "my ssn is 078-05-1120", "078-05-1120 is my SSN", "078-05-1120 " + "x " * 40 + "ssn"])
    assert [r.a for r in rows] == ["", "ssn:10:21", "ssn:0:11", ""]


def test_redact_keeps_odd_column_names(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.example", 2)], "doc_id long, text string, `a.b` int")
    assert pii.redact(docs).collect()[0].asDict() == {"doc_id": 1, "text": "mail <EMAIL>", "a.b": 2}
