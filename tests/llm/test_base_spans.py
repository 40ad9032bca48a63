"""Base spans of personal data against Python's own matching."""

import hashlib
import random
import re

from ratesmith.llm import pii

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    spans = {kind: [m.span() for m in re.finditer(pattern, text) if valid(kind, m[0])]
             for kind, pattern in KINDS.items()}
    listed = ",".join(f"{kind}:{a}:{b}" for kind, found in spans.items() for a, b in found)
    return [len(found) for found in spans.values()], hashlib.sha256(listed.encode()).hexdigest(), listed


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    rows = {r.doc_id: r for r in pii.pii_report(docs).collect()}
    assert len(rows) == len(texts)
    for name, text in enumerate(texts):
        counts, digest, listed = plain(text or "")
        row = rows[name]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts, text
        assert row.base_sha256 == digest, text
        assert set(listed.split(",")) - {""} <= set(row.spans.split(","))


def test_given_and_random_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r.text for r in docs.select("text").collect()]
    draw = random.Random(3)
    texts += ["".join(draw.choices("12345 .-+()@ab%x:é😀", k=draw.randint(1, 60))) for _ in range(6000)]
    texts += ["4111 1111 1111 1111 4111-1111-1111-1111", "a@b.c.@d.e", "1.2.3.4.5.6.7.8", "+49 30 (12) 34-56", None, ""]
    check(spark, texts)


def test_long_runs(spark):
    n = 4000
    check(spark, ["a@b" + ".c" * n, "1" * n, "7 " * n + "x", "." * n + "@", "+1" + "(" * n, "1." * n])


def test_very_long_runs_do_not_end_the_task(spark):
    n = 300_000  # beyond what the plain matching, quadratic in runs, can do
    texts = ["a@b" + ".c" * n, "1" * n, "7 " * n + "x", "1." * n]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = sorted(pii.pii_report(docs).collect())
    assert [r.n_email for r in rows] == [1, 0, 0, 0] and [r.n_card for r in rows] == [0] * 4
    assert rows[0].spans == f"email:0:{3 + 2 * n}" and rows[3].n_ip == n // 4
