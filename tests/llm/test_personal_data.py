"""Wider spans of personal data, planted beside look-alikes in the given texts."""

import pytest

from ratesmith.llm import pii

DATA = "/root/testdata/sf0.001"
PLANTED = {
    "email": ["jane.doe [at] example [dot] org", "jim (at) mail.example.com", "a_b@host[dot]net"],
    "ip": ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80:0:0:0:202:b3ff:fe1e:8329", "2a02:2e0:3fe::12"],
    "card": ["4111.1111.1111.1111", "5500/0000/0000/0004"],
    "phone": ["(030) 1234-5678"],
}
LOOK_ALIKES = ["price [at] 3 [dot] 50", "look (at) page . then", "12:34:56:78:9a:bc:de:f0", "fade::bad",
               "2024:01:02:03:04:05:06:07", "4111.1111.1111.1112", "1234/5678/1234/5678", "12.345.678"]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    right = [(kind, match) for kind, matches in PLANTED.items() for match in matches]
    cases = right * 10 + [(None, match) for match in LOOK_ALIKES * 3]
    rows = [(10**6 + i, f"Zwölf plain words and {match}. Then more", kind, match) for i, (kind, match) in enumerate(cases)]
    planted = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    reports = {r.doc_id: r for r in pii.pii_report(docs.unionByName(planted)).collect()}
    return [(reports[name], text, kind, match) for name, text, kind, match in rows]


def test_wider_spans_appear(found):
    for report, text, kind, match in found:
        if kind:
            start = text.index(match)
            assert f"{kind}:{start}:{start + len(match)}" in report.spans.split(","), match


def test_look_alikes_do_not(found):
    for report, _, kind, match in found:
        if not kind:
            assert report.spans == "", match


def test_a_base_match_is_one_candidate(spark):
    docs = spark.createDataFrame([(1, "mail a.b@c.de or 4111 1111 1111 1111, 4111 1111 1111 1112")],
                                 "row_number long, text string").withColumn("doc_id", pii.F.col("row_number"))
    rows = pii.spans(pii.candidates(docs)).where("kind IN ('email', 'card')")
    assert sorted((r.kind, r.base, r.evidence) for r in rows.collect()) == [
        ("card", True, False), ("card", True, True), ("email", True, True)]
