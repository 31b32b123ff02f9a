"""Releases to notices: one hand-made release per rule."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from noticeworks.functions import ocds
from noticeworks.operators.merge import merge_notices
from noticeworks.plans.gold import procurement_dedup, run_counts
from noticeworks.plans.notices import good, parse_releases, quarantine, with_release
from noticeworks.schemas import TABLES

AWARD = {
    "ocid": "ocds-b5fd17-n1",
    "id": "n1-award",
    "date": "2024-05-06T10:00:00Z",
    "tag": ["award"],
    "tender": {
        "title": "Machine Learning Pipeline",
        "description": "Triage of letters.",
        "value": {"amount": 500, "currency": "GBP"},
        "procurementMethod": "open",
        "items": [{"id": "1", "classification": {"scheme": "CPV", "id": "72212000"}}],
        "contractPeriod": {"startDate": "2024-06-01", "endDate": "2024-07-01"},
        "documents": [{"url": "https://files.test/spec", "description": "Spec", "documentType": "tenderNotice"}],
    },
    "buyer": {"name": "Ministry of Tests", "identifier": {"scheme": "X", "id": "B1"}},
    "relatedProcesses": [{"id": "1", "relationship": ["framework"], "identifier": "fw-9"}],
    "awards": [
        {
            "id": "a1",
            "value": {"amount": 450, "currency": "EUR"},
            "suppliers": [{"name": "Maker Ltd", "identifier": {"scheme": "Y", "id": "S1"}}],
            "contractPeriod": {"startDate": "2024-06-15T00:00:00Z", "endDate": "2025-06-14T00:00:00Z"},
            "documents": [
                {"url": "https://files.test/award", "title": "Award", "documentType": "awardNotice"},
                {"url": "https://files.test/spec", "title": "Again"},
            ],
        }
    ],
}


def changed(**top):
    return {**AWARD, **top}


def tender(**fields):
    return changed(tender={**AWARD["tender"], **fields})


def without(key):
    return {k: v for k, v in AWARD.items() if k != key}


def parse(spark, *releases, source="contracts_finder", **options):
    texts = [(i, r if isinstance(r, str) else json.dumps(r)) for i, r in enumerate(releases)]
    df = spark.createDataFrame(texts, "i int, release string")
    return parse_releases(df, source, **options)


def one(spark, release, **options):
    return parse(spark, release, **options).first()


def test_award_release(spark):
    n = one(spark, AWARD)
    assert n["reason"] is None and n["issue"] is None
    assert n["notice_id"] == "ocds-b5fd17-n1::n1-award"
    assert (n["source"], n["stage"], n["contract_status"]) == ("contracts_finder", "award", "awarded")
    assert (n["value_amount"], n["currency"]) == (450.0, "EUR")
    assert (n["supplier_name"], n["supplier_id"]) == ("Maker Ltd", "S1")
    assert (n["buyer_name"], n["buyer_org_id"]) == ("Ministry of Tests", "B1")
    assert json.loads(n["cpv_codes"]) == ["72212000"]
    assert [str(n[c]) for c in ("published_date", "contract_start", "contract_end")] == [
        "2024-05-06",
        "2024-06-15",
        "2025-06-14",
    ]
    assert n["framework_id"] == "fw-9" and n["procurement_method"] == "open"
    assert (n["ai_confidence"], n["ai_relevant"], n["ai_relevance_version"]) == ("strong", True, "2.0")
    assert [(d["title"], d["url"][-5:]) for d in json.loads(n["documents"])] == [("Spec", "/spec"), ("Award", "award")]
    assert json.loads(n["awards"])[0]["id"] == "a1"
    assert (n["source_url"], n["link_status"]) == ("https://www.contractsfinder.service.gov.uk/Notice/n1", "ok")


def test_other_source_is_unresolved_without_its_own_document(spark):
    n = one(spark, AWARD, source="find_a_tender")
    assert (n["source"], n["source_url"], n["link_status"]) == ("find_a_tender", None, "unresolved")
    url = "https://www.find-tender.service.gov.uk/Notice/1"
    n = one(spark, tender(documents=[{"url": url}]), source="find_a_tender")
    assert (n["source_url"], n["link_status"]) == (url, "ok")


def test_own_document_is_chosen_by_type_then_position(spark):
    site = "https://www.contractsfinder.service.gov.uk/Notice/"
    docs = [{"url": site + "z"}, {"url": site + "c", "documentType": "contractNotice"}, {"url": site + "a", "documentType": "awardNotice"}]
    assert one(spark, tender(documents=docs))["source_url"] == site + "a"
    assert one(spark, tender(documents=docs[:1]))["source_url"] == site + "z"


def test_bare_release(spark):
    n = one(spark, {"ocid": "o", "id": "1"})
    assert n["reason"] is None
    assert n["title"] is None and n["documents"] is None and n["awards"] is None and n["framework_id"] is None
    assert (n["supplier_name"], n["contract_status"], n["currency"]) == ("supplier_unknown", "unknown", "GBP")
    assert (n["cpv_codes"], n["ai_confidence"], n["ai_relevant"]) == ("[]", "none", False)


@pytest.mark.parametrize("release", [without("ocid"), without("id"), changed(ocid=""), changed(id=None), "{}", "[1]", "{oops"])
def test_missing_key_is_quarantined(spark, release):
    assert one(spark, release)["reason"] == "no ocid or id"


@pytest.mark.parametrize(
    "awards,status,expected",
    [
        ([{"status": "active", "suppliers": [{"name": "X"}]}], None, "awarded"),
        ([{"suppliers": [{"name": "X"}]}], "active", "awarded"),
        ([{"status": "pending", "suppliers": [{"name": "X"}]}], "complete", "closed"),
        ([{"status": "active"}], "active", "open"),
        ([], "planning", "planned"),
        ([], "planned", "planned"),
        ([], "cancelled", "cancelled"),
        ([], "unsuccessful", "unsuccessful"),
        ([], "withdrawn", "withdrawn"),
        ([], "something", "unknown"),
    ],
)
def test_status(spark, awards, status, expected):
    assert one(spark, changed(awards=awards, tender={"status": status} if status else {}))["contract_status"] == expected


@pytest.mark.parametrize(
    "awards,value,expected",
    [
        ([{"value": {}}, {"value": {"amount": "12.5"}}], {"amount": 9}, (12.5, "GBP")),
        ([{}], {"amount": 9, "currency": None}, (9.0, None)),
        ([{}], {"amount": 0}, (0.0, "GBP")),
        ([], {"currency": "EUR"}, (None, "GBP")),
    ],
)
def test_headline_value(spark, awards, value, expected):
    n = one(spark, changed(awards=awards, tender={"value": value}))
    assert n["reason"] is None and (n["value_amount"], n["currency"]) == expected


@pytest.mark.parametrize(
    "suppliers,expected",
    [
        ([[], [{"name": "B", "identifier": {"id": "2"}}]], ("B", "2")),
        ([[{"name": "", "identifier": {"id": "3"}}]], ("supplier_unknown", "3")),
        ([[{"name": "C"}, {"name": "D"}]], ("C", None)),
        ([[]], ("supplier_unknown", None)),
    ],
)
def test_headline_supplier(spark, suppliers, expected):
    n = one(spark, changed(awards=[{"suppliers": s} for s in suppliers]))
    assert (n["supplier_name"], n["supplier_id"]) == expected


@pytest.mark.parametrize(
    "items,top,expected",
    [
        ([("CPV", "1"), ("cpv", "2"), ("CPV", "1"), ("X", "3"), ("CPV", "")], None, ["1", "2", "1"]),
        ([("CPV", "1")], ("CPV", "9"), ["9", "1"]),
        ([("CPV", "1"), ("CPV", "2")], ("cpv", "2"), ["1", "2"]),
        ([], ("CPV", "9"), ["9"]),
        ([], ("X", "9"), []),
    ],
)
def test_codes(spark, items, top, expected):
    t = {"items": [{"classification": {"scheme": s, "id": i}} for s, i in items]}
    if top:
        t["classification"] = {"scheme": top[0], "id": top[1]}
    assert json.loads(one(spark, changed(tender=t))["cpv_codes"]) == expected


@pytest.mark.parametrize(
    "award,own,expected",
    [
        ({"startDate": "2026-01-01", "endDate": "2025-01-01"}, {}, (None, None)),
        ({"durationInDays": 3}, {"startDate": "2025-01-01"}, ("2025-01-01", None)),
        ({"endDate": "2025-02-01"}, {"startDate": "2025-01-01"}, (None, "2025-02-01")),
        ({}, {"startDate": "2025-01-01", "endDate": "2025-01-02"}, ("2025-01-01", "2025-01-02")),
    ],
)
def test_contract_period(spark, award, own, expected):
    n = one(spark, changed(awards=[{"contractPeriod": award}], tender={"contractPeriod": own}))
    assert tuple(None if n[c] is None else str(n[c]) for c in ("contract_start", "contract_end")) == expected


def test_bad_date_is_null_with_an_issue(spark):
    n = one(spark, changed(date="6 May 2024"))
    assert n["published_date"] is None and n["reason"] is None and n["issue"] == "date text is no date"
    n = one(spark, {**without("date"), "publishedDate": "2024-01-02T03:04:05Z"})
    assert str(n["published_date"]) == "2024-01-02"


def test_title_falls_back_to_planning(spark):
    n = one(spark, {**tender(title=""), "planning": {"project": {"title": "Planned AI"}}})
    assert n["title"] == "Planned AI"


@pytest.mark.parametrize(
    "related,expected",
    [
        ([{"id": "1", "relationship": "Framework agreement"}], "1"),
        ([{"id": "1", "relationship": "parent", "identifier": "p"}, {"relationship": ["x", "FRAMEWORK"], "identifier": "f"}], "f"),
        ([{"relationship": "framework"}, {"relationship": "framework", "identifier": "second"}], None),
        ([], None),
    ],
)
def test_framework(spark, related, expected):
    assert one(spark, changed(relatedProcesses=related))["framework_id"] == expected


def test_lone_surrogate_becomes_question_mark(spark):
    assert one(spark, r'{"ocid":"o","id":"1","tender":{"title":"AI \ud800 x"}}')["title"] == "AI ? x"


def test_stage(spark):
    assert one(spark, {**without("tag"), "stage": "planning"})["stage"] == "planning"
    assert one(spark, changed(tag=[], stage="planning"))["stage"] == "planning"


RAISING = [
    changed(tender=None),
    changed(buyer=None),
    changed(buyer={"name": "B", "identifier": None}),
    {**tender(title=""), "planning": None},
    {**tender(title=""), "planning": {"project": None}},
    tender(items=None),
    tender(items=[{"classification": None}]),
    tender(items=[{"classification": {"scheme": None, "id": "1"}}]),
    tender(classification=None),
    tender(classification={"scheme": None}),
    changed(awards=None),
    changed(awards=[{"value": None}]),
    changed(awards=[], tender={"value": None}),
    changed(awards=[{"suppliers": [{"name": "X", "identifier": None}]}]),
    changed(awards=[{"contractPeriod": {"startDate": None, "endDate": "2025-01-01"}}]),
    changed(awards=[], tender={"contractPeriod": None}),
    changed(awards=[], tender={"contractPeriod": {"startDate": None}}),
    changed(awards=[{"value": {"amount": "many"}}]),
]
READABLE = [
    changed(tag=None),
    changed(date=None),
    changed(relatedProcesses=None),
    tender(documents=None),
    tender(title=None),
    tender(contractPeriod=None),  # never looked at: the award has a period
    {**AWARD, "planning": None},  # never looked at: there is a tender title
    changed(awards=[{"value": {"amount": 1}, "suppliers": None}, {"value": None, "contractPeriod": None}]),
    tender(value=None),  # never looked at: the award has an amount
    tender(description="the value: null"),
]


def test_explicit_nulls(spark):
    reasons = [r["reason"] for r in parse(spark, *RAISING).orderBy("i").collect()]
    assert all(reasons) and len(set(reasons)) >= 15, reasons
    assert [r["reason"] for r in parse(spark, *READABLE).orderBy("i").collect()] == [None] * len(READABLE)
    lenient = [r["reason"] for r in parse(spark, *RAISING, lenient=True).orderBy("i").collect()]
    assert lenient == [None] * (len(RAISING) - 1) + ["amount is no number"]


@pytest.mark.parametrize(
    "release,reason",
    [
        (changed(tender="none"), "tender is no object"),
        (changed(tender=[1]), "tender is no object"),
        (changed(buyer=5), "buyer is no object"),
        (changed(awards="none"), "awards is no list"),
        (changed(awards=""), None),
        (changed(awards={}), None),
        (changed(awards=[]), None),
        (without("buyer"), None),
    ],
)
def test_wrong_types(spark, release, reason):
    n = one(spark, release)
    assert n["reason"] == reason and n["notice_id"] == "ocds-b5fd17-n1::n1-award"


def test_counts_and_split(spark):
    p = parse(spark, AWARD, changed(id="2", tender={"title": "Office cleaning"}, awards=[]), changed(tender=None))
    assert tuple(run_counts(p).first()) == (3, 2, 1, 1)
    assert good(p).count() == 2 and [r["i"] for r in quarantine(p).collect()] == [2]


def test_very_many_documents(spark):
    docs = [{"url": f"u{i % 700}", "title": str(i)} for i in range(5000)]
    n = one(spark, changed(awards=[], tender={"documents": docs}))
    assert [d["title"] for d in json.loads(n["documents"])] == [str(i) for i in range(700)]


def test_merge_is_insert_only(spark):
    empty = spark.createDataFrame([], TABLES["procurement_notices"])
    p = good(parse(spark, AWARD, changed(id="2", tender={"title": "Office cleaning"})))
    first = merge_notices(p, empty, ["i"])
    assert first.count() == 1 and first.columns == TABLES["procurement_notices"].names
    assert merge_notices(p, first, ["i"]).count() == 0
    assert merge_notices(p, empty, ["i"], keep_all=True).count() == 2


def test_first_relevant_duplicate_wins(spark):
    empty = spark.createDataFrame([], TABLES["procurement_notices"])
    p = good(parse(spark, tender(title="Cleaning", description="x", items=[]), tender(title="AI one"), tender(title="AI two")))
    assert [r["title"] for r in merge_notices(p, empty, ["i"]).collect()] == ["AI one"]
    assert [r["title"] for r in merge_notices(p, empty, ["i"], keep_all=True).collect()] == ["Cleaning"]


def test_dedup_keeps_the_richest(spark):
    rows = [
        ("t", "contracts_finder", "COMIT4 Imaging Framework", 100.0, "NHS X", "supplier_unknown", None, "2024-01-03", True),
        ("a", "contracts_finder", "ComIT 4 imaging framework", 100.0, "nhs x", "Maker", "[{}]", "2024-01-01", True),
        ("f", "find_a_tender", "Comit4 Imaging-Framework", 100.0, " NHS X ", "Maker", None, "2024-01-09", True),
        ("other", "find_a_tender", "Comit4 Imaging-Framework", 101.0, "NHS X", "Maker", None, "2024-01-09", True),
        ("no", "find_a_tender", "Comit4 Imaging-Framework", 100.0, "NHS X", "Maker", "[{}]", "2024-01-09", False),
    ]
    df = spark.createDataFrame(
        rows, "notice_id string, source string, title string, value_amount double, buyer_name string, "
        "supplier_name string, awards string, published_date string, ai_relevant boolean"
    ).withColumn("published_date", F.col("published_date").cast("date"))
    assert sorted(r["notice_id"] for r in procurement_dedup(df).collect()) == ["a", "other"]
    long = df.limit(1).withColumn("title", F.explode(F.array(F.lit("x" * 50 + "1"), F.lit("X " * 50 + "2"))))
    assert procurement_dedup(long).count() == 1


def test_dedup_and_keep_first_cut_groups_before_the_shuffle(spark):
    df = parse(spark, AWARD)
    plan = procurement_dedup(good(df))._jdf.queryExecution().executedPlan().toString()
    before = plan.split("Exchange hashpartitioning", 1)[1]
    assert plan.count("WindowGroupLimit") == 2 and "WindowGroupLimit" in before


def test_parse_happens_once(spark):
    plan = good(parse(spark, AWARD)).select("notice_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(ocid") == 1


@pytest.mark.parametrize(
    ("release", "reason"),
    [
        (tender(items={"id": "1"}), "tender.items is no list"),
        (tender(documents={"url": "u"}), "tender.documents is no list"),
        (tender(value=5), "tender.value is no object"),
        (tender(classification="CPV"), "tender.classification is no object"),
        (changed(buyer={"name": "B", "identifier": "x"}), "buyer.identifier is no object"),
        (changed(tag="award"), "tag is no list"),
        (changed(tender={"status": "open"}, planning="soon"), "planning is no object"),
        (changed(planning="soon"), None),  # not looked at beside a tender title
        (changed(awards={"id": "a"}), "awards is no list"),
        (changed(awards=[{"value": 7}]), "award value is no object"),
        (changed(awards=[{"suppliers": {"name": "x"}}]), "award suppliers is no list"),
        (changed(awards=[{"documents": "x"}]), "award documents is no list"),
        (changed(awards=[{"contractPeriod": "2024"}]), "award contract period is no object"),
        (tender(items=["x"]), "tender.items element is no object"),
        (tender(items=[{"id": "1"}, {"classification": "CPV"}]), "tender.items element.classification is no object"),
        (tender(items=[{"classification": {"scheme": 7, "id": "1"}}]), "tender.items element.classification.scheme is no text"),
        (tender(items=[{"id": "1"}, {"classification": {"id": "7"}}]), None),
        (tender(items=""), None),  # nothing is read from it
        (tender(items={}), None),
        (tender(documents=["u"]), "tender.documents element is no object"),
        (tender(title={"en": "AI"}), "tender.title is no text"),
        (tender(title=["AI"]), "tender.title is no text"),
        (tender(title=12), "tender.title is no text"),
        (tender(title="12"), None),
        (tender(title="{AI}"), None),
        (tender(description=False), "tender.description is no text"),
        (tender(classification={"scheme": ["CPV"]}), "tender.classification.scheme is no text"),
        (changed(date=20240101), "date is no text"),
        (changed(relatedProcesses=["framework"]), "relatedProcesses element is no object"),
        (changed(awards=["won"]), "awards element is no object"),
        (changed(awards=[{"suppliers": ["Acme"]}]), "award supplier is no object"),
        (changed(awards=[{"suppliers": [{"name": "A", "identifier": "GB-1"}]}]), "supplier identifier is no object"),
        (changed(awards=[{"suppliers": [{"name": "A"}]}, {"suppliers": [{"name": "B", "identifier": "not read"}]}]), None),
        (changed(awards=[{"suppliers": []}, {"suppliers": [{"identifier": 5}]}]), "supplier identifier is no object"),
        (changed(awards=[{"documents": ["u"]}]), "award documents element is no object"),
        (changed(id=0), "no ocid or id"),
        (changed(id="0"), None),
        (changed(id=7), None),
    ],
)
def test_every_wrongly_typed_part_has_a_reason(spark, release, reason):
    assert one(spark, release)["reason"] == reason


def test_a_key_given_twice_does_not_hide_a_null(spark):
    text = json.dumps(without("awards"))[:-1] + ', "x": 1, "x": 2, "awards": null}'
    assert one(spark, text)["reason"] == "explicit nulls cannot be told"


def test_only_releases_with_a_key_that_was_not_read_are_looked_into(spark):
    """A release without some part, though its name stands elsewhere, is no reason to go through the whole table of kinds."""
    second = {"id": "a2", "value": {"amount": 1}}  # lacks parts that the other award has
    plain = {**AWARD, "tag": ["tender"], "stage": "planning", "tender": {"title": "items"}, "awards": [*AWARD["awards"], second]}
    wrong = {**plain, "awards": [*AWARD["awards"], {**second, "contractPeriod": "x"}]}
    escaped = json.dumps(wrong).replace('"contractPeriod": "x"', '"contract\\u0050eriod": "x"')
    texts = [json.dumps(plain), json.dumps(wrong), escaped, json.dumps({**plain, "title": "Children's \u2019"})]
    rows = with_release(spark.createDataFrame(list(enumerate(texts)), "k int, release string"))
    looked = rows.select("k", "suspect", ocds.miscounted("release", F.col("r"), F.col("aw")).alias("m")).orderBy("k").collect()
    assert [r["suspect"] for r in looked] == [True] * 4 and [r["m"] for r in looked] == [False, True, True, False]
    parsed = parse_releases(rows.select("k", "release"), "contracts_finder").orderBy("k").collect()
    assert [r["reason"] for r in parsed][1:3] == ["award contract period is no object"] * 2


def test_kinds_are_told_by_the_parse_itself(spark):
    """A part that stands in the awards only is no reason for another parse; one that is of a wrong kind is, whatever else the text holds."""
    plain = {**AWARD, "tender": {"title": "AI", "items": []}}
    wrong = [{**plain, "tender": {**plain["tender"], "contractPeriod": "2024"}}, {**plain, "buyer": {"name": "b", "identifier": 5}}, {**plain, "planning": []}]
    texts = [json.dumps(plain), json.dumps({**plain, "unread": {"a": 1}}), *map(json.dumps, wrong)]
    rows = with_release(spark.createDataFrame(list(enumerate(texts)), "k int, release string")).orderBy("k")
    assert [(r["suspect"], r["v"] is not None) for r in rows.collect()] == [(False, False)] * 2 + [(True, True)] * 3
    parsed = parse_releases(rows.select("k", "release"), "contracts_finder").orderBy("k").collect()
    assert [r["reason"] for r in parsed] == [None, None, "tender.contractPeriod is no object", "buyer.identifier is no object", None]
