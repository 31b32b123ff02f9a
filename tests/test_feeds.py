"""Announcements, questions, transparency records and landed pages."""

from __future__ import annotations

import json
import time
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from noticeworks.operators.merge import (
    duplicate_keys,
    merge_announcements,
    merge_questions,
    merge_records,
)
from noticeworks.plans.feeds import parse_announcements, parse_questions, parse_records
from noticeworks.schemas import TABLES
from noticeworks.sources.html import read_sections
from noticeworks.sources.pages import (
    candidate_filter,
    cap_per_query,
    count_items,
    explode_items,
    first_wins_union,
    read_bronze,
    read_pages,
    write_bronze,
)


def items(spark, *objects):
    return spark.createDataFrame(
        [(i, o if isinstance(o, str) else json.dumps(o)) for i, o in enumerate(objects)], "i int, item string"
    )


def empty(spark, name):
    return spark.createDataFrame([], TABLES[name])


NEWS = {
    "link": "/government/news/ai-plan",
    "title": "AI plan published",
    "description": "Machine learning for all.",
    "content_store_document_type": "press_release",
    "public_timestamp": "2025-03-31T23:30:00-05:00",
    "organisations": [
        {"link": "/government/organisations/dsit/", "acronym": "DSIT", "title": "Science"},
        {"title": "Nameless"},
    ],
}


def test_announcement(spark):
    a = parse_announcements(items(spark, NEWS)).first()
    assert a["announcement_id"] == NEWS["link"] and a["source_url"] == "https://www.gov.uk" + NEWS["link"]
    assert (a["document_type"], a["summary"], a["ai_confidence"]) == ("press_release", NEWS["description"], "strong")
    assert a["public_timestamp"] == datetime(2025, 4, 1, 4, 30)
    assert json.loads(a["organisations"]) == [
        {"slug": "dsit", "acronym": "DSIT", "title": "Science"},
        {"slug": None, "acronym": None, "title": "Nameless"},
    ]


def test_announcement_edges(spark):
    plain = {"link": "/x", "title": "Office move", "organisations": []}
    rows = parse_announcements(items(spark, plain, {"title": "AI"}, {**NEWS, "public_timestamp": "soon"})).orderBy("i").collect()
    assert (rows[0]["ai_confidence"], rows[0]["organisations"], rows[0]["reason"]) == ("none", None, None)
    assert rows[1]["reason"] == "no link"
    assert (rows[2]["public_timestamp"], rows[2]["issue"]) == (None, "date text is no date")


def test_merge_announcements(spark):
    batch = parse_announcements(items(spark, NEWS, {"link": "/x", "title": "Office move"}, {**NEWS, "title": "AI later"}))
    first = merge_announcements(batch, empty(spark, "gov_announcements"), ["i"])
    assert [r["title"] for r in first.collect()] == ["AI plan published"]
    assert merge_announcements(batch, first, ["i"]).count() == 0
    assert merge_announcements(batch, empty(spark, "gov_announcements"), ["i"], keep_all=True).count() == 2


QUESTION = {
    "id": 17,
    "uin": "HL1",
    "house": "Lords",
    "dateTabled": "2025-02-03T00:00:00",
    "dateAnswered": "2025-02-10T00:00:00",
    "askingMember": {"name": "Lord A"},
    "answeringBodyName": "Home Office",
    "heading": "Facial Recognition",
    "questionText": "To ask about cameras.",
    "answerText": "No.",
}


def test_question(spark):
    q = parse_questions(items(spark, QUESTION)).first()
    assert (q["question_id"], q["house"], q["member_name"], q["department"]) == ("17", "Lords", "Lord A", "Home Office")
    assert (str(q["date_tabled"]), str(q["date_answered"])) == ("2025-02-03", "2025-02-10")
    assert q["ai_relevance_flag"] and q["source_url"].endswith("/written-questions/detail/2025-02-03/HL1")


def test_question_edges(spark):
    other = {"id": 0, "heading": "Artificial Insemination", "questionText": "Cows?", "answerText": "AI", "askingMember": {"name": "", "listAs": "B, Lord"}}
    rows = parse_questions(items(spark, other, {"heading": "AI"}, {**QUESTION, "id": None}, {**QUESTION, "uin": ""})).orderBy("i").collect()
    assert (rows[0]["question_id"], rows[0]["ai_relevance_flag"], rows[0]["member_name"]) == ("0", False, "B, Lord")
    assert rows[0]["source_url"] is None and rows[0]["date_answered"] is None and rows[0]["reason"] is None
    assert [r["reason"] for r in rows[1:]] == ["no id", "no id", None] and rows[3]["source_url"] is None


def test_merge_questions(spark):
    batch = parse_questions(items(spark, QUESTION, {"id": 2, "heading": "Cows"}, QUESTION))
    first = merge_questions(batch, empty(spark, "written_questions"), ["i"])
    assert first.count() == 1 and merge_questions(batch, first, ["i"]).count() == 0


BODY = """
<h2 id="s">1</h2><h3 id="name">Name</h3><p>Helper</p>
<h3 id="model-architecture">33</h3><p>Large <b>language</b> model.</p><div><p>not beside it</p></div><p>Second</p>
<h3>No id</h3><p>dropped</p>
<h3 id="sensitive-attributes">47</h3><p>NINOs.</p><ul><li>age</li><li> sex </li></ul>
<h3 id="sensitive-attributes-1">54</h3><p>None used.</p>
<h3 id="sensitive-attributesX">55</h3><p>Not this.</p>
<h2>5</h2><h3 id="impact-assessments">58</h3><ul><li><a href="https://no.test">in a list</a></li></ul>
<p>See <a href="/local">a</a> <a href="https://yes.test/dpia">b</a><a href="https://late.test">c</a></p>
"""
RECORD = {
    "base_path": "/records/helper/",
    "title": "NHS England : Helper: v2",
    "description": "Helps.",
    "details": {
        "metadata": {
            "algorithmic_transparency_record_atrs_version": "v4.0",
            "algorithmic_transparency_record_date_published": "2025-05-28",
            "algorithmic_transparency_record_phase": "pilot",
        },
        "body": BODY,
    },
}


def test_record(spark):
    r = parse_records(items(spark, RECORD)).first()
    assert (r["record_id"], r["organisation_name"], r["phase"]) == ("helper", "NHS England", "pilot")
    assert (str(r["date_published"]), r["standard_version"]) == ("2025-05-28", "v4.0")
    assert r["model_architecture"] == "Large language model. Second"
    assert r["sensitive_attributes"] == "NINOs. age, sex | None used."
    assert r["dpi_assessment_url"] == "https://yes.test/dpia"
    assert r["source_url"] == "https://www.gov.uk/records/helper/"


def test_record_edges(spark):
    bare = {"base_path": "/records/x", "title": "\tSome Council Tool "}
    no_body = {**RECORD, "details": {"body": ""}}
    rows = parse_records(
        items(spark, bare, {"title": "No path"}, no_body, {**RECORD, "title": None}, {**RECORD, "details": None}, {**RECORD, "details": {"body": None}})
    ).orderBy("i").collect()
    assert rows[0]["organisation_name"] == "Some Council Tool" and rows[0]["reason"] is None
    assert rows[0]["model_architecture"] is None and rows[2]["dpi_assessment_url"] is None
    assert [r["reason"] for r in rows[1:]] == ["no base_path", None, "title is null", "details is null", "details.body is null"]


@pytest.mark.parametrize(
    "html,expected",
    [
        ("", []),
        ("<p>no heading</p>", []),
        ("<h3 id=a>x</h3><p>one<p>two</p></p>", [("a", "one two")]),
        ("<h3 id=a></h3><p>1</p><h3 id=b></h3><p>2</p><h3 id=a></h3><p>3</p>", [("a", "3"), ("b", "2")]),
        ("<div><h3 id=a></h3></div><p>outside</p>", [("a", "")]),
        ("<h3 id=a></h3><p>a &amp; b<script>x()</script><!-- c --><br>c</p>", [("a", "a & b c")]),
        ("<h3 id=a></h3><ul><li>x<ul><li>y</li></ul></li><li></li></ul>", [("a", "xy, y,")]),
        ("<h3 id=a></h3><p></p><p> </p><p>z</p></section>", [("a", "z")]),
        ("<H3 ID=Up></H3><P>t</P>", [("Up", "t")]),
    ],
)
def test_sections(html, expected):
    assert [(s["id"], s["text"]) for s in read_sections(html)] == expected


def test_deep_markup_is_read_without_recursion():
    assert read_sections("<h3 id=a></h3><p>" + "<i>" * 5000 + "deep")[0]["text"] == "deep"


def test_merge_records(spark):
    other = {**RECORD, "base_path": "/records/other"}
    batch = parse_records(items(spark, RECORD, other))
    first = merge_records(batch, empty(spark, "atrs_records"))
    assert first.count() == 2 and merge_records(batch, first).count() == 0
    assert merge_records(batch.limit(0), first).count() == 0
    twice = parse_records(items(spark, RECORD, RECORD))
    assert [tuple(r) for r in duplicate_keys(twice, "record_id").collect()] == [("helper", 2)]
    with pytest.raises(PySparkException, match="more than once"):
        merge_records(twice, empty(spark, "atrs_records")).collect()
    assert merge_records(twice, first).count() == 0


def test_pages(spark, tmp_path):
    (tmp_path / "p1.json").write_text('{"results": [{"value": {"id": 1}},\n {"id": 2}], "total": 2}')
    (tmp_path / "p2.json").write_text('{"results": []}')
    (tmp_path / "p3.json").write_text("{}")
    pages = read_pages(spark, str(tmp_path))
    got = explode_items(pages, unwrap="value").orderBy("pos").collect()
    assert [(r["page"], r["pos"], json.loads(r["item"])) for r in got] == [("p1.json", 0, {"id": 1}), ("p1.json", 1, {"id": 2})]
    assert [r[0] for r in pages.orderBy("page").select(count_items("body")).collect()] == [2, 0, 0]


@pytest.mark.parametrize("cap", [1, 100, 250, 300, 5000])
def test_cap_counts_whole_pages(spark, cap):
    sizes = [100, 100, 100, 40, 0, 100]
    rows = [(q, i, n) for q in ("a", "b") for i, n in enumerate(sizes)]
    got = cap_per_query(spark.createDataFrame(rows, "q string, start int, n int"), "q", "start", "n", cap)
    want, seen = [], 0
    for i, n in enumerate(sizes):
        if seen >= cap:
            break
        want.append(i)
        if n == 0:
            break
        seen += n
    assert sorted((r["q"], r["start"]) for r in got.collect()) == [(q, i) for q in ("a", "b") for i in want]


def test_first_wins_union(spark):
    df = spark.createDataFrame([("x", 1, "late"), ("x", 0, "first"), ("", 0, "no"), (None, 0, "no"), ("y", 2, "only")], "k string, q int, v string")
    assert sorted(r["v"] for r in first_wins_union(df, "k", ["q"]).collect()) == ["first", "only"]
    numbers = spark.createDataFrame([(0, 1), (0, 0), (None, 0)], "k int, q int")
    assert [tuple(r) for r in first_wins_union(numbers, "k", ["q"]).collect()] == [(0, 0)]


def test_candidates(spark):
    df = items(spark, NEWS, {**NEWS, "content_store_document_type": "manual"}, {**NEWS, "organisations": []})
    df = df.select("i", F.from_json("item", "struct<content_store_document_type string, organisations array<struct<link string>>>").alias("r")).select("i", "r.*")
    ids = lambda **o: [r["i"] for r in candidate_filter(df, "content_store_document_type", "organisations", **o).collect()]
    assert ids() == [0, 2] and ids(slugs=("dsit",)) == [0] and ids(slugs=("x",)) == []


def test_bronze_is_idempotent_per_page(spark, tmp_path):
    root = str(tmp_path / "bronze")

    def land(run, *rows):
        df = spark.createDataFrame([(p, b, "wpq", "2025-01-01") for p, b in rows], "page string, body string, source string, run_date string")
        write_bronze(df.withColumn("run_date", F.col("run_date").cast("date")), root, run)

    land("10", ("page_0001", "a"), ("page_0002", "b"))
    land("11", ("page_0001", "A"))
    land("11", ("page_0001", "A"))
    assert sorted((r["page"], r["body"]) for r in read_bronze(spark, root).collect()) == [("page_0001", "A"), ("page_0002", "b")]


def test_section_reader_travels_without_the_package(tmp_path):
    import subprocess
    import sys

    from pyspark import cloudpickle

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(read_sections))
    code = "import pickle; f = pickle.load(open('f.pkl', 'rb')); print(f('<h3 id=a></h3><p>x</p>')[0]['text'])"
    done = subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.strip() == "x", done.stderr


@pytest.mark.parametrize(
    "page",
    [
        lambda n: '<div><h3 id="a">x</h3><p>y' * n,  # as deep as the page is long
        lambda n: '<h3 id="a">x</h3>' + "<p>" * n + "</em>" * n,  # end tags of what was never opened
        lambda n: '<h3 id="a">x</h3>' + "<ul><li>z" * n,
        lambda n: '<h3 id="a">x</h3><p>' + "<template>y" * n,
    ],
)
def test_deep_nesting_takes_linear_time(page):
    read_sections(page(500))
    took = []
    for n in (4000, 32_000):
        start = time.perf_counter()
        read_sections(page(n)) if "<ul>" not in page(1) else read_sections(page(n // 100))  # its text is quadratic: items in items
        took.append(time.perf_counter() - start)
    assert took[1] < 24 * took[0] + 0.2


def test_unshown_text_counts_where_it_is_asked_for():
    html = '<h3 id="a">1</h3><p>x<template>t<p>u</p></template>y</p><template><h3 id="b">2</h3><p>in <script>s</script>it</p></template>'
    assert [(s["id"], s["text"]) for s in read_sections(html)] == [("a", "x y"), ("b", "in it")]


def test_unclosed_paragraphs_take_linear_time():
    import time

    start = time.time()
    assert read_sections("<h3>none</h3>" + "<p>" * 50_000 + "x<h3 id=a></h3><p>text</p>")[0]["text"] == "text"
    assert time.time() - start < 5


def test_pages_are_loaded_once_and_in_page_order(spark, tmp_path):
    from pyspark.sql import Observation

    from noticeworks.plans.feed_loads import ANNOUNCEMENTS, load_feed
    from noticeworks.plans.store import read_runs

    def item(link, title, kind="news_story"):
        return {"link": link, "title": title, "content_store_document_type": kind}

    pages = {
        "page-2.json": [item("/a", "AI second"), item(None, "AI nowhere"), item("/b", "Cleaning")],
        "page-10.json": [item("/a", "AI tenth"), item("/c", "AI guide", "manual"), item("/d", "AI plan", "policy_paper")],
    }
    for name, items in pages.items():
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(json.dumps({"results": items}))
    counts = Observation()
    paths = f"{tmp_path}/in", f"{tmp_path}/table"
    assert load_feed(spark, *paths, ANNOUNCEMENTS, run="x", counts=counts, quarantine_path=f"{tmp_path}/bad") == 2
    assert counts.get == {"n_rows": 5, "n_parsed": 4, "n_relevant": 3, "n_errors": 1}
    want = [("/a", "AI second"), ("/d", "AI plan")]
    assert sorted((r["announcement_id"], r["title"]) for r in read_runs(spark, paths[1], "gov_announcements").collect()) == want
    assert load_feed(spark, *paths, ANNOUNCEMENTS) == 0 and load_feed(spark, *paths, ANNOUNCEMENTS, run="x") == 2
    assert read_runs(spark, paths[1], "gov_announcements").count() == 2
    bad = spark.read.parquet(f"{tmp_path}/bad").collect()
    assert [(r["file"], r["reason"]) for r in bad] == [("page-2.json", "no link")]
