"""Organisations, analytical views, report operators, formats and exports."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from noticeworks import fixed_values as fixed
from noticeworks.functions.display import money, money_bn, supplier_summary
from noticeworks.functions.text import last_segment, strip, text_key, to_day, to_instant, to_number, version_label
from noticeworks.operators import lookup, orgs
from noticeworks.operators.dedup import first_n_per_key, keep_first
from noticeworks.operators.lookup import is_small, measured
from noticeworks.operators.median import exact_median
from noticeworks.operators.merge import known_keys
from noticeworks.operators.orgs import alias_join, resolve, unmatched_names
from noticeworks.plans import explore, export, gold
from noticeworks.schemas import TABLES, append_by_name, columns, conform, create_tables, empty, evolve, read_table, shipped_aliases, shipped_growth_zones
from noticeworks.sources.pages import run_order
from noticeworks.sources.seeds import read_seed_csv


def table(spark, name, *rows):
    """Rows given as dicts, put into a registered table."""
    schema = TABLES[name]
    text = ", ".join(f"{f.name} string" for f in schema)
    return conform(spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], text), schema)


ALIASES = [("MoD", "Ministry of Defence"), ("MOD", "Ministry of Defence"), ("Home Office", "Home Office"), ("DfE", "Education")]


@pytest.fixture
def aliases(spark):
    return table(spark, "org_aliases", *[{"raw_name": a, "canonical_name": b} for a, b in ALIASES])


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def test_resolve(spark, aliases):
    got = {r["name"]: r["canonical_name"] for r in resolve(names(spark, " mod ", "HOME OFFICE", "x", None), "name", aliases).collect()}
    assert got == {" mod ": "Ministry of Defence", "HOME OFFICE": "Home Office", "x": None, None: None}


def test_alias_join_fans_out_as_the_table_does(spark, aliases):
    df = names(spark, "mod", "x", "dfe")
    assert alias_join(df, "name", aliases).count() == 3
    assert alias_join(df, "name", aliases, "distinct").count() == 2


def test_unmatched_names(spark, aliases):
    df = names(spark, "Zed", " zed", "mod", None, "Abc")
    rows = lambda a: [r["raw"] for r in unmatched_names(df, "name", a).collect()]
    assert rows(aliases) == ["abc", "zed"]
    assert rows(aliases.limit(0)) == ["abc", "mod", "zed", None]
    assert rows(aliases.unionByName(table(spark, "org_aliases", {"raw_name": None}))) == []


def test_lookup_is_broadcast_only_when_small(spark, monkeypatch):
    left, right = names(spark, *"abc"), names(spark, *"ab")
    join = lambda: left.join(measured(right), "name")
    plan = lambda: join()._jdf.queryExecution().optimizedPlan().toString()
    assert is_small(right) and not is_small(right, rows=1) and not is_small(right, size=10)
    assert "strategy=broadcast" in plan()
    monkeypatch.setattr(lookup, "is_small", lambda df: False)
    assert "broadcast" not in plan()
    assert sorted(r[0] for r in join().collect()) == ["a", "b"]
    assert [r[0] for r in known_keys(left, right, "name").orderBy("name").collect()] == ["a", "b"]


def notice(i, buyer, value, day, **more):
    return {"notice_id": str(i), "buyer_name": buyer, "value_amount": value, "published_date": day, "currency": "GBP",
            "title": f"t{i}", "source": "find_a_tender", "ai_relevant": "true", "ai_confidence": "strong", **more}


@pytest.fixture
def notices(spark):
    return table(
        spark,
        "procurement_notices",
        notice(1, "mod", "100.5", "2025-01-03", contract_status="awarded", supplier_name="S"),
        notice(2, "MOD ", "50", "2025-01-30", contract_status="open"),
        notice(3, "Home Office", None, None, contract_status="planned"),
        notice(4, "Nowhere", "7", "2025-02-01", contract_status="awarded", source="contracts_finder", ai_confidence="weak"),
        notice(5, "Home Office", None, "2025-02-02", currency="EUR", contract_status="odd"),
        notice(6, "mod", "1", "2025-01-01", ai_relevant="false"),
    )


def test_reporting_gap(spark, notices, aliases):
    records = table(spark, "atrs_records", {"record_id": "r1", "organisation_name": "MoD"}, {"record_id": "r2", "organisation_name": "dfe "}, {"record_id": "r3", "organisation_name": "?"})
    got = [tuple(r) for r in gold.reporting_gap(gold.procurement_dedup(notices), records, aliases).collect()]
    assert got == [("Home Office", 2, 0), ("Ministry of Defence", 2, 1), ("Education", 0, 1)]
    gap = gold.reporting_gap(gold.procurement_dedup(notices), records, aliases)
    assert explore.gap_top(gap, 1).count() == 1
    assert sorted(map(tuple, explore.gap_long(explore.gap_top(gap)).collect()))[:2] == [
        ("Education", "AI-flagged contracts", 0),
        ("Education", "ATRS registrations", 1),
    ]


def test_spend_by_month(spark, notices, aliases):
    dd = gold.procurement_dedup(notices)
    rows = lambda p: {(r["canonical_name"], str(r["month"])[:7], r["currency"]): (r["total_value"], r["notice_count"]) for r in gold.spend_by_month(dd, aliases, p).collect()}
    once, as_is = rows("distinct"), rows("as_is")
    assert once == {
        ("Ministry of Defence", "2025-01", "GBP"): (150.5, 2),
        ("Home Office", "None", "GBP"): (None, 1),
        ("Home Office", "2025-02", "EUR"): (None, 1),
    }
    assert as_is[("Ministry of Defence", "2025-01", "GBP")] == (301.0, 4)


def test_trends_keep_null_groups_and_reports_drop_them(spark):
    q = table(
        spark,
        "written_questions",
        {"question_id": "1", "department": "A", "date_tabled": "2025-01-02", "ai_relevance_flag": "true", "question_text": "x" * 200},
        {"question_id": "2", "department": "A", "date_tabled": "2025-01-20", "ai_relevance_flag": "true"},
        {"question_id": "3", "department": None, "date_tabled": None, "ai_relevance_flag": "true"},
        {"question_id": "4", "department": "B", "date_tabled": "2025-01-20", "ai_relevance_flag": "false"},
    )
    assert [(r["department"], r["question_count"]) for r in gold.question_trends(q).collect()] == [("A", 2), (None, 1)]
    assert [r["count"] for r in explore.monthly_counts(q, "date_tabled").collect()] == [3]
    assert [tuple(r) for r in explore.top_groups(q, "department", 1).collect()] == [("A", 2)]
    assert [r["Tabled"] for r in explore.question_listing(q).collect()] == ["2025-01-20", "2025-01-20", "2025-01-02"]
    assert [len(r["Question"]) for r in explore.question_listing(q).collect()] == [0, 0, 160]
    assert [tuple(r) for r in explore.group_sizes(q, "department").collect()] == [("B", 1), ("A", 2)]


def test_month_is_a_utc_month(spark):
    a = table(spark, "gov_announcements", {"announcement_id": "1", "public_timestamp": "2025-03-31T23:30:00-05:00", "ai_relevant": "true", "document_type": "speech"})
    assert str(gold.announcement_trends(a).first()["month"]) == "2025-04-01 00:00:00"
    assert explore.announcement_listing(a).first()["Published"] == "2025-04-01"


def test_kpis(spark, notices):
    k = explore.kpis(notices).first().asDict()
    assert k == {"n_contracts": 6, "spend": 158.5, "n_awarded": 2, "n_open": 1, "n_planned": 1, "awarded_value": 107.5, "median_value": 28.5}
    none = explore.kpis(notices.limit(0)).first()
    assert (none["n_contracts"], none["spend"], none["median_value"]) == (0, 0.0, None)
    assert tuple(explore.source_counts(notices).first()) == (6, 1, 5)
    assert explore.confident(notices).count() == 5 and explore.confident(notices, False).count() == 6


def test_monthly_by_source_drops_undated_and_sums_to_zero(spark, notices):
    got = {(str(r["month"])[:7], r["source"]): (r["value"], r["notices"]) for r in explore.monthly_by_source(notices).collect()}
    assert got == {("2025-01", "find_a_tender"): (151.5, 3), ("2025-02", "contracts_finder"): (7.0, 1), ("2025-02", "find_a_tender"): (0.0, 1)}


def test_status_labels_and_top_contracts(spark, notices):
    assert [r[0] for r in explore.present_status_labels(notices).collect()] == ["Awarded", "Out to tender", "Planned", "Unknown"]
    top = explore.top_contracts(notices, 3).collect()
    assert [r["Value"] for r in top] == ["£100", "£50", "£7"] and top[0]["Supplier(s)"] == "S" and top[1]["Supplier(s)"] == "—"
    assert [r["Value"] for r in explore.top_contracts(notices).collect()][-2:] == ["—", "—"]


@pytest.mark.parametrize(
    "awards,name,expected",
    [
        ('[{"suppliers":[{"name":"B"},{"name":"A"}]},{"suppliers":null},{"suppliers":[{"name":"B"},{"name":""}]}]', "B", "B  +1"),
        ('[{"suppliers":[{"name":"B"}]}]', "x", "B"),
        ("[{}]", "Fallback", "Fallback"),
        ("{broken", "Fallback", "Fallback"),
        (None, "supplier_unknown", "—"),
        (None, None, "—"),
    ],
)
def test_supplier_summary(spark, awards, name, expected):
    df = spark.createDataFrame([(awards, name)], "a string, n string")
    assert df.select(supplier_summary("a", "n")).first()[0] == expected


def test_money_formats_equal_python(spark):
    rng = random.Random(5)
    values = [0.0, 0.5, 1.5, 2.5, -0.5, 1234567.5, 0.15e9, 0.25e9, 8.25e9, 1.05e9, 2.5e9, 1e15] + [rng.uniform(-1, 1) * 10 ** rng.randint(0, 12) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", money("v").alias("m"), money_bn("v").alias("b")).collect():
        assert r["m"] == f"£{r['v']:,.0f}", r
        assert r["b"] == f"£{r['v'] / 1e9:.1f}bn", r
    nulls = spark.createDataFrame([(None,), (0.0,)], "v double")
    assert [tuple(r) for r in nulls.select(money("v"), money_bn("v"), money_bn("v", True)).collect()] == [("—", "—", "—"), ("£0", "£0.0bn", "—")]


def test_text_helpers(spark):
    df = spark.createDataFrame([("vv2",), ("unknown",), (None,), ("v",), ("3.0",)], "v string")
    assert [r[0] for r in df.select(version_label("v")).collect()] == ["v2", "unknown", "unknown", "v", "v3.0"]
    df = spark.createDataFrame([("/a/b//",), ("/",), ("",), ("x",)], "p string")
    assert [r[0] for r in df.select(last_segment("p")).collect()] == ["b", None, None, "x"]
    df = spark.createDataFrame([("2025-02-28",), ("2025-02-30",), ("2025-2-3",), ("2025",), (None,)], "d string")
    assert [r[0] and str(r[0]) for r in df.select(to_day("d")).collect()] == ["2025-02-28", None, None, None, None]
    df = spark.createDataFrame([(" 12.5 ",), ("1e3",), ("x",), ("",)], "n string")
    assert [r[0] for r in df.select(to_number("n")).collect()] == [12.5, 1000.0, None, None]
    one = spark.range(1).select(strip(F.lit(" \t a b  \n")), text_key(F.lit(" COMIT4 É-x")), text_key(F.lit("abc"), 2)).first()
    assert tuple(one) == ("a b", "comit4x", "ab")


def test_text_search_is_a_regular_expression(spark):
    df = spark.createDataFrame([("Fraud", None), (None, "dwp tool"), ("x", "y")], "a string, b string")
    assert explore.text_search(df, ["a", "b"], "FRAUD|d.p").count() == 2
    assert explore.text_search(df, ["a", "b"], "").count() == 3
    assert explore.filter_in(df, "a", ["x"]).count() == 1 and explore.filter_in(df, "a", None).count() == 3


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1001])
@pytest.mark.parametrize("kind", ["spread", "skewed", "ties", "huge"])
def test_exact_median(spark, n, kind):
    rng = random.Random(n)
    make = {
        "spread": lambda: rng.uniform(-1e6, 1e6),
        "skewed": lambda: math.exp(rng.uniform(-30, 30)),
        "ties": lambda: float(rng.choice([1, 1, 1, 2, 50])),
        "huge": lambda: rng.choice([-8e307, 8e307, 0.0, 1.0]),
    }[kind]
    values = [make() for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    assert exact_median(df, "v", buckets=8, direct=3) == exact_median(df, "v") == statistics.median(values)


def test_median_takes_two_scans(spark, monkeypatch):
    """One for counts and bounds, one to rank what lies between; more only where too much lies between."""
    df = spark.range(20_001).select((F.col("id") * 7919 % 20_011).alias("v"))
    kind, scans = type(df), []
    first, collect = kind.first, kind.collect
    monkeypatch.setattr(kind, "first", lambda self: scans.append(1) or first(self))
    monkeypatch.setattr(kind, "collect", lambda self: scans.append(1) or collect(self))
    want = statistics.median(i * 7919 % 20_011 for i in range(20_001))
    assert exact_median(df, "v", direct=1000) == want and len([1 for _ in scans]) <= 4  # first() collects, too
    seen = len(scans)
    assert exact_median(df, "v", buckets=16, direct=5) == want and len(scans) > seen + 4


def test_median_of_nothing(spark):
    assert exact_median(spark.createDataFrame([(None,)], "v double"), "v") is None


def test_first_n_per_key_beyond_the_group_limit(spark):
    df = spark.range(6000).select((F.col("id") % 2).alias("k"), "id")
    assert first_n_per_key(df, "k", ["id"], 1500).agg(F.max("id"), F.count("*")).first() == (2999, 3000)
    assert [r["id"] for r in keep_first(df, "k", [F.col("id").desc()]).orderBy("id").collect()] == [5998, 5999]


def test_schemas(spark, tmp_path):
    old = spark.createDataFrame([("1", "T", 5)], "notice_id string, title string, extra int")
    schema = TABLES["procurement_notices"]
    new = evolve(old, schema)
    assert set(new.columns) == set(schema.names) | {"extra"} and evolve(new, schema).columns == new.columns
    assert new.first()["title"] == "T" and dict(new.dtypes)["value_amount"] == "double"
    assert evolve(spark.createDataFrame([("q",)], "question_id string"), TABLES["written_questions"]).count() == 1
    rows = append_by_name(conform(old, schema), spark.createDataFrame([("2025-01-02", "2"), ("bad", "3")], "published_date string, notice_id string"))
    assert {r["notice_id"]: r["published_date"] and str(r["published_date"]) for r in rows.collect()} == {"1": None, "2": "2025-01-02", "3": None}
    made = create_tables(spark, str(tmp_path))
    assert set(made) == set(TABLES) and create_tables(spark, str(tmp_path)) == []
    assert read_table(spark, f"{tmp_path}/datacentre_planning", TABLES["datacentre_planning"]).count() == 0


def test_seed_csv(spark, tmp_path):
    path = tmp_path / "z.csv"
    path.write_text('id,name,money,day,note\na,"One, two",8200000000,2026-01-29,"said ""yes"""\nb,NA,,,\n', encoding="utf-8")
    rows = read_seed_csv(spark, str(path), columns("id string, name string, money double, day date, note string")).orderBy("_ord").collect()
    assert (rows[0]["name"], rows[0]["money"], str(rows[0]["day"]), rows[0]["note"]) == ("One, two", 8.2e9, "2026-01-29", 'said "yes"')
    assert tuple(rows[1])[1:5] == (None, None, None, None)


def test_shipped_registers(spark):
    a, z = shipped_aliases(spark), shipped_growth_zones(spark)
    assert a.count() == 117 and a.select("raw_name").distinct().count() == 117
    got = {r["name"]: r["canonical_name"] for r in resolve(names(spark, "dwp", "HMRC", "nobody"), "name", a).collect()}
    assert got == {"dwp": "Department for Work and Pensions", "HMRC": "HM Revenue & Customs", "nobody": None}
    assert [r["zone_id"] for r in gold.capacity_overview(z).collect()][-1] == "lanarkshire"
    assert z.filter("zone_id = 'lanarkshire'").first()["investment_gbp"] == 8.2e9
    assert explore.zone_kpis(z).first()["pledged_text"] == "£8.2bn"
    assert explore.zone_listing(z).filter("Zone = 'Culham'").first()["£ pledged"] == "—"


def test_export_by_year(spark, notices, tmp_path):
    path = str(tmp_path / "n")
    assert export.write_by_year(notices, path) == 6
    back = export.read_by_year(spark, path, notices.schema)
    assert {r["year"]: r["count"] for r in back.groupBy("year").count().collect()} == {"2025": 5, "unknown": 1}
    assert export.write_by_year(notices.filter("published_date IS NOT NULL"), path) == 5
    assert {p.name for p in (tmp_path / "n").glob("year=*")} == {"year=2025"}
    plan = back.filter("year = '2025'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_export_gold(spark, notices, aliases, tmp_path):
    tables = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    tables |= {"procurement_notices": notices, "org_aliases": aliases, "ai_growth_zones": shipped_growth_zones(spark)}
    counts = export.export_gold(spark, tables, str(tmp_path))
    assert counts["procurement_notices"] == 5 and counts["v_reporting_gap"] == 3 and counts["ai_growth_zones"] == 5
    assert len(counts) == 10
    back = export.read_gold(spark, str(tmp_path))
    assert {name: df.count() for name, df in back.items()} == counts and counts["v_spend_by_month"] == 3
    for name, schema in export.VIEW_SCHEMAS.items():
        assert spark.read.parquet(f"{tmp_path}/{name}").dtypes == back[name].dtypes, name
    absent = export.read_gold(spark, str(tmp_path / "absent"))
    assert set(absent) == set(back) and all(df.isEmpty() for df in absent.values())


def test_read_gold_puts_versions_and_confidence_right(spark, notices, tmp_path):
    export.write_by_year(notices.withColumn("ai_confidence", F.expr("nullif(ai_confidence, 'weak')")), f"{tmp_path}/procurement_notices")
    records = table(spark, "atrs_records", {"record_id": "1", "standard_version": "3.0"}, {"record_id": "2"})
    records.write.parquet(f"{tmp_path}/atrs_records")
    back = export.read_gold(spark, str(tmp_path))
    assert back["procurement_notices"].filter("ai_confidence = 'none'").count() == 1
    assert sorted(r["standard_version"] for r in back["atrs_records"].collect()) == ["unknown", "v3.0"]


def test_views_answer_sql(spark, notices, aliases):
    tables = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    gold.register_views(tables | {"procurement_notices": notices, "org_aliases": aliases})
    assert spark.sql("SELECT count(*) FROM v_procurement_dedup").first()[0] == 5
    assert spark.sql("SELECT notice_count FROM v_spend_by_month WHERE currency = 'GBP' AND month IS NOT NULL").first()[0] == 4
    assert spark.sql("SELECT canonical_name FROM v_reporting_gap WHERE ai_procurement_count = 0").first()[0] == "Education"
    for name in ("v_wpq_trends", "v_announcement_trends", "v_capacity_overview"):
        assert spark.table(name).count() == 0


def test_big_alias_table_is_not_broadcast(spark, aliases, monkeypatch):
    monkeypatch.setattr(orgs, "is_small", lambda df: False)
    df = names(spark, " mod ", "x")
    for out in (resolve(df, "name", aliases), alias_join(df, "name", aliases)):
        assert "strategy=broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert out.filter("canonical_name = 'Ministry of Defence'").count() >= 1


def test_export_of_empty_tables(spark, tmp_path):
    tables = {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}
    counts = export.export_gold(spark, tables, str(tmp_path))
    assert set(counts.values()) == {0}
    assert all(df.isEmpty() for df in export.read_gold(spark, str(tmp_path)).values())


def test_shipped_values():
    assert set(fixed.STATUS_LABELS) >= {"awarded", "open", "planned", "closed"}
    assert len(fixed.ANNOUNCEMENT_QUERIES) == 9 and len(fixed.ANNOUNCEMENT_DOCUMENT_TYPES) == 8


def test_median_of_infinities(spark):
    inf = float("inf")

    def median(*values, **options):
        return exact_median(spark.createDataFrame([(v,) for v in values], "v double"), "v", **options)

    assert median(1.0, 2.0, 4.0, inf, direct=1) == 3.0
    assert median(inf, inf, 1.0) == inf and median(-inf, 1.0, -inf) == -inf
    assert median(inf, 1.0) == inf and median(1.0, -inf, 3.0, 2.0, direct=1) == 1.5
    assert math.isnan(median(inf, -inf))


def test_runs_are_ordered_by_number(spark):
    ids = ["run-10", "run-9", "run-1", "2025-01-31T10", "2025-02-01T09"]
    df = spark.createDataFrame([(i,) for i in ids], "run_id string")
    assert [r["run_id"] for r in df.orderBy(run_order("run_id")).collect()] == ["2025-01-31T10", "2025-02-01T09", "run-1", "run-9", "run-10"]


def test_instants_need_a_date(spark):
    texts = ["12:30", "2024", "2024-05-06", "2024-05-06T10:00:00Z", "2024-05-06 10:00", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] is not None for r in df.select(to_instant("t")).collect()] == [False, False, True, True, True, False, False]


def test_absent_tables_leave_no_join(spark):
    rows = spark.range(5).selectExpr("CAST(id AS string) AS notice_id")
    plan = rows.join(empty(spark, TABLES["procurement_notices"]).select("notice_id"), "notice_id", "left_anti")
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()
