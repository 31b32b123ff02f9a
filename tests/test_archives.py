"""Archive lines, packages and loading."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from noticeworks.functions.relevance import RelevanceConfig
from noticeworks.operators.sieve import sieve
from noticeworks.plans import load
from noticeworks.plans.load import load_archive, load_years
from noticeworks.plans.notices import promising
from noticeworks.schemas import TABLES, read_table
from noticeworks.sources.archives import land_lines, normalise_packages, read_landed, read_lines, split_lines, unpack_lines
from noticeworks.plans.store import merge_run, read_manifest, read_runs, write_run
from noticeworks.streaming.incremental import merge_batch, start_ingest


def release(ocid, title="AI service", id="r1"):
    return {"ocid": ocid, "id": id, "tender": {"title": title}}


def ids(spark, *objects):
    df = spark.createDataFrame([(o if isinstance(o, str) else json.dumps(o),) for o in objects], "line string")
    rows = normalise_packages(df).orderBy("line", "pos").collect()
    return [(json.loads(r["release"]).get("id") or r["compiled_id"]) for r in rows]


@pytest.mark.parametrize(
    "line,expected",
    [
        ({"uri": "x", "releases": [release("a", id="1"), release("b", id="2")]}, ["1", "2"]),
        ({"records": [{"ocid": "a", "compiledRelease": {"ocid": "ocds-a", "tender": {}}}]}, ["ocds-a-compiled"]),
        ({"records": [{"compiledRelease": {"ocid": "a", "id": "own"}, "releases": [release("z")]}]}, ["own"]),
        ({"records": [{"compiledRelease": {}, "releases": [release("a", id="3")]}, {"releases": []}, {}]}, ["3"]),
        ({"records": [{"releases": [release("a", id="4")]}], "releases": [release("b")]}, ["4"]),
        ({"records": [], "releases": [release("b")]}, []),
        ({"releases": [release("b", id="5")], "compiledRelease": {"ocid": "c", "id": "no"}}, ["5"]),
        ({"compiledRelease": {"ocid": "c", "id": ""}}, ["c-compiled"]),
        (release("a", id="6"), ["6"]),
        ({"ocid": ""}, []),
        ({"foo": "bar"}, []),
        ("{not json}", []),
        ("[1,2]", []),
        ("5", []),
        ({"records": None, "ocid": "x"}, []),
        ({"records": None, "releases": [release("b", id="5")]}, []),
        ({"releases": None, "compiledRelease": {"ocid": "c", "id": "no"}}, []),
        ({"releases": [{**release("b", id="7"), "note": 'has "records" in it'}]}, ["7"]),
        ({"releases": [{**release("b", id="8"), "records": 1}]}, ["8"]),
        ('{"releases": [{"ocid": "a", "id": "1"}]', []),
        ('{"ocid": "a", "id": "1", "x": }', []),
    ],
)
def test_package_shapes(spark, line, expected):
    assert ids(spark, line) == expected


def write(path, lines, gz=False):
    text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n"
    with (gzip.open(path, "wt", encoding="utf-8") if gz else open(path, "w", encoding="utf-8")) as f:
        f.write(text)
    return str(path)


@pytest.mark.parametrize("gz", [False, True])
def test_scan_skips_blank_and_sets_bad_lines_aside(spark, tmp_path, gz):
    path = write(tmp_path / ("a.jsonl.gz" if gz else "a.jsonl"), [release("a"), "", "  \t", "{not json}", "[1]", release("b")], gz)
    lines = read_lines(spark, path, spread=4 if gz else None)
    ok, bad = split_lines(lines)
    assert normalise_packages(ok).count() == 2
    assert sorted((r["line"], r["reason"]) for r in bad.collect()) == [("[1]", "not an object"), ("{not json}", "malformed")]
    assert [json.loads(r["line"])["ocid"] for r in ok.orderBy("_ord").collect()] == ["a", "b"]


def test_lines_that_cannot_be_unpacked_are_set_aside(spark):
    lines = ['{"records": null}', '{"records": {}}', '{"releases": 5}', '{"records": [], "releases": null}', '{"foo": 1}', '{"compiledRelease": null}']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    ok, bad = split_lines(df)
    assert {r["line"]: r["reason"] for r in bad.collect()} == {lines[0]: "records is no list", lines[1]: "records is no list", lines[2]: "releases is no list"}
    assert ok.count() == 3 and normalise_packages(ok).count() == 0


def test_keys_are_listed_only_where_parts_do_not_tell(spark):
    plan = unpack_lines(spark.createDataFrame([("{}",)], "line string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(StructField(ocid") == 1 and plan.count("json_object_keys") <= 1


def test_line_order_survives_splits_and_shuffles(spark, tmp_path):
    path = write(tmp_path / "big.jsonl", [f'{{"ocid":"o{i}"}}' for i in range(20000)])
    size = "65536"
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        lines = read_lines(spark, path, spread=7)
        assert spark.read.text(path).rdd.getNumPartitions() > 3
        got = [r["line"] for r in lines.orderBy("_ord").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == [f'{{"ocid":"o{i}"}}' for i in range(20000)]


def test_load_keeps_relevant_rows_once(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", [release("a"), release("b", "Cleaning"), release("c"), release("a", "AI again")])
    table = str(tmp_path / "table")
    assert load_archive(spark, path, table, "contracts_finder") == 2
    assert load_archive(spark, path, table, "contracts_finder") == 0
    rows = {r["notice_id"]: r["title"] for r in read_table(spark, table, TABLES["procurement_notices"]).collect()}
    assert rows == {"a::r1": "AI service", "c::r1": "AI service"}
    assert load_archive(spark, path, table, "contracts_finder", keep_all=True) == 1


def test_load_counts_and_quarantines(spark, tmp_path):
    lines = [release("a"), release("b", "Cleaning"), "{bad", {"ocid": "c", "id": "1", "tender": None}, {"releases": [{"id": "no ocid"}]}]
    path = write(tmp_path / "a.jsonl", lines)
    counts = Observation()
    assert load_archive(spark, path, str(tmp_path / "t"), "find_a_tender", counts=counts, quarantine_path=str(tmp_path / "q")) == 1
    assert counts.get == {"n_rows": 5, "n_parsed": 2, "n_relevant": 1, "n_errors": 3}  # the cut line counts, too
    bad = spark.read.parquet(str(tmp_path / "q")).collect()
    assert sorted(r["reason"] for r in bad) == ["malformed", "no ocid or id", "tender is null"]
    assert all(r["file"].endswith("a.jsonl") for r in bad) and "{bad" in {r["text"] for r in bad}


@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_result_does_not_depend_on_partitions(spark, tmp_path, partitions):
    lines = [release(f"o{i % 40}", f"AI {i}") for i in range(200)]
    path = write(tmp_path / "a.jsonl.gz", lines, gz=True)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        n = load_archive(spark, path, str(tmp_path / "t"), "find_a_tender", spread=5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    got = {r["notice_id"]: r["title"] for r in read_table(spark, str(tmp_path / "t"), TABLES["procurement_notices"]).collect()}
    assert n == 40 and got == {f"o{i}::r1": f"AI {i}" for i in range(40)}


def test_other_config(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", [release("a", "Blue widget"), release("b")])
    config = RelevanceConfig(strong_keywords=("widget",), version="w1")
    assert load_archive(spark, path, str(tmp_path / "t"), "find_a_tender", config=config) == 1
    row = read_table(spark, str(tmp_path / "t"), TABLES["procurement_notices"]).first()
    assert (row["title"], row["ai_relevance_version"]) == ("Blue widget", "w1")


def stored(spark, table):
    return sorted((r["notice_id"], r["title"]) for r in read_runs(spark, table).collect())


def run_stream(spark, root):
    start_ingest(spark, f"{root}/in", f"{root}/table", f"{root}/cp", "contracts_finder").awaitTermination()


def test_stream_takes_new_files_only_and_inserts_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "1.jsonl", [release("a", "AI first"), release("b", "Cleaning"), "{bad"])
    run_stream(spark, tmp_path)
    assert stored(spark, f"{tmp_path}/table") == [("a::r1", "AI first")]
    write(tmp_path / "in" / "2.jsonl", [release("a", "AI second"), release("c", "AI third")])
    run_stream(spark, tmp_path)
    run_stream(spark, tmp_path)
    assert stored(spark, f"{tmp_path}/table") == [("a::r1", "AI first"), ("c::r1", "AI third")]


def test_batch_run_again_replaces_itself(spark, tmp_path):
    table = str(tmp_path / "table")
    batch = lambda *rs: spark.createDataFrame([(json.dumps(r), i) for i, r in enumerate(rs)], "line string, _ord int")
    merge_batch(batch(release("a"), release("b")), 0, table, "contracts_finder")
    merge_batch(batch(release("b", "AI later"), release("c")), 1, table, "contracts_finder")
    before = stored(spark, table)
    merge_batch(batch(release("b", "AI later"), release("c")), 1, table, "contracts_finder")
    assert stored(spark, table) == before == [("a::r1", "AI service"), ("b::r1", "AI service"), ("c::r1", "AI service")]
    assert read_runs(spark, table).filter(F.col("run") == "batch-1").count() == 1


def test_loads_and_streams_share_one_table(spark, tmp_path):
    """Nothing a load stored is lost to a stream, nor to a second stream with a checkpoint of its own."""
    (tmp_path / "in").mkdir()
    path = write(tmp_path / "a.jsonl", [release(f"o{i}", f"AI load {i}") for i in range(5)])
    table = f"{tmp_path}/table"
    assert load_archive(spark, path, table, "contracts_finder", run="old") == 5
    write(tmp_path / "in" / "1.jsonl", [release(f"o{i}", f"AI stream {i}") for i in range(3, 9)])
    run_stream(spark, tmp_path)
    want = [(f"o{i}::r1", f"AI {'load' if i < 5 else 'stream'} {i}") for i in range(9)]
    assert stored(spark, table) == want
    write(tmp_path / "in" / "2.jsonl", [release("o9", "AI stream 9")])
    start_ingest(spark, f"{tmp_path}/in", table, f"{tmp_path}/other", "contracts_finder").awaitTermination()
    assert stored(spark, table) == [*want, ("o9::r1", "AI stream 9")]
    assert load_archive(spark, path, table, "contracts_finder", run="old") == 5
    assert stored(spark, table) == [*want, ("o9::r1", "AI stream 9")]
    with pytest.raises(ValueError):
        write_run(read_runs(spark, table), table, "a/b")


def test_stream_counts_and_sets_aside(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "1.jsonl", [release("a"), "{bad", {"ocid": "c", "id": "1", "tender": None}])
    seen = []
    start_ingest(
        spark, f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/cp", "contracts_finder",
        quarantine_path=f"{tmp_path}/bad", on_counts=lambda n, c: seen.append((n, c)),
    ).awaitTermination()
    assert seen == [(0, {"n_rows": 3, "n_parsed": 1, "n_relevant": 1, "n_errors": 2, "n_added": 1})]
    assert sorted(r["reason"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()) == ["malformed", "tender is null"]


def test_bare_nan_is_read_once(spark):
    lines = ['{"releases": [{"ocid": "a", "id": "1", "x": NaN}]}', '{"ocid": "b", "id": "1", "x": -Infinity}', '{"x": NaN']
    df = spark.createDataFrame([(x, i) for i, x in enumerate(lines)], "line string, _ord int")
    assert [r["reason"] for r in split_lines(df)[1].collect()] == ["malformed"]
    assert normalise_packages(df).count() == 2
    assert sorted((r["_ord"], r["line_reason"]) for r in unpack_lines(df).collect()) == [(0, None), (1, None), (2, "malformed")]


def test_years_and_stages_of_a_load(spark, tmp_path):
    """Files of other years are not listed, releases of other stages are left out before the first occurrence is taken."""
    rows = []
    for year in range(2019, 2024):
        for source in ("contracts_finder", "find_a_tender"):
            rows.append((json.dumps({**release(f"{source}-{year}"), "tag": ["tender"]}), source, year))
            rows.append((json.dumps({**release("again", f"AI {year}"), "tag": ["award" if year > 2020 else "odd"]}), source, year))
    root = str(tmp_path / "landed")
    land_lines(spark.createDataFrame(rows, "line string, source string, year int").coalesce(1), root)
    plan = read_landed(spark, root, "contracts_finder", 2020, 2021)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "= contracts_finder)" in filters and ">= 2020)" in filters
    assert load_years(spark, root, str(tmp_path / "t"), "contracts_finder", 2020, 2021) == 3
    assert stored(spark, str(tmp_path / "t")) == [
        ("again::r1", "AI 2021"), ("contracts_finder-2020::r1", "AI service"), ("contracts_finder-2021::r1", "AI service"),
    ]
    assert load_years(spark, root, str(tmp_path / "u"), "contracts_finder", None, 2019, stages=["award"]) == 0
    assert load_years(spark, root, str(tmp_path / "v"), "find_a_tender") == 6  # all years, all stages


@pytest.fixture
def parsed_whole(monkeypatch):
    """How many releases each load parses as a whole."""
    seen, first = [], load.first_relevant
    monkeypatch.setattr(load, "first_relevant", lambda marked, *more: seen.append(marked.count()) or first(marked, *more))
    return seen


def test_a_load_parses_only_what_may_be_new(spark, tmp_path, parsed_whole):
    path = write(tmp_path / "a.jsonl", [*(release(f"o{i}") for i in range(300)), *(release(f"c{i}", "Cleaning") for i in range(50)), "{bad", {"ocid": "x"}])
    table = str(tmp_path / "t")
    assert load_archive(spark, path, table, "find_a_tender", run="one") == 300
    more = write(tmp_path / "b.jsonl", [*(release(f"o{i}", "AI again") for i in range(310)), release("o305", "AI later")])
    assert load_archive(spark, more, table, "find_a_tender", run="two") == 10
    assert load_archive(spark, path, table, "find_a_tender", run="one") == 300  # its own rows are none that it knows
    assert parsed_whole[0] == 300 and 11 <= parsed_whole[1] < 100 and parsed_whole[2] == 300
    assert stored(spark, table) == sorted((f"o{i}::r1", "AI service" if i < 300 else "AI again") for i in range(310))
    counts = Observation()
    assert load_archive(spark, path, table, "find_a_tender", counts=counts) == 0
    assert parsed_whole[3] == 352 and counts.get == {"n_rows": 352, "n_parsed": 350, "n_relevant": 300, "n_errors": 2}


def test_what_a_glance_cannot_read_is_left_to_the_whole_parse(spark):
    wrong = {"ocid": "w", "id": "1", "tender": {"title": "Cleaning", "items": "CPV"}}
    texts = [json.dumps(x) for x in (release("a"), release("b", "Cleaning"), release("", "AI"), {"ocid": "d"}, wrong, release("z", id=0))] + ["[1]", '{"ocid": "e", "id"', None]
    rows = spark.createDataFrame([(k, x, None) for k, x in enumerate(texts)], "k int, release string, compiled_id string")
    assert sorted((r["k"], r["notice"]) for r in promising(rows).collect()) == [(0, "a::r1"), (4, None), (6, None), (7, None)]
    assert [r["k"] for r in promising(rows, keep_all=True).orderBy("k").collect()] == [0, 1, 4, 6, 7]


def test_a_load_begins_anew_where_a_run_it_looked_at_was_replaced(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    assert load_archive(spark, write(tmp_path / "a.jsonl", [release("a"), release("b")]), table, "find_a_tender", run="one") == 2
    path, tries, whole = write(tmp_path / "b.jsonl", [release("b", "AI two"), release("c", "AI two")]), [], load.read_promising

    def replaced_meanwhile(*args):
        tries.append(args)
        found = whole(*args)
        if len(tries) == 1:
            merge_run(read_runs(spark, table).filter("notice_id = 'a::r1'").drop("run"), table, "one")
        return found

    monkeypatch.setattr(load, "read_promising", replaced_meanwhile)
    assert load_archive(spark, path, table, "find_a_tender", run="two") == 2
    assert len(tries) == 2 and stored(spark, table) == [("a::r1", "AI service"), ("b::r1", "AI two"), ("c::r1", "AI two")]
    assert merge_run(read_runs(spark, table).drop("run"), table, "three", seen=read_manifest(spark, table)) == 0


def test_a_sieve_keeps_every_wanted_row_and_few_others(spark):
    rows = spark.range(60000).selectExpr("IF(id = 7, NULL, concat('k', id)) AS key", "id")
    kept = sieve(rows, "key", rows.filter("id % 3 = 0").select("key"))
    assert kept.filter("id % 3 = 0").count() == 20000 and kept.count() < 24000 and kept.filter("key IS NULL").count() == 0
    assert sieve(rows, "key", rows.filter("false").select("key")).count() == 0


def test_a_stream_that_nobody_asks_for_counts_parses_only_what_may_be_new(spark, tmp_path, parsed_whole):
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "1.jsonl", [*(release(f"o{i}") for i in range(200)), *(release(f"c{i}", "Cleaning") for i in range(20))])
    run_stream(spark, tmp_path)
    start_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/other", "contracts_finder").awaitTermination()
    assert parsed_whole[0] == 200 and parsed_whole[1] < 50 and len(stored(spark, f"{tmp_path}/table")) == 200
