"""How texts are made up from the test tables: dealt out, in order, and read by as many tasks."""

from __future__ import annotations

import datetime
import glob

import pytest
from pyspark.sql import functions as F

from noticeworks.catalog import derive, queries
from noticeworks.catalog.queries import QUERIES, _land
from noticeworks.plans.feed_loads import QUESTIONS
from noticeworks.plans.store import merge_run
from noticeworks.sources.pages import explode_items, land_pages, read_pages
from noticeworks.streaming.incremental import start_feed_ingest

N = 6001


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders in one file, as one task reads them; the last without a key."""
    root = str(tmp_path_factory.mktemp("tables"))
    day = datetime.date(1995, 1, 1)
    rows = [((k * 7919) % N or None, k % 50, "FOP"[k % 3], 1000.0 * (k % 300), day) for k in range(N)]
    kinds = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate date"
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{root}/orders.parquet")
    customers = [(k, k % 25, "BUILDING") for k in range(50)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey long, c_mktsegment string").write.parquet(f"{root}/customer.parquet")
    nations = [(k, f"NATION_{k}") for k in range(25)]
    spark.createDataFrame(nations, "n_nationkey long, n_name string").write.parquet(f"{root}/nation.parquet")
    return root


@pytest.mark.parametrize("made", [derive.releases, derive.archive_lines, derive.extra_lines])
def test_texts_are_made_in_several_tasks(spark, tables, made):
    texts = made(spark, tables)
    assert texts.rdd.getNumPartitions() == N // derive.LEAST_ROWS
    assert texts.count() == N


def test_lines_in_order_need_no_sort_of_texts(spark, tables, tmp_path):
    lines = derive.archive_lines(spark, tables, in_order=True)
    keys = [r[0] for r in lines.select("_ord").collect()]
    assert keys == [None, *range(1, N)]
    half = lines.filter("src = 'contracts_finder'")
    plan = half.select("line")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index(" AS line") < plan.index("Sort [") < plan.index("Join")  # the texts come after the sort
    half.select("line").write.text(f"{tmp_path}/half")
    read = [r[0] for r in spark.read.text(f"{tmp_path}/half").collect()]
    assert sorted(read) == sorted(r[0] for r in half.select("line").collect())


def test_parts_follow_the_rows(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [derive.parts_for(spark, n) for n in (0, 1999, 4000, 10**6, 10**8)] == [1, 1, 2, 3 * cores, 500]


@pytest.mark.parametrize("name,branches", [("q_confidence_mode", 2), ("q_stage_filter", 3)])
def test_branches_read_one_parse(spark, tables, name, branches):
    plan = QUERIES[name](spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Relation") == branches


def test_a_run_reads_its_own_share(spark, tables, monkeypatch):
    """Files that the batches of the ten runs read: each tenth twice, not all of them ten times."""
    files = []

    def noted(batch, path, run):
        files.append({r[0] for r in batch.select(F.input_file_name()).distinct().collect()})
        return merge_run(batch, path, run)

    monkeypatch.setattr(queries, "merge_run", noted)
    assert queries.QUERIES["q_compacted"](spark, tables).count() > 0
    assert len(files) == 10 and sum(map(len, files)) == 2 * len(set.union(*files))


def test_pages_are_landed_many_to_a_file(spark, tmp_path):
    """As many files at ten times the pages; names and bodies come back as they were."""
    sent = {f"page-{k}": f'{{"results": [\n{{"id": {k}, "t": "a\\tb\t"}}]}}' for k in range(200)} | {"odd": "no json\t", "": ""}
    for n in (20, len(sent)):
        rows = [*sent.items()][-n:]
        land_pages(spark.createDataFrame([*rows, (None, None)], "page string, body string").coalesce(2), f"{tmp_path}/{n}")
        assert len(glob.glob(f"{tmp_path}/{n}/part-*")) <= 2
        got = read_pages(spark, f"{tmp_path}/{n}", bundled=True).collect()
        want = [(p, b.replace("\n", " ")) for p, b in rows] + [("", "")]
        assert sorted(map(tuple, got)) == sorted(want)


def test_queries_land_no_file_per_page(spark, tmp_path):
    """300 pages, 3 files; a third of the items first, then all, then a fresh checkpoint."""
    items = spark.range(15_000).selectExpr(
        "id AS n", "concat('{\"id\":', id, ',\"heading\":\"AI ', id, '\",\"questionText\":\"artificial intelligence\"}') AS item"
    )
    _land(items.repartition(3), "n", f"{tmp_path}/pages")
    assert len(glob.glob(f"{tmp_path}/pages/part-*")) <= 4
    pages = read_pages(spark, f"{tmp_path}/pages", bundled=True)
    assert sorted(r[0] for r in pages.select("page").collect()) == sorted(f"page-{k}" for k in range(300))
    assert explode_items(pages).count() == 15_000
    for checkpoint, added in (("a", 15_000), ("b", 0)):
        counts = []
        start_feed_ingest(
            spark, f"{tmp_path}/pages", f"{tmp_path}/table", f"{tmp_path}/{checkpoint}", QUESTIONS,
            on_counts=lambda n, c: counts.append(c["n_added"]), files_per_batch=100, bundled=True,
        ).awaitTermination()
        assert counts == [added]
