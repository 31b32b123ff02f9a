"""Raw records derived from the test tables (see :mod:`noticeworks.catalog.rules`)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.catalog import rules
from noticeworks.schemas import exists

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Session setting that names a folder where made-up texts are kept; unset, they are made anew each time.
KEEP = "noticeworks.fixtures"


#: Files that a kept text is written to: the test tables have one row group each, which one task would read.
KEPT_FILES = 32


def _kept(spark: SparkSession, sf_dir: str, name: str, made: DataFrame) -> DataFrame:
    """``made``, or what an earlier call wrote of it, in a fixed number of files. For timing the library without its fixtures."""
    root = spark.conf.get(KEEP, None)
    if not root:
        return made
    path = f"{root}/{sf_dir.rstrip('/').rsplit('/', 1)[-1]}/{name}"
    if not exists(spark, path):
        made.repartition(KEPT_FILES).write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def _sql(spark: SparkSession, sf_dir: str, query: str, *names: str) -> DataFrame:
    """Run a query over test tables, given as named arguments rather than session-wide views."""
    frames = {n: table(spark, sf_dir, n) for n in names}
    for n in names:
        query = query.replace(f"FROM {n}", f"FROM {{{n}}}").replace(f"JOIN {n} ", f"JOIN {{{n}}} ")
    return spark.sql(query, **frames)


#: Fewest rows that are worth a task of their own, and most rows whose texts one task makes up.
LEAST_ROWS, MOST_ROWS = 2_000, 200_000


def parts_for(spark: SparkSession, rows: int) -> int:
    """Tasks that texts of so many rows are made up and read in: a few a core, more only where each had too many rows."""
    return max(1, min(3 * spark.sparkContext.defaultParallelism, rows // LEAST_ROWS), rows // MOST_ROWS)


def orders(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    """The scalars of every order, dealt out while rows are narrow: a table's file or two would be made texts of in as many tasks.

    ``in_order``: by ranges of the order key, sorted, so that texts need no sort of their own.
    """
    columns = "o_orderkey, o_orderstatus, o_orderdate, o_totalprice, c_mktsegment, n_name, n_nationkey"
    joined = _sql(spark, sf_dir, f"SELECT {columns} FROM {rules.ORDER_FROM}", "orders", "customer", "nation")
    parts = parts_for(spark, table(spark, sf_dir, "orders").count())
    if in_order:
        dealt = joined.repartitionByRange(parts, "o_orderkey").sortWithinPartitions("o_orderkey")
    else:
        dealt = joined.repartition(parts)
    return spark.sql(rules.ORDER_SQL.replace(rules.ORDER_FROM, "{dealt}"), dealt=dealt)


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, rules.DOC_SQL, "documents")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, rules.TURN_SQL, "conversations")


def _struct(**fields: str | Column) -> Column:
    return F.struct(*[(F.expr(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()])


def _when(condition: str, value: Column) -> Column:
    return F.when(F.expr(condition), value)


def _to_json(record: Column) -> Column:
    """JSON text where ``@null`` stands for an explicit null, ``@list`` for a list of relationships
    and ``@n…`` for a bare number."""
    text = F.to_json(record)
    text = F.replace(text, F.lit('"@null"'), F.lit("null"))
    text = F.replace(text, F.lit('"@list"'), F.lit('["Framework agreement","other"]'))
    return F.regexp_replace(text, r'"@n([0-9.]+)"', "$1")


def release_json(df: DataFrame) -> DataFrame:
    """Adds ``release``, the JSON text of one release per order."""
    cut = F.expr("substring(_text, 1, length(_text) - 1)")
    return (
        df.withColumn("_text", _release_text(df.sparkSession.sparkContext.applicationId))
        .withColumn(
            "release",
            F.when(F.expr("k % 107 = 0"), F.concat(cut, F.lit(',"tender":null}')))
            .when(F.expr("k % 109 = 0"), F.concat(cut, F.lit(',"buyer": null}')))
            # Parts two levels down that are of a wrong kind.
            .when(
                F.expr("k % 131 = 0 AND cpv IS NOT NULL"),
                F.regexp_replace("_text", r'"items":\[\{"classification":\{[^}]*\}', '"items":[{"classification":"CPV"'),
            )
            .when(F.expr("k % 137 = 0 AND has_aw"), F.regexp_replace("_text", r'"suppliers":\[[^\]]*\]', '"suppliers":["Acme"]'))
            .when(
                F.expr("k % 139 = 0 AND has_aw"),
                F.regexp_replace("_text", r'"identifier":\{"scheme":"GB-COH"[^}]*\}', '"identifier":"GB-1"'),
            )
            .otherwise(F.col("_text")),
        )
        .drop("_text")
    )


@lru_cache(maxsize=4)
def _release_text(app: str) -> Column:
    """The release of one order; built once per application."""
    finder = "https://www.contractsfinder.service.gov.uk"
    doc = lambda url, type_=None, title=None, description=None: _struct(
        url=url,
        documentType=f"'{type_}'" if type_ else "CAST(NULL AS STRING)",
        title=f"'{title}'" if title else "CAST(NULL AS STRING)",
        description=f"'{description}'" if description else "CAST(NULL AS STRING)",
    )
    file_url = "concat('https://files.example.org/', k)"
    tender_docs = F.when(
        F.expr("k % 4 = 0"),
        F.array(
            doc(f"concat('{finder}/Notice/', k)", "tenderNotice", None, "Tender notice"),
            doc(file_url, "technicalSpecifications", "Spec"),
            doc("CAST(NULL AS STRING)", None, "no url"),
        ),
    ).when(
        F.expr("k % 4 = 1"),
        F.array(doc("concat('https://www.find-tender.service.gov.uk/Notice/0', k)", "contractNotice", "FTS")),
    )
    award_docs = _when(
        "k % 3 = 0",
        F.array(doc(f"concat('{finder}/Award/', k)", "awardNotice", "Award"), doc(file_url, None, "again")),
    )
    number = lambda sql: f"concat('@n', CAST({sql} AS STRING))"
    tender_value = F.when(
        F.expr("k % 127 = 0"), _struct(amount="'n/a'", currency="'GBP'")
    ).when(
        F.expr("tamount IS NOT NULL"),
        _struct(
            amount=f"CASE WHEN k % 29 = 0 THEN CAST(CAST(tamount AS DOUBLE) AS STRING) ELSE {number('CAST(tamount AS DOUBLE)')} END",
            currency="CASE k % 9 WHEN 0 THEN NULL WHEN 1 THEN '@null' WHEN 2 THEN 'EUR' ELSE 'GBP' END",
        ),
    )
    supplier = lambda name, sid: _struct(name=name, identifier=_struct(scheme="'GB-COH'", id=sid))
    s1 = supplier(
        "CASE WHEN k % 47 <> 0 THEN concat('Supplier ', k % 50) END", "concat('GB-', k % 50)"
    )
    s2 = supplier("concat('Supplier ', k % 50 + 1)", "concat('GB-', k % 50 + 1)")
    a1 = _struct(
        id="concat('award-', k)",
        status="CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'pending' ELSE 'active' END",
        value=_when(
            "a1amount IS NOT NULL",
            _struct(amount=number("CAST(a1amount AS DOUBLE)"), currency="CASE WHEN k % 9 = 2 THEN 'EUR' ELSE 'GBP' END"),
        ),
        suppliers=F.when(F.expr("k % 14 = 0"), F.array().cast("array<struct<name string, identifier struct<scheme string, id string>>>"))
        .when(F.expr("k % 4 = 0"), F.array(s1, s2))
        .otherwise(F.array(s1)),
        contractPeriod=_when(
            "k % 21 <> 0",
            _struct(
                startDate="concat(CAST(day AS STRING), 'T00:00:00Z')",
                endDate="concat(CAST(day + CAST(k % 400 - 20 AS INT) AS STRING), 'T00:00:00Z')",
            ),
        ),
        documents=award_docs,
    )
    a2 = _struct(
        id="concat('second-', k)",
        status="CAST(NULL AS STRING)",
        value=_struct(amount="'@n777'", currency="'USD'"),
        suppliers=F.array(supplier("'Second Ltd'", "'S2'")),
        contractPeriod="CAST(NULL AS STRUCT<startDate: STRING, endDate: STRING>)",
        documents="CAST(NULL AS ARRAY<STRUCT<url: STRING, documentType: STRING, title: STRING, description: STRING>>)",
    )
    code = lambda scheme, sql: _struct(scheme=f"'{scheme}'", id=sql)
    item = lambda c: F.struct(c.alias("classification"))
    tender = _struct(
        title="CASE WHEN k % 19 = 0 THEN '' ELSE titlevar END",
        description="descr",
        status="tstatus",
        procurementMethod="method",
        value=tender_value,
        classification=F.when(F.expr("k % 8 = 5"), code("CPV", "'72240000'")).when(
            F.expr("k % 8 = 6"), code("CPV", "coalesce(cpv, '79000000')")
        ),
        items=_when(
            "cpv IS NOT NULL",
            F.array(item(code("CPV", "cpv")), item(code("cpv", "'79000000'")), item(code("OTHER", "'1'"))),
        ),
        contractPeriod=_when(
            "NOT has_aw AND k % 5 = 0",
            _struct(
                startDate="concat(CAST(day AS STRING), 'T00:00:00Z')",
                endDate="concat(CAST(day + 30 AS STRING), 'T00:00:00Z')",
            ),
        ),
        documents=tender_docs,
    )
    record = _struct(
        ocid="ocid",
        id="rid",
        date="CASE WHEN k % 17 = 0 THEN NULL WHEN k % 113 = 0 THEN 'unknown-date' WHEN k % 13 = 0 THEN NULL "
        "ELSE concat(CAST(day AS STRING), 'T09:00:00Z') END",
        publishedDate="CASE WHEN k % 17 <> 0 AND k % 13 = 0 THEN CAST(day AS STRING) END",
        tag="CASE ost WHEN 'F' THEN array('award', 'x') WHEN 'O' THEN array('tender') END",
        stage="CASE WHEN ost = 'P' THEN 'planning' END",
        tender=_when("k % 107 <> 0", tender),
        planning=F.struct(_struct(title="concat('Planned ', phrase)").alias("project")),
        buyer=_when(
            "k % 109 <> 0",
            _struct(
                name="buyer",
                identifier=_struct(scheme="'GB-GOR'", id="CASE WHEN k % 53 <> 0 THEN concat('B-', nkey) END"),
            ),
        ),
        relatedProcesses=F.when(
            F.expr("k % 6 = 0"), F.array(_struct(id="'1'", relationship="'framework'", identifier="concat('FW-', k % 30)"))
        )
        .when(
            F.expr("k % 6 = 1"),
            F.array(
                _struct(id="'0'", relationship="'parent'", identifier="'P-1'"),
                _struct(id="concat('rp-', k)", relationship="'@list'", identifier="CAST(NULL AS STRING)"),
            ),
        )
        .when(F.expr("k % 6 = 2"), F.array(_struct(id="'1'", relationship="'parent'", identifier="'P-2'"))),
        awards=F.when(F.expr("a2"), F.array(a1, a2)).when(F.expr("has_aw"), F.array(a1)),
    )
    return _to_json(record)


def package_lines(df: DataFrame, extra: bool = False) -> DataFrame:
    """Adds ``line``: the release in one of five package shapes. With ``extra`` every 16th order's
    package holds a second, bare release."""
    second = "CASE WHEN k % 16 = 0 THEN concat(',{\"ocid\":\"extra-', k, '\",\"id\":\"e\"}') ELSE '' END"
    line = f"""CASE
        WHEN k % 4 = 0 THEN concat('{{"uri":"u","releases":[', release, {second if extra else "''"}, ']}}')
        WHEN k % 8 = 1 THEN concat('{{"records":[{{"ocid":"x","compiledRelease":', release, ',"releases":[]}}]}}')
        WHEN k % 8 = 3 THEN concat('{{"records":[{{"ocid":"x","releases":[', release, ']}}]}}')
        WHEN k % 8 = 7 THEN concat('{{"compiledRelease":', release, '}}')
        ELSE release END"""
    return df.withColumn("line", F.expr(line))


def archive_lines(spark: SparkSession, sf_dir: str, in_order: bool = False) -> DataFrame:
    """``(line, _ord, src)`` for every order; with ``in_order`` its partitions hold them in order-key order."""
    lines = package_lines(release_json(orders(spark, sf_dir, in_order)))
    lines = _kept(spark, sf_dir, "archive_lines", lines.select("line", F.col("k").alias("_ord"), "src"))
    if in_order and spark.conf.get(KEEP, None):  # kept texts stand in any order
        return lines.repartitionByRange("_ord").sortWithinPartitions("_ord")
    return lines


def extra_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(k, line)`` for every order, some packages with a second release."""
    lines = package_lines(release_json(orders(spark, sf_dir)), extra=True)
    return _kept(spark, sf_dir, "extra_lines", lines.select("k", "line"))


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(release, compiled_id, k, src)``: releases straight from the orders, without packages."""
    df = release_json(orders(spark, sf_dir))
    made_up = F.expr("CASE WHEN k % 8 IN (1, 7) THEN concat(ocid, '-compiled') END")
    return _kept(spark, sf_dir, "releases", df.select("release", made_up.alias("compiled_id"), "k", "src"))


def announcement_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item, d)``: one search result per document."""
    org = lambda link, acronym, title: _struct(link=link, acronym=acronym, title=title)
    record = _struct(
        link="link",
        title="atitle",
        description="adesc",
        content_store_document_type="dtype",
        public_timestamp="CASE WHEN d % 61 = 0 THEN 'n/a' WHEN d % 59 = 0 THEN NULL "
        "WHEN d % 3 = 0 THEN concat(CAST(day AS STRING), 'T23:30:00-05:00') "
        "ELSE concat(CAST(day AS STRING), 'T10:30:00Z') END",
        organisations=F.when(
            F.expr("d % 3 = 0"), F.array(org("concat('/government/organisations/', source, '/')", "upper(lang)", "source"))
        ).when(
            F.expr("d % 3 = 1"),
            F.array(
                org("concat('/government/organisations/', source)", "NULL", "source"),
                org("'/'", "'X'", "'No slug'"),
            ),
        ),
    )
    items = docs(spark, sf_dir).select(F.to_json(record).alias("item"), "d", "source", "dtype")
    return _kept(spark, sf_dir, "announcement_items", items)


def question_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item, qid, conv_id, turn)``: one question per conversation turn; some wrapped in ``value``."""
    record = _struct(
        id="CASE WHEN turn = 5 THEN NULL ELSE qid END",
        uin="CASE WHEN conv_id % 11 <> 0 THEN concat('U', qid) END",
        house="house",
        dateTabled="CASE WHEN conv_id % 9 = 0 THEN NULL ELSE concat(CAST(day AS STRING), 'T00:00:00') END",
        dateAnswered="CASE WHEN turn % 2 = 0 THEN concat(CAST(day + 7 AS STRING), 'T00:00:00') END",
        askingMember=F.when(
            F.expr("conv_id % 4 <> 3"),
            _struct(
                name="CASE WHEN conv_id % 4 = 0 THEN concat('Member ', conv_id) ELSE '' END",
                nameDisplayAs="CASE WHEN conv_id % 4 = 1 THEN concat('Rt Hon ', conv_id) END",
                listAs="concat('List, ', conv_id)",
            ),
        ),
        answeringBodyName="dept",
        heading="heading",
        questionText="text",
        answerText="'AI is mentioned in the answer only'",
    )
    text = F.to_json(record)
    items = turns(spark, sf_dir).select(
        F.when(F.expr("turn % 2 = 0"), F.concat(F.lit('{"value":'), text, F.lit("}"))).otherwise(text).alias("item"),
        "qid",
        "conv_id",
        "turn",
    )
    return _kept(spark, sf_dir, "question_items", items)


def escape_html(text: str) -> Column:
    return F.expr(f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')")


def record_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(item, d)``: one transparency record per document, its whole text in the HTML body."""
    body = F.concat(
        F.lit('<h2 id="summary">1. Summary</h2>\n<h3 id="name">1 - Name</h3>\n<p>Tool '),
        F.col("d"),
        F.lit("</p>\n"),
        F.expr("CASE WHEN d % 3 <> 2 THEN '<h3 id=\"model-architecture\">33</h3><p>' ELSE '<h3>none</h3><p>' END"),
        escape_html("text"),
        F.lit("</p><!-- x -->"),
        F.expr("CASE WHEN d % 4 = 0 THEN '<h3 id=\"model-type-1\">34</h3><ul><li> one </li><li><b>two</b> &amp; 2</li></ul>' ELSE '' END"),
        F.lit('<h3 id="sensitive-attributes">47</h3><p>NINOs, <b>age</b></p><p>and more</p>'),
        F.expr("CASE WHEN d % 5 = 0 THEN '<h3 id=\"sensitive-attributes-1\">48</h3><p></p>' "
               "WHEN d % 5 = 1 THEN '<h3 id=\"sensitive-attributes-1\">48</h3><p>Second set</p>' ELSE '' END"),
        F.lit('<h2>5</h2><h3 id="dpia">58</h3><p>See <a href="/local">here</a>'),
        F.expr("CASE WHEN d % 2 = 0 THEN concat(' and <a href=\"https://example.gov.uk/dpia/', d, '?a=1&amp;b=2\">there</a>') ELSE '' END"),
        F.lit("</p>"),
    )
    record = _struct(
        base_path="CASE WHEN d % 89 = 0 THEN NULL WHEN d % 2 = 0 THEN concat('/algorithmic-transparency-records/doc-', d, '/') "
        "ELSE concat('/algorithmic-transparency-records/doc-', d) END",
        title="CASE WHEN d % 7 = 0 THEN concat(' NATION_', d % 25, ' ') ELSE concat('NATION_', d % 25, ' : Tool: ', d) END",
        description="text",
        details=_struct(
            metadata=_struct(
                algorithmic_transparency_record_atrs_version="CASE d % 4 WHEN 0 THEN 'v4.0' WHEN 1 THEN '3.0' WHEN 2 THEN 'vv2' END",
                algorithmic_transparency_record_date_published="CASE WHEN d % 83 = 0 THEN 'soon' ELSE CAST(day AS STRING) END",
                algorithmic_transparency_record_phase="CASE d % 6 WHEN 0 THEN NULL WHEN 1 THEN 'production' WHEN 2 THEN 'private-beta' ELSE 'pilot' END",
            ),
            body=body,
        ),
    )
    items = docs(spark, sf_dir).select(F.to_json(record).alias("item"), "d", body.alias("body"))
    return _kept(spark, sf_dir, "record_items", items)


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias table from nations to regions: every sixth nation left out, one name in two spellings."""
    return _sql(
        spark,
        sf_dir,
        ALIAS_SQL,
        "nation",
        "region",
    )


ALIAS_SQL = """SELECT n_name AS raw_name, r_name AS canonical_name, 'country' AS org_type
    FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey WHERE n_nationkey % 6 <> 5
    UNION ALL
    SELECT concat(' ', lower(n_name)) AS raw_name, r_name AS canonical_name, 'country' AS org_type
    FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey WHERE n_nationkey % 7 = 3"""

ZONE_SQL = """SELECT concat('zone-', s_suppkey) AS zone_id, s_name AS zone_name,
    CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE concat('Site, "', s_suppkey, '"') END AS site,
    concat('Region ', s_nationkey) AS region,
    CASE WHEN s_suppkey % 4 = 0 THEN 'announced' ELSE 'confirmed' END AS status,
    CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE s_acctbal * 1000000 END AS investment_gbp,
    CASE WHEN s_suppkey % 5 = 0 THEN 'N/A' ELSE concat(s_suppkey, 'MW') END AS compute_capacity,
    CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE DATE '2025-01-13' + CAST(s_suppkey % 300 AS INT) END AS announced_date,
    'Lead' AS lead_org, concat('https://www.gov.uk/z/', s_suppkey) AS source_url,
    CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE concat('Note, with "quotes" ', s_suppkey) END AS notes
    FROM supplier"""


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(spark, sf_dir, ZONE_SQL, "supplier")
