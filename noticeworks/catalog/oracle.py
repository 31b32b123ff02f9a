"""Checking SQL for DuckDB, one statement per registered query.

Answers are worked out from the rule scalars (:mod:`noticeworks.catalog.rules`) and the test tables
alone: no JSON, HTML or CSV text is built or read here.
"""

from __future__ import annotations

from noticeworks import fixed_values as fixed
from noticeworks.catalog.rules import DOC_SQL, ORDER_SQL, TURN_SQL
from noticeworks.catalog.settings import (
    CAP,
    CORPUS_KEYWORDS,
    PART_CONFIG,
    SEARCH,
    SLUGS,
)
from noticeworks.schemas import TABLES

_NOT_WORD = r"[^\p{L}\p{N}_]"
_FINDER = "https://www.contractsfinder.service.gov.uk"


def has_word(text: str, words: tuple[str, ...]) -> str:
    if not words:
        return "false"
    return f"regexp_matches(lower({text}), '(^|{_NOT_WORD})(?:{'|'.join(words)})($|{_NOT_WORD})')"


def tier(text: str, strong_code: str, weak_code: str, strong=fixed.STRONG_KEYWORDS, weak=fixed.WEAK_KEYWORDS) -> str:
    s, w = has_word(text, strong), has_word(text, weak)
    return f"""CASE WHEN {s} OR ({w} AND {strong_code}) THEN 'strong'
        WHEN {w} OR {strong_code} OR {weak_code} THEN 'weak' ELSE 'none' END"""


def joined(title: str, description: str) -> str:
    return f"concat_ws(' ', nullif({title}, ''), nullif({description}, ''))"


def label_case(column: str, labels: dict[str, str], default: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE {column} {whens} ELSE {default} END"


def money(c: str) -> str:
    return f"coalesce('£' || format('{{:,.0f}}', {c}), '—')"


def money_bn(c: str) -> str:
    return f"coalesce('£' || format('{{:.1f}}', {c} / 1e9) || 'bn', '—')"


STATUS_LABEL = label_case("contract_status", fixed.STATUS_LABELS, "'Unknown'")

# Every release with the notice it should become and the reason it does not.
NOTICES = f"""o AS ({ORDER_SQL}),
o2 AS (SELECT *,
    CASE WHEN k % 8 IN (1, 7) AND coalesce(rid, '') = '' THEN concat(ocid, '-compiled') ELSE rid END AS fid,
    CASE WHEN k % 19 = 0 THEN concat('Planned ', phrase) ELSE titlevar END AS title,
    CASE WHEN k % 8 = 5 THEN ['72240000'] WHEN k % 8 = 6 AND cpv IS NULL THEN ['79000000'] ELSE []::VARCHAR[] END
        || CASE WHEN cpv IS NOT NULL THEN [cpv, '79000000'] ELSE []::VARCHAR[] END AS codes,
    CASE WHEN has_aw AND k % 21 <> 0 THEN day WHEN NOT has_aw AND k % 5 = 0 THEN day END AS start0,
    CASE WHEN has_aw AND k % 21 <> 0 THEN day + CAST(k % 400 - 20 AS INT)
        WHEN NOT has_aw AND k % 5 = 0 THEN day + 30 END AS end0,
    list_filter([
        CASE WHEN k % 4 = 0 THEN '{{"title":"Tender notice","url":"{_FINDER}/Notice/' || k || '","documentType":"tenderNotice"}}' END,
        CASE WHEN k % 4 = 0 THEN '{{"title":"Spec","url":"https://files.example.org/' || k || '","documentType":"technicalSpecifications"}}' END,
        CASE WHEN k % 4 = 1 THEN '{{"title":"FTS","url":"https://www.find-tender.service.gov.uk/Notice/0' || k || '","documentType":"contractNotice"}}' END,
        CASE WHEN has_aw AND k % 3 = 0 THEN '{{"title":"Award","url":"{_FINDER}/Award/' || k || '","documentType":"awardNotice"}}' END,
        CASE WHEN has_aw AND k % 3 = 0 AND k % 4 <> 0 THEN '{{"title":"again","url":"https://files.example.org/' || k || '","documentType":null}}' END
    ], lambda x: x IS NOT NULL) AS docs
    FROM o),
n AS (SELECT k, codes, docs,
    concat(ocid, '::', fid) AS notice_id, src AS source,
    CASE ost WHEN 'F' THEN 'award' WHEN 'O' THEN 'tender' ELSE 'planning' END AS stage,
    tstatus AS tender_status,
    CASE WHEN has_aw AND ((k % 14 <> 0 AND k % 6 <> 1) OR a2) THEN 'awarded'
        ELSE CASE WHEN tstatus = 'active' THEN 'open' WHEN tstatus IN ('planning', 'planned') THEN 'planned'
            WHEN tstatus IN ('cancelled', 'withdrawn') THEN tstatus WHEN tstatus = 'complete' THEN 'closed'
            ELSE 'unknown' END END AS contract_status,
    title, descr AS description,
    CAST(coalesce(a1amount, CASE WHEN a2 THEN 777.0 END, tamount) AS DOUBLE) AS value_amount,
    CASE WHEN a1amount IS NOT NULL THEN CASE WHEN k % 9 = 2 THEN 'EUR' ELSE 'GBP' END
        WHEN a2 THEN 'USD'
        WHEN tamount IS NOT NULL THEN CASE k % 9 WHEN 1 THEN NULL WHEN 2 THEN 'EUR' ELSE 'GBP' END
        ELSE 'GBP' END AS currency,
    buyer AS buyer_name,
    CASE WHEN k % 53 <> 0 THEN concat('B-', nkey) END AS buyer_org_id,
    CASE WHEN has_aw AND k % 14 <> 0 THEN CASE WHEN k % 47 <> 0 THEN concat('Supplier ', k % 50) ELSE 'supplier_unknown' END
        WHEN a2 THEN 'Second Ltd' ELSE 'supplier_unknown' END AS supplier_name,
    CASE WHEN has_aw AND k % 14 <> 0 THEN concat('GB-', k % 50) WHEN a2 THEN 'S2' END AS supplier_id,
    '[' || array_to_string(list_transform(codes, lambda x: '"' || x || '"'), ',') || ']' AS cpv_codes,
    CASE WHEN len(docs) > 0 THEN '[' || array_to_string(docs, ',') || ']' END AS documents,
    has_aw AS has_awards,
    CASE k % 6 WHEN 0 THEN concat('FW-', k % 30) WHEN 1 THEN concat('rp-', k) END AS framework_id,
    method AS procurement_method,
    CASE WHEN k % 17 <> 0 AND k % 113 <> 0 THEN day END AS published_date,
    CASE WHEN end0 >= start0 THEN start0 END AS contract_start,
    CASE WHEN end0 >= start0 THEN end0 END AS contract_end,
    {tier(joined('title', 'descr'), "coalesce(cpv IN ('72220000', '72230000'), false)",
          "(coalesce(cpv IN ('48000000', '72210000'), false) OR k % 8 = 5)")} AS ai_confidence,
    CASE WHEN src = 'contracts_finder' THEN CASE WHEN k % 4 = 0 THEN '{_FINDER}/Notice/' || k
            WHEN has_aw AND k % 3 = 0 THEN '{_FINDER}/Award/' || k ELSE '{_FINDER}/Notice/' || nk END
        WHEN k % 4 = 1 THEN 'https://www.find-tender.service.gov.uk/Notice/0' || k END AS source_url,
    CASE WHEN ocid = '' OR fid IS NULL OR fid = '' THEN 'no ocid or id' WHEN k % 107 = 0 THEN 'tender is null'
        WHEN k % 109 = 0 THEN 'buyer is null'
        WHEN k % 131 = 0 AND cpv IS NOT NULL THEN 'tender.items element.classification is no object'
        WHEN k % 137 = 0 AND has_aw THEN 'award supplier is no object'
        WHEN k % 139 = 0 AND has_aw AND (k % 14 <> 0 OR a2) THEN 'supplier identifier is no object'
        WHEN k % 127 = 0 AND a1amount IS NULL AND NOT a2 THEN 'amount is no number' END AS reason,
    CASE WHEN k % 17 <> 0 AND k % 113 = 0 THEN 'date text is no date' END AS issue
    FROM o2),
g AS (SELECT *, ai_confidence <> 'none' AS ai_relevant, '2.0' AS ai_relevance_version,
    CASE WHEN source_url IS NULL THEN 'unresolved' ELSE 'ok' END AS link_status
    FROM n WHERE reason IS NULL)"""

# The merged notice table, relevant rows only, and its de-duplicated form.
SILVER = f"""{NOTICES},
silver AS (SELECT * FROM g WHERE ai_relevant
    QUALIFY row_number() OVER (PARTITION BY notice_id ORDER BY k) = 1)"""


def text_key(c: str) -> str:
    return f"regexp_replace(lower(trim({c})), '[^a-z0-9]', '', 'g')"


DEDUP = f"""{SILVER},
dd AS (SELECT * FROM silver QUALIFY row_number() OVER (
    PARTITION BY {text_key('buyer_name')}, value_amount, left({text_key('title')}, 50)
    ORDER BY CASE WHEN has_awards THEN 0 ELSE 1 END,
        CASE WHEN supplier_name <> 'supplier_unknown' THEN 0 ELSE 1 END,
        CASE WHEN value_amount IS NOT NULL THEN 0 ELSE 1 END,
        published_date DESC NULLS LAST, source NULLS LAST, notice_id) = 1)"""

ALIASES = """al AS (
    SELECT n_name AS raw_name, r_name AS canonical_name FROM nation JOIN region ON r_regionkey = n_regionkey
    WHERE n_nationkey % 6 <> 5
    UNION ALL SELECT ' ' || lower(n_name), r_name FROM nation JOIN region ON r_regionkey = n_regionkey
    WHERE n_nationkey % 7 = 3)"""

ANNOUNCEMENTS = f"""dc AS ({DOC_SQL}),
an AS (SELECT d, link AS announcement_id, atitle AS title, dtype AS document_type,
    CASE d % 3 WHEN 0 THEN '[{{"slug":"' || source || '","acronym":"' || upper(lang) || '","title":"' || source || '"}}]'
        WHEN 1 THEN '[{{"slug":"' || source || '","acronym":null,"title":"' || source
            || '"}},{{"slug":null,"acronym":"X","title":"No slug"}}]' END AS organisations,
    CASE WHEN d % 61 = 0 OR d % 59 = 0 THEN NULL
        WHEN d % 3 = 0 THEN CAST(day + 1 AS TIMESTAMP) + INTERVAL '4 hours 30 minutes'
        ELSE CAST(day AS TIMESTAMP) + INTERVAL '10 hours 30 minutes' END AS public_timestamp,
    adesc AS summary, source AS src,
    {tier(joined('atitle', 'adesc'), 'false', 'false')} AS ai_confidence,
    'https://www.gov.uk' || link AS source_url
    FROM dc),
ag AS (SELECT *, ai_confidence <> 'none' AS ai_relevant FROM an WHERE announcement_id IS NOT NULL),
asilver AS (SELECT * FROM ag WHERE ai_relevant
    QUALIFY row_number() OVER (PARTITION BY announcement_id ORDER BY d) = 1)"""

QUESTIONS = f"""tu AS ({TURN_SQL}),
qn AS (SELECT qid, conv_id, turn, CAST(qid AS VARCHAR) AS question_id, house,
    CASE WHEN conv_id % 9 <> 0 THEN day END AS date_tabled,
    CASE WHEN turn % 2 = 0 THEN day + 7 END AS date_answered,
    CASE conv_id % 4 WHEN 0 THEN 'Member ' || conv_id WHEN 1 THEN 'Rt Hon ' || conv_id
        WHEN 2 THEN 'List, ' || conv_id END AS member_name,
    dept AS department, text AS question_text,
    {tier(joined('heading', 'text'), 'false', 'false')} <> 'none' AS ai_relevance_flag,
    CASE WHEN conv_id % 9 <> 0 AND conv_id % 11 <> 0 THEN
        'https://questions-statements.parliament.uk/written-questions/detail/' || day || '/U' || qid END AS source_url
    FROM tu WHERE turn <> 5),
qsilver AS (SELECT * FROM qn WHERE ai_relevance_flag)"""

_STRIPPED = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"
RECORDS = f"""dc AS ({DOC_SQL}),
rc AS (SELECT d, 'doc-' || d AS record_id, 'NATION_' || (d % 25) AS organisation_name,
    CASE d % 6 WHEN 0 THEN NULL WHEN 1 THEN 'production' WHEN 2 THEN 'private-beta' ELSE 'pilot' END AS phase,
    text AS one_sentence_desc,
    nullif(concat_ws(' | ', CASE WHEN d % 3 <> 2 THEN nullif({_STRIPPED}, '') END,
        CASE WHEN d % 4 = 0 THEN 'one, two& 2' END), '') AS model_architecture,
    CASE WHEN d % 5 = 1 THEN 'NINOs, age and more | Second set' ELSE 'NINOs, age and more' END AS sensitive_attributes,
    CASE WHEN d % 2 = 0 THEN 'https://example.gov.uk/dpia/' || d || '?a=1&b=2' END AS dpi_assessment_url,
    CASE WHEN d % 83 <> 0 THEN day END AS date_published,
    CASE d % 4 WHEN 0 THEN 'v4.0' WHEN 1 THEN '3.0' WHEN 2 THEN 'vv2' END AS standard_version,
    'https://www.gov.uk/algorithmic-transparency-records/doc-' || d || CASE WHEN d % 2 = 0 THEN '/' ELSE '' END AS source_url
    FROM dc WHERE d % 89 <> 0)"""

ZONES = """z AS (SELECT 'zone-' || s_suppkey AS zone_id, s_name AS zone_name,
    CASE WHEN s_suppkey % 3 <> 0 THEN 'Site, "' || s_suppkey || '"' END AS site,
    'Region ' || s_nationkey AS region,
    CASE WHEN s_suppkey % 4 = 0 THEN 'announced' ELSE 'confirmed' END AS status,
    CASE WHEN s_suppkey % 2 <> 0 THEN s_acctbal * 1000000 END AS investment_gbp,
    CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey || 'MW' END AS compute_capacity,
    CASE WHEN s_suppkey % 9 <> 0 THEN DATE '2025-01-13' + CAST(s_suppkey % 300 AS INT) END AS announced_date,
    'Lead' AS lead_org, 'https://www.gov.uk/z/' || s_suppkey AS source_url,
    CASE WHEN s_suppkey % 6 <> 0 THEN 'Note, with "quotes" ' || s_suppkey END AS notes
    FROM supplier)"""

_NOTICE_COLUMNS = """k, notice_id, source, stage, tender_status, contract_status, title, description,
    round(value_amount, 2) AS value_amount, currency, buyer_name, buyer_org_id, supplier_name, supplier_id,
    cpv_codes, documents, has_awards, framework_id, procurement_method, published_date, contract_start,
    contract_end, ai_confidence, ai_relevance_version, ai_relevant, link_status, source_url"""

# Ordered distinct supplier names of a notice's awards.
_NAMES = """list_filter([
    CASE WHEN has_awards AND k % 14 <> 0 AND k % 47 <> 0 THEN 'Supplier ' || (k % 50) END,
    CASE WHEN has_awards AND k % 14 <> 0 AND k % 4 = 0 THEN 'Supplier ' || (k % 50 + 1) END,
    CASE WHEN has_awards AND k % 3 = 0 THEN 'Second Ltd' END], lambda x: x IS NOT NULL)"""
_SUMMARY = f"""CASE WHEN len({_NAMES}) > 0 THEN {_NAMES}[1] || CASE WHEN len({_NAMES}) > 1
        THEN '  +' || (len({_NAMES}) - 1) ELSE '' END
    WHEN supplier_name <> 'supplier_unknown' THEN supplier_name ELSE '—' END"""

_GAP = f"""{DEDUP}, {RECORDS}, {ALIASES},
gap AS (SELECT c.canonical_name,
    count(DISTINCT dd.notice_id) AS ai_procurement_count, count(DISTINCT rc.record_id) AS atrs_record_count
    FROM (SELECT DISTINCT canonical_name FROM al) c
    LEFT JOIN al ON al.canonical_name = c.canonical_name
    LEFT JOIN dd ON lower(trim(dd.buyer_name)) = lower(trim(al.raw_name))
    LEFT JOIN rc ON lower(trim(rc.organisation_name)) = lower(trim(al.raw_name))
    GROUP BY c.canonical_name)"""


def _spend(lookup: str) -> str:
    return f"""WITH {DEDUP}, {ALIASES}, lk AS ({lookup})
    SELECT canonical_name, CAST(date_trunc('month', published_date) AS TIMESTAMP) AS month,
        round(sum(value_amount), 2) AS total_value, currency, CAST(count(*) AS BIGINT) AS notice_count
    FROM dd JOIN lk ON lower(trim(buyer_name)) = key GROUP BY 1, 2, 4"""


def _month(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS TIMESTAMP)"


def _non_null_counts() -> str:
    made = {"ingested_at": "count(*)", "awards": "count(*) FILTER (WHERE has_awards)",
            "notice_summary": "count(NULL)", "enrichment_version": "count(NULL)"}
    filled = [
        f"SELECT 'procurement_notices' AS table_name, '{f.name}' AS column_name, CAST({made.get(f.name, f'count({f.name})')} AS BIGINT) AS n FROM g"
        for f in TABLES["procurement_notices"]
    ]
    others = [f"SELECT '{t}', '{f.name}', CAST(0 AS BIGINT)" for t, fields in TABLES.items() if t != "procurement_notices" for f in fields]
    return f"WITH {NOTICES} " + " UNION ALL ".join([*filled, *others])


_WAVES = f"""WITH {NOTICES}, waves AS (
    SELECT *, 1 AS wave FROM g WHERE k % 3 = 0 UNION ALL SELECT *, 2 AS wave FROM g),
    kept AS (SELECT * FROM waves WHERE ai_relevant QUALIFY row_number() OVER (PARTITION BY notice_id ORDER BY wave, k) = 1)"""

_STREAMED = f"""WITH {NOTICES}, x AS (SELECT CASE WHEN k % 50 = 7 THEN 'malformed' ELSE reason END AS reason FROM n
    WHERE k % 50 = 7 OR NOT ((k % 4 = 2 OR k % 8 = 5) AND k % 101 = 0))
    SELECT 'n_rows' AS what, count(*) AS n FROM x UNION ALL SELECT 'n_parsed', count(*) FROM x WHERE reason IS NULL
    UNION ALL SELECT 'n_errors', count(*) FROM x WHERE reason IS NOT NULL
    UNION ALL SELECT reason, count(*) FROM x WHERE reason IS NOT NULL GROUP BY reason"""

ORACLE: dict[str, str] = {
    "q_flagship": f"WITH {_GAP} SELECT * FROM gap",
    # --- sources and sinks
    "q_jsonl_scan": f"""WITH {NOTICES}, x AS (SELECT *, CASE WHEN k % 8 IN (1, 7) AND coalesce(rid, '') = '' THEN concat(ocid, '-compiled') ELSE rid END AS id2 FROM o)
        SELECT 'release' AS kind, ocid AS a, id2 AS b FROM x WHERE NOT ((k % 4 = 2 OR k % 8 = 5) AND ocid = '')
        UNION ALL SELECT 'malformed', '{{not json}}', NULL FROM x WHERE k % 50 = 1
        UNION ALL SELECT 'not an object', '[1,2]', NULL FROM x WHERE k % 50 = 2""",
    "q_normalise_packages": f"""WITH o AS ({ORDER_SQL})
        SELECT k, CAST(0 AS INT) AS pos, ocid,
            CASE WHEN k % 8 IN (1, 7) AND coalesce(rid, '') = '' THEN concat(ocid, '-compiled') ELSE rid END AS id
        FROM o WHERE NOT ((k % 4 = 2 OR k % 8 = 5) AND ocid = '')
        UNION ALL SELECT k, 1, 'extra-' || k, 'e' FROM o WHERE k % 16 = 0""",
    "q_page_explode": f"""WITH tu AS ({TURN_SQL})
        SELECT conv_id // 10 AS grp, turn // 20 AS page,
            CAST(row_number() OVER (PARTITION BY conv_id // 10, turn // 20 ORDER BY qid) - 1 AS INT) AS pos,
            CASE WHEN turn <> 5 THEN CAST(qid AS VARCHAR) END AS id FROM tu""",
    "q_query_cap": f"""WITH p AS (SELECT source AS query, doc_id // 50 AS start,
            CASE WHEN source LIKE '%3' AND doc_id // 50 = 7 THEN 0 ELSE count(*) END AS n
            FROM documents GROUP BY 1, 2),
        s AS (SELECT *, coalesce(sum(n) OVER w, 0) AS seen, coalesce(min(n) OVER w, 1) AS least FROM p
            WINDOW w AS (PARTITION BY query ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT query, start, CAST(n AS INT) AS n_items FROM s WHERE seen < {CAP} AND least > 0""",
    "q_first_wins_union": f"""WITH dc AS ({DOC_SQL}), u AS (
            SELECT link, d, d % 3 AS query_idx FROM dc UNION ALL SELECT link, d, (d + 1) % 3 FROM dc)
        SELECT link, query_idx, d FROM u WHERE link IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY link ORDER BY query_idx, d // 50, d % 50) = 1""",
    "q_candidate_filter": f"""WITH {ANNOUNCEMENTS} SELECT d, announcement_id, document_type FROM an
        WHERE document_type IN ({', '.join(repr(t) for t in fixed.ANNOUNCEMENT_DOCUMENT_TYPES)})
        AND d % 3 <> 2 AND src IN ({', '.join(repr(s) for s in SLUGS)})""",
    "q_seed_csv": f"WITH {ZONES} SELECT * FROM z",
    "q_parquet_concat": f"""WITH {NOTICES} SELECT k, notice_id, title,
        CASE WHEN k % 2 = 0 THEN currency END AS currency, CAST(NULL AS DATE) AS published_date FROM g""",
    "q_bronze_roundtrip": """SELECT CAST(page_id AS VARCHAR) AS page, 'web' || (page_id % 3) AS source,
        CAST(DATE '2025-01-01' + CAST(page_id % 2 AS INT) AS DATE) AS run_date,
        md5(CASE WHEN page_id % 5 = 0 THEN 'again ' || html ELSE html END) AS body_md5 FROM pages""",
    "q_export_by_year": f"""WITH {DEDUP} SELECT notice_id,
        coalesce(CAST(year(published_date) AS VARCHAR), 'unknown') AS year FROM dd""",
    "q_export_new": f"""WITH {DEDUP} SELECT notice_id, title,
        coalesce(CAST(year(published_date) AS VARCHAR), 'unknown') AS year FROM dd""",
    "q_dedup_stored": f"WITH {DEDUP} SELECT notice_id, source, title, has_awards FROM dd",
    "q_export_counts": f"""WITH {_GAP}, {ANNOUNCEMENTS.removeprefix(f"dc AS ({DOC_SQL}),")},
        {QUESTIONS}, {ZONES}
        SELECT 'procurement_notices' AS relation, CAST(count(*) AS BIGINT) AS n FROM dd
        UNION ALL SELECT 'atrs_records', count(*) FROM rc
        UNION ALL SELECT 'v_reporting_gap', count(*) FROM gap
        UNION ALL SELECT 'v_spend_by_month', count(*) FROM (SELECT DISTINCT canonical_name, date_trunc('month', published_date), currency
            FROM dd JOIN al ON lower(trim(buyer_name)) = lower(trim(raw_name)))
        UNION ALL SELECT 'gov_announcements', count(*) FROM asilver
        UNION ALL SELECT 'written_questions', count(*) FROM qsilver
        UNION ALL SELECT 'ai_growth_zones', count(*) FROM z
        UNION ALL SELECT 'v_announcement_trends', count(*) FROM (SELECT DISTINCT date_trunc('month', public_timestamp), document_type FROM asilver)
        UNION ALL SELECT 'v_wpq_trends', count(*) FROM (SELECT DISTINCT date_trunc('month', date_tabled), department FROM qsilver)
        UNION ALL SELECT 'v_capacity_overview', count(*) FROM z""",
    "q_schema_registry": _non_null_counts(),
    "q_migrate": f"""WITH {NOTICES} SELECT notice_id, title, {len(TABLES['procurement_notices'])} AS n_columns,
        {len(TABLES['procurement_notices']) - 2} AS n_null FROM g WHERE notice_id IS NOT NULL AND title IS NOT NULL""",
    "q_append_by_name": f"""WITH {NOTICES} SELECT notice_id, title, published_date,
        CASE WHEN k % 2 = 0 THEN currency END AS currency FROM g""",
    # --- releases
    "q_parse_release": f"WITH {NOTICES} SELECT {_NOTICE_COLUMNS} FROM g",
    "q_quarantine": f"WITH {NOTICES} SELECT k, reason FROM n WHERE reason IS NOT NULL",
    "q_parse_lenient": f"""WITH {NOTICES} SELECT k, CASE WHEN k % 107 <> 0 THEN tender_status END AS tender_status,
        buyer_name, coalesce(reason, 'read') AS reason FROM (SELECT * REPLACE (
            CASE WHEN reason IN ('tender is null', 'buyer is null') THEN
                CASE WHEN k % 107 <> 0 AND k % 127 = 0 AND NOT (has_awards AND (k % 7 <> 0 OR k % 3 = 0)) THEN 'amount is no number' END
                ELSE reason END AS reason) FROM n)""",
    "q_cpv_codes": f"WITH {NOTICES} SELECT k, array_to_string(codes, ' ') AS codes FROM g",
    "q_headline_value": f"WITH {NOTICES} SELECT k, value_amount, currency FROM g",
    "q_headline_supplier": f"WITH {NOTICES} SELECT k, supplier_name, supplier_id FROM g",
    "q_documents": f"WITH {NOTICES} SELECT k, documents FROM g",
    "q_contract_status": f"WITH {NOTICES} SELECT k, contract_status FROM g",
    "q_notice_url": f"WITH {NOTICES} SELECT k, source_url, link_status FROM g",
    "q_framework_id": f"WITH {NOTICES} SELECT k, framework_id FROM g",
    "q_contract_dates": f"WITH {NOTICES} SELECT k, published_date, contract_start, contract_end, issue FROM g",
    "q_utf8_repair": f"WITH o AS ({ORDER_SQL}) SELECT k, titlevar || '?' || seg AS title FROM o",
    # --- the other feeds
    "q_organisations": f"WITH {ANNOUNCEMENTS} SELECT d, organisations FROM an",
    "q_parse_announcement": f"""WITH {ANNOUNCEMENTS} SELECT d, announcement_id, title, document_type, organisations,
        public_timestamp, summary, ai_relevant, ai_confidence, source_url FROM ag""",
    "q_parse_question": f"WITH {QUESTIONS} SELECT * EXCLUDE (qid, conv_id, turn) FROM qn",
    "q_parse_record": f"WITH {RECORDS} SELECT * EXCLUDE (d) FROM rc",
    "q_html_sections": f"""WITH dc AS ({DOC_SQL}), s AS (
            SELECT d, 'name' AS id, 'Tool ' || d AS text, NULL AS hrefs FROM dc
            UNION ALL SELECT d, 'model-architecture', {_STRIPPED}, NULL FROM dc WHERE d % 3 <> 2
            UNION ALL SELECT d, 'model-type-1', 'one, two& 2', NULL FROM dc WHERE d % 4 = 0
            UNION ALL SELECT d, 'sensitive-attributes', 'NINOs, age and more', NULL FROM dc
            UNION ALL SELECT d, 'sensitive-attributes-1', CASE WHEN d % 5 = 1 THEN 'Second set' ELSE '' END, NULL FROM dc WHERE d % 5 < 2
            UNION ALL SELECT d, 'dpia', CASE WHEN d % 2 = 0 THEN 'See here and there' ELSE 'See here' END,
                CASE WHEN d % 2 = 0 THEN '/local https://example.gov.uk/dpia/' || d || '?a=1&b=2' ELSE '/local' END FROM dc)
        SELECT 'doc' AS kind, d AS key, id, text, hrefs FROM s
        UNION ALL SELECT 'page', page_id, NULL, NULL, NULL FROM pages""",
    "q_section_join": f"WITH {RECORDS} SELECT d, model_architecture, sensitive_attributes FROM rc",
    "q_section_link": f"WITH {RECORDS} SELECT d, dpi_assessment_url FROM rc",
    # --- scalar functions
    "q_text_key": f"""SELECT doc_id, {text_key('text')} AS full_key, left({text_key('text')}, 50) AS short_key,
        left({text_key('source')}, 2) AS source_key FROM documents""",
    "q_slug": r"""SELECT page_id, nullif(regexp_extract(regexp_replace(url, '/+$', ''), '[^/]*$'), '') AS slug FROM pages""",
    "q_version_norm": f"""WITH {RECORDS} SELECT d, CASE d % 4 WHEN 0 THEN 'v4.0' WHEN 1 THEN 'v3.0' WHEN 2 THEN 'v2'
        ELSE 'unknown' END AS version FROM rc""",
    "q_coerce": """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN CAST(ts AS DATE) END AS day,
        CASE WHEN event_id % 4 <> 0 THEN value END AS amount,
        CASE WHEN event_id % 5 = 0 THEN 'none' ELSE event_type END AS confidence FROM events""",
    "q_money_format": f"""SELECT o_orderkey, {money('o_totalprice')} AS value, {money_bn('o_totalprice * 12345')} AS bn,
        {money('CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END')} AS maybe FROM orders""",
    "q_supplier_summary": f"WITH {NOTICES} SELECT k, {_SUMMARY} AS suppliers FROM g",
    "q_status_label": f"WITH {NOTICES} SELECT k, {STATUS_LABEL} AS label FROM g",
    # --- relevance
    "q_keyword_match": f"SELECT doc_id, {has_word('text', fixed.STRONG_KEYWORDS)} AS strong, "
    f"{has_word('text', CORPUS_KEYWORDS)} AS corpus FROM documents",
    "q_cpv_prefix": """SELECT p_partkey, p_partkey % 13 <> 0 AND (p_size BETWEEN 20 AND 29 OR p_brand LIKE 'Brand#1%') AS hit
        FROM part""",
    "q_classify": f"""SELECT p_partkey, {tier(joined('p_name', 'p_type'), '(p_size BETWEEN 20 AND 29)', '(p_size BETWEEN 30 AND 39)',
        PART_CONFIG.strong_keywords, PART_CONFIG.weak_keywords)} AS tier FROM part""",
    # --- filters
    "q_text_search": f"WITH {RECORDS} SELECT d FROM rc WHERE regexp_matches(coalesce(one_sentence_desc, ''), '(?i){SEARCH}') "
    f"OR regexp_matches(coalesce(organisation_name, ''), '(?i){SEARCH}')",
    "q_filter_status": f"WITH {NOTICES} SELECT k, {STATUS_LABEL} AS label FROM g WHERE {STATUS_LABEL} IN ('Awarded', 'Planned')",
    "q_confidence_mode": f"""WITH {NOTICES} SELECT 'strong' AS mode, k FROM g WHERE ai_confidence = 'strong'
        UNION ALL SELECT 'both', k FROM g WHERE ai_confidence IN ('strong', 'weak')""",
    "q_stage_filter": f"""WITH {NOTICES} SELECT 'default' AS asked, k FROM g WHERE source = 'contracts_finder'
        UNION ALL SELECT 'all', k FROM g WHERE source = 'find_a_tender'
        UNION ALL SELECT 'tender', k FROM g WHERE stage = 'tender' AND source = 'contracts_finder'""",
    "q_date_range": "SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-08'",
    "q_year_range": """SELECT 'some' AS asked, o_orderkey FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998
        UNION ALL SELECT 'all', o_orderkey FROM orders""",
    # --- organisations
    "q_resolve": f"""WITH {NOTICES}, {ALIASES}, one AS (SELECT lower(trim(raw_name)) AS key, min_by(canonical_name, raw_name) AS c FROM al GROUP BY 1)
        SELECT k, c AS canonical_name FROM g LEFT JOIN one ON key = lower(trim(buyer_name))""",
    "q_alias_join": f"""WITH {NOTICES}, {ALIASES} SELECT k, canonical_name FROM g
        JOIN al ON lower(trim(buyer_name)) = lower(trim(raw_name))""",
    "q_unmatched_names": f"""WITH {NOTICES}, {ALIASES} SELECT DISTINCT lower(trim(buyer_name)) AS raw FROM g
        WHERE lower(trim(buyer_name)) NOT IN (SELECT lower(trim(raw_name)) FROM al)""",
    # --- views
    "q_dedup_richest": f"WITH {DEDUP} SELECT notice_id, source, title, buyer_name, value_amount, has_awards, published_date FROM dd",
    "q_reporting_gap": f"WITH {_GAP} SELECT * FROM gap",
    "q_gap_top": f"""WITH {_GAP} SELECT * FROM gap WHERE ai_procurement_count > 0 OR atrs_record_count > 0
        ORDER BY ai_procurement_count DESC, canonical_name LIMIT 25""",
    "q_gap_long": f"""WITH {_GAP} SELECT canonical_name, 'AI-flagged contracts' AS metric, ai_procurement_count AS count FROM gap
        UNION ALL SELECT canonical_name, 'ATRS registrations', atrs_record_count FROM gap""",
    "q_spend_by_month": _spend("SELECT DISTINCT lower(trim(raw_name)) AS key, canonical_name FROM al"),
    "q_spend_by_month_as_is": _spend("SELECT lower(trim(raw_name)) AS key, canonical_name FROM al"),
    "q_wpq_trends": f"""WITH {QUESTIONS} SELECT department, {_month('date_tabled')} AS month,
        count(*) AS question_count FROM qn WHERE ai_relevance_flag GROUP BY 1, 2""",
    "q_announcement_trends": f"""WITH {ANNOUNCEMENTS} SELECT {_month('public_timestamp')} AS month, document_type,
        count(*) AS announcement_count FROM asilver GROUP BY 1, 2""",
    "q_capacity_overview": f"""WITH {ZONES} SELECT zone_id, zone_name, region, status, investment_gbp, compute_capacity,
        announced_date, lead_org, source_url FROM z""",
    "q_run_counts": f"""WITH {NOTICES} SELECT count(*) AS n_rows, count(*) FILTER (WHERE reason IS NULL) AS n_parsed,
        count(*) FILTER (WHERE reason IS NULL AND ai_confidence <> 'none') AS n_relevant,
        count(*) FILTER (WHERE reason IS NOT NULL) AS n_errors FROM n""",
    # --- report operators
    "q_kpis": f"""WITH {DEDUP} SELECT count(*) AS n_contracts, round(coalesce(sum(value_amount), 0), 2) AS spend,
        count(*) FILTER (WHERE contract_status = 'awarded') AS n_awarded,
        count(*) FILTER (WHERE contract_status = 'open') AS n_open,
        count(*) FILTER (WHERE contract_status = 'planned') AS n_planned,
        round(coalesce(sum(value_amount) FILTER (WHERE contract_status = 'awarded'), 0), 2) AS awarded_value,
        median(value_amount) AS median_value FROM dd WHERE ai_confidence = 'strong'""",
    "q_exact_median": "SELECT 'price' AS what, median(o_totalprice) AS median_value FROM orders "
    "UNION ALL SELECT 'quantity', median(l_quantity) FROM lineitem",
    "q_zone_kpis": f"""WITH {ZONES} SELECT count(*) AS n_zones, count(*) FILTER (WHERE status = 'confirmed') AS n_confirmed,
        round(coalesce(sum(investment_gbp), 0), 0) AS pledged,
        {money_bn('nullif(sum(investment_gbp), 0)')} AS pledged_text FROM z""",
    "q_source_counts": f"""WITH {DEDUP} SELECT count(*) AS n_contracts,
        count(*) FILTER (WHERE source = 'contracts_finder') AS contracts_finder,
        count(*) FILTER (WHERE source = 'find_a_tender') AS find_a_tender FROM dd""",
    "q_monthly_by_source": f"""WITH {DEDUP} SELECT {_month('published_date')} AS month, source,
        round(coalesce(sum(value_amount), 0), 2) AS value, count(*) AS notices FROM dd
        WHERE published_date IS NOT NULL GROUP BY 1, 2""",
    "q_monthly_counts": f"""WITH {ANNOUNCEMENTS}, {QUESTIONS}
        SELECT {_month('public_timestamp')} AS month, document_type AS grp, count(*) AS count FROM asilver
        WHERE public_timestamp IS NOT NULL AND document_type IS NOT NULL GROUP BY 1, 2
        UNION ALL SELECT {_month('date_tabled')}, 'question', count(*) FROM qsilver WHERE date_tabled IS NOT NULL GROUP BY 1""",
    "q_phase_counts": f"WITH {RECORDS} SELECT phase, count(*) AS count FROM rc WHERE phase IS NOT NULL GROUP BY 1",
    "q_top_departments": f"""WITH {QUESTIONS} SELECT department, count(*) AS count FROM qsilver
        WHERE date_tabled IS NOT NULL AND department IS NOT NULL GROUP BY 1 ORDER BY count DESC, department LIMIT 10""",
    "q_facets": f"""WITH {NOTICES}, {RECORDS}, st AS (SELECT DISTINCT {STATUS_LABEL} AS label FROM g)
        SELECT 'phase' AS facet, phase AS value, CAST(NULL AS INT) AS position FROM (SELECT DISTINCT phase FROM rc WHERE phase IS NOT NULL)
        UNION ALL SELECT 'status', label, CAST(list_position({list(fixed.STATUS_LABELS.values())}, label) AS INT) FROM st""",
    "q_top_contracts": f"""WITH {DEDUP}, t AS (SELECT * FROM dd ORDER BY value_amount DESC NULLS LAST, notice_id LIMIT 20)
        SELECT buyer_name AS "Buyer", title AS "Title", {money('value_amount')} AS "Value", {STATUS_LABEL} AS "Status",
        {_SUMMARY} AS "Supplier(s)", source AS "Source", strftime(published_date, '%Y-%m-%d') AS "Published", source_url AS "Link" FROM t""",
    "q_record_listing": f"""WITH {RECORDS} SELECT organisation_name AS "Organisation", phase AS "Phase",
        standard_version AS "Version", strftime(date_published, '%Y-%m-%d') AS "Published",
        one_sentence_desc AS "Description", source_url AS "Link" FROM rc WHERE phase IN ('pilot', 'production')""",
    "q_announcement_listing": f"""WITH {ANNOUNCEMENTS} SELECT strftime(public_timestamp, '%Y-%m-%d') AS "Published",
        document_type AS "Type", title AS "Title", summary AS "Summary", source_url AS "Link" FROM asilver
        WHERE public_timestamp IS NOT NULL""",
    "q_latest_questions": f"""WITH {QUESTIONS} SELECT strftime(date_tabled, '%Y-%m-%d') AS "Tabled", house AS "House",
        department AS "Department", member_name AS "Member", substr(question_text, 1, 160) AS "Question", source_url AS "Link"
        FROM qsilver WHERE date_tabled IS NOT NULL""",
    "q_zone_listing": f"""WITH {ZONES} SELECT zone_name AS "Zone", region AS "Region", status AS "Status",
        {money_bn('investment_gbp')} AS "£ pledged", compute_capacity AS "Compute",
        strftime(announced_date, '%Y-%m-%d') AS "Announced", source_url AS "Source", notes AS "Notes" FROM z""",
    "q_preview": f"""WITH {RECORDS} SELECT record_id, substr(one_sentence_desc, 1, 80) AS one_sentence_desc,
        substr(CAST(date_published AS VARCHAR), 1, 80) AS date_published FROM (SELECT * FROM rc ORDER BY d LIMIT 5)""",
    # --- merges
    "q_merge_notices": f"""WITH {SILVER} SELECT notice_id, source, title, ai_confidence, CAST(NULL AS VARCHAR) AS enrichment_version
        FROM silver WHERE notice_id NOT IN (SELECT notice_id FROM g WHERE k % 20 = 1)""",
    "q_merge_notices_all": f"""WITH {NOTICES} SELECT notice_id, title, ai_relevant FROM g
        QUALIFY row_number() OVER (PARTITION BY notice_id ORDER BY k) = 1""",
    "q_merge_announcements": f"""WITH {ANNOUNCEMENTS} SELECT announcement_id, title, ai_confidence FROM asilver
        WHERE announcement_id NOT IN (SELECT announcement_id FROM ag WHERE d % 7 = 0)""",
    "q_merge_questions": f"""WITH {QUESTIONS} SELECT question_id, department, member_name FROM qsilver WHERE turn % 3 <> 0""",
    "q_merge_records": f"WITH {RECORDS} SELECT record_id, organisation_name, date_published FROM rc WHERE d % 3 <> 0",
    "q_seed_merge": f"""WITH {ALIASES}, {ZONES}
        SELECT 'alias' AS kind, raw_name AS key, canonical_name AS value FROM al
        WHERE raw_name NOT IN (SELECT n_name FROM nation WHERE n_nationkey % 4 = 0)
        UNION ALL SELECT 'zone', zone_id, CAST(announced_date AS VARCHAR) FROM z WHERE status = 'confirmed'""",
    "q_keep_first": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) = 1""",
    "q_load_archive": f"""WITH {NOTICES} SELECT notice_id, title, ai_confidence, published_date FROM g
        WHERE ai_relevant QUALIFY row_number() OVER (PARTITION BY notice_id ORDER BY k) = 1""",
    "q_incremental": f"{_WAVES} SELECT notice_id, title, ai_confidence FROM kept",
    "q_load_announcements": f"""WITH {ANNOUNCEMENTS} SELECT announcement_id, title, ai_confidence, 'one' AS run FROM ag
        WHERE ai_relevant AND document_type IN ({", ".join(f"'{t}'" for t in fixed.ANNOUNCEMENT_DOCUMENT_TYPES)})
        QUALIFY row_number() OVER (PARTITION BY announcement_id ORDER BY d) = 1""",
    "q_load_questions": f"WITH {QUESTIONS} SELECT question_id, department, date_tabled FROM qsilver",
    "q_load_records": f"WITH {RECORDS} SELECT record_id, organisation_name, sensitive_attributes FROM rc",
    "q_one_table": f"{_WAVES} SELECT notice_id, ai_confidence FROM kept",
    "q_load_years": f"""WITH {NOTICES}, y AS (SELECT g.*, year(o_orderdate) AS year FROM g JOIN orders o ON o.o_orderkey = g.k)
        SELECT notice_id, title, stage, ai_confidence FROM y
        WHERE ai_relevant AND year BETWEEN 1994 AND 1995 AND (source <> 'contracts_finder' OR stage IN ('award', 'tender'))
        QUALIFY row_number() OVER (PARTITION BY notice_id ORDER BY year, k) = 1""",
    "q_compacted": f"WITH {SILVER} SELECT notice_id, title, 1 AS n_parts FROM silver",
    "q_stream_announcements": f"""WITH {ANNOUNCEMENTS} SELECT announcement_id, ai_confidence FROM ag
        WHERE ai_relevant AND document_type IN ({", ".join(f"'{t}'" for t in fixed.ANNOUNCEMENT_DOCUMENT_TYPES)})
        QUALIFY row_number() OVER (PARTITION BY announcement_id ORDER BY CASE WHEN d % 3 = 0 THEN 0 ELSE 1 END, d) = 1""",
    "q_stream_questions": f"WITH {QUESTIONS} SELECT question_id, department, date_tabled FROM qsilver",
    "q_stream_records": f"WITH {RECORDS} SELECT record_id, organisation_name, sensitive_attributes FROM rc",
    "q_stream_counts": _STREAMED,
}
