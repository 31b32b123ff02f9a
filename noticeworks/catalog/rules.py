"""How raw records are made up from the test tables.

The tables hold no public records, so the queries derive some: one release per order, one announcement
and one transparency record per document, one question per conversation turn. The rules here are plain
scalar SQL that Spark and DuckDB both run. Spark puts the scalars into JSON, CSV or HTML texts and runs
the library over those; the checking SQL never sees the texts and works the answer out from the same
scalars.
"""

# One row per order, over: orders o JOIN customer c ON c_custkey = o_custkey JOIN nation n.
ORDER_FROM = """orders o JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey"""
ORDER_SCALARS = {
    "k": "o_orderkey",
    # Orders ending in 8 repeat the notice of the order before.
    "nk": "CASE WHEN o_orderkey % 10 = 8 THEN o_orderkey - 1 ELSE o_orderkey END",
    "src": "CASE WHEN o_orderkey % 5 = 4 THEN 'find_a_tender' ELSE 'contracts_finder' END",
    "ost": "o_orderstatus",
    "day": "CAST(o_orderdate AS DATE)",
    "seg": "c_mktsegment",
    "nname": "n_name",
    "nkey": "n_nationkey",
    "step": "floor(o_totalprice / 25000)",
    "phrase": """CASE o_orderkey % 12 WHEN 0 THEN 'Artificial Intelligence triage'
        WHEN 1 THEN 'AI-powered records' WHEN 2 THEN 'Maintain air units'
        WHEN 3 THEN 'Machine learning platform' WHEN 4 THEN 'Algorithm review'
        WHEN 5 THEN 'Office cleaning' WHEN 6 THEN 'Automation of forms'
        WHEN 7 THEN 'Chatbots for benefits' WHEN 8 THEN 'éai systems'
        WHEN 9 THEN 'Predictive, analytics' WHEN 10 THEN 'Decision support desk'
        ELSE 'Generic IT services' END""",
    "cpv": """CASE o_orderkey % 6 WHEN 0 THEN '72220000' WHEN 1 THEN '48000000'
        WHEN 2 THEN '90911200' WHEN 3 THEN '72230000' WHEN 4 THEN '72210000' END""",
}
ORDER_STEP_2 = {
    "ocid": """CASE WHEN k % 101 = 0 THEN '' WHEN src = 'find_a_tender'
        THEN concat('ocds-h6vhtk-', CAST(nk AS STRING)) ELSE concat('ocds-b5fd17-', CAST(nk AS STRING)) END""",
    "rid": """CASE WHEN k % 8 = 1 THEN NULL WHEN k % 103 = 0 THEN ''
        ELSE concat('r-', CAST(nk AS STRING)) END""",
    "titlevar": """CASE k % 3 WHEN 0 THEN phrase WHEN 1 THEN upper(phrase)
        ELSE concat(replace(phrase, ' ', '  '), ' !') END""",
    "descr": """CASE WHEN k % 23 = 0 THEN NULL ELSE concat('Supply for ', seg, ' sector',
        CASE WHEN k % 31 = 0 THEN ' using neural network models' ELSE '' END) END""",
    "tstatus": """CASE ost WHEN 'F' THEN 'complete'
        WHEN 'O' THEN CASE WHEN k % 37 = 0 THEN 'cancelled' WHEN k % 41 = 0 THEN 'withdrawn' ELSE 'active' END
        ELSE CASE WHEN k % 2 = 0 THEN 'planning' WHEN k % 43 = 0 THEN 'on hold' ELSE 'planned' END END""",
    "method": "CASE k % 3 WHEN 0 THEN 'open' WHEN 1 THEN 'limited' END",
    "tamount": "CASE WHEN k % 11 = 0 OR k % 127 = 0 THEN NULL ELSE step * 1000 + 0.5 END",
    "has_aw": "ost = 'F'",
    "a1amount": "CASE WHEN ost = 'F' AND k % 7 <> 0 THEN step * 900 + 0.0 END",
    "a2": "ost = 'F' AND k % 3 = 0",
    "buyer": """CASE WHEN k % 109 = 0 THEN NULL ELSE CASE k % 4 WHEN 0 THEN nname WHEN 1 THEN lower(nname)
        WHEN 2 THEN concat('  ', nname, ' ') ELSE replace(nname, '_', ' ') END END""",
}

# One row per document, over: documents.
DOC_SCALARS = {
    "d": "doc_id",
    "link": """CASE WHEN doc_id % 97 = 0 THEN NULL ELSE concat('/government/news/doc-',
        CAST(CASE WHEN doc_id % 10 = 8 THEN doc_id - 1 ELSE doc_id END AS STRING)) END""",
    "atitle": "concat(CASE WHEN doc_id % 4 = 0 THEN 'AI Growth: ' ELSE '' END, text)",
    "adesc": "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE text END",
    "dtype": """CASE doc_id % 10 WHEN 0 THEN 'press_release' WHEN 1 THEN 'news_story'
        WHEN 2 THEN 'policy_paper' WHEN 3 THEN 'consultation' WHEN 4 THEN 'guidance'
        WHEN 5 THEN 'speech' WHEN 6 THEN 'manual' WHEN 7 THEN NULL ELSE 'news_story' END""",
    "day": "DATE '2023-01-15' + CAST(doc_id % 900 AS INT)",
    "source": "source",
    "lang": "lang",
    "text": "text",
}

# One row per conversation turn, over: conversations.
TURN_SCALARS = {
    "qid": "conv_id * 100000 + turn",
    "conv_id": "conv_id",
    "turn": "turn",
    "house": "CASE role WHEN 'user' THEN 'Commons' WHEN 'assistant' THEN 'Lords' END",
    "heading": "text",
    "text": "text",
    "dept": "CASE WHEN conv_id % 13 = 0 THEN NULL ELSE concat('Department ', CAST(conv_id % 7 AS STRING)) END",
    "day": "DATE '2022-11-01' + CAST((conv_id * 17 + turn) % 800 AS INT)",
}


def select_list(scalars: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in scalars.items())


ORDER_SQL = (
    f"SELECT *, {select_list(ORDER_STEP_2)} FROM "
    f"(SELECT {select_list(ORDER_SCALARS)} FROM {ORDER_FROM}) base"
)
DOC_SQL = f"SELECT {select_list(DOC_SCALARS)} FROM documents"
TURN_SQL = f"SELECT {select_list(TURN_SCALARS)} FROM conversations"
