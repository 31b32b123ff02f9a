"""Parameters shared by the registered queries and their checking SQL."""

from noticeworks.functions.relevance import RelevanceConfig

CAP = 20
SLUGS = ("src1", "src2", "src13")
SEARCH = "the|tion"
CORPUS_KEYWORDS = ("que", "of the", "eaux", "die", "los")
PART_CONFIG = RelevanceConfig(
    strong_keywords=("gizmo", "red ring"),
    weak_keywords=("plate", "small"),
    strong_cpv_prefixes=("2",),
    weak_cpv_prefixes=("3",),
    version="parts",
)
