"""Versioned keyword and code-prefix relevance tiers."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeworks import fixed_values as fixed
from noticeworks.functions.text import blank_to_null, col, java_quote

# Texts are lower-case: naming their commonest letters first spares most look-ups of Unicode classes.
_WORD, _NO_WORD = r"[a-z0-9_\p{L}\p{N}]", r"[^a-z0-9_\p{L}\p{N}]"


@dataclass(frozen=True)
class RelevanceConfig:
    """Word lists and code prefixes, with the version stamped on every classified row."""

    strong_keywords: tuple[str, ...] = ()
    weak_keywords: tuple[str, ...] = ()
    strong_cpv_prefixes: tuple[str, ...] = ()
    weak_cpv_prefixes: tuple[str, ...] = ()
    version: str = "unknown"

    def __post_init__(self) -> None:
        for word in (*self.strong_keywords, *self.weak_keywords):
            if not re.fullmatch(r"\w(.*\w)?", word):
                raise ValueError(f"keyword must start and end with a word character: {word!r}")


DEFAULT_CONFIG = RelevanceConfig(
    strong_keywords=fixed.STRONG_KEYWORDS,
    weak_keywords=fixed.WEAK_KEYWORDS,
    strong_cpv_prefixes=fixed.STRONG_CPV_PREFIXES,
    weak_cpv_prefixes=fixed.WEAK_CPV_PREFIXES,
    version=fixed.RELEVANCE_VERSION,
)


def search_text(title: Column | str, description: Column | str) -> Column:
    return F.lower(F.concat_ws(" ", blank_to_null(title), blank_to_null(description)))


def _letters(text: str, ascii_only: bool) -> str:
    """``text`` as a pattern. Besides capitals, only ``ı`` and ``ſ`` equal an ASCII letter when case
    is ignored; naming them spares the slow case-blind matching."""
    quoted = java_quote(text)
    return quoted.replace("i", "[iı]").replace("s", "[sſ]") if ascii_only else quoted


def _alternatives(words: list[str], ascii_only: bool) -> str:
    """Words as one alternation, grouped by first letter so that few are tried at each place."""
    by_letter: dict[str, list[str]] = {}
    for w in words:
        by_letter.setdefault(w[0], []).append(_letters(w[1:], ascii_only))
    return "|".join(f"{_letters(c, ascii_only)}(?:{'|'.join(rest)})" for c, rest in by_letter.items())


def any_keyword(lowered: Column | str, keywords: tuple[str, ...]) -> Column:
    """True where the lower-case text holds one of the keywords as whole words, in any case.

    A word is made of Unicode letters, numbers and underscore, so ``ai`` is found in ``AI-powered``
    but in neither ``maintain`` nor ``éai``. One literal pattern is compiled once per task.
    """
    if not keywords:
        return F.lit(False)
    words = [k.lower() for k in keywords]
    ascii_only = all(w.isascii() for w in words)
    flags = "" if ascii_only else "(?iu)"
    # A word begins after a character that is none of a word's, so only those places are looked at; the blank
    # in front stands for the text's start. The look at the first letter turns most of them away.
    first = "|".join(sorted({_letters(w[0], ascii_only) for w in words}))
    if ascii_only:  # one class instead of a letter after the other
        first = f"[{re.sub('[^a-z0-9_ıſ]', '', first)}]"
    hit = F.concat(F.lit(" "), col(lowered)).rlike(
        f"{flags}{_NO_WORD}(?={first})(?:{_alternatives(words, ascii_only)})(?!{_WORD})"
    )
    return F.coalesce(hit, F.lit(False))


def any_code_prefix(codes: Column | str | None, prefixes: tuple[str, ...]) -> Column:
    """True where a code starts with one of the prefixes; a NULL or empty list is False."""
    if codes is None or not prefixes:
        return F.lit(False)

    def starts(code: Column) -> Column:
        hit = code.startswith(prefixes[0])
        for p in prefixes[1:]:
            hit = hit | code.startswith(p)
        return F.coalesce(hit, F.lit(False))

    return F.coalesce(F.exists(col(codes), starts), F.lit(False))


def classify(
    title: Column | str,
    description: Column | str,
    codes: Column | str | None = None,
    config: RelevanceConfig = DEFAULT_CONFIG,
) -> Column:
    """``strong``, ``weak`` or ``none``.

    A strong keyword is enough for ``strong``; a weak keyword needs a strong code beside it. A weak
    keyword or any listed code alone is ``weak``.
    """
    text = search_text(title, description)
    # Most texts hold no keyword at all: one search for both kinds tells, and the others are for the rest.
    no_word = ~any_keyword(text, config.strong_keywords + config.weak_keywords)
    strong_word = any_keyword(text, config.strong_keywords)
    weak_word = any_keyword(text, config.weak_keywords)
    strong_code = any_code_prefix(codes, config.strong_cpv_prefixes)
    weak_code = any_code_prefix(codes, config.weak_cpv_prefixes)
    return (
        F.when(no_word, F.when(strong_code | weak_code, "weak").otherwise("none"))
        .when(strong_word, "strong")
        .when(weak_word, F.when(strong_code, "strong").otherwise("weak"))
        .when(strong_code | weak_code, "weak")
        .otherwise("none")
    )


def is_relevant(tier: Column | str) -> Column:
    return col(tier) != "none"
