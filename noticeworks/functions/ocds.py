"""Fields of one procurement release, as Column expressions over the parsed struct.

Every leaf is read as STRING and cast afterwards: ``from_json`` would otherwise give up the whole
record over one number written as text. ``MAP`` is used where a key that is present with ``null``
means something else than a missing key.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeworks import fixed_values as fixed
from noticeworks.functions.text import (
    blank_to_null,
    col,
    first_non_blank,
    iso_day,
)

_DOCUMENTS = "array<struct<url string, title string, description string, documentType string>>"

#: ``unread`` (see :data:`UNREAD`) is the whole text where a part is of another kind than here, or the text no object, else NULL.
RELEASE_SCHEMA = f"""struct<
    ocid string, id string, date string, publishedDate string, tag array<string>, stage string,
    tender struct<title string, description string, status string, procurementMethod string,
        value map<string,string>,
        classification struct<scheme string, id string>,
        items array<struct<classification struct<scheme string, id string>>>,
        contractPeriod map<string,string>,
        documents {_DOCUMENTS}>,
    planning struct<project struct<title string>>,
    buyer struct<name string, identifier struct<id string>>,
    relatedProcesses array<struct<id string, relationship string, identifier string>>,
    awards string, unread string>"""

UNREAD = {"columnNameOfCorruptRecord": "unread"}

AWARDS_SCHEMA = f"""array<struct<status string, value map<string,string>,
    suppliers array<struct<name string, identifier struct<id string>>>,
    contractPeriod map<string,string>,
    documents {_DOCUMENTS}>>"""


def _first(array: Column) -> Column:
    return F.try_element_at(array, F.lit(1))


def _key(mapping: Column, key: str) -> Column:
    return F.try_element_at(mapping, F.lit(key))


def _or_empty(array: Column, element: str) -> Column:
    return F.coalesce(array, F.array().cast(f"array<{element}>"))


def notice_title(r: Column) -> Column:
    return first_non_blank(r["tender"]["title"], r["planning"]["project"]["title"])


def cpv_codes(r: Column) -> Column:
    """CPV ids of the items in order, with the tender's own id put in front unless already there."""

    def is_cpv(c: Column) -> Column:
        return (F.upper(c["scheme"]) == "CPV") & blank_to_null(c["id"]).isNotNull()

    items = F.filter(r["tender"]["items"], lambda i: F.coalesce(is_cpv(i["classification"]), F.lit(False)))
    codes = _or_empty(F.transform(items, lambda i: i["classification"]["id"]), "string")
    top = r["tender"]["classification"]
    put_in_front = F.coalesce(is_cpv(top), F.lit(False)) & ~F.array_contains(
        codes, F.coalesce(top["id"], F.lit(""))
    )
    return F.when(put_in_front, F.concat(F.array(top["id"]), codes)).otherwise(codes)


def headline_value(r: Column, awards: Column) -> Column:
    """The ``value`` map of the first award with an amount, else the tender's if it has one."""
    return F.coalesce(
        _first(F.filter(awards, lambda a: _key(a["value"], "amount").isNotNull()))["value"],
        F.when(_key(r["tender"]["value"], "amount").isNotNull(), r["tender"]["value"]),
    )


def amount_text(value: Column | str) -> Column:
    return _key(col(value), "amount")


def currency(value: Column | str) -> Column:
    """GBP only where the key is missing; an explicit null stays NULL."""
    v = col(value)
    return F.when(
        F.coalesce(F.map_contains_key(v, "currency"), F.lit(False)), _key(v, "currency")
    ).otherwise(fixed.DEFAULT_CURRENCY)


def headline_supplier(awards: Column) -> Column:
    """First supplier of the first award that has any: ``struct(name, id)``."""
    award = _first(F.filter(awards, lambda a: F.size(_or_zero(a["suppliers"])) > 0))
    supplier = _first(award["suppliers"])
    return F.struct(
        F.coalesce(blank_to_null(supplier["name"]), F.lit(fixed.UNKNOWN_SUPPLIER)).alias("name"),
        supplier["identifier"]["id"].alias("id"),
    )


def _or_zero(suppliers: Column) -> Column:
    return _or_empty(suppliers, "struct<name string, identifier struct<id string>>")


def all_documents(r: Column, awards: Column) -> Column:
    """Tender then award documents that have a URL, numbered: ``array<struct(url, pos, doc)>``.

    Sorted by URL then position, so that :func:`distinct_documents` can drop repeats by looking at
    the neighbour only; this keeps a notice with very many documents at n·log n.
    """
    empty = _DOCUMENTS.removeprefix("array<").removesuffix(">")
    docs = F.concat(
        _or_empty(r["tender"]["documents"], empty),
        _or_empty(
            F.flatten(
                F.filter(
                    F.transform(awards, lambda a: a["documents"]), lambda d: d.isNotNull()
                )
            ),
            empty,
        ),
    )
    numbered = F.transform(docs, lambda d, i: F.struct(d["url"].alias("url"), i.alias("pos"), d.alias("doc")))
    return F.array_sort(
        F.filter(numbered, lambda d: blank_to_null(d["url"]).isNotNull())
    )


def distinct_documents(sorted_docs: Column | str) -> Column:
    """First document per URL in original order: ``array<struct(title, url, documentType)>``.

    ``sorted_docs`` must be a materialised column of :func:`all_documents`.
    """
    s = col(sorted_docs)
    kept = F.filter(
        s, lambda d, i: (i == 0) | (d["url"] != F.get(s, i - 1)["url"])
    )
    in_order = F.array_sort(F.transform(kept, lambda d: F.struct(d["pos"].alias("pos"), d["doc"].alias("doc"))))
    return F.transform(
        in_order,
        lambda d: F.struct(
            first_non_blank(d["doc"]["title"], d["doc"]["description"]).alias("title"),
            d["doc"]["url"].alias("url"),
            d["doc"]["documentType"].alias("documentType"),
        ),
    )


def json_or_null(array: Column) -> Column:
    """JSON text that keeps null fields; NULL for an empty or missing array."""
    return F.when(F.size(array) > 0, F.to_json(array, {"ignoreNullFields": "false"}))


def contract_status(r: Column, awards: Column) -> Column:
    won = F.exists(
        awards,
        lambda a: (F.size(_or_zero(a["suppliers"])) > 0)
        & (a["status"].isNull() | (a["status"] == "active")),
    )
    status = r["tender"]["status"]
    return (
        F.when(F.coalesce(won, F.lit(False)), "awarded")
        .when(status == "active", "open")
        .when(status.isin("planning", "planned"), "planned")
        .when(status.isin("cancelled", "unsuccessful", "withdrawn"), status)
        .when(status == "complete", "closed")
        .otherwise("unknown")
    )


def own_documents(documents: Column | str, source: Column) -> Column:
    """Documents that lie on the source's own site."""
    domain = F.when(
        source == fixed.CONTRACTS_FINDER, fixed.NOTICE_DOMAINS[fixed.CONTRACTS_FINDER]
    ).otherwise(fixed.NOTICE_DOMAINS[fixed.FIND_A_TENDER])
    return F.filter(col(documents), lambda d: F.contains(d["url"], domain))


def notice_url(own: Column | str, ocid: Column, source: Column) -> Column:
    """Public notice page, NULL if there is no telling.

    The publisher's own link (``own`` holds those of :func:`own_documents`) wins, by document type
    and then by position. Without one, a Contracts Finder page follows from the ocid.
    """
    docs = col(own)

    def first_of_type(wanted: str) -> Column:
        return _first(F.filter(docs, lambda d: d["documentType"] == wanted))["url"]

    published = F.when(
        F.size(docs) > 0,
        F.coalesce(*[first_of_type(t) for t in fixed.NOTICE_DOCUMENT_TYPES], _first(docs)["url"]),
    )
    built = F.when(
        (source == fixed.CONTRACTS_FINDER) & blank_to_null(ocid).isNotNull(),
        F.concat(
            F.lit(fixed.CONTRACTS_FINDER_NOTICE_URL),
            F.substring_index(ocid, fixed.CONTRACTS_FINDER_OCID_PREFIX, -1),
        ),
    )
    return F.coalesce(published, built)


def framework_id(r: Column) -> Column:
    """Identifier of the first related process that is a framework.

    ``relationship`` may be a text or a list; read as STRING both hold the word.
    """
    process = _first(
        F.filter(r["relatedProcesses"], lambda p: F.contains(F.lower(p["relationship"]), F.lit("framework")))
    )
    return F.coalesce(blank_to_null(process["identifier"]), process["id"])


def award_period(awards: Column) -> Column:
    """The contract period (a map) of the first award that has one."""
    return _first(
        F.filter(awards, lambda a: F.coalesce(F.size(a["contractPeriod"]) > 0, F.lit(False)))
    )["contractPeriod"]


def contract_dates(r: Column, period: Column | str) -> Column:
    """Day texts ``struct(published, start, end)``; ``period`` is the award's.

    Without any day in it the tender's period is taken.
    """
    award, tender = col(period), r["tender"]["contractPeriod"]
    a_start, a_end = iso_day(_key(award, "startDate")), iso_day(_key(award, "endDate"))
    use_tender = a_start.isNull() & a_end.isNull()
    start = F.when(use_tender, iso_day(_key(tender, "startDate"))).otherwise(a_start)
    end = F.when(use_tender, iso_day(_key(tender, "endDate"))).otherwise(a_end)
    return F.struct(
        iso_day(first_non_blank(r["date"], r["publishedDate"])).alias("published"),
        start.alias("start"),
        end.alias("end"),
    )


def backwards(dates: Column | str) -> Column:
    """A period that ends before it starts; neither end of it can be trusted."""
    d = col(dates)
    return F.coalesce(d["end"] < d["start"], F.lit(False))


def stage(r: Column) -> Column:
    return F.when(F.size(r["tag"]) > 0, _first(r["tag"])).otherwise(r["stage"])


# --- wrong types ---------------------------------------------------------------------------------

#: What each part has to be, if it is there: a path, in which ``[]`` stands for each element, and a kind. Where several parts are wrong,
#: the first of the list is named. Parts that are read only without a tender title come second.
KINDS = (
    ("tender", "object"),
    ("buyer", "object"),
    ("buyer.identifier", "object"),
    ("tender.value", "object"),
    ("tender.classification", "object"),
    ("tender.classification.scheme", "text"),
    ("tender.contractPeriod", "object"),
    ("tender.title", "text"),
    ("tender.description", "text"),
    ("date", "text"),
    ("tender.items", "list"),
    ("tender.items[]", "object"),
    ("tender.items[].classification", "object"),
    ("tender.items[].classification.scheme", "text"),
    ("tender.documents", "list"),
    ("tender.documents[]", "object"),
    ("relatedProcesses", "list"),
    ("relatedProcesses[]", "object"),
    ("tag", "list"),
    ("awards", "list"),
    ("awards[]", "object"),
    ("awards[].value", "object"),
    ("awards[].suppliers", "list"),
    ("awards[].documents", "list"),
    ("awards[].documents[]", "object"),
    ("awards[].contractPeriod", "object"),
)
KINDS_WITHOUT_TITLE = (("planning", "object"), ("planning.project", "object"))
_VARIANT_KINDS = {"object": "OBJECT", "list": "ARRAY", "text": "STRING"}
#: How a number, a truth value, an object or a list looks as a text.
_ODD = r"^(-?[0-9][0-9.eE+-]*|true|false|[{\[](?s:.*))$"


def _is_no(kind: str, x: Column, element: bool) -> Column:
    """Whether ``x`` (VARIANT) is there and not of the kind. Empty texts and objects do as lists, as nothing is read from them; a
    null counts only as the element of a list, :func:`null_reason` sees to the others."""
    shape = F.schema_of_variant(x)
    wrong = ~F.startswith(shape, F.lit(_VARIANT_KINDS[kind]))
    if not element:
        wrong = wrong & (shape != "VOID")
    if kind == "list":
        wrong = wrong & ~F.coalesce(x.try_cast("string").isin("", "{}"), F.lit(False))
    return F.coalesce(wrong, F.lit(False))


def _compiled(path: str, kind: str):
    """A test of one line of the table, over a VARIANT."""
    first, *rest = path.split("[]")

    def at(x: Column, steps: list[str]) -> Column:
        step = steps[0].strip(".")
        if len(steps) == 1:
            return _is_no(kind, F.try_variant_get(x, f"$.{step}", "variant") if step else x, element=not step)
        elements = F.try_variant_get(x, f"$.{step}" if step else "$", "array<variant>")
        return F.coalesce(F.exists(elements, lambda e: at(e, steps[1:])), F.lit(False))

    return lambda v: at(v, [first, *rest])


def _spoken(path: str) -> str:
    return path.replace("awards[].contractPeriod", "award contract period").replace("awards[].", "award ").replace("[]", " element")


def type_reason(v: Column, r: Column, awards: Column, looked_into: Column | None = None) -> Column:
    """Why a release with a part of another kind than :data:`KINDS` says cannot be read, or NULL.

    ``v`` is the release as VARIANT, NULL where :func:`suspicious` found nothing to look into; the table is gone through only where
    ``looked_into`` (:func:`miscounted`) holds, too. Of the suppliers only the one that is taken matters: the first of the first award that has any.
    """
    no_title = blank_to_null(r["tender"]["title"]).isNull()

    def tests(kinds) -> list[Column]:
        return [F.when(_compiled(path, kind)(v), f"{_spoken(path)} is no {kind}") for path, kind in kinds]

    v_awards = F.try_variant_get(v, "$.awards", "array<variant>")
    filled = F.filter(v_awards, lambda a: F.coalesce(F.size(F.try_variant_get(a, "$.suppliers", "array<variant>")) > 0, F.lit(False)))
    supplier = F.try_variant_get(F.get(filled, F.lit(0)), "$.suppliers[0]", "variant")
    taken = [
        F.when(_is_no("object", supplier, element=True), "award supplier is no object"),
        F.when(_is_no("object", F.try_variant_get(supplier, "$.identifier", "variant"), element=False), "supplier identifier is no object"),
    ]
    asked = v.isNotNull() if looked_into is None else v.isNotNull() & looked_into
    return F.when(asked, F.coalesce(*tests(KINDS), F.when(no_title, F.coalesce(*tests(KINDS_WITHOUT_TITLE))), *taken))


def _odd(x: Column) -> Column:
    return x.rlike(_ODD)


def _at(r: Column, path: str) -> Column:
    return functools.reduce(lambda part, name: part[name], path.split("."), r)


def _otherwise_odd(r: Column, awards: Column) -> Column:
    """Whether a list has an element that was not read, a text looks like something else, or the awards are no list."""
    texts = [_odd(_at(r, p)) for p, kind in KINDS if "[]" not in p and kind == "text"]
    items = F.exists(r["tender"]["items"], lambda i: i.isNull() | F.coalesce(_odd(i["classification"]["scheme"]), F.lit(False)))
    lists = [F.exists(part, lambda x: x.isNull()) for part in (r["tender"]["documents"], r["relatedProcesses"])]
    given = blank_to_null(r["awards"])
    no_list = (awards.isNull() & given.isNotNull()) | (r["awards"].startswith("{") & (r["awards"] != "{}"))
    each = F.exists(
        awards,
        lambda a: a.isNull()
        | F.coalesce(F.exists(a["documents"], lambda d: d.isNull()), F.lit(False))
        | F.coalesce(F.exists(a["suppliers"], lambda x: x.isNull()), F.lit(False)),
    )
    return _any(*texts, items, *lists, no_list, each)


def _any(*tests: Column) -> Column:
    return functools.reduce(lambda found, test: found | F.coalesce(test, F.lit(False)), tests, F.lit(False))


def _unread(part: Column, name: str, inside: Column) -> Column:
    return part.isNull() & F.contains(inside, F.lit(f'"{name}"'))


def _unread_of_awards(r: Column, awards: Column) -> Column:
    """Whether a part of an award was not read though its name occurs in the awards."""
    each = lambda a: _any(
        *(_unread(a[name], name, r["awards"]) for name in ("value", "suppliers", "documents", "contractPeriod")),
        F.exists(a["suppliers"], lambda x: _unread(x["identifier"], "identifier", r["awards"])),
    )
    return F.exists(awards, each)


def suspicious(r: Column, awards: Column) -> Column:
    """Whether a part may be of a wrong kind: the parser met one, one of an award was not read though its name occurs, or a text looks like
    something else.

    A quick look at what is parsed already; releases that pass it need no VARIANT.
    """
    return _any(r["unread"].isNotNull(), _otherwise_odd(r, awards), _unread_of_awards(r, awards))


def unread_parts(release: str, r: Column, awards: Column) -> Column:
    """Whether a part was not read though its name occurs, or is a text that looks like something else; for texts that have no VARIANT."""
    text = F.col(release)
    whole = [p for p, kind in KINDS if "[]" not in p and p != "awards" and kind != "text"] + [p for p, _ in KINDS_WITHOUT_TITLE]
    items = F.exists(r["tender"]["items"], lambda i: _unread(i["classification"], "classification", text))
    return _any(*(_unread(_at(r, p), p.split(".")[-1], text) for p in whole), items, _otherwise_odd(r, awards), _unread_of_awards(r, awards))


def miscounted(release: str, r: Column, awards: Column) -> Column:
    """Whether a part that :func:`suspicious` found unread, or something else of it, can be of a wrong kind at all.

    Every part that was read stands under a key of its own. So where the names of the parts occur no more often than parts of these names
    were read, none of them is wrong, however many releases or awards lack one. Only names written plainly can be counted: with an escape
    in a key, or a name in single quotes, nothing is taken as shown.
    """
    text, tender = F.col(release), r["tender"]

    def read(*parts: Column) -> Column:
        return sum((p.isNotNull().cast("int") for p in parts), F.lit(0))

    def read_of(array: Column, test) -> Column:
        return F.coalesce(F.array_size(F.filter(array, test)), F.lit(0))

    def of_awards(name: str) -> Column:
        return read_of(awards, lambda a: a[name].isNotNull())

    suppliers = F.flatten(F.filter(F.transform(awards, lambda a: a["suppliers"]), lambda x: x.isNotNull()))
    counted = [
        read(*(_at(r, p) for p, kind in KINDS if "[]" not in p and p != "awards" and kind != "text")),
        read(*(_at(r, p) for p, _ in KINDS_WITHOUT_TITLE)),
        read_of(tender["items"], lambda i: i["classification"].isNotNull()),
        read_of(r["relatedProcesses"], lambda p: p["identifier"].isNotNull()),
        read_of(suppliers, lambda x: x["identifier"].isNotNull()),
        *(of_awards(name) for name in ("value", "suppliers", "documents", "contractPeriod")),
    ]
    names = {p.removesuffix("[]").split(".")[-1] for p, kind in (*KINDS, *KINDS_WITHOUT_TITLE) if kind != "text"} - {"awards"}
    name = f"(?:{'|'.join(sorted(names))})"
    times = F.regexp_count(text, F.lit(rf'"{name}"\s*:'))  # the same word as a value is no key
    escaped = F.contains(text, F.lit("\\u")) & text.rlike(r'"[^"]*\\u[^"]*"\s*:')
    quoted = F.contains(text, F.lit("'")) & text.rlike(f"'{name}'")
    plain = ~escaped & ~quoted
    shown = plain & (times <= sum(counted, F.lit(0)))
    return ~F.coalesce(shown, F.lit(False)) | _otherwise_odd(r, awards)


def zero_id(release: str, r: Column) -> Column:
    """Whether the id is the number 0, which counts as none; the text "0" is an id."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(release), "$.id", "variant"))
    return r["id"].rlike(r"^-?0+(\.0+)?$") & F.coalesce(kind != "STRING", F.lit(False))


# --- explicit nulls -------------------------------------------------------------------------------


def _is_null(v: Column, path: str) -> Column:
    return F.coalesce(F.is_variant_null(F.try_variant_get(v, path, "variant")), F.lit(False))


def _first_index(array: Column, test) -> Column:
    """0-based index of the first element passing ``test``; NULL if none does."""
    pos = F.array_position(F.transform(array, test), F.lit(True))
    return F.when(pos > 0, (pos - 1).cast("int"))


def null_reason(v: Column, r: Column, awards: Column, period: Column) -> Column:
    """Why a release with an explicit ``null`` cannot be read, or NULL if it can.

    A null where an object or list is needed makes a release unreadable, but only where reading it
    gets that far: an award value is looked at only up to the first amount, the planning title only
    without a tender title, and so on. ``v`` is the release as VARIANT, which unlike a struct tells
    null from missing.
    """
    v_items = F.try_variant_get(v, "$.tender.items", "array<variant>")
    v_awards = F.try_variant_get(v, "$.awards", "array<variant>")
    no_title = blank_to_null(r["tender"]["title"]).isNull()

    paid = _first_index(awards, lambda a: _key(a["value"], "amount").isNotNull())
    null_value = F.exists(
        F.transform(v_awards, lambda a, i: _is_null(a, "$.value") & (paid.isNull() | (i < paid))),
        lambda x: x,
    )
    supplied = _first_index(awards, lambda a: F.size(_or_zero(a["suppliers"])) > 0)
    supplying = F.get(v_awards, supplied)
    tender_period = r["tender"]["contractPeriod"]

    def null_day(p: Column, key: str) -> Column:
        return F.coalesce(F.map_contains_key(p, key), F.lit(False)) & _key(p, key).isNull()

    any_null_day = null_day(period, "startDate") | null_day(period, "endDate")
    no_award_day = (
        iso_day(_key(period, "startDate")).isNull() & iso_day(_key(period, "endDate")).isNull()
    )
    null_class = F.exists(
        v_items,
        lambda i: _is_null(i, "$.classification") | _is_null(i, "$.classification.scheme"),
    )
    return (
        F.when(_is_null(v, "$.tender"), "tender is null")
        .when(_is_null(v, "$.buyer"), "buyer is null")
        .when(_is_null(v, "$.buyer.identifier"), "buyer.identifier is null")
        .when(no_title & _is_null(v, "$.planning"), "planning is null")
        .when(no_title & _is_null(v, "$.planning.project"), "planning.project is null")
        .when(_is_null(v, "$.tender.items"), "tender.items is null")
        .when(F.coalesce(null_class, F.lit(False)), "item classification is null")
        .when(_is_null(v, "$.tender.classification"), "tender.classification is null")
        .when(_is_null(v, "$.tender.classification.scheme"), "tender.classification.scheme is null")
        .when(_is_null(v, "$.awards"), "awards is null")
        .when(F.coalesce(null_value, F.lit(False)), "award value is null")
        .when(paid.isNull() & _is_null(v, "$.tender.value"), "tender.value is null")
        .when(
            supplying.isNotNull() & _is_null(supplying, "$.suppliers[0].identifier"),
            "supplier identifier is null",
        )
        .when(any_null_day, "award contract period is null")
        .when(no_award_day & _is_null(v, "$.tender.contractPeriod"), "tender.contractPeriod is null")
        .when(
            no_award_day & (null_day(tender_period, "startDate") | null_day(tender_period, "endDate")),
            "tender contract period is null",
        )
    )
