"""Formatting of values for reports."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeworks import fixed_values as fixed
from noticeworks.functions.text import col

_AWARD_NAMES = "array<struct<suppliers array<struct<name string>>>>"


def money(amount: Column | str) -> Column:
    """``£1,234``; a dash for NULL."""
    c = col(amount)
    return F.coalesce(F.concat(F.lit("£"), F.format_number(c, 0)), F.lit(fixed.NO_VALUE))


def money_bn(amount: Column | str, zero_is_none: bool = False) -> Column:
    """Billions with one decimal, ``£1.2bn``; a dash for NULL (and for 0 if asked)."""
    c = col(amount)
    if zero_is_none:
        c = F.nullif(c, F.lit(0.0))
    # The pattern form of format_number rounds half-even on the double, as report figures do.
    digits = F.call_function("format_number", c / F.lit(1e9), F.lit("0.0"))
    return F.coalesce(F.concat(F.lit("£"), digits, F.lit("bn")), F.lit(fixed.NO_VALUE))


def day_text(day: Column | str) -> Column:
    return F.date_format(col(day), "yyyy-MM-dd")


def preview_text(text: Column | str, length: int) -> Column:
    return F.substring(F.coalesce(col(text), F.lit("")), 1, length)


def label_of(code: Column | str, labels: dict[str, str], default: str | None = None) -> Column:
    """Look a code up in a small fixed map."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    hit = F.try_element_at(pairs, col(code))
    return hit if default is None else F.coalesce(hit, F.lit(default))


def status_label(status: Column | str) -> Column:
    return label_of(status, fixed.STATUS_LABELS, fixed.STATUS_LABELS["unknown"])


def supplier_summary(awards_json: Column | str, supplier_name: Column | str) -> Column:
    """``First supplier  +N`` over the distinct named suppliers of the awards, in their order.

    Without one, the headline supplier unless it is unknown; otherwise a dash.
    """
    awards = F.from_json(col(awards_json), _AWARD_NAMES)
    names = F.array_distinct(
        F.filter(
            F.flatten(
                F.transform(
                    F.filter(awards, lambda a: a["suppliers"].isNotNull()),
                    lambda a: F.transform(a["suppliers"], lambda s: s["name"]),
                )
            ),
            lambda n: n.isNotNull() & (n != ""),
        )
    )
    more = F.when(
        F.size(names) > 1, F.concat(F.lit("  +"), (F.size(names) - 1).cast("string"))
    ).otherwise("")
    name = F.nullif(F.nullif(col(supplier_name), F.lit("")), F.lit(fixed.UNKNOWN_SUPPLIER))
    return F.coalesce(
        F.concat(F.try_element_at(names, F.lit(1)), more), name, F.lit(fixed.NO_VALUE)
    )
