"""Labels: decoding, stripping, rewriting."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def decode(code: Column | str, labels: dict[int, str]) -> Column:
    """The label of a code; null for an unknown one."""
    column = _column(code)
    (first, label), *rest = labels.items()
    return reduce(
        lambda chain, item: chain.when(column == item[0], F.lit(item[1])),
        rest,
        F.when(column == first, F.lit(label)),
    )


def to_boolean(code: Column | str) -> Column:
    """1 is true, 2 is false, anything else null."""
    column = _column(code)
    return F.when(column == 1, True).when(column == 2, False)


def strip_code(label: Column | str) -> Column:
    """The label before its `` [code]`` suffix."""
    return F.split(_column(label), r" \[")[0]


def apply_rules(label: Column | str, rules: Iterable[tuple[str, str]]) -> Column:
    """Rewrite a label by ordered ``(pattern, replacement)`` rules."""
    return reduce(
        lambda text, rule: F.regexp_replace(text, rule[0], rule[1]), rules, _column(label)
    )
