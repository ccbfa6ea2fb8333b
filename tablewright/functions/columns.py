"""Column expressions shared by several jobs."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPARE = {">=": operator.ge, ">": operator.gt, "<=": operator.le, "<": operator.lt, "==": operator.eq}


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucketize(column: str | Column, rules: Sequence[tuple[str, float, str]], default: str) -> Column:
    """Label of the first rule that holds; null values take the default."""
    value = as_col(column)
    chain = F
    for op, threshold, label in rules:
        chain = chain.when(COMPARE[op](value, F.lit(threshold)), F.lit(label))
    return chain.otherwise(F.lit(default))


def label_code(column: str | Column, mapping: Mapping[str, int], default: float | None = 0.0) -> Column:
    """Number of a label as float. Unknown labels and nulls take the default."""
    value = as_col(column)
    chain = F
    for label, code in mapping.items():
        chain = chain.when(value == F.lit(label), F.lit(float(code)))
    return chain.otherwise(F.lit(default)).cast("float")


def compute_label(is_serverless: str | Column) -> Column:
    return F.when(as_col(is_serverless), "Serverless").otherwise("Classic")


def numbered_key(prefix: str, number: str | Column, width: int) -> Column:
    """``prefix`` and a zero-padded number; longer numbers are kept whole."""
    return F.format_string(f"{prefix}%0{width}d", as_col(number))


def file_stem(path: str | Column) -> Column:
    """File name without directory and last extension."""
    name = F.regexp_extract(as_col(path), r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def first_json_item(text: str | Column) -> Column:
    return F.get(F.from_json(as_col(text), "array<string>"), F.lit(0))


def json_items(text: str | Column) -> Column:
    return F.from_json(as_col(text), "array<string>")


def dot(a: str | Column, b: str | Column) -> Column:
    """Dot product of two arrays, summed in double."""
    products = F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_normalize(v: str | Column) -> Column:
    """Unit-length array of doubles; the zero vector stays as it is."""
    value = as_col(v)
    # repeated once per row, as a lambda would work the norm out for every element
    norms = F.array_repeat(F.sqrt(dot(value, value)), F.size(value))
    return F.zip_with(value, norms, lambda x, n: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def linear(columns: Sequence[str], coefficients: str, intercept: str) -> Column:
    """Intercept plus the dot product of columns and a coefficient array, without a lambda."""
    terms = [F.get(F.col(coefficients), F.lit(i)) * F.col(c) for i, c in enumerate(columns)]
    return reduce(operator.add, terms, F.col(intercept))
