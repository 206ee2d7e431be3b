"""Plain-Python forms of the rules, and small frame builders."""

from __future__ import annotations

import re


def column(spark, values, type_name="string", name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {type_name}")


def values(df, expression):
    """The expression's value per row, in the order of the (single-partition) frame."""
    return [r[0] for r in df.coalesce(1).select(expression).collect()]


def strict_rule(text):
    if text is None:
        return None
    rest = "".join(ch for ch in text if ch in "0123456789,.-").replace(",", ".")
    return float(rest) if re.fullmatch(r"-?[0-9]+(\.[0-9]+)?", rest) else None


def lenient_rule(text):
    if text is None:
        return None
    rest = "".join(ch for ch in text if ch in "0123456789,.-").replace(",", ".")
    found = re.search(r"-?[0-9]+(\.[0-9]+)?", rest)
    return float(found.group()) if found else None


def median_rule(numbers):
    """The lower middle of the sorted numbers."""
    ordered = sorted(numbers)
    return ordered[(len(ordered) - 1) // 2]


def auc_rule(pairs):
    """Share of positive/negative pairs in the right order; ties count half."""
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
