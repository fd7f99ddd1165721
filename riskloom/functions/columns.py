"""Column-level building blocks. All stay inside whole-stage codegen."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.config import RISK_ADVICE, RISK_CUTS, RISK_LABELS, Bounds


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """One missing marker only: NaN becomes NULL."""
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def zero_to_missing(c: str | Column) -> Column:
    c = as_column(c)
    return F.when(c != F.lit(0), c)


def clip_column(c: str | Column, lo: float, hi: float) -> Column:
    c = as_column(c)
    return F.when(c < F.lit(lo), F.lit(lo)).when(c > F.lit(hi), F.lit(hi)).otherwise(c)


def flag_above(c: str | Column, threshold: float) -> Column:
    """1 where the value is strictly above; missing counts as 0."""
    return F.coalesce(as_column(c) > F.lit(threshold), F.lit(False)).cast("int")


def safe_divide(a: str | Column, b: str | Column) -> Column:
    return F.try_divide(as_column(a), as_column(b))


def ratio_of(a: str | Column, b: str | Column, eps: float) -> Column:
    return F.try_divide(as_column(a).cast("double"), as_column(b).cast("double") + F.lit(float(eps)))


def linear_score_of(weights: dict[str, float]) -> Column:
    terms = [F.col(name).cast("double") * F.lit(float(w)) for name, w in weights.items()]
    return reduce(lambda x, y: x + y, terms)


def cut_column(
    c: str | Column,
    edges: Sequence[float],
    labels: Sequence[str],
    closed: str = "right",
    include_lowest: bool = False,
) -> Column:
    """Label of the interval that holds the value; outside all intervals is NULL.

    ``closed='right'`` means ``(a, b]``; ``include_lowest`` also admits the very
    first left edge. ``closed='left'`` means ``[a, b)``. Infinite edges leave
    that side open.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need exactly one label per interval")
    if closed not in ("right", "left"):
        raise ValueError("closed must be 'right' or 'left'")
    c = as_column(c)
    chain = None
    for i, label in enumerate(labels):
        lo, hi = float(edges[i]), float(edges[i + 1])
        tests = []
        if not math.isinf(lo):
            inclusive = closed == "left" or (include_lowest and i == 0)
            tests.append(c >= F.lit(lo) if inclusive else c > F.lit(lo))
        if not math.isinf(hi):
            tests.append(c <= F.lit(hi) if closed == "right" else c < F.lit(hi))
        inside = reduce(lambda x, y: x & y, tests) if tests else c.isNotNull()
        chain = F.when(inside, F.lit(label)) if chain is None else chain.when(inside, F.lit(label))
    return chain


def dummy_columns(
    c: str | Column, labels: Sequence[str], prefix: str, drop_first: bool = True, unknown: bool = False
) -> list[Column]:
    """One boolean per declared label, in declared order, whatever the data holds.

    A missing category gives all-false, like the dropped base label; ``unknown``
    adds a flag that tells the two apart.
    """
    c = as_column(c)
    kept = list(labels)[1:] if drop_first else list(labels)
    out = [F.coalesce(c == F.lit(label), F.lit(False)).alias(f"{prefix}_{label}") for label in kept]
    if unknown:
        out.append(c.isNull().alias(f"{prefix}_unknown"))
    return out


def confidence_of(p: str | Column) -> Column:
    p = as_column(p)
    return F.greatest(p, F.lit(1.0) - p)


def risk_category_of(
    p: str | Column, cuts: Sequence[float] = RISK_CUTS, labels: Sequence[str] = RISK_LABELS, closed: str = "left"
) -> Column:
    """Two published edge rules, kept apart on purpose.

    ``closed='left'``: below the first cut, below the second, else (request
    scoring). ``closed='right'``: ``(0, c1] (c1, c2] (c2, 1]``, where a
    probability of exactly 0 has no category (table scoring).
    """
    if closed == "left":
        edges = (-math.inf, *cuts, math.inf)
    else:
        edges = (0.0, *cuts, 1.0)
    return cut_column(p, edges, labels, closed=closed)


def recommendation_of(category: str | Column, advice: dict[str, str] = RISK_ADVICE) -> Column:
    category = as_column(category)
    chain = None
    for label, text in advice.items():
        test = category == F.lit(label)
        chain = F.when(test, F.lit(text)) if chain is None else chain.when(test, F.lit(text))
    return chain


def range_violation(c: str | Column, lo: float, hi: float, null_policy: str = "fail") -> Column:
    """True where the value breaks the inclusive bounds.

    ``null_policy='fail'`` treats missing as a violation (request validation);
    ``'pass'`` does not (table screening).
    """
    if null_policy not in ("fail", "pass"):
        raise ValueError("null_policy must be 'fail' or 'pass'")
    c = as_column(c)
    outside = (c < F.lit(lo)) | (c > F.lit(hi))
    return F.coalesce(outside, F.lit(null_policy == "fail"))


def _plain(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else repr(float(x))


def range_errors(bounds: Bounds, null_policy: str = "fail", sep: str = "; ") -> Column:
    """All range messages of a row in one string, NULL when the row is clean."""
    parts: Iterable[Column] = [
        F.when(
            range_violation(name, lo, hi, null_policy),
            F.lit(f"{name} must be between {_plain(lo)} and {_plain(hi)}"),
        )
        for name, (lo, hi) in bounds.items()
    ]
    return F.nullif(F.concat_ws(sep, *parts), F.lit(""))
