"""Column expressions; every one stays inside Spark's generated code."""

from sievemart.functions.codes import norm_code
from sievemart.functions.flags import (
    any_flag,
    gross_flag,
    three_state_flag,
    true_flag,
    two_way_label,
)
from sievemart.functions.numbers import (
    coerce_number,
    guarded_id,
    lenient_number,
    midpoint,
    strict_number,
    zero_if_null,
)

__all__ = [
    "any_flag",
    "coerce_number",
    "gross_flag",
    "guarded_id",
    "lenient_number",
    "midpoint",
    "norm_code",
    "strict_number",
    "three_state_flag",
    "true_flag",
    "two_way_label",
    "zero_if_null",
]
