"""Column builders shared by all operators."""

from peerscope.functions.columns import (  # noqa: F401
    monotone,
    normalised,
    null_safe_equal,
    rounded_ratio,
    safe_divide,
    title_case,
)
