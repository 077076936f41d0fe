"""Column expressions (JVM-side, codegen-friendly; no Python UDFs)."""

from huddle.functions.columns import (  # noqa: F401
    agree_on_winner,
    closer_than_line,
    fixed_width_line,
    hash_bucket,
    line_correct,
    nan_to_null,
    prefix_equal,
    safe_divide,
    sign_label,
    winner_correct,
)
