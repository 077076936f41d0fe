"""Scalar column expressions used by the operators.

All of these are plain ``pyspark.sql.functions`` compositions, so they stay
inside whole-stage codegen.  NULL handling follows the rules the pipelines
need: a NULL test in a ``when`` ladder falls through to ``otherwise``, just
as a missing value fails every comparison in the row loops being replaced.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Verdict labels (fixed values: they appear verbatim in the output files).
PUSH, HOME, AWAY = "Push", "Home", "Away"
CORRECT, INCORRECT = "Correct", "Incorrect"
BEATS, TIE, LOSES_SPREAD = "Beats Vegas", "Tie", "Loses Vegas"
LOSES_WINNER, NO_RESULT = "Loses to Vegas", "No Result"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(col) -> Column:
    """NaN is a value in Spark (NaN > 0 is true, sum is NaN); make it NULL."""
    c = _c(col)
    return F.when(~F.isnan(c), c)


def safe_divide(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (no ANSI divide-by-zero error)."""
    n, d = _c(num), _c(den)
    return F.when(d != 0, n.cast("double") / d)


def prefix_equal(a, b, n: int = 3) -> Column:
    """First ``n`` characters of two strings are equal."""
    return F.substring(_c(a), 1, n) == F.substring(_c(b), 1, n)


def sign_label(x) -> Column:
    """0 -> Push, > 0 -> Home, else (negative or NULL) -> Away."""
    c = _c(x)
    return F.when(c == 0, PUSH).when(c > 0, HOME).otherwise(AWAY)


def line_correct(line_label, result_label) -> Column:
    lp, ar = _c(line_label), _c(result_label)
    return (
        F.when((lp == PUSH) | (ar == PUSH), PUSH)
        .when(lp == ar, CORRECT)
        .otherwise(INCORRECT)
    )


def winner_correct(predicted, actual) -> Column:
    p, a = _c(predicted), _c(actual)
    return (
        F.when((p == 0) | (a == 0), PUSH)
        .when(((p > 0) & (a > 0)) | ((p < 0) & (a < 0)), CORRECT)
        .otherwise(INCORRECT)
    )


def closer_than_line(predicted, line, actual) -> Column:
    model_error = F.abs(_c(predicted) - _c(actual))
    line_error = F.abs(_c(line) - _c(actual))
    return (
        F.when(model_error < line_error, BEATS)
        .when(model_error == line_error, TIE)
        .otherwise(LOSES_SPREAD)
    )


def agree_on_winner(model_verdict, line_verdict) -> Column:
    m, v = _c(model_verdict), _c(line_verdict)
    return (
        F.when((m == CORRECT) & (v == INCORRECT), BEATS)
        .when((m == INCORRECT) & (v == CORRECT), LOSES_WINNER)
        .when((m == CORRECT) & (v == CORRECT), TIE)
        .when((m == INCORRECT) & (v == INCORRECT), TIE)
        .otherwise(NO_RESULT)
    )


def hash_bucket(key, modulus: int) -> Column:
    """Repeatable bucket from the first 32 bits of md5(key as text).

    The same value is computable in plain SQL engines, which is what makes
    random-looking splits checkable:
    ``conv(substr(md5(k), 1, 8), 16, 10) % modulus``.
    """
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(modulus)).cast("int")


def pad_right(text, width: int) -> Column:
    """Left-align in ``width`` characters; longer text is kept whole
    (``rpad`` alone would cut it)."""
    t = _c(text)
    return F.when(F.length(t) >= width, t).otherwise(F.rpad(t, width, " "))


def fixed_width_line(label, value, width: int = 20, decimals: int = 5) -> Column:
    """``f"{label:<20} {value:<20.5f}"`` as a column."""
    number = F.format_string(f"%.{decimals}f", _c(value))
    return F.concat(pad_right(label, width), F.lit(" "), pad_right(number, width))
