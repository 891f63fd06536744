"""Text normalisation, categorical encoders and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() removes for ASCII text.
WHITESPACE = " \t\n\r\x0b\x0c"


def _c(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def strip_text(c, whitespace: bool = True) -> Column:
    """M1: trim. ``whitespace`` strips tabs/newlines too (str.strip), else
    spaces only (SQL TRIM)."""
    return F.btrim(_c(c), F.lit(WHITESPACE)) if whitespace else F.trim(_c(c))


def norm_text(c, case: str = "lower", whitespace: bool = True) -> Column:
    """M1+M2: trimmed and case-folded text."""
    s = strip_text(c, whitespace)
    return F.upper(s) if case == "upper" else F.lower(s)


def encode_codes(c, mapping: dict, default=None, case: str = "lower",
                 whitespace: bool = True, dtype: str = "int") -> Column:
    """Map normalised text through a small literal dictionary.

    Unmatched values and NULL get ``default`` (M28 fill). The mapping is a
    chained CASE, evaluated inside whole-stage codegen.
    """
    key = norm_text(c, case, whitespace)
    out = None
    for k, v in mapping.items():
        cond = key == F.lit(k)
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    out = out.otherwise(F.lit(default)) if out is not None else F.lit(default)
    return out.cast(dtype)


def encode_binary(c, positive: str = "yes", whitespace: bool = True) -> Column:
    """M4: 1 when the trimmed lower-cased text equals ``positive``, else 0."""
    return encode_codes(c, {positive: 1}, default=0, whitespace=whitespace)


def encode_gender(c, male: str = "m", female: str = "f", case: str = "lower",
                  whitespace: bool = True) -> Column:
    """M5: male -> 0, female -> 1, anything else (and NULL) -> -1."""
    return encode_codes(c, {female: 1, male: 0}, default=-1, case=case, whitespace=whitespace)


def encode_ordinal(c, levels=("low", "normal", "high"), default: int = 1,
                   whitespace: bool = True) -> Column:
    """M6: ordered levels -> 0..n-1, unknown -> ``default``."""
    return encode_codes(c, {lv: i for i, lv in enumerate(levels)}, default=default,
                        whitespace=whitespace)


def round_half_up(c, scale: int) -> Column:
    """SQL ROUND (half away from zero)."""
    return F.round(_c(c), scale)


def round_half_even(c, scale: int) -> Column:
    """banker's rounding, as pandas ``.round``."""
    return F.bround(_c(c), scale)
