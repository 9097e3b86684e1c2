"""Scalar column functions (JVM-side expressions, no Python UDFs)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config


def risk_tier(prob: Column) -> Column:
    """Probability -> Critical / High / Medium / Low on the unrounded value."""
    expr = None
    for tier, cut in config.RISK_TIERS:
        expr = F.when(prob >= cut, F.lit(tier)) if expr is None else expr.when(prob >= cut, F.lit(tier))
    return expr.otherwise(F.lit("Low"))


def psi_status(psi: Column) -> Column:
    return (F.when(psi.isNull() | F.isnan(psi), F.lit("unknown"))
            .when(psi >= config.PSI_ALERT, F.lit("alert"))
            .when(psi >= config.PSI_WATCH, F.lit("watch"))
            .otherwise(F.lit("ok")))


# --- fixed values: validation notes of a public battery rollup, in rule order ---
NOTE_SHORT = "Very short discharge sequence; useful for parser coverage only."
NOTE_GAIN = ("Capacity increases versus first discharge; review protocol/first-cycle "
             "normalization before fade modeling.")
NOTE_POSITIVE = "Positive capacity trend; not a simple capacity-fade validation case."
NOTE_SLIGHT_GAIN = "Slight capacity gain versus first discharge; use cautiously."
NOTE_CLEAR_FADE = "Clear capacity-fade validation case."
NOTE_LIMITED = "Parsed real cycle data; limited fade signal in this window."


def validation_note(cycles: Column, loss: Column, corr: Column) -> Column:
    """Six-way ordered label; a null/NaN comparison counts as false."""
    def t(cond: Column) -> Column:
        return F.coalesce(cond, F.lit(False))
    nan_safe_loss = F.when(~F.isnan(loss), loss)
    nan_safe_corr = F.when(~F.isnan(corr), corr)
    return (F.when(t(cycles < 10), F.lit(NOTE_SHORT))
            .when(t(nan_safe_loss < -0.05), F.lit(NOTE_GAIN))
            .when(t(nan_safe_corr > 0.25), F.lit(NOTE_POSITIVE))
            .when(t(nan_safe_loss < 0), F.lit(NOTE_SLIGHT_GAIN))
            .when(t(nan_safe_loss >= 0.05) & t(nan_safe_corr < -0.5), F.lit(NOTE_CLEAR_FADE))
            .otherwise(F.lit(NOTE_LIMITED)))


def likely_root_cause(driver: Column, severity: Column, last_soh: Column) -> Column:
    d = F.coalesce(driver, F.lit("Unknown"))
    eol = (severity == "critical") & (F.coalesce(last_soh, F.lit(1.0)) < config.SOH_EOL_THRESHOLD)
    return F.when(F.coalesce(eol, F.lit(False)), F.concat(d, F.lit(config.ROOT_CAUSE_EOL_SUFFIX))).otherwise(d)


def exposure_band(hours: Column) -> Column:
    return (F.when(hours < 40, F.lit("0-40h")).when(hours < 80, F.lit("40-80h"))
            .when(hours < 120, F.lit("80-120h")).otherwise(F.lit("120h+")))


def clip(col: Column, lo: float | None = None, hi: float | None = None) -> Column:
    out = col
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return out


def to_numeric(col: Column) -> Column:
    """Bad numeric text -> null (NaN text is not a number here)."""
    s = F.trim(col.cast("string"))
    ok = s.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    return F.when(ok, s.try_cast("double"))


def in_queue(tier: Column, escalation_flag: Column) -> Column:
    return tier.isin("High", "Critical") | (escalation_flag == 1)


def round_half_up(col: Column, digits: int) -> Column:
    """Round half away from zero as ``round(x * 10^d) / 10^d`` in IEEE doubles.

    Every engine evaluates this formula bit-identically, unlike a decimal
    ROUND whose treatment of near-ties differs between engines."""
    scale = float(10 ** digits)
    return F.round(col * F.lit(scale)) / F.lit(scale)


def round_half_even(col: Column, digits: int) -> Column:
    """Banker's rounding (NumPy ``round``) as ``bround(x * 10^d) / 10^d``."""
    scale = float(10 ** digits)
    return F.bround(col * F.lit(scale)) / F.lit(scale)
