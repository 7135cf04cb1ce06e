"""Visitor attribute functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
UNKNOWN = "Unknown"            # default product category / title / country
UNKNOWN_GENDER = "U"           # default gender code
GENDER_LABELS = {"M": "Male", "F": "Female", "U": "Unknown"}
GENDER_LABEL_OTHER = "Not Specified"
OFFER_MALE = "offer1"          # offer code when gender == 'M'
OFFER_OTHER = "offer2"         # every other gender
# Demographic gate of the first sequence step, inclusive bounds.
MALE_AGE_RANGE = (35, 45)
FEMALE_AGE_RANGE = (25, 35)
# Valid age domain offered by the shop (18..65 inclusive).
AGE_DOMAIN = (18, 65)
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def or_default(col, default: str) -> Column:
    """``x or default`` -- null *and* empty string take the default."""
    return F.coalesce(F.nullif(_c(col), F.lit("")), F.lit(default))


def age_to_int(col, strict: bool = True) -> Column:
    """age text -> int. Strict raises on junk (ANSI cast); else null."""
    return _c(col).cast("int") if strict else _c(col).try_cast("int")


def gender_letter(col) -> Column:
    """first letter of the worded gender ('Male' -> 'M')."""
    return F.substring(_c(col), 1, 1)


def gender_label(code) -> Column:
    """M/F/U -> Male/Female/Unknown, anything else 'Not Specified'."""
    c = _c(code)
    expr = F.when(c == "M", F.lit(GENDER_LABELS["M"]))
    expr = expr.when(c == "F", F.lit(GENDER_LABELS["F"])).when(c == "U", F.lit(GENDER_LABELS["U"]))
    return expr.otherwise(F.lit(GENDER_LABEL_OTHER))


def offer_for_gender(gender) -> Column:
    """'offer1' for men, 'offer2' for everyone else (null included)."""
    return F.when(_c(gender) == "M", F.lit(OFFER_MALE)).otherwise(F.lit(OFFER_OTHER))


def in_target_group(gender, age) -> Column:
    """(M and 35<=age<=45) or (F and 25<=age<=35); null age is false."""
    g, a = _c(gender), _c(age)
    m = (g == "M") & a.between(*MALE_AGE_RANGE)
    f = (g == "F") & a.between(*FEMALE_AGE_RANGE)
    return F.coalesce(m | f, F.lit(False))


def valid_age(age) -> Column:
    """age inside the shop's 18..65 domain."""
    return _c(age).between(*AGE_DOMAIN)
