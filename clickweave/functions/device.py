"""F8: user agent -> device type, as one JVM-side CASE over a pattern ladder.

The reference calls a full user-agent parser per row and asks it, in this
order: mobile? tablet? pc? bot? else "Other"; a parse failure (null agent)
gives "Unknown". We keep the same ladder and express each rung as one
regular expression written in the common subset of Java regex and RE2 (no
look-around), so the identical pattern text also runs in the DuckDB oracle.
In Spark it is tried only where one of its alternatives can begin: Java would
try them all at every place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: device ladder, checked top to bottom --------------------
# Patterns are matched against the lower-cased agent (one lower() per row,
# case-sensitive matching is cheaper than (?i) on every rung).
DEVICE_LADDER = [
    ("Mobile", r"iphone|ipod|windows phone|windows ce|windows mobile|symbian|blackberry|bb10|j2me|midp"
               r"|opera mini|opera mobi|iemobile|googlebot-mobile|playstation vita|maemo"
               r"|android.*mobile safari|android.*firefox.*mobile|nokiabrowser.*mobile"),
    ("Tablet", r"ipad|kindle|silk/|playbook|galaxy tab|xoom|dell streak|windows nt [0-9.]+; arm|android"),
    ("Desktop", r"windows nt|windows 9[58]|win 9x|windows me|macintosh|mac os x|cros|x11.*linux|linux.*x11"
                r"|ubuntu|sunos|solaris"),
    ("Bot", r"bot\b|bot/|crawl|spider|slurp|mediapartners|facebookexternalhit|bingpreview"),
]
DEVICE_OTHER = "Other"
DEVICE_UNKNOWN = "Unknown"
# ---------------------------------------------------------------------------


def _where_it_can_begin(pattern: str) -> str:
    """The same matches. Every alternative of the ladder begins with a plain character."""
    first = "".join(sorted({alternative[0] for alternative in pattern.split("|")}))
    return f"(?=[{first}])(?:{pattern})"


def device_type(user_agent) -> Column:
    """Device type of a user-agent string (null -> 'Unknown')."""
    ua = F.col(user_agent) if isinstance(user_agent, str) else user_agent
    low = F.lower(ua)
    expr = F.when(ua.isNull(), F.lit(DEVICE_UNKNOWN))
    for label, pattern in DEVICE_LADDER:
        expr = expr.when(low.rlike(_where_it_can_begin(pattern)), F.lit(label))
    return expr.otherwise(F.lit(DEVICE_OTHER))


def device_case_sql(ua_sql: str, regex_fn: str = "regexp_matches") -> str:
    """The same ladder as SQL text (for oracles and SQL users)."""
    parts = [f"WHEN {ua_sql} IS NULL THEN '{DEVICE_UNKNOWN}'"]
    for label, pattern in DEVICE_LADDER:
        parts.append(f"WHEN {regex_fn}(lower({ua_sql}), '{pattern}') THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{DEVICE_OTHER}' END"
