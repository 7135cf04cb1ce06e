"""String functions of the click pipeline (F1, F2, F19-F25), all JVM-side Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
# Product page URL pattern; group 2 is the product id. Unanchored search.
PRODUCT_URL_PATTERN = r"http://www.acme.com/(\w+)/(\w+)"
# Characters stripped from both ends of a visitor id: "{" and "}".
VISITOR_ID_BRACES = "{}"
# Offer image and product image folders, key prefixes, sub-domain fallback.
PRODUCT_ASSET_DIR = "assets/products/"
OFFER_ASSET_DIR = "assets/"
PRODUCT_KEY_PREFIX = "product:"
VISITOR_KEY_PREFIX = "visitor:"
DEFAULT_SUBDOMAIN = "platform"
# Log messages of the detector.
ENTERED_MESSAGE = "[User %s entered state %s][Event: clicked %s][Category: %s]"
OFFER_MESSAGE = "[User %s triggered offer %s]"
PRICE_CURRENCY = "€"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_braces(col) -> Column:
    """``x.strip("{}")`` -- remove any run of braces at both ends."""
    return F.btrim(_c(col), F.lit(VISITOR_ID_BRACES))


def product_id_from_url(col, pattern: str = PRODUCT_URL_PATTERN, group: int = 2) -> Column:
    """group ``group`` of the first match; no match keeps the URL itself.

    Java's ``\\w`` is ASCII-only by default while Python's is Unicode-aware,
    so the pattern runs with the UNICODE_CHARACTER_CLASS flag.
    """
    p = "(?U)" + pattern
    url = _c(col)
    return F.when(url.rlike(p), F.regexp_extract(url, p, group)).otherwise(url)


def state_log_message(user, state, product, category) -> Column:
    """state-transition log text."""
    return F.format_string(ENTERED_MESSAGE,
                           _c(user), _c(state), _c(product), _c(category))


def offer_log_message(user, offer) -> Column:
    """offer log text."""
    return F.format_string(OFFER_MESSAGE, _c(user), _c(offer))


def rendered_log_line(created_ts, msg) -> Column:
    """``'<yyyy-MM-dd HH:mm:ss>: <msg>'``."""
    return F.concat_ws(": ", F.date_format(_c(created_ts), "yyyy-MM-dd HH:mm:ss"), _c(msg))


def product_key(id_col) -> Column:
    """lookup key ``product:{id}``."""
    return F.concat(F.lit(PRODUCT_KEY_PREFIX), _c(id_col))


def visitor_key(id_col) -> Column:
    """lookup key ``visitor:{id}``."""
    return F.concat(F.lit(VISITOR_KEY_PREFIX), _c(id_col))


def topic_id(workspace, topic) -> Column:
    """``{workspace}-{topic}``."""
    return F.concat_ws("-", _c(workspace), _c(topic))


def price_label(price) -> Column:
    """``€1,234.50`` (two decimals, thousands grouping)."""
    return F.concat(F.lit(PRICE_CURRENCY), F.format_number(_c(price).cast("double"), 2))


def title_case(col) -> Column:
    """first letter of each space-separated word upper, the rest lower."""
    return F.initcap(_c(col))


def product_image_path(image) -> Column:
    """``assets/products/<image>``."""
    return F.concat(F.lit(PRODUCT_ASSET_DIR), _c(image))


def offer_image_path(offer) -> Column:
    """``assets/<offer>.png``."""
    return F.concat(F.lit(OFFER_ASSET_DIR), _c(offer), F.lit(".png"))


def strip_first_line_feed(col) -> Column:
    """remove the first ``\\n`` only (JS ``replace('\\n', '')``)."""
    s = _c(col)
    pos = F.instr(s, "\n")
    return F.when(pos == 0, s).otherwise(F.overlay(s, F.lit(""), pos, F.lit(1)))


def subdomain(url, service: str, default: str = DEFAULT_SUBDOMAIN) -> Column:
    """the environment label behind the ``service`` label of a host name (``https://<service>.<label>.``),
    default ``platform``."""
    pattern = rf"^https?://\Q{service}\E\.([a-zA-Z]+)\."
    return F.coalesce(F.nullif(F.regexp_extract(_c(url), pattern, 1), F.lit("")), F.lit(default))
