"""Raw click log, state-transition log and snapshot documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import offer_log_message, rendered_log_line, state_log_message
from ..sources.testbed import RAW_CLICK_COLUMNS, rendered_columns


def raw_log_from_events(events: DataFrame) -> DataFrame:
    """The producer's TSV log derived from the events table (every row has a
    Unix timestamp; visitor ids are wrapped in braces as in the real log)."""
    raw = events.selectExpr(*rendered_columns(RAW_CLICK_COLUMNS, "spark"), "unix_timestamp(CAST(ts AS TIMESTAMP)) AS _epoch")
    return raw.select(
        "event_id",
        F.concat(F.lit("{"), "userId", F.lit("}")).alias("Visitor Unique ID"),
        F.col("ip").alias("IP Address"),
        F.col("userAgent").alias("29"),
        F.col("_epoch").alias("Unix Timestamp"),
        F.col("url").alias("Product Page URL"),
    )


def transition_log(trace: DataFrame) -> DataFrame:
    """K7 + F19: log lines for transitions of live clicks only.

    An offer transition logs two lines: entering state ``offer``, then the
    offer itself. Columns: created, event_id, line, userId, msg.
    """
    live = trace.filter(F.col("live"))
    entered = state_log_message("userId", "state", "productId", "category")
    msgs = F.when(F.col("state") == "offer",
                  F.array(entered, offer_log_message("userId", "offer"))).otherwise(F.array(entered))
    return live.select(F.col("timestamp").alias("created"), "event_id", "userId",
                       F.posexplode(msgs).alias("line", "msg"))


def log_tail(log: DataFrame, keep: int = 10, show: int = 8) -> DataFrame:
    """K6 + S9 + F20: cap the log to the newest ``keep`` lines, read the
    newest ``show`` of them, render ``time: message`` (top-k, no full sort)."""
    order = [F.desc("created"), F.desc("event_id"), F.desc("line")]
    capped = log.orderBy(*order).limit(keep)
    return capped.orderBy(*order).limit(show).select(
        "created", "event_id", "line", rendered_log_line("created", "msg").alias("text"))


def column_json(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    """K4: a small result table as one column-oriented JSON document
    ``{"col": {"0": v, "1": v, ...}, ...}`` (datetimes and dates as epoch milliseconds).
    The index is the row's place in the mart's ``order``: columns, with a leading ``-`` for
    descending. A column whose name starts with ``_`` is for the order only.

    A document is one value, so the input must be a bounded mart (top-k,
    pivot, per-category counts); it is gathered by one aggregate.
    """
    conv = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz", "date"):
            c = F.unix_millis(c.cast("timestamp"))
        conv.append(c.alias(f.name))
    def compare(a, b):
        out = F.lit(0)
        for c in reversed(order):
            field, sign = c.removeprefix("-"), -1 if c.startswith("-") else 1
            out = (F.when(a[field].eqNullSafe(b[field]), out).when(a[field].isNull(), 1).when(b[field].isNull(), -1)
                   .when(a[field] < b[field], -sign).otherwise(sign))
        return out

    rows = F.array_sort(F.collect_list(F.struct(*conv)), compare)
    doc = df.agg(rows.alias("_rows"))
    idx = F.transform(F.sequence(F.lit(0), F.size("_rows") - 1), lambda i: i.cast("string"))
    def field(name: str):
        return lambda r: r[name]

    per_col = [F.when(F.size("_rows") > 0, F.map_from_arrays(idx, F.transform("_rows", field(c))))
               .otherwise(F.create_map().cast(f"map<string,{t}>")).alias(c)
               for c, t in ((f.name, f.dataType.simpleString()) for f in df.select(*conv).schema.fields) if not c.startswith("_")]
    return doc.select(F.lit(name).alias("key"),
                      F.to_json(F.struct(*per_col)).alias("value"))


def rows_from_column_json(doc: DataFrame, columns: list[tuple[str, str]], value_col: str = "value") -> DataFrame:
    """A column-oriented JSON document back into rows.

    ``columns`` = [(name, spark type text)], e.g. [("count", "bigint")].
    The row index comes from the first column's keys; each document is
    exploded on its own (one row per document in, n rows out).
    """
    schema = "struct<" + ", ".join(f"`{n}`: map<string, {t}>" for n, t in columns) + ">"
    parsed = doc.select(F.from_json(F.col(value_col), schema).alias("_d"))
    first = columns[0][0]
    keyed = parsed.select("_d", F.explode(F.map_keys(F.col(f"_d.`{first}`"))).alias("_i"))
    return keyed.select(*[F.col(f"_d.`{n}`")[F.col("_i")].alias(n) for n, _ in columns])
