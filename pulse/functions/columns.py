"""Scalar column functions shared by the batch operators and the stream jobs.

Everything here is a built-in expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (labels the dashboard contract expects, verbatim).
# ---------------------------------------------------------------------------
# Age bands, in display order: under 20, 20 to 30, over 30.
AGE_LABELS = ("20岁以下", "20-30岁", "30岁以上")
# Gender labels for codes M and F.
GENDER_LABELS = {"M": "男", "F": "女"}
# Width and number of the legend bands of the sales map (0-100, ..., 500-600).
SALES_BAND_WIDTH = 100
SALES_BAND_COUNT = 6


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- time ------------------------------------------------------------------

def epoch_millis(ts: str | Column) -> Column:
    """Timestamp (with or without zone) -> epoch milliseconds (session zone = UTC)."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def date_hour_columns(ts_millis: str | Column) -> tuple[Column, Column]:
    """Epoch millis -> (`yyyy-MM-dd`, `HH`) strings."""
    t = F.timestamp_millis(_c(ts_millis))
    return F.date_format(t, "yyyy-MM-dd"), F.date_format(t, "HH")


def with_date_hour(df: DataFrame, ts: str = "ts", date_col: str = "logDate",
                   hour_col: str = "logHour") -> DataFrame:
    """Add the day and zero-padded hour of an epoch-millis column."""
    d, h = date_hour_columns(ts)
    return df.withColumns({date_col: d, hour_col: h})


def split_create_time(create_time: str | Column) -> tuple[Column, Column]:
    """`yyyy-MM-dd HH:mm:ss` -> (text before the first blank, text before the first colon
    of the second part). A value without a blank gives a null hour."""
    c = _c(create_time)
    date = F.split_part(c, F.lit(" "), F.lit(1))
    hour = F.nullif(F.split_part(F.split_part(c, F.lit(" "), F.lit(2)), F.lit(":"), F.lit(1)),
                    F.lit(""))
    return date, hour


def with_create_date_hour(df: DataFrame, create_time: str = "create_time") -> DataFrame:
    d, h = split_create_time(create_time)
    return df.withColumns({"create_date": d, "create_hour": h})


def prev_day(day: str | Column) -> Column:
    """`yyyy-MM-dd` minus one day; unparseable input gives null.

    ``day`` is a column (name); pass ``F.lit("2024-01-15")`` for a constant."""
    parsed = F.try_to_date(_c(day), "yyyy-MM-dd")
    return F.date_format(F.date_sub(parsed, 1), "yyyy-MM-dd")


def on_date(df: DataFrame, col: str, day: str | None) -> DataFrame:
    """Equality on a day string. A null day selects nothing (SQL `= NULL`)."""
    return df.where(F.col(col) == F.lit(day).cast("string"))


# --- masking, routing, stamping --------------------------------------------

def mask_phone(tel: str | Column) -> Column:
    """First three characters, `****`, then everything after the seventh."""
    t = _c(tel)
    return F.concat(F.substring(t, 1, 3), F.lit("****"), F.substring(t, 8, 2147483647))


def route_topic(value: str | Column, startup_topic: str, event_topic: str) -> Column:
    """`type == 'startup'` -> startup topic; anything else, a missing type included,
    -> event topic."""
    kind = F.get_json_object(_c(value), "$.type")
    return F.when(kind == F.lit("startup"), F.lit(startup_topic)).otherwise(F.lit(event_topic))


def stamp_ts(value: str | Column, ts_millis: str | Column, field: str = "ts") -> Column:
    """Add (or overwrite) a top-level numeric field of a JSON object string.

    The object is read as ``map<string, variant>``, so every other field keeps
    its JSON type and nesting. A line that is not a JSON object gives null.
    """
    obj = F.from_json(_c(value), "map<string,variant>")
    kept = F.map_filter(obj, lambda k, v: k != F.lit(field))
    stamped = F.map_concat(kept, F.create_map(F.lit(field), _c(ts_millis).cast("variant")))
    return F.when(obj.isNotNull(), F.to_json(stamped))


# --- search and banding ----------------------------------------------------

def match_keyword(text: str | Column, keyword: str | None) -> Column:
    """Every blank-separated token of ``keyword`` occurs in ``text``, ignoring case,
    in any order. A blank keyword matches every row (null text included)."""
    tokens = (keyword or "").split()
    if not tokens:
        return F.lit(True)
    low = F.lower(_c(text))
    cond = None
    for tok in tokens:
        term = F.contains(low, F.lit(tok.lower()))
        cond = term if cond is None else (cond & term)
    return F.coalesce(cond, F.lit(False))


def age_band(age: str | Column) -> Column:
    """`< 20`, `20..30` (both ends inclusive), `> 30`; null stays null."""
    a = _c(age)
    return (F.when(a.isNull(), F.lit(None).cast("string"))
            .when(a < 20, F.lit(AGE_LABELS[0]))
            .when(a <= 30, F.lit(AGE_LABELS[1]))
            .otherwise(F.lit(AGE_LABELS[2])))


def gender_label(code: str | Column) -> Column:
    c = _c(code)
    return (F.when(c == F.lit("M"), F.lit(GENDER_LABELS["M"]))
            .when(c == F.lit("F"), F.lit(GENDER_LABELS["F"])))


def sales_band(value: str | Column) -> Column:
    """Legend band index: floor(v / width) clamped to [0, count - 1]; lower bound inclusive."""
    b = F.floor(_c(value) / F.lit(SALES_BAND_WIDTH)).cast("int")
    return F.least(F.greatest(b, F.lit(0)), F.lit(SALES_BAND_COUNT - 1))


# --- folding ---------------------------------------------------------------

def fold_map(key: str | Column, value: str | Column) -> Column:
    """Aggregate expression: rows (k, v) -> one map {k: v}, entries sorted by key.

    Only for groups with a small fixed number of rows (24 hours of one day)."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(_c(key).alias("k"),
                                                                   _c(value).alias("v")))))
