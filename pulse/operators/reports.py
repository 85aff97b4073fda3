"""Detail paging and the JSON documents the dashboard reads.

Documents are one-row DataFrames with a single JSON string column; their parts are
scalar subqueries over bounded results (3 KPIs, 24 hours, one page of at most 100
rows, 2-3 share rows), so nothing unbounded is gathered in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions import match_keyword, on_date, prev_day
from pulse.operators import paging
from pulse.operators.metrics import money_sum
from pulse.schemas import SALE_DETAIL_COLUMNS

PAGE_SIZES = (10, 20, 50, 100)
SEEK_FROM = 10_000  # first row of a page that is sought instead of counted off


def filter_detail(detail: DataFrame, day: str | None = None, keyword: str | None = None,
                  level: str | None = None) -> DataFrame:
    """Date equality (when given), keyword match on the SKU name, user-level equality."""
    out = detail if day is None else on_date(detail, "dt", day)
    if keyword and keyword.strip():
        out = out.where(match_keyword("sku_name", keyword))
    if level is not None:
        out = out.where(F.col("user_level") == F.lit(str(level)))
    return out


def _sort_cols(order: Sequence[tuple[str, str]], columns: Sequence[str]) -> list[Column]:
    used = [c for c, _ in order]
    spec = [F.col(c).desc_nulls_last() if d.lower() == "desc" else F.col(c).asc_nulls_first()
            for c, d in order]
    return spec + [F.col(c).asc_nulls_first() for c in columns if c not in used]


def detail_order_by(detail: DataFrame, order: Sequence[tuple[str, str]], n: int,
                    columns: Sequence[str] = SALE_DETAIL_COLUMNS) -> DataFrame:
    """First ``n`` grid rows under a multi-column asc/desc sort; the remaining grid
    columns break ties, so the result is the same on every run (top-k plan)."""
    return detail.select(*columns).orderBy(*_sort_cols(order, columns)).limit(n)


def _page(rows: DataFrame, start: int, length: int, order: Sequence[tuple[str, str]], seek_from: int = SEEK_FROM) -> DataFrame:
    if length not in PAGE_SIZES or start < 0:
        raise ValueError(f"start must be >= 0 and length one of {PAGE_SIZES}")
    rows, offset = rows.select(*SALE_DETAIL_COLUMNS), start
    if start >= seek_from:
        used = [c for c, _ in order]
        whole = [(c, d.lower() == "desc") for c, d in order] + [(c, False) for c in SALE_DETAIL_COLUMNS if c not in used]
        inside, offset, _ = paging.seek(rows, whole, start, length)
        rows = rows.where(inside)
    return rows.orderBy(*_sort_cols(order, SALE_DETAIL_COLUMNS)).offset(offset).limit(length)


def paged_detail(detail: DataFrame, start: int, length: int, day: str | None = None,
                 keyword: str | None = None, level: str | None = None,
                 order: Sequence[tuple[str, str]] = (), counted: DataFrame | None = None,
                 seek_from: int = SEEK_FROM) -> DataFrame:
    """Rows ``start+1 .. start+length`` of the filtered grid in a total order, each
    with ``total`` (the filtered row count, a scalar subquery). A page past the end is one row
    of nulls that carries ``total``.

    ``start`` is a row offset. ``orderBy().offset().limit()`` plans as a top-k
    (TakeOrderedAndProject) of ``start+length`` rows per partition; from ``seek_from`` on the page is sought in the
    histogram of the sort key instead (``paging``), with the same rows. ``counted``: the same rows with only
    the columns that the filters read, for the count."""
    rows = filter_detail(detail, day, keyword, level)
    total = filter_detail(detail if counted is None else counted, day, keyword, level).agg(F.count(F.lit(1))).scalar()
    page = _page(rows, start, length, order, seek_from)
    past = detail.sparkSession.range(1).select(
        *[F.lit(None).cast(page.schema[c].dataType).alias(c) for c in SALE_DETAIL_COLUMNS], total.alias("total"))
    return page.withColumn("total", total).unionByName(past.where(F.col("total") <= F.lit(start)))


# --- JSON documents ------------------------------------------------------------

def report_total(kpis: DataFrame) -> DataFrame:
    """``[{"id":…,"name":…,"value":…}, …]`` in ``ord`` order; counts print as integers,
    a null value drops its key."""
    value = (F.when(F.col("id").isin("dau", "new_mid"), F.col("value").cast("bigint").cast("variant"))
             .otherwise(F.col("value").cast("variant")))
    items = kpis.select(F.struct("ord", "id", "name", value.alias("value")).alias("s"))
    by_ord = F.array_sort(F.collect_list("s"), lambda a, b: F.when(a["ord"] < b["ord"], -1)
                          .when(a["ord"] > b["ord"], 1).otherwise(0))
    doc = F.to_json(F.transform(by_ord, lambda s: F.struct(s["id"].alias("id"), s["name"].alias("name"),
                                                           s["value"].alias("value"))))
    return items.agg(doc.alias("doc"))


def _hour_doc(rows: DataFrame, date_col: str, hour: str, agg: Column, day: str) -> DataFrame:
    today = F.lit(day)
    yday = prev_day(today)
    per = (rows.where((F.col(date_col) == today) | (F.col(date_col) == yday))
           .groupBy(date_col, hour).agg(agg.alias("v")))

    def fold(d):
        entries = F.collect_list(F.when(F.col(date_col) == d, F.struct(F.col(hour).alias("k"), F.col("v"))))
        return F.map_from_entries(F.array_sort(entries))
    return per.agg(F.to_json(F.struct(fold(yday).alias("yesterday"), fold(today).alias("today"))).alias("doc"))


def report_hour(metric: str, dau: DataFrame, orders: DataFrame, day: str) -> DataFrame:
    """``{"yesterday":{hh:v…},"today":{hh:v…}}`` for ``dau`` or ``order_amount``;
    any other id gives a null document."""
    if metric == "dau":
        return _hour_doc(dau, "logDate", "logHour", F.count(F.lit(1)), day)
    if metric == "order_amount":
        return _hour_doc(orders, "create_date", "create_hour", money_sum("total_amount"), day)
    return dau.sparkSession.range(1).select(F.lit(None).cast("string").alias("doc"))


def report_hour_totals(metric: str, device_hours: DataFrame, order_hours: DataFrame, day: str) -> DataFrame:
    """:func:`report_hour` from the totals that the stream jobs keep."""
    if metric == "dau":
        return _hour_doc(device_hours.where(F.col("devices") > 0), "logDate", "logHour", F.sum("devices"), day)
    if metric == "order_amount":
        return _hour_doc(order_hours.where(F.col("orders") > 0), "create_date", "create_hour", F.sum("amount").cast("double"), day)
    return device_hours.sparkSession.range(1).select(F.lit(None).cast("string").alias("doc"))


def _label_counts(label: Column, names, prefix: str) -> tuple[list[Column], Column]:
    """Count columns for each fixed label (and for a null label), plus the expression
    that turns them into the non-empty ``[{name, value}]`` options sorted by name —
    the same list a ``groupBy(label).count()`` would give, from one aggregate."""
    cols, items = [], []
    for i, name in enumerate(list(names) + [None]):
        alias = f"{prefix}{i}"
        cond = label.isNull() if name is None else (label == F.lit(name))
        cols.append(F.count_if(F.coalesce(cond, F.lit(False))).alias(alias))
        items.append(F.struct(F.lit(name).cast("string").alias("name"), F.col(alias).alias("value")))
    options = F.array_sort(F.filter(F.array(*items), lambda x: x["value"] > 0))
    return cols, options


def report_detail(detail: DataFrame, draw: int, start: int, length: int, day: str | None = None,
                  keyword: str | None = None, level: str | None = None,
                  order: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """``{"draw":d,"data":{"total":n,"stat":[{"options":[age…]},{"options":[gender…]}],
    "detail":[row…]}}`` — one page plus the age and gender shares of the filtered rows.

    Two passes over the filtered rows: one aggregate gives the total and both share
    lists (conditional counts per fixed label), the other the page (top-k)."""
    from pulse.functions import AGE_LABELS, GENDER_LABELS, age_band, gender_label
    rows = filter_detail(detail, day, keyword, level)
    page = _page(rows, start, length, order)
    age_cols, age_opts = _label_counts(age_band("user_age"), AGE_LABELS, "_age")
    gen_cols, gen_opts = _label_counts(gender_label("user_gender"), GENDER_LABELS.values(), "_gender")
    # the page in its own order: position first, then the rows without it
    place = Window.partitionBy(F.lit(1)).orderBy(*_sort_cols(order, SALE_DETAIL_COLUMNS))  # at most 100 rows
    numbered = page.select(F.struct(F.row_number().over(place).alias("i"), F.struct(*SALE_DETAIL_COLUMNS).alias("row")).alias("r"))
    detail_arr = numbered.agg(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["row"])).scalar()
    counts = rows.agg(F.count(F.lit(1)).alias("total"), *age_cols, *gen_cols)
    body = counts.select(
        F.lit(int(draw)).alias("draw"),
        F.struct(F.col("total"),
                 F.array(F.struct(age_opts.alias("options")),
                         F.struct(gen_opts.alias("options"))).alias("stat"),
                 detail_arr.alias("detail")).alias("data"))
    return body.select(F.to_json(F.struct("draw", "data")).alias("doc"))
