"""Column functions: pure expressions, JVM-side, codegen-friendly."""

from pulse.functions.columns import (
    AGE_LABELS, GENDER_LABELS, age_band, date_hour_columns, epoch_millis, fold_map,
    gender_label, mask_phone, match_keyword, on_date, prev_day, route_topic, sales_band,
    split_create_time, stamp_ts, with_create_date_hour, with_date_hour,
)

__all__ = [
    "AGE_LABELS", "GENDER_LABELS", "age_band", "date_hour_columns", "epoch_millis",
    "fold_map", "gender_label", "mask_phone", "match_keyword", "on_date", "prev_day",
    "route_topic", "sales_band", "split_create_time", "stamp_ts", "with_create_date_hour",
    "with_date_hour",
]
