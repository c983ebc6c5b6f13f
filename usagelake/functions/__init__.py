from usagelake.functions.expressions import (
    BUCKET_BOUNDS_S, duration_bucket, epoch_ms_of, hour_of, int_div, local_time, pair_text,
    session_ms, trunc_seconds, week_of_month,
)

__all__ = [
    "BUCKET_BOUNDS_S", "duration_bucket", "epoch_ms_of", "hour_of", "int_div", "local_time",
    "pair_text", "session_ms", "trunc_seconds", "week_of_month",
]
