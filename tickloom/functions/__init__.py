from tickloom.functions.columns import (
    band,
    epoch_text,
    money_text,
    safe_bigint,
    safe_double,
    sentiment_score,
    split_list,
    surrogate_key,
    ticker,
    utc_text,
)
from tickloom.functions.rolling import full_window_mean, rolling_corr, rolling_mean, rows_window

__all__ = [
    "band",
    "epoch_text",
    "full_window_mean",
    "money_text",
    "rolling_corr",
    "rolling_mean",
    "rows_window",
    "safe_bigint",
    "safe_double",
    "sentiment_score",
    "split_list",
    "surrogate_key",
    "ticker",
    "utc_text",
]
