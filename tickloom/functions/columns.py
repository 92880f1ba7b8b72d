"""Scalar Column builders. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom import fixed_values as V

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the parts joined by '-', with a fixed text for NULL parts."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit(V.SURROGATE_KEY_NULL)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def utc_text(ts: Column | str) -> Column:
    """Timestamp as text with a '+00' suffix and 0, 3 or 6 sub-second digits."""
    ts = _col(ts)
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    digits = (
        F.when(micros == 0, F.date_format(ts, SECOND_FORMAT))
        .when(F.pmod(micros, F.lit(1_000)) == 0, F.date_format(ts, SECOND_FORMAT + ".SSS"))
        .otherwise(F.date_format(ts, SECOND_FORMAT + ".SSSSSS"))
    )
    return F.concat(digits, F.lit("+00"))


def safe_double(c: Column | str) -> Column:
    """Numeric parse that gives NULL instead of failing."""
    return _col(c).try_cast("double")


def safe_bigint(c: Column | str) -> Column:
    """Integer parse: NULL for anything that is not a whole number."""
    c = _col(c)
    as_double = c.cast("string").try_cast("double")
    whole = F.when(as_double == F.floor(as_double), as_double.try_cast("bigint"))
    return F.coalesce(c.cast("string").try_cast("bigint"), whole)


def json_int(v: Column | str) -> Column:
    """A JSON value (variant) as a whole number, else NULL.

    Quoted text has to be the digits of a whole number, with a sign or blanks around at most; a
    number is cut towards zero; true and false are 1 and 0.
    """
    v = _col(v)
    kind = F.schema_of_variant(v)
    text = F.trim(F.try_variant_get(v, "$", "string"))
    digits = F.when(text.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.translate(text, "_", "")).try_cast("bigint")
    number = F.try_variant_get(v, "$", "double")
    cut = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number)).try_cast("bigint")
    return (
        F.when(kind == "STRING", digits)
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("bigint"))
        .when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint"))
        .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), cut)
    )


def epoch_text(seconds: Column | str) -> Column:
    """Epoch seconds (possibly fractional text) as 'yyyy-MM-dd HH:mm:ss', else NULL."""
    value = safe_double(seconds)
    # Outside years 1..9999 there is no calendar date to format.
    in_range = value.between(-62135596800.0, 253402300799.0)
    return F.date_format(F.timestamp_seconds(F.when(in_range, value)), SECOND_FORMAT)


def ticker(symbol: Column | str, names: dict[str, str] | None = None) -> Column:
    """Known coin name to its ticker; any other symbol upper-cased."""
    symbol = _col(symbol)
    pairs = [F.lit(x) for kv in (names or V.TICKERS).items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(symbol)), F.upper(symbol))


def mentions(lowered_title: Column | str, patterns: tuple[str, ...]) -> Column:
    """True where a lower-cased title holds any of the substrings.

    A pattern that contains another one can add nothing and is not searched for.
    """
    needed = [p for p in patterns if not any(q != p and q in p for q in patterns)]
    return reduce(lambda a, b: a | b, [_col(lowered_title).contains(p) for p in needed])


def sentiment_score(index_value: Column | str, posts: Column | str, engagement: Column | str) -> Column:
    """70% index value + 30% discussion activity, the latter capped at 100 from above only."""
    activity = F.least(
        F.lit(100.0),
        _col(posts).cast("double") * 5.0 + _col(engagement).cast("double") / 10.0,
    )
    return F.round(F.lit(0.7) * _col(index_value).cast("double") + F.lit(0.3) * activity).cast("bigint")


def band(
    value: Column | str,
    low: float,
    high: float,
    labels: tuple[str, str, str],
    high_inclusive: bool = False,
) -> Column:
    """Three-way bucket: below ``low``, between, above ``high``."""
    value = _col(value)
    above = value >= high if high_inclusive else value > high
    return F.when(value < low, labels[0]).when(above, labels[2]).when(value.isNotNull(), labels[1])


def money_text(value: Column | str) -> Column:
    """'$1,234.50'; four decimals below one."""
    value = _col(value)
    return F.when(value < 1, F.concat(F.lit("$"), F.format_number(value, 4))).otherwise(
        F.concat(F.lit("$"), F.format_number(value, 2))
    )


def split_list(text: Column | str) -> Column:
    """Comma list to array: trimmed, empty items dropped."""
    return F.filter(F.transform(F.split(_col(text), ","), lambda x: F.trim(x)), lambda x: x != "")
