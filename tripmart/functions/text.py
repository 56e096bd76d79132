"""Text features: request/trip sentences (D17), word tokens (X1) and the
plain-language reading of a prediction (X9). All are JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentence formats shared by training and scoring, so that a
# model sees the same wording in both (demand: latitude, longitude, hour,
# weekday; duration: distance, hour, weekday, passengers).
DEMAND_FORMAT = "Location: %s, %s. Hour: %s. Weekday: %s."
DURATION_FORMAT = "Trip Distance: %s miles. Hour: %s. Weekday: %s. Passengers: %s."
DATE_FORMAT = " Date: %s."
PLACE_FORMAT = " %s: %s, %s."
PAD_TOKEN = "[PAD]"
MAX_TOKENS = 32


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_text(c: str | Column, decimals: int = 2) -> Column:
    """A number as fixed-point text ('%.2f'), never in exponent form."""
    return F.format_string(f"%.{decimals}f", _c(c).cast("double"))


def describe_demand(lat, lon, hour, weekday, date=None) -> Column:
    """Demand sentence from location, hour and weekday (no label in it),
    and the date where it is given."""
    text = F.format_string(DEMAND_FORMAT, number_text(lat, 6), number_text(lon, 6),
                           _c(hour).cast("bigint").cast("string"),
                           _c(weekday).cast("bigint").cast("string"))
    if date is None:
        return text
    return F.concat(text, F.format_string(DATE_FORMAT, F.date_format(_c(date), "yyyy-MM-dd")))


def describe_trip(distance, hour, weekday, passengers, pickup=None, dropoff=None) -> Column:
    """Trip sentence from distance, hour, weekday and passengers, and the
    (latitude, longitude) pairs of both ends where they are given."""
    text = F.format_string(DURATION_FORMAT, number_text(distance, 2),
                           _c(hour).cast("bigint").cast("string"),
                           _c(weekday).cast("bigint").cast("string"),
                           number_text(passengers, 0))
    for name, ends in (("Pickup", pickup), ("Dropoff", dropoff)):
        if ends is not None:
            text = F.concat(text, F.format_string(PLACE_FORMAT, F.lit(name),
                                                  *[number_text(c, 6) for c in ends]))
    return text


# Word boundaries: a sentence stop, or any run of characters that is not a
# letter, digit, '.' or '-' (so "2.50" and "-73.9" stay whole).
WORD_GAPS = r"\.(?:\s+|$)|[^a-z0-9.\-]+"


def words(text: str | Column) -> Column:
    """All word tokens of a whole text, lower case (none for NULL)."""
    lowered = F.lower(F.coalesce(_c(text), F.lit("")))
    # a gap becomes a space, which no word holds: one compiled pattern for all rows, and
    # an expression without a lambda is evaluated once where it is used twice
    return F.array_remove(F.split(F.regexp_replace(lowered, WORD_GAPS, " "), " "), "")


def words_sql(text: str) -> str:
    """:func:`words` of a SQL expression, to be saved with a model (NULL for NULL)."""
    gaps = WORD_GAPS.replace("\\", "\\\\")
    return f"array_remove(split(regexp_replace(lower({text}), '{gaps}', ' '), ' '), '')"


def tokens(text: str | Column, n: int) -> Column:
    """The first ``n`` word tokens, padded with '[PAD]' to exactly ``n``."""
    w = words(text)
    cut = F.slice(w, 1, n)
    pad = F.array_repeat(F.lit(PAD_TOKEN), F.greatest(F.lit(n) - F.size(cut), F.lit(0)))
    return F.concat(cut, pad)


def explain_prediction(model: str | Column, prediction: str | Column) -> Column:
    """Durations in whole minutes (hours and minutes from 60 on), demand
    as an approximate number of trips. NULL for other model names."""
    m = _c(model)
    r = F.round(_c(prediction).cast("double")).cast("bigint")
    duration = (F.when(r < 60, F.format_string("The trip should take about %d minutes.", r))
                .otherwise(F.format_string("The trip should take about %d hours %d minutes.",
                                           F.floor(r / 60).cast("bigint"), F.pmod(r, F.lit(60)))))
    demand = F.format_string("Expect about %d trips.", r)
    return (F.when(m == "duration", duration).when(m == "demand", demand)
            .otherwise(F.lit(None).cast("string")))
