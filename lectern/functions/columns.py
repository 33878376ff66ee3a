"""Column expressions of the daily and weekly layers; all of them stay inside generated code."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.contract import vocabulary as v
from lectern.contract.manifest import ArticleView

WINDOW_DAYS, BINS = 28, 4
#: Days since the last activity if there was none in the window.
RECENCY_CAP = WINDOW_DAYS + 1
#: Least denominators of rates. Fixed values.
FLOORS = {"views": 3.0, "sessions": 2.0, "active_days": 1.0, "actions": 1.0}
CV_EPS = 1e-9


def utc_clock(ts: Column) -> Column:
    """The instant's clock in UTC as a timestamp without zone, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def instant(naive: Column) -> Column:
    """The instant that a timestamp without zone means in UTC, whatever the session's zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), naive))


def local_date(ts: Column, zone: str) -> Column:
    """The calendar day of an instant in a zone; null for null."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock(ts)).cast("date")


def is_view(view: ArticleView, kind: Column, content_id: Column, content_type: Column) -> Column:
    """Whether an event counts as an article view; content without a row counts, as its type is unknown."""
    return F.coalesce(kind.isin(*view.event_kinds) & content_id.isNotNull() & (content_type.isNull() | content_type.isin(*view.content_types)), F.lit(False))


def effective_sections(resolution: Column, sections: Column) -> Column:
    """The sections of content, or the sentinel alone if they are unresolved, null or none."""
    return F.when((resolution == v.RESOLVED) & sections.isNotNull() & (F.size(sections) > 0), sections).otherwise(F.array(F.lit(v.UNRESOLVED_SECTION)))


def safe_rate(numerator: Column, denominator: Column, floor: float) -> Column:
    if floor <= 0:
        raise ValueError("the floor of a rate has to be above 0")
    return numerator / F.greatest(denominator.cast("double"), F.lit(float(floor)))


def recency_days(last: Column, week_end: Column) -> Column:
    return F.coalesce(F.date_diff(week_end, last).cast("double"), F.lit(float(RECENCY_CAP)))


def recency_score(days: Column) -> Column:
    return 1.0 - F.least(days, F.lit(float(RECENCY_CAP))) / float(RECENCY_CAP)


def momentum(b1: Column, b2: Column, b3: Column, b4: Column) -> Column:
    return F.log1p(b1 + b2) - F.log1p(b3 + b4)


def entropy(shares: Sequence[Column]) -> Column:
    """Entropy of shares over its largest value; 0 log 0 counts as 0."""
    terms = [F.when(s > 0, s * F.log(s)).otherwise(F.lit(0.0)) for s in shares]
    return -sum(terms[1:], terms[0]) / math.log(len(shares))


def bin_metrics(bins: Sequence[Column]) -> dict[str, Column]:
    """Active weeks, share of the top week, variation of logs and evenness of four weekly sums."""
    if len(bins) != BINS:
        raise ValueError(f"{BINS} weekly bins are needed, not {len(bins)}")
    total = sum(bins[1:], bins[0])
    logs = [F.log1p(b) for b in bins]
    mean = sum(logs[1:], logs[0]) / BINS
    spread = [(x - mean) * (x - mean) for x in logs]
    some = total > 0
    shares = [F.when(some, b / total).otherwise(F.lit(0.0)) for b in bins]
    return {
        "active_weeks_4": sum((F.when(b > 0, 1.0).otherwise(0.0) for b in bins[1:]), F.when(bins[0] > 0, 1.0).otherwise(0.0)),
        "top_week_share_4": F.when(some, F.greatest(*bins) / total).otherwise(F.lit(0.0)),
        "weekly_cv_4": F.sqrt(sum(spread[1:], spread[0]) / BINS) / (mean + CV_EPS),
        "weekly_evenness_entropy_4": F.when(some, entropy(shares)).otherwise(F.lit(0.0)),
    }


def week_of_age(day: Column, week_end: Column) -> Column:
    """1 for the week that ends on week_end, 2 for the week before, and so on."""
    return F.floor(F.date_diff(week_end, day) / 7).cast("int") + 1


def log_count(values: Column, lower: float, upper: float) -> Column:
    """log(1 + x) of values clipped first."""
    return F.log1p(F.least(F.greatest(values, F.lit(lower)), F.lit(upper)))


def z_score(values: Column, mean: float, std: float, clip: float | None = None) -> Column:
    out = (values - F.lit(mean)) / F.lit(max(std, 1e-12))
    return out if clip is None else F.greatest(F.lit(-clip), F.least(F.lit(clip), out))


def digest_mod(text: Column, n: Column) -> Column:
    """The SHA-256 of a text as a number, modulo n below 2^31, from eight chunks of 32 bits."""
    hexes = F.sha2(text.cast("binary"), 256)
    out = F.lit(0).cast("long")
    for k in range(8):
        out = (out * (1 << 32) + F.conv(F.substring(hexes, 8 * k + 1, 8), 16, 10).cast("long")) % n
    return out
