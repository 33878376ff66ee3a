"""A made-up publisher for tests and trials: readers of seven kinds over many weeks, drawn by seed for each reader."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from lectern.contract import schema
from lectern.contract import vocabulary as v
from lectern.contract.manifest import ArticleView, Availability, Manifest, Population, WeekAnchor
from lectern.plans.buckets import BucketMap

#: Kinds of readers: share, weekly web and app views, sections read, weekly clicks, weekly community actions.
KINDS = {
    "devoted": (0.12, 16.0, 10.0, 7, 3.0, 0.3),
    "app_first": (0.16, 1.5, 14.0, 4, 0.5, 0.1),
    "web_first": (0.18, 11.0, 0.8, 4, 0.6, 0.1),
    "specialist": (0.15, 8.0, 2.0, 2, 0.8, 0.2),
    "talker": (0.08, 9.0, 4.0, 5, 0.8, 5.0),
    "mail_reader": (0.14, 2.0, 1.0, 3, 4.0, 0.05),
    "fading": (0.17, 1.2, 0.6, 2, 0.2, 0.02),
}
SECTIONS = ("news", "politics", "sports", "food", "arts", "education", "business", "travel", "science", "opinion")
ZONE = "America/New_York"


@dataclass(frozen=True)
class Cohort:
    readers: int = 400
    weeks: int = 26
    contents: int = 140
    seed: int = 7
    start: date = date(2026, 1, 5)


def bucket_map() -> BucketMap:
    return BucketMap("cohort-1", {"public": ("news", "politics", "opinion"), "leisure": ("sports", "travel"), "culture": ("food", "arts"), "learning": ("education", "science"), "money": ("business",)})


def manifest() -> Manifest:
    there = Availability(v.AVAILABLE, date(2026, 1, 1))
    return Manifest("1.0.0", ZONE, WeekAnchor("Sunday", v.WEEK_ENDS_ON), ArticleView("cohort-view", ("article",), (v.DELIVERY,)), Population("cohort-subscribers", ("trial", "active", "grace")), {t: there for t in schema.OPTIONAL})


def _kind(reader: int, c: Cohort) -> tuple[str, np.random.Generator]:
    rng = np.random.default_rng([c.seed, reader])
    names = list(KINDS)
    return names[rng.choice(len(names), p=[KINDS[n][0] for n in names])], rng


def _times(rng: np.random.Generator, c: Cohort, rate: float) -> list[datetime]:
    start = datetime(c.start.year, c.start.month, c.start.day, 14, tzinfo=UTC)
    own = rate * rng.gamma(6, 1 / 6)
    return [start + timedelta(days=7 * w + int(rng.integers(0, 7)), seconds=int(rng.integers(0, 8 * 3600))) for w in range(c.weeks) for _ in range(rng.poisson(own))]


def _events(reader: int, c: Cohort) -> Iterator[tuple]:
    kind, rng = _kind(reader, c)
    _, web, app, n_sections, _, _ = KINDS[kind]
    liked = rng.choice(len(SECTIONS), size=n_sections, replace=False)
    for channel, rate in (("web", web), ("app", app)):
        for k, at in enumerate(_times(rng, c, rate)):
            section = int(liked[rng.integers(len(liked))])
            content = section + len(SECTIONS) * int(rng.integers(c.contents // len(SECTIONS)))
            ident = f"evt-{reader}-{channel}-{k}"
            yield ident, f"rdr-{reader:06d}", at, channel, v.DELIVERY, f"cnt-{content}", f"ses-{reader}-{channel}-{at:%Y%m%d%H}", float(rng.gamma(2, 40)) if rng.random() < 0.8 else None
            if rng.random() < 0.2:
                yield f"{ident}i", f"rdr-{reader:06d}", at + timedelta(seconds=30), channel, v.INTERACTION, f"cnt-{content}", f"ses-{reader}-{channel}-{at:%Y%m%d%H}", None


def _mail(kind_of_row: str) -> Callable[[int, Cohort], Iterator[tuple]]:
    def rows(reader: int, c: Cohort) -> Iterator[tuple]:
        kind, _ = _kind(reader, c)
        rng = np.random.default_rng([c.seed, reader, 1])
        for k, at in enumerate(_times(rng, c, KINDS[kind][4])):
            shift = timedelta(seconds=60 if kind_of_row == "opn" else 0)
            yield f"{kind_of_row}-{reader}-{k}", f"rdr-{reader:06d}", at - shift, f"lst-{k % 2}", f"cmp-{k % 9}" if k % 5 else None

    return rows


def _actions(reader: int, c: Cohort) -> Iterator[tuple]:
    kind, _ = _kind(reader, c)
    rng = np.random.default_rng([c.seed, reader, 2])
    for k, at in enumerate(_times(rng, c, KINDS[kind][5])):
        yield f"act-{reader}-{k}", f"rdr-{reader:06d}", at, v.ACTIONS[int(rng.integers(len(v.ACTIONS)))], "site-main", None


def _spans(reader: int, c: Cohort) -> Iterator[tuple]:
    """Nearly all subscribe throughout; some join late, lapse, or never pay."""
    rng = np.random.default_rng([c.seed, reader, 3])
    at = lambda day: datetime(c.start.year, c.start.month, c.start.day, 5, tzinfo=UTC) + timedelta(days=day)
    ident, draw, days = f"rdr-{reader:06d}", rng.random(), 7 * c.weeks
    if draw < 0.05:
        yield ident, "registered_unpaid", None, at(-200), None
    elif draw < 0.12:
        joined = int(rng.integers(days // 4, days // 2))
        yield ident, "trial", "individual", at(joined), at(joined + 14)
        yield ident, "active", "individual", at(joined + 14), None
    elif draw < 0.18:
        left = int(rng.integers(days // 2, days))
        yield ident, "active", None, at(-200), at(left)
        yield ident, "cancelled", None, at(left), None
    else:
        yield ident, "active", "institutional" if draw > 0.9 else "individual", at(-200), None


def build(spark: SparkSession, c: Cohort | None = None) -> dict[str, DataFrame]:
    """The seven tables; each reader's rows depend on the seed and the reader's number alone."""
    c = c or Cohort()

    def made(table: str, rows: Callable[[int, Cohort], Iterator[tuple]]) -> DataFrame:
        spec = schema.BY_NAME[table].schema

        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in parts:
                yield pd.DataFrame([r for i in part["id"] for r in rows(int(i), c)], columns=spec.names)

        return spark.range(c.readers).mapInPandas(run, spec)

    day = datetime(2025, 12, 1, tzinfo=UTC)
    contents = [(f"cnt-{k}", "article" if k % 11 else "video", v.UNRESOLVED if k % 23 == 5 else v.RESOLVED, None if k % 23 == 5 else [SECTIONS[k % len(SECTIONS)]] + ([SECTIONS[(k + 3) % len(SECTIONS)]] if k % 17 == 0 else []), day + timedelta(hours=k)) for k in range(c.contents)]
    return {
        "reader": made("reader", lambda i, _: iter([(f"rdr-{i:06d}", v.READER_GRAINS[0])])),
        "reader_event": made("reader_event", _events),
        "content": spark.createDataFrame(contents, schema.BY_NAME["content"].schema),
        "subscription_span": made("subscription_span", _spans),
        "email_click": made("email_click", _mail("clk")),
        "email_open": made("email_open", _mail("opn")),
        "community_action": made("community_action", _actions),
    }
