"""The delivery's manifest: decisions that have no default."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from lectern.contract import schema
from lectern.contract import vocabulary as v

FILENAME = "manifest.json"
#: What a template has where an answer is due.
UNANSWERED = "ANSWER-REQUIRED"
REQUIRED_KEYS = ("contract_name", "contract_version", "day_boundary_timezone", "week_anchor", "article_view", "scored_population", "optional_inputs")
#: What an excluded id may not hold, as then it wouldn't be an opaque id.
NOT_OPAQUE = ("@", " ", "%", "*", "like ", "'")


class ManifestError(ValueError):
    """The manifest doesn't say what has to be said."""


def _need(ok: object, message: str) -> None:
    if not ok:
        raise ManifestError(message)


def _subset(values: tuple[str, ...], allowed: tuple[str, ...], where: str) -> None:
    _need(values, f"{where} names nothing")
    _need(not (odd := [x for x in values if x not in allowed]), f"{where} has {odd}, which is not among {list(allowed)}")


@dataclass(frozen=True)
class WeekAnchor:
    weekday: str
    position: str

    def __post_init__(self) -> None:
        _subset((self.weekday,), v.WEEKDAYS, "week_anchor.weekday")
        _subset((self.position,), (v.WEEK_STARTS_ON, v.WEEK_ENDS_ON), "week_anchor.position")


@dataclass(frozen=True)
class ArticleView:
    definition_id: str
    content_types: tuple[str, ...]
    event_kinds: tuple[str, ...]

    def __post_init__(self) -> None:
        _need(self.definition_id.strip(), "article_view.definition_id is empty")
        _subset(self.content_types, v.CONTENT_TYPES, "article_view.content_types")
        _subset(self.event_kinds, v.EVENT_KINDS, "article_view.event_kinds")


@dataclass(frozen=True)
class Population:
    definition_id: str
    entitled_states: tuple[str, ...]

    def __post_init__(self) -> None:
        _need(self.definition_id.strip(), "scored_population.definition_id is empty")
        _subset(self.entitled_states, v.STATES, "scored_population.entitled_states")
        _need(len(set(self.entitled_states)) == len(self.entitled_states), "scored_population.entitled_states has repeats")


@dataclass(frozen=True)
class Availability:
    status: str
    available_from: date | None = None

    def __post_init__(self) -> None:
        _subset((self.status,), v.AVAILABILITIES, "optional_inputs status")
        _need((self.status == v.AVAILABLE) == (self.available_from is not None), "available_from belongs to available inputs, and to no others")

    @property
    def is_available(self) -> bool:
        return self.status == v.AVAILABLE


@dataclass(frozen=True)
class Manifest:
    contract_version: str
    timezone: str
    week_anchor: WeekAnchor
    article_view: ArticleView
    population: Population
    optional_inputs: dict[str, Availability]
    exclusions: tuple[str, ...] = ()
    contract_name: str = schema.NAME

    def available(self, table: str) -> bool:
        return table in schema.REQUIRED or self.optional_inputs[table].is_available


def unanswered(raw: object, path: str = "") -> list[str]:
    """Places that still hold the template's placeholder; keys that start with an underscore are comments."""
    if isinstance(raw, dict):
        return [p for k, x in raw.items() if not str(k).startswith("_") for p in unanswered(x, f"{path}.{k}" if path else str(k))]
    if isinstance(raw, list):
        return [p for n, x in enumerate(raw) for p in unanswered(x, f"{path}[{n}]")]
    return [path or "the manifest"] if isinstance(raw, str) and raw.strip() == UNANSWERED else []


def _object(raw: dict, key: str, parts: tuple[str, ...]) -> dict:
    value = raw[key]
    _need(isinstance(value, dict), f"{key} is not an object")
    for part in parts:
        _need(part in value, f"{key} has no {part}")
    return value


def _texts(value: object, where: str) -> tuple[str, ...]:
    _need(isinstance(value, list), f"{where} is not a list")
    return tuple(map(str, value))


def parse(raw: object) -> Manifest:
    _need(isinstance(raw, dict), f"{FILENAME} is not a JSON object")
    for key in REQUIRED_KEYS:
        _need(key in raw, f"{FILENAME} has no {key}, and there is no default for it")
    _need(not (open_places := unanswered(raw)), f"{FILENAME} still has {UNANSWERED} at {open_places}")
    _need(isinstance(raw["contract_name"], str) and bool(raw["contract_name"].strip()), "contract_name is empty")
    zone = raw["day_boundary_timezone"]
    _need(isinstance(zone, str) and zone.strip(), "day_boundary_timezone is empty")
    try:
        ZoneInfo(zone)
    except (ZoneInfoNotFoundError, ValueError) as e:
        raise ManifestError(f"day_boundary_timezone {zone!r} is no IANA zone") from e
    anchor = _object(raw, "week_anchor", ("weekday", "position"))
    view = _object(raw, "article_view", ("definition_id", "content_types", "event_kinds"))
    population = _object(raw, "scored_population", ("definition_id", "entitled_states"))
    inputs = _object(raw, "optional_inputs", schema.OPTIONAL)
    _need(not (odd := set(inputs) - set(schema.OPTIONAL)), f"optional_inputs names {sorted(odd)}")
    availability = {}
    for name, entry in inputs.items():
        _need(isinstance(entry, dict) and "status" in entry, f"optional_inputs.{name} has no status")
        floor = entry.get("available_from")
        try:
            availability[name] = Availability(entry["status"], None if floor is None else date.fromisoformat(floor))
        except (TypeError, ValueError) as e:
            raise ManifestError(f"optional_inputs.{name}: {e}") from e
    exclusions = _texts(raw.get("population_exclusions", []), "population_exclusions")
    _need(not (odd := [x for x in exclusions if any(m in x.lower() for m in NOT_OPAQUE)]), f"population_exclusions has {odd}, which are no opaque ids")
    return Manifest(
        str(raw["contract_version"]),
        zone,
        WeekAnchor(anchor["weekday"], anchor["position"]),
        ArticleView(str(view["definition_id"]), _texts(view["content_types"], "article_view.content_types"), _texts(view["event_kinds"], "article_view.event_kinds")),
        Population(str(population["definition_id"]), _texts(population["entitled_states"], "scored_population.entitled_states")),
        availability,
        exclusions,
        raw["contract_name"],
    )


def as_dict(m: Manifest) -> dict:
    out = {
        "contract_name": m.contract_name,
        "contract_version": m.contract_version,
        "day_boundary_timezone": m.timezone,
        "week_anchor": {"weekday": m.week_anchor.weekday, "position": m.week_anchor.position},
        "article_view": {"definition_id": m.article_view.definition_id, "content_types": list(m.article_view.content_types), "event_kinds": list(m.article_view.event_kinds)},
        "scored_population": {"definition_id": m.population.definition_id, "entitled_states": list(m.population.entitled_states)},
        "optional_inputs": {k: {"status": a.status, "available_from": a.available_from and a.available_from.isoformat()} for k, a in m.optional_inputs.items()},
    }
    return out | ({"population_exclusions": list(m.exclusions)} if m.exclusions else {})


def load(spark, directory: str) -> Manifest:
    """The manifest of a delivery, read through Spark, so that any store that Spark reads will do."""
    path = f"{directory}/{FILENAME}"
    try:
        text = spark.read.text(path, wholetext=True).first()
    except Exception as e:
        raise ManifestError(f"no readable {path}") from e
    try:
        return parse(json.loads(text.value if text else ""))
    except json.JSONDecodeError as e:
        raise ManifestError(f"{path} is no JSON: {e}") from e
