"""The section taxonomy: which sections make up a bucket, with one bucket for the rest."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from lectern.contract import vocabulary as v

#: Most sections that a map may name; it is held by each task.
MAX_SECTIONS = 100_000


class BucketError(ValueError):
    """The bucket map can't be used."""


@dataclass(frozen=True)
class BucketMap:
    version: str
    buckets: dict[str, tuple[str, ...]]
    catch_all: str = "other"
    catch_all_share_max: float = 0.15
    completeness_min_view_share: float = 0.005
    min_buckets: int = 2
    max_buckets: int = 64

    def __post_init__(self) -> None:
        from lectern.model.guards import refused_columns

        need = lambda ok, why: None if ok else _refuse(why)
        named = [x for parts in self.buckets.values() for x in parts]
        need(self.buckets, "there are no buckets")
        need(self.catch_all.strip(), "the catch-all bucket has no name")
        need(self.catch_all not in self.buckets, f"the catch-all bucket {self.catch_all!r} can't list sections")
        need(v.UNRESOLVED_SECTION not in self.buckets and v.UNRESOLVED_SECTION not in named, f"{v.UNRESOLVED_SECTION} is no section")
        need(all(self.buckets.values()) and all(x.strip() for x in named), "a bucket or section is empty")
        need(len(named) == len(set(named)), f"sections mapped twice: {sorted({x for x in named if named.count(x) > 1})[:5] if len(named) < 1000 else 'some'}")
        need(len(named) <= MAX_SECTIONS, f"{len(named)} sections are more than {MAX_SECTIONS}")
        need(self.min_buckets >= 2 and self.max_buckets >= self.min_buckets, "min_buckets has to be 2 at least and no more than max_buckets")
        need(self.min_buckets <= len(self.names) <= self.max_buckets, f"{len(self.names)} buckets are not within {self.min_buckets} to {self.max_buckets}")
        need(0 < self.catch_all_share_max <= 1, "catch_all_share_max has to be above 0 and 1 at most")
        need(0 <= self.completeness_min_view_share <= 1, "completeness_min_view_share has to be from 0 to 1")
        need(not (bad := refused_columns(self.share_columns)), f"bucket names give refused columns: {bad}")

    @property
    def names(self) -> tuple[str, ...]:
        return (*self.buckets, self.catch_all)

    @property
    def bucket_of(self) -> dict[str, str]:
        return {section: b for b, parts in self.buckets.items() for section in parts}

    @property
    def share_columns(self) -> list[str]:
        return [f"topic_share_{b}" for b in self.names]

    def bucket_for(self, section: str) -> str:
        if section == v.UNRESOLVED_SECTION:
            raise BucketError("unresolved reading belongs to no bucket")
        return self.bucket_of.get(section, self.catch_all)


def _refuse(why: str) -> None:
    raise BucketError(why)


def parse(raw: object) -> BucketMap:
    if not isinstance(raw, dict) or not isinstance(raw.get("buckets"), dict) or "version" not in raw:
        raise BucketError("a bucket map is an object with a version and buckets")
    if any(not isinstance(x, list) for x in raw["buckets"].values()):
        raise BucketError("each bucket lists its sections")
    known = {"catch_all_share_max": float, "completeness_min_view_share": float, "min_buckets": int, "max_buckets": int}
    return BucketMap(
        str(raw["version"]),
        {str(b): tuple(str(x).strip() for x in parts) for b, parts in raw["buckets"].items()},
        str(raw.get("catch_all_bucket", "other")),
        **{k: kind(raw[k]) for k, kind in known.items() if k in raw},
    )


def load(path: str) -> BucketMap:
    try:
        with open(path, encoding="utf-8") as f:
            return parse(json.load(f))
    except (FileNotFoundError, json.JSONDecodeError) as e:
        raise BucketError(f"no bucket map at {path}: {e}") from e


@dataclass(frozen=True)
class Completeness:
    unmapped: tuple[str, ...]
    catch_all_share: float
    passed: bool


def completeness(m: BucketMap, shares: Mapping[str, float]) -> Completeness:
    """Sections of weight that the map doesn't name, and the share of all such; over resolved reading only."""
    if v.UNRESOLVED_SECTION in shares:
        raise BucketError("shares are of resolved reading only")
    rest = {x: s for x, s in shares.items() if x not in m.bucket_of}
    heavy = tuple(sorted(x for x, s in rest.items() if s >= m.completeness_min_view_share))
    share = float(sum(rest.values()))
    return Completeness(heavy, share, not heavy and share <= m.catch_all_share_max)
