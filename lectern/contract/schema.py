"""The seven input tables: columns, keys, vocabularies and conditional rules, as Spark types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import ArrayType, DataType, DoubleType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from lectern.contract import vocabulary as v

#: The name that manifests made here give their contract (one read from a file keeps its own), and the version read here.
NAME, VERSION = "reader-engagement-input", "1.0.0"
TEXT, INSTANT, SECONDS, TEXTS = StringType(), TimestampType(), DoubleType(), ArrayType(StringType())


@dataclass(frozen=True)
class Field:
    name: str
    type: DataType = TEXT
    nullable: bool = False
    allowed: tuple[str, ...] | None = None
    non_negative: bool = False


@dataclass(frozen=True)
class Rule:
    """Where `when` is one of `values`, `then` has to be filled, or has to be empty."""

    id: str
    when: str
    values: tuple[str, ...]
    then: str
    filled: bool


@dataclass(frozen=True)
class Table:
    name: str
    required: bool
    key: tuple[str, ...]
    block: str
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...] = ()
    reader_column: str | None = "reader_id"
    time_column: str | None = None

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields)

    @property
    def schema(self) -> StructType:
        return StructType([StructField(f.name, f.type, f.nullable) for f in self.fields])


def _event(*more: Field) -> tuple[Field, ...]:
    return Field("event_id"), Field("reader_id"), Field("event_ts", INSTANT), *more


_EMAIL = _event(Field("list_id"), Field("campaign_id", nullable=True))

TABLES = (
    Table("reader", True, ("reader_id",), "spine", (Field("reader_id"), Field("id_grain", allowed=v.READER_GRAINS)), reader_column=None),
    Table(
        "reader_event",
        True,
        ("event_id",),
        "consumption",
        _event(
            Field("channel", allowed=v.CHANNELS),
            Field("event_kind", allowed=v.EVENT_KINDS),
            Field("content_id", nullable=True),
            Field("session_id"),
            Field("engagement_time_seconds", SECONDS, nullable=True, non_negative=True),
        ),
        (Rule("delivery_requires_content_id", "event_kind", (v.DELIVERY,), "content_id", True),),
        time_column="event_ts",
    ),
    Table(
        "content",
        True,
        ("content_id",),
        "topic",
        (Field("content_id"), Field("content_type", allowed=v.CONTENT_TYPES), Field("section_resolution", allowed=v.RESOLUTIONS), Field("sections", TEXTS, nullable=True), Field("published_ts", INSTANT, nullable=True)),
        (
            Rule("resolved_requires_sections", "section_resolution", (v.RESOLVED,), "sections", True),
            Rule("unresolved_forbids_sections", "section_resolution", (v.UNRESOLVED,), "sections", False),
        ),
        reader_column=None,
    ),
    Table(
        "subscription_span",
        True,
        ("reader_id", "start_ts"),
        "spine",
        (Field("reader_id"), Field("state", allowed=v.STATES), Field("payer_type", nullable=True, allowed=v.PAYERS), Field("start_ts", INSTANT), Field("end_ts", INSTANT, nullable=True)),
    ),
    Table("email_click", False, ("event_id",), "email_cadence", _EMAIL, time_column="event_ts"),
    Table("email_open", False, ("event_id",), "deliverability", _EMAIL, time_column="event_ts"),
    Table("community_action", False, ("event_id",), "community", _event(Field("action_kind", allowed=v.ACTIONS), Field("site_id"), Field("target_content_id", nullable=True)), time_column="event_ts"),
)
BY_NAME = {t.name: t for t in TABLES}
REQUIRED = tuple(t.name for t in TABLES if t.required)
OPTIONAL = tuple(t.name for t in TABLES if not t.required)

#: Column names that a delivery may not have, by what they contain, and why. Fixed values.
FORBIDDEN = {
    "scroll": "scroll depth is out of scope",
    "event_date": "a day computed by the producer hides its time zone",
    "local_date": "a day computed by the producer hides its time zone",
    "email": "no personal data: email address",
    "ip_address": "no personal data: IP address",
    "ip_addr": "no personal data: IP address",
    "phone": "no personal data: phone number",
    "first_name": "no personal data: name",
    "last_name": "no personal data: name",
    "full_name": "no personal data: name",
    "postal": "no personal data: postal address",
    "birth": "no personal data: date of birth",
}


def compatible(declared: DataType, actual: DataType) -> bool:
    """Whether a column of one type may stand for the other: the same type, whatever array elements' nullability."""
    if isinstance(declared, ArrayType) and isinstance(actual, ArrayType):
        return compatible(declared.elementType, actual.elementType)
    return type(declared) is type(actual)


def naive_instant(declared: DataType, actual: DataType) -> bool:
    return isinstance(declared, TimestampType) and isinstance(actual, TimestampNTZType)
