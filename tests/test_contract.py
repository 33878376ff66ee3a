"""Manifest, validator, mapping and oracle: each broken input raises exactly what it has to."""

import copy
import json
import shutil

import pytest
from pyspark.sql import functions as F

from lectern.contract import manifest as mf
from lectern.contract import mapping, oracle, schema, validate
from lectern.contract import vocabulary as v
from lectern.sources import demo
from lectern.sources.delivery import read_delivery, register_views, write_delivery


@pytest.fixture(scope="module")
def tables(spark):
    return {n: df.persist() for n, df in demo.build(spark).items()}


@pytest.fixture(scope="module")
def delivery(spark, tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("demo"))
    write_delivery({n: df.coalesce(1) for n, df in tables.items()}, demo.manifest(), path)
    return path


def codes(tables, manifest=None, **unreadable):
    return sorted({f.code for r in validate.validate_tables(tables, manifest or demo.manifest(), unreadable) for f in r.findings})


def put(name, column, value, where=None):
    """The table with a column replaced by a SQL expression, on all or some rows."""
    return lambda t: {**t, name: t[name].withColumn(column, F.when(F.expr(where), F.expr(value)).otherwise(F.col(column)) if where else F.expr(value))}


def twice(name):
    return lambda t: {**t, name: t[name].unionByName(t[name].limit(1))}


def manifest_with(**status):
    m = mf.as_dict(demo.manifest())
    for t, s in status.items():
        m["optional_inputs"][t] = {"status": s}
    return mf.parse(m)


def test_demo_conforms(spark, delivery, tables):
    report = validate.validate(spark, delivery)
    assert report.findings == () and report.exit_code == 0 and "PASS: no findings" in report.render()
    assert json.loads(report.to_json())["passed"]
    assert set(read_delivery(spark, delivery)) == set(schema.BY_NAME)
    assert spark.sql(f"SELECT count(*) FROM {register_views(tables)[1]}").first()[0] == 26


nul = "CAST(NULL AS STRING)"
CASES = {
    "null reader": (put("reader_event", "reader_id", nul, "event_id = 'evt-1'"), ["NULL_IN_NON_NULLABLE"]),
    "null session": (put("reader_event", "session_id", nul, "event_id = 'evt-1'"), ["NULL_IN_NON_NULLABLE"]),
    "negative time": (put("reader_event", "engagement_time_seconds", "-1.0D", "event_id = 'evt-1'"), ["NEGATIVE_MEASURE"]),
    "channel": (put("reader_event", "channel", "'kiosk'", "event_id = 'evt-1'"), ["ENUM_VALUE_OUT_OF_RANGE"]),
    "kind": (put("reader_event", "event_kind", "'glance'", "event_id = 'evt-1'"), ["ENUM_VALUE_OUT_OF_RANGE"]),
    "content type": (put("content", "content_type", "'poem'", "content_id = 'cnt-1'"), ["ENUM_VALUE_OUT_OF_RANGE"]),
    "state": (put("subscription_span", "state", "'paused'", "state = 'grace'"), ["ENUM_VALUE_OUT_OF_RANGE"]),
    "payer": (put("subscription_span", "payer_type", "'uncle'", "payer_type = 'guest'"), ["ENUM_VALUE_OUT_OF_RANGE"]),
    "action": (put("community_action", "action_kind", "'like_received'", "action_kind = 'like_given'"), ["ENUM_VALUE_OUT_OF_RANGE"]),
    "grain": (put("reader", "id_grain", "'device'", "reader_id = 'rdr-a'"), ["ENUM_VALUE_OUT_OF_RANGE", "MIXED_READER_ID_GRAIN"]),
    "one odd grain": (put("reader", "id_grain", "'device'"), ["ENUM_VALUE_OUT_OF_RANGE"]),
    **{f"twice {n}": (twice(n), ["DUPLICATE_DEDUP_KEY"]) for n in ("reader", "reader_event", "content", "email_click", "email_open", "community_action")},
    "delivery without content": (put("reader_event", "content_id", nul, "event_id = 'evt-1'"), ["CONDITIONAL_FIELD_REQUIRED"]),
    "resolved without sections": (put("content", "sections", "CAST(array() AS array<string>)", "content_id = 'cnt-1'"), ["CONDITIONAL_FIELD_REQUIRED"]),
    "unresolved with sections": (put("content", "sections", "array('news')", "content_id = 'cnt-7'"), ["CONDITIONAL_FIELD_FORBIDDEN"]),
    "repeated section": (put("content", "sections", "array('news', 'news')", "content_id = 'cnt-1'"), ["DUPLICATE_SECTION"]),
    "prefix": (put("email_click", "reader_id", "concat('web:', reader_id)", "event_id = 'clk-1'"), ["NAMESPACED_READER_ID", "UNKNOWN_READER_ID"]),
    "unknown reader": (put("email_click", "reader_id", "'rdr-z'", "event_id = 'clk-1'"), ["UNKNOWN_READER_ID"]),
    "other ids": (put("community_action", "reader_id", "concat('x', reader_id)"), ["DISJOINT_READER_ID_SPACE"]),
    "span end": (put("subscription_span", "end_ts", "start_ts", "state = 'grace'"), ["SPAN_END_NOT_AFTER_START"]),
    "overlap": (put("subscription_span", "end_ts", "end_ts + INTERVAL 1 DAY", "state = 'payment_failed'"), ["OVERLAPPING_SPANS"]),
    "open twice": (put("subscription_span", "end_ts", "CAST(NULL AS TIMESTAMP)", "state = 'grace'"), ["MULTIPLE_OPEN_SPANS", "OVERLAPPING_SPANS"]),
    "before the floor": (put("email_open", "event_ts", "timestamp_seconds(1769921999)", "event_id = 'opn-1'"), ["EVENT_BEFORE_AVAILABILITY_FLOOR"]),
    "at the floor": (put("email_open", "event_ts", "timestamp_seconds(1769922000)", "event_id = 'opn-1'"), []),
    "no zone": (lambda t: {**t, "reader_event": t["reader_event"].withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))}, ["TIMESTAMP_NOT_TIMEZONE_AWARE"]),
    "text time": (put("email_click", "event_ts", "CAST(event_ts AS STRING)"), ["COLUMN_TYPE_MISMATCH"]),
    "integer seconds": (put("reader_event", "engagement_time_seconds", "CAST(engagement_time_seconds AS INT)"), ["COLUMN_TYPE_MISMATCH"]),
    "missing column": (lambda t: {**t, "content": t["content"].drop("published_ts")}, ["MISSING_REQUIRED_COLUMN"]),
    "extra column": (put("content", "headline", "'x'"), ["UNEXPECTED_COLUMN"]),
    **{f"column {c}": (put("reader_event", c, "'x'"), ["FORBIDDEN_COLUMN"]) for c in ("Scroll_Depth", "event_date", "local_date", "email_hash", "ip_address", "phone_no", "first_name", "birth_year", "postal_code")},
    "no reader": (lambda t: {k: x for k, x in t.items() if k != "reader"}, ["MISSING_REQUIRED_TABLE"]),
    "no content": (lambda t: {k: x for k, x in t.items() if k != "content"}, ["MISSING_REQUIRED_TABLE"]),
    "no clicks": (lambda t: {k: x for k, x in t.items() if k != "email_click"}, ["FILE_ABSENT_BUT_DECLARED_AVAILABLE"]),
    "two at once": (lambda t: twice("content")(put("reader_event", "channel", "'kiosk'")(t)), ["DUPLICATE_DEDUP_KEY", "ENUM_VALUE_OUT_OF_RANGE"]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_negative_controls(tables, name):
    broken, want = CASES[name]
    assert codes(broken(tables)) == want


def test_presence(spark, tables, delivery, tmp_path):
    assert codes(tables, manifest_with(email_open="not_deployed")) == ["FILE_PRESENT_BUT_DECLARED_ABSENT"]
    less = {k: x for k, x in tables.items() if k != "email_open"}
    assert codes(less, manifest_with(email_open="not_yet_launched")) == []
    copied = str(tmp_path / "d")
    shutil.copytree(delivery, copied)
    shutil.rmtree(f"{copied}/content.parquet")
    open(f"{copied}/content.parquet", "w").write("no parquet")
    assert validate.validate(spark, copied).codes == ("UNREADABLE_TABLE",)
    open(f"{copied}/manifest.json", "w").write("{}")
    assert validate.validate(spark, copied).exit_code == 2


def broken_manifest(change):
    raw = copy.deepcopy(mf.as_dict(demo.manifest()))
    change(raw)
    with pytest.raises(mf.ManifestError) as e:
        mf.parse(raw)
    return str(e.value)


def test_manifest():
    assert mf.parse(mf.as_dict(demo.manifest())) == demo.manifest()
    for key in mf.REQUIRED_KEYS:
        assert key in broken_manifest(lambda m, key=key: m.pop(key))
    assert "ANSWER-REQUIRED" in broken_manifest(lambda m: m["article_view"].update(definition_id="ANSWER-REQUIRED"))
    assert "IANA" in broken_manifest(lambda m: m.update(day_boundary_timezone="Mars/Base"))
    assert "Someday" in broken_manifest(lambda m: m["week_anchor"].update(weekday="Someday"))
    assert "repeats" in broken_manifest(lambda m: m["scored_population"].update(entitled_states=["active", "active"]))
    assert "names nothing" in broken_manifest(lambda m: m["article_view"].update(content_types=[]))
    assert "available_from" in broken_manifest(lambda m: m["optional_inputs"]["email_open"].update(available_from=None))
    assert "opaque" in broken_manifest(lambda m: m.update(population_exclusions=["a@b.c"]))
    assert mf.unanswered({"a": ["x", {"_note": "ANSWER-REQUIRED", "b": " ANSWER-REQUIRED "}]}) == ["a[1].b"]


def mapped():
    where = {"system": "warehouse", "relation": "events", "column": "id"}
    code = {"path": "adapter/events.sql", "sha256": "0" * 64}
    field = {"outcome": "rename", "source": where, "implementation": code, "rationale": "the column means the same thing there"}
    out = {"schema_version": 1, "contract": {"name": schema.NAME, "version": schema.VERSION}, "declarations": {k: {"owner_role": "Head of Editorial", "decision_ref": "decision-1"} for k in mapping.DECLARATIONS}, "tables": {}}
    for t in schema.TABLES:
        out["tables"][t.name] = {"fields": {n: copy.deepcopy(field) for n in t.names}} | ({} if t.required else {"availability": {"status": "available", "available_from": "2026-01-01"}})
    return out


def one(m):
    return m["tables"]["content"]["fields"]["content_id"]


MAPPING = {
    "unknown_schema_version": lambda m: m.update(schema_version=2),
    "contract_mismatch": lambda m: m["contract"].update(version="0.9"),
    "unknown_key": lambda m: m.update(extra=1),
    "missing_declaration": lambda m: m["declarations"].pop("week_anchor"),
    "unknown_declaration": lambda m: m["declarations"].update(other={"owner_role": "x", "decision_ref": "y"}),
    "personal_identifier": lambda m: m["declarations"]["week_anchor"].update(owner_role="jo@paper.org"),
    "missing_table": lambda m: m["tables"].pop("content"),
    "unknown_table": lambda m: m["tables"].update(other={}),
    "missing_field": lambda m: m["tables"]["content"]["fields"].pop("sections"),
    "unknown_field": lambda m: m["tables"]["content"]["fields"].update(other=one(m)),
    "invalid_outcome": lambda m: one(m).update(outcome="assume"),
    "rename_without_source": lambda m: one(m).pop("source"),
    "missing_implementation": lambda m: one(m).pop("implementation"),
    "missing_rationale": lambda m: one(m).update(rationale="short"),
    "placeholder_value": lambda m: one(m).update(rationale="TBD"),
    "derive_without_inputs": lambda m: one(m).update(outcome="derive", inputs=[]),
    "absent_in_required_table": lambda m: m["tables"]["content"]["fields"].update(content_id={"outcome": "declare_absent"}),
    "absent_in_available_table": lambda m: m["tables"]["email_open"]["fields"].update(list_id={"outcome": "declare_absent"}),
    "present_in_unavailable_table": lambda m: m["tables"]["email_open"].update(availability={"status": "not_deployed", "statement": "there is no such product in this house"}),
    "missing_absence_statement": lambda m: m["tables"]["email_open"].update(availability={"status": "not_deployed"}),
    "available_without_floor": lambda m: m["tables"]["email_open"].update(availability={"status": "available"}),
    "unavailable_with_floor": lambda m: m["tables"]["email_open"].update(availability={"status": "not_deployed", "available_from": "2026-01-01", "statement": "there is no such product in this house"}),
    "invalid_availability_status": lambda m: m["tables"]["email_open"].update(availability={"status": "hard"}),
    "gap_without_owner": lambda m: m["tables"]["content"]["fields"].update(content_id={"outcome": "gap", "blocker": "the system that knew it was shut down"}),
    "gap_without_blocker": lambda m: m["tables"]["content"]["fields"].update(content_id={"outcome": "gap", "owner": {"role": "Archivist", "tracking_ref": "T-1"}, "blocker": "lost"}),
    "implementation_path_escapes": lambda m: one(m)["implementation"].update(path="../x.sql"),
    "bad_type": lambda m: one(m)["implementation"].update(sha256="zz"),
}


@pytest.mark.parametrize("code", list(MAPPING))
def test_mapping(code):
    m = mapped()
    MAPPING[code](m)
    assert code in {f.code for f in mapping.lint(m).errors}


def test_mapping_bundle(tmp_path):
    good = mapping.lint(mapped())
    assert good.errors == () and {f.code for f in good.findings} == {"no_adapter_bundle", "shared_implementation"}
    assert good.passed() and not good.passed(strict=True)
    assert {f.code for f in mapping.lint(mapped(), str(tmp_path)).errors} == {"implementation_file_missing"}
    (tmp_path / "adapter").mkdir()
    (tmp_path / "adapter/events.sql").write_text("SELECT 1")
    assert {f.code for f in mapping.lint(mapped(), str(tmp_path)).errors} == {"implementation_hash_mismatch"}
    (tmp_path / mapping.FILENAME).write_text('{"a": 1, "a": 2}')
    with pytest.raises(mapping.MappingError, match="twice"):
        mapping.load(str(tmp_path))


def test_oracle(spark, delivery, tables, tmp_path):
    shutil.copytree(delivery, tmp_path / "base")

    def variant(name, table, change):
        shutil.copytree(delivery, tmp_path / name)
        change(tables)[table].coalesce(1).write.mode("overwrite").parquet(str(tmp_path / name / f"{table}.parquet"))
        changed = oracle.changed_files(str(tmp_path / "base"), str(tmp_path / name))
        return {"id": name, "path": name, "expected_exit": 1, "changed_files": changed, "mutation": f"one value of {table} was replaced"}

    cases = [
        variant("channel", "reader_event", CASES["channel"][0]) | {"required_codes": ["ENUM_VALUE_OUT_OF_RANGE"], "forbidden_codes": ["NULL_IN_NON_NULLABLE"]},
        variant("dup", "content", CASES["twice content"][0]) | {"required_codes": ["DUPLICATE_DEDUP_KEY"]},
        variant("span", "subscription_span", CASES["span end"][0]) | {"required_codes": ["OVERLAPPING_SPANS"]},
    ]
    raw = {"baseline": {"path": "base"}, "negative_cases": cases}
    (tmp_path / oracle.FILENAME).write_text(json.dumps(raw))
    out = {c.id: c for c in oracle.run(spark, oracle.load(str(tmp_path)), str(tmp_path))}
    assert [c.passed for c in out.values()] == [True, True, True, False]
    assert "weren't raised" in out["span"].problems[0]
    assert not oracle.run(spark, {**raw, "negative_cases": cases[:1]}, str(tmp_path))[1].passed


def test_schema_is_consistent():
    for t in schema.TABLES:
        assert set(t.key) <= set(t.names) and all(not f.nullable for f in t.fields if f.name in t.key)
        assert not [n for n in t.names if any(token in n for token in schema.FORBIDDEN)]
    assert set(v.ACTION_COLUMNS) == set(v.ACTIONS) and len(schema.REQUIRED) == 4
