"""The contract validator: findings for each table of a delivery, none of which hides another.

A table is checked in this order: columns, types, values, key, conditional rules, reader ids, sections, spans, and the
availability floor. Counts of all columns come from one aggregation; ids, spans and keys take one shuffle each.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, time
from zoneinfo import ZoneInfo

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from lectern.contract import manifest as mf
from lectern.contract import schema

from lectern.sources.delivery import exists

OK, FINDINGS, UNTRUSTWORTHY = 0, 1, 2
SEPARATOR = ":"


@dataclass(frozen=True)
class Finding:
    table: str
    code: str
    column: str | None = None
    rows: int | None = None
    message: str = ""

    def __str__(self) -> str:
        where = " ".join([self.code, self.table, *([f"column={self.column}"] * bool(self.column)), *([f"rows={self.rows}"] * (self.rows is not None))])
        return f"{where}: {self.message}"


@dataclass(frozen=True)
class TableReport:
    table: str
    present: bool
    rows: int | None
    findings: tuple[Finding, ...] = ()


@dataclass(frozen=True)
class Report:
    directory: str
    version: str
    manifest_error: str | None = None
    tables: tuple[TableReport, ...] = field(default_factory=tuple)
    contract: str = schema.NAME

    @property
    def findings(self) -> tuple[Finding, ...]:
        return tuple(f for t in self.tables for f in t.findings)

    @property
    def codes(self) -> tuple[str, ...]:
        return tuple(f.code for f in self.findings)

    @property
    def exit_code(self) -> int:
        return UNTRUSTWORTHY if self.manifest_error else FINDINGS if self.findings else OK

    def render(self) -> str:
        head = [f"contract: {self.contract} {self.version}", f"directory: {self.directory}", ""]
        if self.manifest_error:
            return "\n".join([*head, f"MANIFEST {self.manifest_error}", "", "no table was checked"])
        lines = []
        for t in self.tables:
            lines.append(f"{'FAIL' if t.findings else 'PASS'}  {t.table:20} {f'{t.rows} rows' if t.present else 'absent'}")
            lines += [f"        {f}" for f in t.findings]
        return "\n".join([*head, *lines, "", f"FAIL: {len(self.findings)} finding(s)" if self.findings else "PASS: no findings"])

    def to_json(self) -> str:
        tables = [{"table": t.table, "present": t.present, "rows": t.rows, "passed": not t.findings, "findings": [{"code": f.code, "column": f.column, "rows": f.rows, "message": f.message} for f in t.findings]} for t in self.tables]
        return json.dumps({"contract_name": self.contract, "contract_version": self.version, "directory": self.directory, "passed": self.exit_code == OK, "manifest_error": self.manifest_error, "tables": tables}, indent=2, sort_keys=True)


def check_columns(df: DataFrame, t: schema.Table) -> list[Finding]:
    out = [Finding(t.name, "MISSING_REQUIRED_COLUMN", n, None, "the contract requires it") for n in t.names if n not in df.columns]
    for n in df.columns:
        if n not in t.names:
            why = next((w for token, w in schema.FORBIDDEN.items() if token in n.lower()), None)
            out.append(Finding(t.name, "FORBIDDEN_COLUMN" if why else "UNEXPECTED_COLUMN", n, None, why or "the contract doesn't know it"))
    return out


def check_types(df: DataFrame, t: schema.Table) -> tuple[list[Finding], set[str]]:
    """Findings, and the columns whose type is right."""
    out, right = [], set()
    for f in t.fields:
        if f.name not in df.columns:
            continue
        actual = df.schema[f.name].dataType
        if schema.naive_instant(f.type, actual):
            out.append(Finding(t.name, "TIMESTAMP_NOT_TIMEZONE_AWARE", f.name, None, "the instants carry no zone; attach the one the source stored them in"))
        elif not schema.compatible(f.type, actual):
            out.append(Finding(t.name, "COLUMN_TYPE_MISMATCH", f.name, None, f"{actual.simpleString()} where the contract has {f.type.simpleString()}; it is not cast"))
        else:
            right.add(f.name)
    return out, right


def _empty(c: Column, f: schema.Field) -> Column:
    return c.isNull() | (F.size(c) == 0) if isinstance(f.type, ArrayType) else c.isNull()


def counters(t: schema.Table, right: set[str]) -> dict[str, Column]:
    """All that one pass over the rows can count, by name."""
    fields, out = {f.name: f for f in t.fields}, {}
    for f in t.fields:
        c = F.col(f.name)
        if f.name in right:
            if not f.nullable:
                out[f"null|{f.name}"] = F.count_if(c.isNull())
            if f.allowed:
                odd = c.isNotNull() & ~c.isin(*f.allowed)
                out[f"enum|{f.name}"] = F.count_if(odd)
                # one of them, as there can be any number
                out[f"seen|{f.name}"] = F.min(F.when(odd, F.substring(c, 1, 40)))
            if f.non_negative:
                out[f"negative|{f.name}"] = F.count_if(c < 0)
    for r in t.rules:
        if {r.when, r.then} <= right:
            empty = _empty(F.col(r.then), fields[r.then])
            out[f"rule|{r.id}"] = F.count_if(F.coalesce(F.col(r.when).isin(*r.values), F.lit(False)) & (empty if r.filled else ~empty))
    if t.name == "content" and "sections" in right:
        out["repeats"] = F.count_if(F.size(F.array_distinct("sections")) < F.size("sections"))
    if t.name == "subscription_span" and {"start_ts", "end_ts"} <= right:
        out["inverted"] = F.count_if(F.col("end_ts") <= F.col("start_ts"))
    id_column = t.reader_column or ("reader_id" if t.name == "reader" else None)
    if id_column in right:
        out["namespaced"] = F.count_if(F.col(id_column).contains(SEPARATOR))
    return out


def check_rows(df: DataFrame, t: schema.Table, right: set[str]) -> tuple[int, list[Finding], dict]:
    """Number of rows, findings of the counters for values and rules, and the counts that later checks tell of."""
    row = df.agg(F.count(F.lit(1)).alias("n"), *(c.alias(k) for k, c in counters(t, right).items())).first().asDict()
    out = []
    for f in t.fields:
        for key, code, text in (("null", "NULL_IN_NON_NULLABLE", "has nulls"), ("enum", "ENUM_VALUE_OUT_OF_RANGE", f"allowed are {list(f.allowed or ())}; found {row.get(f'seen|{f.name}')!r} among others"), ("negative", "NEGATIVE_MEASURE", "is negative")):
            if row.get(f"{key}|{f.name}"):
                out.append(Finding(t.name, code, f.name, row[f"{key}|{f.name}"], text))
    return row["n"], out, row


def check_key(df: DataFrame, t: schema.Table, right: set[str]) -> list[Finding]:
    if not set(t.key) <= right:
        return []
    keys, rows = df.groupBy(*t.key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)), F.sum("n")).first()
    return [Finding(t.name, "DUPLICATE_DEDUP_KEY", ", ".join(t.key), rows, f"{keys} key values are on {rows} rows")] if keys else []


def check_rules(t: schema.Table, row: dict) -> list[Finding]:
    return [Finding(t.name, "CONDITIONAL_FIELD_REQUIRED" if r.filled else "CONDITIONAL_FIELD_FORBIDDEN", r.then, row[f"rule|{r.id}"], r.id) for r in t.rules if row.get(f"rule|{r.id}")]


def check_reader_ids(df: DataFrame, t: schema.Table, right: set[str], row: dict, registry: DataFrame | None) -> list[Finding]:
    out = []
    if t.name == "reader" and "id_grain" in right:
        odd = row["enum|id_grain"]
        kinds = df.where(F.col("id_grain").isNotNull()).select("id_grain").distinct().limit(2).count() if odd else 1
        if kinds > 1:
            out.append(Finding(t.name, "MIXED_READER_ID_GRAIN", "id_grain", odd, "one column of ids holds several grains"))
    id_column = t.reader_column or ("reader_id" if t.name == "reader" else None)
    if id_column not in right:
        return out
    if row["namespaced"]:
        out.append(Finding(t.name, "NAMESPACED_READER_ID", id_column, row["namespaced"], f"ids with {SEPARATOR!r} announce a grain of their own"))
    if registry is None or t.name == "reader":
        return out
    ids = df.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("reader_id"))
    orphans = ids.join(registry, "reader_id", "left_anti").count()
    if orphans:
        every = orphans == ids.count()
        out.append(Finding(t.name, "DISJOINT_READER_ID_SPACE" if every else "UNKNOWN_READER_ID", id_column, orphans, "no id is registered" if every else "ids that aren't registered"))
    return out


def span_order(df: DataFrame) -> DataFrame:
    """Spans with the end of the one before: `overlaps` where that is open or later than the start."""
    own = Window.partitionBy("reader_id").orderBy("start_ts")
    rows = df.where(F.col("reader_id").isNotNull() & F.col("start_ts").isNotNull())
    rows = rows.withColumn("_at", F.row_number().over(own)).withColumn("_end", F.lag("end_ts").over(own))
    return rows.withColumn("overlaps", (F.col("_at") > 1) & (F.col("_end").isNull() | (F.col("_end") > F.col("start_ts"))))


def check_spans(df: DataFrame, t: schema.Table, right: set[str], row: dict) -> list[Finding]:
    if t.name != "subscription_span" or not {"reader_id", "start_ts", "end_ts"} <= right:
        return []
    out = [Finding(t.name, "SPAN_END_NOT_AFTER_START", "end_ts", row["inverted"], "spans end before they start")] if row["inverted"] else []
    ordered = span_order(df)
    overlaps = ordered.agg(F.count_if("overlaps")).first()[0]
    opened = ordered.where("end_ts IS NULL").groupBy("reader_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.sum("n")).first()[0]
    if overlaps:
        out.append(Finding(t.name, "OVERLAPPING_SPANS", "start_ts, end_ts", overlaps, "a reader has two states at once"))
    if opened:
        out.append(Finding(t.name, "MULTIPLE_OPEN_SPANS", "end_ts", opened, "a reader has several open spans"))
    return out


def check_floor(df: DataFrame, t: schema.Table, right: set[str], m: mf.Manifest) -> list[Finding]:
    if t.required or t.time_column not in right or m.optional_inputs[t.name].available_from is None:
        return []
    floor = datetime.combine(m.optional_inputs[t.name].available_from, time.min, tzinfo=ZoneInfo(m.timezone))
    early = df.where(F.unix_micros(t.time_column) < F.lit(int(floor.timestamp() * 1_000_000))).count()
    return [Finding(t.name, "EVENT_BEFORE_AVAILABILITY_FLOOR", t.time_column, early, f"before {floor.isoformat()}")] if early else []


def validate_table(df: DataFrame, t: schema.Table, m: mf.Manifest, registry: DataFrame | None) -> TableReport:
    findings = check_columns(df, t)
    typed, right = check_types(df, t)
    n, values, row = check_rows(df, t, right)
    findings += typed + values + check_key(df, t, right) + check_rules(t, row) + check_reader_ids(df, t, right, row, registry)
    if row.get("repeats"):
        findings.append(Finding(t.name, "DUPLICATE_SECTION", "sections", row["repeats"], "a section is named twice"))
    findings += check_spans(df, t, right, row) + check_floor(df, t, right, m)
    rows = {"MISSING_REQUIRED_COLUMN", "UNEXPECTED_COLUMN", "FORBIDDEN_COLUMN", "TIMESTAMP_NOT_TIMEZONE_AWARE", "COLUMN_TYPE_MISMATCH"}
    return TableReport(t.name, True, n, tuple(Finding(f.table, f.code, f.column, n if f.code in rows else f.rows, f.message) for f in findings))


def registry_of(tables: dict[str, DataFrame]) -> DataFrame | None:
    reader = tables.get("reader")
    if reader is None or "reader_id" not in reader.columns or not isinstance(reader.schema["reader_id"].dataType, StringType):
        return None
    return reader.where(F.col("reader_id").isNotNull()).select("reader_id").distinct()


def validate_tables(tables: dict[str, DataFrame], m: mf.Manifest, unreadable: dict[str, str] | None = None) -> tuple[TableReport, ...]:
    out, registry = [], registry_of(tables)
    for t in schema.TABLES:
        declared = m.available(t.name)
        if t.name in (unreadable or {}) and declared:
            out.append(TableReport(t.name, True, None, (Finding(t.name, "UNREADABLE_TABLE", message=unreadable[t.name]),)))
        elif t.name not in tables and t.name not in (unreadable or {}):
            code = "MISSING_REQUIRED_TABLE" if t.required else "FILE_ABSENT_BUT_DECLARED_AVAILABLE" if declared else None
            out.append(TableReport(t.name, False, None, (Finding(t.name, code, message="the file is not there"),) if code else ()))
        elif not declared:
            out.append(TableReport(t.name, True, None, (Finding(t.name, "FILE_PRESENT_BUT_DECLARED_ABSENT", message=f"declared {m.optional_inputs[t.name].status}"),)))
        else:
            out.append(validate_table(tables[t.name], t, m, registry))
    return tuple(out)


def validate(spark: SparkSession, directory: str) -> Report:
    """The verdict on a delivery; without a valid manifest nothing is checked."""
    try:
        m = mf.load(spark, directory)
    except mf.ManifestError as e:
        return Report(directory, schema.VERSION, str(e))
    tables, unreadable = {}, {}
    for t in schema.TABLES:
        path = f"{directory}/{t.name}.parquet"
        if exists(spark, path):
            try:
                tables[t.name] = spark.read.parquet(path)
            except (PySparkException, Py4JJavaError) as e:
                unreadable[t.name] = (str(e).splitlines() or ['unreadable'])[0][:200]
    return Report(directory, m.contract_version, None, validate_tables(tables, m, unreadable), m.contract_name)


__all__ = ["Finding", "Report", "TableReport", "validate", "validate_tables"]
