"""The validator put to the test: a delivery that conforms, and broken ones that have to fail as predicted.

Each negative case declares its exit code, the finding codes it has to and must not raise, and which files differ from
the baseline; a case that fails for another reason, or breaks more than it says, doesn't pass.
"""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import dataclass

from pyspark.sql import SparkSession

from lectern.contract.validate import FINDINGS, OK, UNTRUSTWORTHY, Report, validate

FILENAME, LEAST_CASES, NOTE = "validation-cases.json", 3, 20


class OracleError(ValueError):
    """The case set can't be used."""


@dataclass(frozen=True)
class Case:
    id: str
    problems: tuple[str, ...]
    exit_code: int | None = None
    codes: tuple[str, ...] = ()

    @property
    def passed(self) -> bool:
        return not self.problems


def digests(root: str) -> dict[str, str]:
    out = {}
    for folder, _, names in os.walk(root):
        for n in names:
            path = os.path.join(folder, n)
            with open(path, "rb") as f:
                out[os.path.relpath(path, root).replace(os.sep, "/")] = hashlib.sha256(f.read()).hexdigest()
    return out


def changed_files(baseline: str, variant: str) -> list[str]:
    a, b = digests(baseline), digests(variant)
    return sorted(n for n in a.keys() | b.keys() if a.get(n) != b.get(n))


def load(path: str) -> dict:
    path = os.path.join(path, FILENAME) if os.path.isdir(path) else path
    try:
        with open(path, encoding="utf-8") as f:
            raw = json.load(f)
    except (OSError, UnicodeDecodeError, json.JSONDecodeError) as e:
        raise OracleError(f"{path}: {e}") from e
    if not isinstance(raw, dict) or not isinstance(raw.get("negative_cases"), list) or "path" not in (raw.get("baseline") or {}):
        raise OracleError(f"{path} needs a baseline with a path, and negative_cases")
    return raw


def _verdict(spark: SparkSession, directory: str) -> tuple[int, tuple[str, ...], str]:
    if not os.path.isdir(directory):
        return UNTRUSTWORTHY, (), f"no directory {directory}"
    report: Report = validate(spark, directory)
    return report.exit_code, report.codes + ("manifest_error",) * bool(report.manifest_error), report.render()


def _negative(spark: SparkSession, case: object, name: str, root: str, baseline: str) -> Case:
    if not isinstance(case, dict):
        return Case(name, ("it is no object",))
    name = str(case.get("id") or name)
    if missing := [k for k in ("path", "expected_exit", "changed_files", "mutation") if k not in case]:
        return Case(name, (f"it doesn't declare {missing}",))
    directory, wanted = os.path.join(root, case["path"]), int(case["expected_exit"])
    code, codes, text = _verdict(spark, directory)
    required, changed = case.get("required_codes", []), changed_files(baseline, directory) if os.path.isdir(directory) else []
    problems = [
        (wanted == OK, "a case that the validator accepts shows nothing"),
        (code != wanted, f"exit {code} where {wanted} is declared"),
        (wanted == FINDINGS and not required, "no code is predicted"),
        (bool(set(required) - set(codes)), f"{sorted(set(required) - set(codes))} weren't raised, but {sorted(set(codes))}"),
        (bool(set(case.get("forbidden_codes", [])) & set(codes)), "a forbidden code was raised"),
        (any(s not in text for s in case.get("required_message_contains", [])), "the message lacks a declared text"),
        (changed != sorted(case["changed_files"]), f"{changed} differ, declared are {sorted(case['changed_files'])}"),
        (not changed, "nothing differs from the baseline"),
        (len(str(case["mutation"]).strip()) < NOTE, "what was broken isn't said"),
    ]
    return Case(name, tuple(why for bad, why in problems if bad), code, codes)


def run(spark: SparkSession, cases: dict, root: str, least: int = LEAST_CASES) -> list[Case]:
    baseline = os.path.join(root, cases["baseline"]["path"])
    code, codes, text = _verdict(spark, baseline)
    wanted = int(cases["baseline"].get("expected_exit", OK))
    out = [Case("baseline", () if code == wanted else (f"exit {code} where {wanted} is declared:\n{text}",), code, codes)]
    if len(cases["negative_cases"]) < least:
        out.append(Case("case count", (f"{len(cases['negative_cases'])} negative cases; {least} are needed",)))
    return out + [_negative(spark, c, f"negative_cases[{n}]", root, baseline) for n, c in enumerate(cases["negative_cases"])]
