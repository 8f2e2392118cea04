"""Declarative quality rules, compiled to Columns.

A rule looks only at the event, never at the clock or a table, so a replay
reaches the same verdicts. Null and missing values pass every check but
``not_null``. ``register_check`` adds a kind of check.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from decimal import Decimal, InvalidOperation
from importlib.util import find_spec
from pathlib import Path
from typing import Any

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.functions import built_once
from changefeed.functions.text import python_repr
from changefeed.functions.times import iso_offset, parse_iso_date, parse_iso_timestamp
from changefeed.schemas import ENTITY_TYPE_PATTERN, VIOLATION

SEVERITIES = ("reject", "warn")
_NAME = re.compile(r"[a-z][a-z0-9_]*\Z")
_ENTITY = re.compile(ENTITY_TYPE_PATTERN)
_PLAIN_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)$"
# Characters that decimal(38,18) holds wherever the point is.
_SHORT = 18
_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
ORDER_RULES = Path(__file__).resolve().parent.parent / "config" / "order_rules.yaml"


class RulesError(ValueError):
    """The rule set cannot be used; the message names every problem."""


@dataclass(frozen=True)
class Value:
    """One payload member as the checks see it: its text, and more if need be."""

    text: Column
    variant: Column

    @property
    def kind(self) -> Column:
        return F.schema_of_variant(self.variant)

    @property
    def is_text(self) -> Column:
        """The type is looked up only if the text could also be that of another one."""
        other = self.text.rlike(r"^([-0-9\[{]|true$|false$)")
        return F.when(other, self.kind == "STRING").otherwise(F.lit(True))

    @property
    def is_text_or_integer(self) -> Column:
        digits = self.text.rlike(r"^-?\d+$")
        return F.when(digits, ~self.kind.rlike("^(DOUBLE|FLOAT)")).otherwise(self.is_text)

    @property
    def shown(self) -> Column:
        """The value as messages quote it."""
        return (
            F.when(self.kind == "STRING", python_repr(self.text))
            .when(self.kind == "BOOLEAN", F.initcap(self.text))
            .otherwise(self.text)
        )


@dataclass(frozen=True)
class Event:
    """The envelope columns a check may read."""

    entity_key: Column
    captured_at: Column


# What can be wrong, in order: a condition and the message it gives.
Findings = list[tuple[Column, Column]]
Check = Callable[[Value, Event, dict[str, Any]], Findings]


@dataclass(frozen=True)
class CheckKind:
    build: Check
    options: tuple[str, ...] = ()
    validate: Callable[[dict[str, Any]], str | None] = field(default=lambda _: None)


def _value_message(value: Value, *rest: Column | str) -> Column:
    parts = [F.lit(part) if isinstance(part, str) else part for part in rest]
    return F.concat(F.lit("value "), value.shown, *parts)


def _is_absent(value: Value) -> Column:
    return value.text.isNull()


def _not_null(value: Value, _event: Event, _options: dict[str, Any]) -> Findings:
    absent = _is_absent(value)
    return [
        (absent & value.variant.isNull(), F.lit("field is missing")),
        (absent, F.lit("value is null")),
    ]


def _against(number: Column, bound: Decimal) -> Column:
    """-1, 0 or 1 as a plain decimal text lies below, at or above the bound, of any
    length; null for other texts."""
    digits = format(abs(bound), "f")
    whole, _, part = digits.partition(".")
    bound_whole, bound_part = F.lit(whole.lstrip("0")), F.lit(part.rstrip("0"))
    bound_sign = 0 if not bound else (-1 if bound < 0 else 1)
    shape = r"^([+-]?)0*(\d*)\.?(\d*?)0*$"
    # Without a point the zeros at the end belong to the whole part.
    text_whole = F.when(
        F.contains(number, F.lit(".")), F.regexp_extract(number, shape, 2)
    ).otherwise(F.regexp_extract(number, r"^[+-]?0*(\d*)$", 1))
    text_part = F.when(F.contains(number, F.lit(".")), F.regexp_extract(number, shape, 3)).otherwise("")
    zero = (text_whole == "") & (text_part == "")
    sign = F.when(zero, 0).when(number.startswith("-"), -1).otherwise(1)

    def order(a: Column, b: Column) -> Column:
        return F.when(a < b, -1).when(a > b, 1).otherwise(0)

    by_length = order(F.length(text_whole), F.length(bound_whole))
    by_whole, by_part = order(text_whole, bound_whole), order(text_part, bound_part)
    size = F.when(by_length != 0, by_length).when(by_whole != 0, by_whole).otherwise(by_part)
    found = F.when(sign != bound_sign, order(sign, F.lit(bound_sign))).otherwise(size * sign)
    return F.when(number.rlike(_PLAIN_NUMBER), found)


def _holds(bound: Decimal) -> bool:
    """Whether decimal(38,18) holds the bound to its last digit."""
    whole, _, part = format(abs(bound), "f").partition(".")
    return len(whole.lstrip("0")) <= 20 and len(part.rstrip("0")) <= 18


def _bound(beyond: Callable[[Column, Column], Column], what: str) -> Check:
    def check(value: Value, _event: Event, options: dict[str, Any]) -> Findings:
        bound = Decimal(str(options["value"]))
        number = F.trim(value.text)
        exact = number.try_cast("decimal(38,18)")
        exact_bound = F.lit(format(bound, "f")).try_cast("decimal(38,18)")
        # Nearly all numbers are short, and these decimals hold them to the last digit: comparing
        # them takes one look at the text, comparing digits a score of them.
        short = (F.length(number) <= _SHORT) & number.rlike(_PLAIN_NUMBER) & F.lit(_holds(bound))
        # Digits decide; numbers with an exponent go through decimals, or doubles where
        # 38 digits do not hold them.
        outside = F.coalesce(
            F.when(short, beyond(exact, exact_bound)),
            beyond(_against(number, bound), F.lit(0)),
            F.when(exact != exact_bound, beyond(exact, exact_bound)),
            beyond(number.try_cast("double"), F.lit(float(bound))),
        )
        return [
            (~value.text.rlike(_NUMBER), _value_message(value, " is not numeric")),
            (outside, F.concat(F.lit("value "), number, F.lit(f" is {what} {options['value']}"))),
        ]

    return check


def _allowed_values(value: Value, _event: Event, options: dict[str, Any]) -> Findings:
    allowed = options["values"]
    texts = [item for item in allowed if isinstance(item, str)]
    flags = [str(item).lower() for item in allowed if isinstance(item, bool)]
    numbers = [str(v) for v in allowed if isinstance(v, int) and not isinstance(v, bool)]
    match = F.lit(False)
    if texts:
        match = match | (value.text.isin(*texts) & value.is_text)
    if flags:
        match = match | (value.text.isin(*flags) & (value.kind == "BOOLEAN"))
    if numbers:
        match = match | (value.text.isin(*numbers) & value.kind.rlike(r"^(BIGINT|DECIMAL)"))
    return [(~match, _value_message(value, f" is not one of {list(allowed)}"))]


def _pattern(value: Value, _event: Event, options: dict[str, Any]) -> Findings:
    # '^' and '$' would let a trailing line break pass.
    full = value.text.rlike(rf"\A(?:{options['regex']})\z")
    return [
        (~value.is_text, _value_message(value, " is not a string")),
        (~full, _value_message(value, f" does not match {options['regex']!r}")),
    ]


def _max_length(value: Value, _event: Event, options: dict[str, Any]) -> Findings:
    length = F.char_length(value.text)
    exceeds = F.lit(f" exceeds {options['value']}")
    return [
        (~value.is_text, _value_message(value, " is not a string")),
        (length > options["value"], F.concat(F.lit("length "), length.cast("string"), exceeds)),
    ]


def _matches_entity_key(value: Value, event: Event, _options: dict[str, Any]) -> Findings:
    same = (value.text == event.entity_key) & value.is_text_or_integer
    shown_key = python_repr(event.entity_key)
    return [(~same, _value_message(value, " does not match entity_key ", shown_key))]


def _not_after_captured_at(value: Value, event: Event, _options: dict[str, Any]) -> Findings:
    moment, day = parse_iso_timestamp(value.text), parse_iso_date(value.text)
    # A plain day is not read as a moment, too.
    unreadable = (day.isNull() & moment.isNull()) | ~value.is_text
    later = F.coalesce(day > event.captured_at.cast("date"), moment > event.captured_at)
    return [
        (unreadable, _value_message(value, " is not an ISO-8601 date or timestamp")),
        (
            later,
            F.concat(
                value.text,
                F.lit(" is later than the capture time "),
                iso_offset(event.captured_at),
            ),
        ),
    ]


def _finite_number(options: dict[str, Any]) -> str | None:
    value = options["value"]
    try:
        ok = not isinstance(value, bool) and Decimal(str(value)).is_finite()
    except InvalidOperation:
        ok = False
    return None if ok else "value must be a number"


def _length_bound(options: dict[str, Any]) -> str | None:
    value = options["value"]
    ok = isinstance(value, int) and not isinstance(value, bool) and value >= 0
    return None if ok else "value must be a whole number of at least 0"


def _value_list(options: dict[str, Any]) -> str | None:
    values = options["values"]
    ok = isinstance(values, list) and values and all(isinstance(v, str | int) for v in values)
    return None if ok else "values must be a non-empty list of strings, integers or booleans"


def _compiles(options: dict[str, Any]) -> str | None:
    """The engine's own compiler decides where a session is there to ask."""
    try:
        re.compile(options["regex"])
    except (re.error, TypeError) as exc:
        return f"invalid regular expression: {exc}"
    session = SparkSession.getActiveSession()
    if session is not None:
        try:
            session._jvm.java.util.regex.Pattern.compile(options["regex"])
        except (Py4JError, PySparkException) as exc:
            return f"invalid regular expression: {str(exc).splitlines()[0]}"
    return None


_CHECKS: dict[str, CheckKind] = {
    "not_null": CheckKind(_not_null),
    "min": CheckKind(_bound(lambda a, b: a < b, "below the minimum"), ("value",), _finite_number),
    "max": CheckKind(_bound(lambda a, b: a > b, "above the maximum"), ("value",), _finite_number),
    "allowed_values": CheckKind(_allowed_values, ("values",), _value_list),
    "pattern": CheckKind(_pattern, ("regex",), _compiles),
    "max_length": CheckKind(_max_length, ("value",), _length_bound),
    "matches_entity_key": CheckKind(_matches_entity_key),
    "not_after_captured_at": CheckKind(_not_after_captured_at),
}
_PASSES_ABSENT = set(_CHECKS) - {"not_null"}


def register_check(
    name: str,
    build: Check,
    *,
    options: tuple[str, ...] = (),
    validate: Callable[[dict[str, Any]], str | None] = lambda _: None,
) -> None:
    """Add a kind of check: ``build`` returns conditions with their messages.

    The first condition that is true gives the message. Absent values pass.
    """
    if name in _CHECKS:
        raise RulesError(f"check {name!r} exists")
    _CHECKS[name] = CheckKind(build, options, validate)
    _PASSES_ABSENT.add(name)


@dataclass(frozen=True)
class Rule:
    name: str
    description: str
    field: str
    severity: str
    check: str
    options: tuple[tuple[str, Any], ...] = ()

    def violations(self, value: Value, event: Event) -> Column:
        """An array with the violation, or an empty one."""
        findings = _CHECKS[self.check].build(value, event, dict(self.options))
        broken = F.lit(False)
        for bad, _ in findings:
            broken = broken | F.coalesce(bad, F.lit(False))
        if self.check in _PASSES_ABSENT:
            broken = ~_is_absent(value) & broken

        def describe(_: Column) -> Column:
            message = F.when(*findings[0])
            for bad, text in findings[1:]:
                message = message.when(bad, text)
            return F.struct(
                F.lit(self.name).alias("rule"),
                F.lit(self.field).alias("field"),
                F.lit(self.severity).alias("severity"),
                message.alias("message"),
            )

        # Only the condition is generated code; the message is for the few that fail.
        found = F.transform(F.array(value.text), describe).cast(VIOLATION)
        return F.when(broken, found).otherwise(F.array().cast(VIOLATION))


@dataclass(frozen=True)
class RuleSet:
    entities: dict[str, tuple[Rule, ...]]

    @property
    def fingerprint(self) -> str:
        """Changes with what the rules mean, not with how the file is written."""
        content = {
            entity: [
                [rule.name, rule.description, rule.field, rule.severity, rule.check, rule.options]
                for rule in rules
            ]
            for entity, rules in self.entities.items()
        }
        text = json.dumps({"version": 1, "entities": content}, sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()[:16]

    def evaluate(self, events: DataFrame, into: str = "violations") -> DataFrame:
        """Add what every rule of the event's entity type found, in rule order.

        ``events`` has ``payload_variant``, ``entity_type``, ``entity_key`` and
        ``captured_at``. Each payload member is read once for all its rules.
        """
        fields = sorted({rule.field for rules in self.entities.values() for rule in rules})
        none = F.array().cast(VIOLATION)
        if not fields:
            return events.withColumn(into, none)
        wanted = ", ".join(f"`{field}`: string" for field in fields)
        members = events.withColumn(
            "_f", F.try_variant_get("payload_variant", "$", f"struct<{wanted}>")
        )
        kept = [F.col(name) for name in events.columns if name != into]
        found = built_once(("rules", self.fingerprint), self._violations)
        return members.select(*kept, found.alias(into))

    def _violations(self) -> Column:
        event = Event(F.col("entity_key"), F.col("captured_at"))
        none = F.array().cast(VIOLATION)

        def value(field: str) -> Value:
            variant = F.try_variant_get("payload_variant", _path(field), "variant")
            return Value(F.col(f"_f.`{field}`"), variant)

        found = none
        for entity, rules in self.entities.items():
            hits = F.concat(none, *[rule.violations(value(rule.field), event) for rule in rules])
            found = F.when(F.col("entity_type") == entity, hits).otherwise(found)
        return found


def _path(field: str) -> str:
    return "$." + field if re.fullmatch(r"\w+", field) else f'$["{field}"]'


def with_severity(violations: Column, severity: str) -> Column:
    return F.filter(violations, lambda item: item["severity"] == severity)


def _parse_rule(where: str, raw: Any, problems: list[str]) -> Rule | None:
    if not isinstance(raw, dict):
        problems.append(f"{where}: a rule is a mapping")
        return None
    found: list[str] = []
    for name in ("name", "description", "field"):
        if not isinstance(raw.get(name), str) or not raw[name]:
            found.append(f"{where}.{name}: a non-empty string is required")
    if isinstance(raw.get("name"), str) and raw["name"] and not _NAME.match(raw["name"]):
        found.append(f"{where}.name: must match {_NAME.pattern}")
    if isinstance(raw.get("field"), str) and set(raw["field"]) & set('"`\\'):
        found.append(f"{where}.field: quotes and backslashes are not supported")
    if raw.get("severity") not in SEVERITIES:
        found.append(f"{where}.severity: must be one of {list(SEVERITIES)}")
    kind = _CHECKS.get(raw.get("check")) if isinstance(raw.get("check"), str) else None
    if kind is None:
        found.append(f"{where}.check: must be one of {sorted(_CHECKS)}")
    else:
        allowed = {"name", "description", "field", "severity", "check", *kind.options}
        found += [f"{where}.{name}: unknown option" for name in sorted(set(raw) - allowed, key=str)]
        absent = [name for name in kind.options if name not in raw]
        found += [f"{where}.{name}: required" for name in absent]
        if not absent and (problem := kind.validate(raw)):
            found.append(f"{where}: {problem}")
    if found or kind is None:
        problems.extend(found)
        return None
    options = tuple((name, raw[name]) for name in kind.options)
    return Rule(
        raw["name"], raw["description"], raw["field"], raw["severity"], raw["check"], options
    )


def parse_rules(raw: Any) -> RuleSet:
    problems: list[str] = []
    entities: dict[str, tuple[Rule, ...]] = {}
    if not isinstance(raw, dict):
        raise RulesError("the rules are a mapping with 'version' and 'entities'")
    problems += [f"{name}: unknown option" for name in sorted(set(raw) - {"version", "entities"})]
    if raw.get("version") != 1 or isinstance(raw.get("version"), bool):
        problems.append("version: must be 1")
    declared = raw.get("entities")
    if not isinstance(declared, dict):
        problems.append("entities: a mapping is required")
        declared = {}
    for entity, definitions in declared.items():
        where = f"entities.{entity}"
        if not isinstance(entity, str) or not _ENTITY.fullmatch(entity):
            problems.append(f"{where}: must match {ENTITY_TYPE_PATTERN}")
        if not isinstance(definitions, list):
            problems.append(f"{where}: a list of rules is required")
            continue
        rules = [_parse_rule(f"{where}.{i}", item, problems) for i, item in enumerate(definitions)]
        names = [rule.name for rule in rules if rule]
        repeated = sorted({name for name in names if names.count(name) > 1})
        if repeated:
            problems.append(f"{where}: duplicate rule names {repeated}")
        entities[entity] = tuple(rule for rule in rules if rule)
    if problems:
        raise RulesError("\n".join(f"  - {problem}" for problem in problems))
    return RuleSet(entities)


def load_rules(path: Path | str = ORDER_RULES) -> RuleSet:
    """The rules of a YAML or JSON file.

    A file that cannot be opened raises the ``OSError`` it always does. What is wrong
    inside raises ``RulesError``, with the path in a note.
    """
    text = Path(path).read_text(encoding="utf-8")
    try:
        return parse_rules(_document(text))
    except RulesError as exc:
        exc.add_note(f"in {path}")
        raise


def _document(text: str) -> Any:
    """What a text of JSON says, or of YAML where PyYAML is present."""
    try:
        return json.loads(text)
    except ValueError as not_json:
        if find_spec("yaml") is None:
            raise RulesError(f"only JSON can be read without PyYAML: {not_json}") from not_json
    import yaml

    try:
        return yaml.safe_load(text)
    except yaml.YAMLError as exc:
        mark = getattr(exc, "problem_mark", None)
        place = f"line {mark.line + 1}" if mark else "an unknown line"
        raise RulesError(f"neither JSON nor YAML from {place} on") from exc
