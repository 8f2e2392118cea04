"""Log records to events, or to the list of what is wrong with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.functions import built_once, ids, times
from changefeed.schemas import (
    ENTITY_TYPE_PATTERN,
    ENVELOPE_FIELDS,
    ERROR,
    EVENT_TYPES,
    MAX_ENTITY_KEY,
    SCHEMA_VERSION,
    SOURCE_FIELDS,
)

# A surrogate escape without its partner names no character.
_LONE_SURROGATE = (
    r"\\u[dD][89abAB][0-9a-fA-F]{2}(?!\\u[dD][c-fC-F][0-9a-fA-F]{2})"
    r"|(?<!\\u[dD][89abAB][0-9a-fA-F]{2})\\u[dD][c-fC-F][0-9a-fA-F]{2}"
)


Errors = Column  # an array of errors, empty if all is well


def none() -> Errors:
    return F.array().cast(ERROR)


def error(kind: str, loc: str | Column, message: str) -> Column:
    location = F.lit(loc) if isinstance(loc, str) else loc
    return F.struct(F.lit(kind).alias("type"), location.alias("loc"), F.lit(message).alias("msg"))


def only(kind: str, loc: str, message: str) -> Errors:
    return F.array(error(kind, loc, message)).cast(ERROR)


def first_error(*checks: tuple[Column, Column]) -> Errors:
    """The error of the first check that is true, as an array of one."""
    found: Column | None = None
    for bad, problem in checks:
        hit = F.array(problem).cast(ERROR)
        found = F.when(bad, hit) if found is None else found.when(bad, hit)
    return none() if found is None else found.otherwise(none())


def aside(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, kept out of generated code.

    A lambda body is interpreted. That is slower per row, but it is used for rows
    that are rare, and the code generated for all the others stays small enough
    for the JVM to compile.
    """
    return F.get(F.transform(F.array(value), then), F.lit(0))


def has_lone_surrogate(text: Column) -> Column:
    # An escaped backslash must not be taken for the start of a \\u escape.
    plain = F.replace(text, F.lit("\\\\"), F.lit(".."))
    return F.when(F.contains(text, F.lit("\\u")), plain.rlike(_LONE_SURROGATE)).otherwise(
        F.lit(False)
    )


def parse_document(text: Column) -> Column:
    """One JSON document as a variant; null if the text is anything else.

    The parser stops after the first value and ignores what follows. So the text
    is wrapped as the first of two array elements, the second being its own hash,
    which no value can contain: a text holding more than one document moves or
    breaks the second element.
    """
    wrapped = F.when(
        ~has_lone_surrogate(text),
        F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), F.sha2(text, 256), F.lit('"]'))),
    )

    def unwrap(array: Column) -> Column:
        whole = (F.try_variant_get(array, "$[1]", "string") == F.sha2(text, 256)) & (
            F.try_variant_get(array, "$[2]", "variant").isNull()
        )
        return F.when(whole, F.try_variant_get(array, "$[0]", "variant"))

    return aside(wrapped, unwrap)


class _Document:
    """The members of an envelope, read from a variant one by one."""

    def __init__(self, variant: Column) -> None:
        self.variant = variant

    def value(self, path: str) -> Column:
        return F.try_variant_get(self.variant, f"$.{path}", "variant")

    def kind(self, path: str) -> Column:
        return F.schema_of_variant(self.value(path))

    def text(self, path: str) -> Column:
        return F.try_variant_get(self.variant, f"$.{path}", "string")

    def names(self, path: str = "") -> Column:
        return F.json_object_keys(F.to_json(self.value(path) if path else self.variant))

    def missing(self, path: str) -> tuple[Column, Column]:
        return self.value(path).isNull(), error("missing", path, "Field required")

    def text_errors(self, path: str, *checks: tuple[Column, Column]) -> Errors:
        not_text = error("string_type", path, "Input should be a valid string")
        return first_error(self.missing(path), (self.kind(path) != "STRING", not_text), *checks)

    def uuid_errors(self, path: str) -> Errors:
        return first_error(
            self.missing(path),
            (
                self.kind(path) != "STRING",
                error("uuid_type", path, "UUID input should be a string"),
            ),
            (
                ~self.text(path).rlike(ids.UUID_PATTERN),
                error("uuid_parsing", path, "Input should be a valid UUID"),
            ),
        )

    def moment(self, path: str) -> Column:
        return times.parse_offset_timestamp(self.text(path))

    def timestamp_errors(self, path: str) -> Errors:
        text, unreadable = self.text(path), self.moment(path).isNull()
        return first_error(
            self.missing(path),
            (
                self.kind(path) != "STRING",
                error("datetime_type", path, "Input should be a valid datetime"),
            ),
            (
                unreadable & (text.rlike(times.NAIVE_TIMESTAMP) | text.rlike(times.PLAIN_DATE)),
                error("timezone_aware", path, "Input should have timezone info"),
            ),
            (unreadable, error("datetime_parsing", path, "Input should be a valid datetime")),
        )

    def version(self) -> Column:
        return F.try_variant_get(self.variant, "$.entity_version", "bigint")

    def version_errors(self) -> Errors:
        path, kind = "entity_version", self.kind("entity_version")
        whole = F.try_variant_get(self.variant, f"$.{path}", "decimal(38,0)")
        largest = F.lit(2**63 - 1)
        too_big = kind.startswith("DECIMAL") & (whole > largest.cast("decimal(38,0)"))
        return first_error(
            self.missing(path),
            (
                too_big,
                error("less_than_equal", path, f"Input should be less than or equal to {2**63 - 1}"),
            ),
            (kind != "BIGINT", error("int_type", path, "Input should be a valid integer")),
            (
                self.version() < 1,
                error("greater_than_equal", path, "Input should be greater than or equal to 1"),
            ),
        )

    def extra_errors(self, path: str, known: tuple[str, ...]) -> Errors:
        unknown = F.array_except(self.names(path), F.array(*[F.lit(name) for name in known]))
        prefix = F.lit(f"{path}." if path else "")
        found = F.transform(
            unknown,
            lambda name: error(
                "extra_forbidden", F.concat(prefix, name), "Extra inputs are not permitted"
            ),
        )
        return F.coalesce(found.cast(ERROR), none())

    def source_errors(self) -> list[Errors]:
        is_object = self.kind("source").startswith("OBJECT")
        not_object = error("model_type", "source", "Input should be an object")
        inner = [
            self.text_errors(
                path,
                (
                    self.text(path) == "",
                    error("string_too_short", path, "String should have at least 1 character"),
                ),
            )
            for path in (f"source.{name}" for name in SOURCE_FIELDS)
        ]
        return [
            first_error(self.missing("source"), (~is_object, not_object)),
            F.when(
                is_object, F.concat(*inner, self.extra_errors("source", SOURCE_FIELDS))
            ).otherwise(none()),
        ]

    def errors(self) -> Errors:
        """Everything wrong with the members, in the order of the fields."""
        entity_type, entity_key = self.text("entity_type"), self.text("entity_key")
        supported = (self.kind("schema_version") == "BIGINT") & (
            F.try_variant_get(self.variant, "$.schema_version", "bigint") == SCHEMA_VERSION
        )
        return F.concat(
            first_error(
                self.missing("schema_version"),
                (~supported, error("literal_error", "schema_version", "Input should be 1")),
            ),
            self.uuid_errors("event_id"),
            self.text_errors(
                "event_type",
                (
                    ~self.text("event_type").isin(*EVENT_TYPES),
                    error("enum", "event_type", "Input should be 'insert' or 'update'"),
                ),
            ),
            *self.source_errors(),
            self.text_errors(
                "entity_type",
                (
                    # '$' would also accept a trailing line break.
                    ~entity_type.rlike(ENTITY_TYPE_PATTERN) | F.contains(entity_type, F.lit("\n")),
                    error(
                        "string_pattern_mismatch",
                        "entity_type",
                        f"String should match pattern '{ENTITY_TYPE_PATTERN}'",
                    ),
                ),
            ),
            self.text_errors(
                "entity_key",
                (
                    entity_key == "",
                    error(
                        "string_too_short", "entity_key", "String should have at least 1 character"
                    ),
                ),
                (
                    F.length(entity_key) > MAX_ENTITY_KEY,
                    error(
                        "string_too_long",
                        "entity_key",
                        f"String should have at most {MAX_ENTITY_KEY} characters",
                    ),
                ),
            ),
            self.version_errors(),
            self.timestamp_errors("occurred_at"),
            self.timestamp_errors("captured_at"),
            self.uuid_errors("batch_id"),
            first_error(
                self.missing("payload"),
                (
                    ~self.kind("payload").startswith("OBJECT"),
                    error("dict_type", "payload", "Input should be a valid dictionary"),
                ),
            ),
            self.extra_errors("", ENVELOPE_FIELDS),
        )

    def derived_id(self) -> Column:
        return ids.event_id(
            self.text("source.system"),
            self.text("source.object"),
            self.text("entity_type"),
            self.text("entity_key"),
            self.version(),
        )

    def all_errors(self) -> Errors:
        """The id must follow from the identity; only then is it safe to dedup on."""
        not_derived = only(
            "value_error",
            "",
            "Value error, event_id must be derived from"
            " (source, entity_type, entity_key, entity_version)",
        )
        underived = F.lower(self.text("event_id")) != self.derived_id()
        return F.when(
            ~F.schema_of_variant(self.variant).startswith("OBJECT"),
            only("model_type", "", "Input should be an object"),
        ).otherwise(
            aside(
                self.errors(),
                lambda found: F.when((F.size(found) == 0) & underived, not_derived).otherwise(found),
            )
        )


_POSITION = ("topic", "partition", "offset")
_TEXT = ("event_type", "system", "object", "entity_type", "entity_key")
_FAST_SCHEMA = (
    "struct<schema_version:bigint,event_id:string,event_type:string,source:variant,"
    "entity_type:variant,entity_key:variant,entity_version:bigint,occurred_at:string,"
    "captured_at:string,batch_id:string,payload:variant,_seal:string>"
)
_PLAIN_SOURCE = "OBJECT<object: STRING, system: STRING>"
# The parser's lenient defaults are not JSON.
_STRICT = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}


def _with_fast_parse(df: DataFrame) -> DataFrame:
    """Read well-formed envelopes in one typed pass, and tell which ones are.

    The text's own hash is put in as the last member of the outer object. It
    comes back only if that object ends where the text ends, so nothing follows
    the document. The fields whose JSON type the values alone would not prove are
    read as variants. What this pass does not take is examined in detail.
    """
    text = F.col("_text")
    sealed = F.when(
        F.endswith(text, F.lit("}")) & ~has_lone_surrogate(text),
        F.concat(
            # The last byte is the brace: cutting bytes counts no characters.
            F.substr(text.cast("binary"), F.lit(1), F.octet_length(text) - F.lit(1)).cast("string"),
            F.lit(',"_seal":"'),
            F.col("_hash"),
            F.lit('"}'),
        ),
    )
    parsed = df.withColumn("_hash", F.sha2(text, 256)).withColumn(
        "_e", F.from_json(sealed, _FAST_SCHEMA, _STRICT)
    )

    def text_of(path: str) -> Column:
        return F.when(F.schema_of_variant(path) == "STRING", F.try_variant_get(path, "$", "string"))

    read = parsed.select(
        *_POSITION,
        "key",
        "value",
        "headers",
        "_text",
        (
            (F.col("_e._seal") == F.col("_hash"))
            & (F.size(F.json_object_keys("_text")) == len(ENVELOPE_FIELDS))
            & (F.col("_e.schema_version") == SCHEMA_VERSION)
            & (F.schema_of_variant("_e.source") == _PLAIN_SOURCE)
        ).alias("_shaped"),
        F.lower("_e.event_id").alias("event_id"),
        F.col("_e.event_type").alias("event_type"),
        F.try_variant_get("_e.source", "$.system", "string").alias("system"),
        F.try_variant_get("_e.source", "$.object", "string").alias("object"),
        text_of("_e.entity_type").alias("entity_type"),
        text_of("_e.entity_key").alias("entity_key"),
        F.col("_e.entity_version").alias("entity_version"),
        times.parse_offset_timestamp(F.col("_e.occurred_at")).alias("occurred_at"),
        times.parse_offset_timestamp(F.col("_e.captured_at")).alias("captured_at"),
        F.lower("_e.batch_id").alias("batch_id"),
        F.col("_e.payload").alias("payload_variant"),
        F.to_json("_e.payload").alias("payload"),
    )
    derived = ids.event_id(*[F.col(n) for n in ("system", "object", "entity_type", "entity_key")],
                           F.col("entity_version"))
    as_expected = (
        F.col("_shaped")
        & F.col("event_type").isin(*EVENT_TYPES)
        & (F.length("system") > 0)
        & (F.length("object") > 0)
        & F.col("entity_type").rlike(ENTITY_TYPE_PATTERN)
        & ~F.contains("entity_type", F.lit("\n"))
        & F.length("entity_key").between(1, MAX_ENTITY_KEY)
        & (F.col("entity_version") >= 1)
        & F.col("occurred_at").isNotNull()
        & F.col("captured_at").isNotNull()
        & F.col("batch_id").rlike(ids.UUID_PATTERN)
        & F.startswith("payload", F.lit("{"))
        & (F.col("event_id") == F.col("_derived"))
    )
    return (
        read.withColumn("_derived", derived)
        .withColumn("_fast", F.coalesce(as_expected, F.lit(False)))
        .drop("_shaped", "_derived")
    )


def _examined_closely() -> Column:
    """Errors and members of a record that the typed pass did not take."""

    def members(variant: Column) -> Column:
        doc = _Document(variant)
        errors = (
            F.when(F.col("value").isNull(), only("missing_value", "", "record has no value"))
            .when(variant.isNull(), only("json_invalid", "", "Invalid JSON"))
            .otherwise(doc.all_errors())
        )
        return F.struct(
            errors.alias("errors"),
            F.lower(doc.text("event_id")).alias("event_id"),
            doc.text("event_type").alias("event_type"),
            doc.text("source.system").alias("system"),
            doc.text("source.object").alias("object"),
            doc.text("entity_type").alias("entity_type"),
            doc.text("entity_key").alias("entity_key"),
            doc.version().alias("entity_version"),
            doc.moment("occurred_at").alias("occurred_at"),
            doc.moment("captured_at").alias("captured_at"),
            F.lower(doc.text("batch_id")).alias("batch_id"),
            doc.value("payload").alias("payload_variant"),
            F.to_json(doc.value("payload")).alias("payload"),
        )

    return aside(F.col("_text"), lambda text: aside(parse_document(text), members))


def decode(records: DataFrame) -> DataFrame:
    """Each record as an event, or with ``errors``; no record is dropped.

    Valid rows have empty ``errors`` and the envelope's fields; the others have
    nulls there and what the headers and the key still tell. The errors name
    fields and kinds and never repeat a value.
    """
    raw = F.col("value").cast("string")
    text = records.select(
        *_POSITION, "key", "value", "headers", F.when(F.is_valid_utf8(raw), raw).alias("_text")
    )
    fast = F.col("_fast")
    checked = _with_fast_parse(text).withColumn(
        "_slow", F.when(~fast, built_once("envelope", _examined_closely))
    )
    ok = fast | (F.size("_slow.errors") == 0)

    def read(name: str, otherwise: Column | None = None) -> Column:
        chosen = F.when(fast, F.col(name)).when(ok, F.col(f"_slow.{name}"))
        return (chosen if otherwise is None else chosen.otherwise(otherwise)).alias(name)

    def header(name: str) -> Column:
        return ids.uuid_or_null(F.element_at("headers", name))

    flat = checked.select(
        *_POSITION,
        "value",
        F.when(fast, none()).otherwise(F.col("_slow.errors")).alias("errors"),
        ok.alias("_ok"),
        read("event_id", aside(F.col("headers"), lambda _: header("event_id"))),
        *[read(name) for name in _TEXT if name != "entity_key"],
        read("entity_key", F.make_valid_utf8(F.col("key").cast("string"))),
        read("entity_version"),
        read("occurred_at"),
        read("captured_at"),
        read("batch_id", aside(F.col("headers"), lambda _: header("batch_id"))),
        read("payload_variant"),
        read("payload"),
    )
    source = F.struct("system", "object")
    return flat.select(
        *_POSITION,
        "value",
        "errors",
        F.when(F.col("_ok"), F.lit(SCHEMA_VERSION)).alias("schema_version"),
        "event_id",
        "event_type",
        F.when(F.col("_ok"), source).alias("source"),
        "entity_type",
        "entity_key",
        "entity_version",
        "occurred_at",
        "captured_at",
        "batch_id",
        "payload",
        "payload_variant",
    )


def is_valid() -> Column:
    return F.size("errors") == 0
