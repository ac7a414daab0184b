"""Fields that are bare or wrapped with their evidence, as VARIANT expressions; text that holds JSON or Turtle."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def kind(field: Column) -> Column:
    """``object``, ``array``, ``null`` or ``scalar``."""
    schema = F.schema_of_variant(field)
    return (
        F.when(field.isNull() | (schema == "VOID"), "null").when(schema.startswith("OBJECT"), "object").when(schema.startswith("ARRAY"), "array").otherwise("scalar")
    )


def has_key(field: Column, key: str) -> Column:
    """Whether an object has a key, be its value null or not."""
    return F.coalesce(F.try_variant_get(field, f"$.{key}", "variant").isNotNull(), F.lit(False))


def get_value(field: Column) -> Column:
    """The ``value`` of an object that has one; any other field is its own value."""
    return F.when(has_key(field, "value"), F.try_variant_get(field, "$.value", "variant")).otherwise(field)


def get_evidence(field: Column) -> Column:
    return F.when(kind(field) == "object", F.try_variant_get(field, "$.evidence", "string"))


def get_source(field: Column) -> Column:
    """The ``source`` of an object, if it is a web address."""
    source = F.when(kind(field) == "object", F.try_variant_get(field, "$.source", "string"))
    return F.when(source.rlike("^https?://"), source)


def normalized_list(field: Column) -> Column:
    """array<variant>: nothing for null, an array's members, any other field alone."""
    members = F.try_variant_get(field, "$", "array<variant>")
    return F.when(kind(field) == "null", F.array().cast("array<variant>")).when(kind(field) == "array", members).otherwise(F.array(field))


def is_meaningful(field: Column) -> Column:
    """Whether the value is neither null nor blank text; zero, false and empty lists count."""
    value = get_value(field)
    blank = (F.schema_of_variant(value) == "STRING") & (F.trim(F.try_variant_get(value, "$", "string")) == "")
    return (kind(value) != "null") & ~F.coalesce(blank, F.lit(False))


@F.pandas_udf(StringType())
def _whole_json(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The text where all of it is one JSON value; the parser in the JVM takes the first value and leaves the rest."""
    import json

    def one(text):
        try:
            json.loads(text)
        except (TypeError, ValueError):
            return None
        return text

    for part in texts:
        yield part.map(one)


def whole_json(text: Column) -> Column:
    """VARIANT of a text that is JSON as a whole, else null."""
    return F.try_parse_json(_whole_json(text))


def greedy_json(text: Column) -> Column:
    """VARIANT of a reply: the whole text, else what stands from the first brace to the last; null if neither is JSON."""
    return F.coalesce(whole_json(text), whole_json(F.regexp_extract(text, r"(?s)\{.*\}", 0)))


@F.pandas_udf(StringType())
def _first_object(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    import json

    decoder = json.JSONDecoder()

    def one(text):
        if text is None or (at := text.find("{")) < 0:
            return None
        try:
            return json.dumps(decoder.raw_decode(text, at)[0], ensure_ascii=False)
        except ValueError:
            return None

    for part in texts:
        yield part.map(one)


def first_json(text: Column) -> Column:
    """VARIANT of the first JSON object in a text, fences and what follows ignored; null if there is none."""
    return F.try_parse_json(_first_object(text))


def turtle_of_reply(text: Column) -> Column:
    """Turtle in a reply: a fenced block, else from the first prefix or base, else all of it."""
    fenced = F.regexp_extract(text, r"(?is)```(?:turtle|ttl)?\s*\n(.*?)```", 1)
    at = lambda mark: F.instr(text, mark)
    start = lambda mark: F.when(at(mark) > 0, F.substring(text, at(mark), F.length(text)))
    return F.btrim(F.coalesce(F.nullif(fenced, F.lit("")), start("@prefix"), start("@base"), text), F.lit(" \t\r\n"))


def top_level_field(lines: Column, key: str, indented: bool = False) -> Column:
    """Value of the first line ``key: value``, quoted or bare, without a trailing comment; ``lines`` is array<string>."""
    lead = r"\s*" if indented else ""
    shape = rf"""^{lead}{key}:\s*(?:"([^"]*)"|'([^']*)'|([^#\s][^#]*?))\s*(?:#.*)?$"""
    line = F.get(F.filter(lines, lambda x: x.rlike(shape)), F.lit(0))
    part = lambda i: F.nullif(F.regexp_extract(line, shape, i), F.lit(""))
    return F.coalesce(part(1), part(2), F.trim(part(3)))
