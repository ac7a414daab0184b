"""RDF terms as single strings, and expressions over them.

A term is one STRING column, so that joins, DISTINCT and grouping compare terms by plain
equality and Parquet can encode each column as a dictionary:

    <iri>            _:label            "lexical"            "lexical"@en            "lexical"^^datatype

Equality is that of terms: kind, lexical form, datatype and language.  Nothing is escaped;
the last quotation mark ends the lexical form, as neither languages nor datatypes hold one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
OWL = "http://www.w3.org/2002/07/owl#"
TYPE = f"<{RDF}type>"
NUMERIC = tuple(XSD + x for x in ("integer", "decimal", "float", "double", "int", "long", "short", "nonNegativeInteger", "positiveInteger"))


def iri(value: Column | str) -> Column:
    return F.concat(F.lit("<"), F.lit(value) if isinstance(value, str) else value.cast("string"), F.lit(">"))


def literal(value: Column, datatype: str | None = None, lang: Column | None = None) -> Column:
    """A literal term; null for null."""
    text = F.concat(F.lit('"'), value.cast("string"), F.lit('"'))
    if lang is not None:
        return F.concat(text, F.when(F.coalesce(lang, F.lit("")) == "", F.lit("")).otherwise(F.concat(F.lit("@"), lang)))
    return F.concat(text, F.lit("^^" + datatype)) if datatype and datatype != XSD + "string" else text


def is_iri(term: Column) -> Column:
    return term.startswith("<")


def is_literal(term: Column) -> Column:
    return term.startswith('"')


def is_blank(term: Column) -> Column:
    return term.startswith("_:")


def _suffix(term: Column) -> Column:
    return F.substring_index(term, '"', -1)


def lexical(term: Column) -> Column:
    """The IRI or the lexical form; null for a blank node."""
    return (
        F.when(is_iri(term), F.substring(term, F.lit(2), F.length(term) - 2))
        .when(is_literal(term), F.substring(term, F.lit(2), F.length(term) - 2 - F.length(_suffix(term))))
    )


def lang(term: Column) -> Column:
    """The language of a literal, empty without one; null for other terms."""
    return F.when(is_literal(term), F.when(_suffix(term).startswith("@"), F.substring(_suffix(term), F.lit(2), F.length(term))).otherwise(F.lit("")))


def datatype(term: Column) -> Column:
    """The datatype IRI of a literal; null for other terms."""
    end = _suffix(term)
    return F.when(
        is_literal(term),
        F.when(end.startswith("^^"), F.substring(end, F.lit(3), F.length(term))).when(end.startswith("@"), F.lit(RDF + "langString")).otherwise(F.lit(XSD + "string")),
    )


def number(term: Column) -> Column:
    """The value of a numeric literal; null for others and for ill-formed ones."""
    return F.when(datatype(term).isin(*NUMERIC), F.trim(lexical(term)).try_cast("double"))


def order_key(term: Column) -> list[Column]:
    """Sort columns: unbound, blank nodes, IRIs, literals; numbers by value, then other literals by text."""
    rank = F.when(term.isNull(), 0).when(is_blank(term), 1).when(is_iri(term), 2).otherwise(3)
    return [rank, number(term).isNull(), number(term), F.coalesce(lexical(term), term)]


def valid_lexical(term: Column) -> Column:
    """Whether a literal's lexical form belongs to its datatype, for the datatypes known here."""
    kind, text = datatype(term), F.trim(lexical(term))
    whole = r"^[+-]?[0-9]+$"
    return (
        F.when(kind.isin(XSD + "integer", XSD + "int", XSD + "long", XSD + "short"), text.rlike(whole))
        .when(kind == XSD + "decimal", text.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"))
        .when(kind.isin(XSD + "float", XSD + "double"), text.rlike(r"^([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|[+-]?INF|NaN)$"))
        .when(kind == XSD + "boolean", text.isin("true", "false", "0", "1"))
        .when(kind == XSD + "date", text.rlike(r"^-?[0-9]{4,}-[0-9]{2}-[0-9]{2}(Z|[+-][0-9]{2}:[0-9]{2})?$") & F.substring(text, 1, 10).try_cast("date").isNotNull())
        .otherwise(F.lit(True))
    )


def inferred_literal(text: Column) -> Column:
    """A typed literal from text, tests in this order: boolean, integer, float (no leading plus or point), else string."""
    trimmed = F.trim(text)
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(F.lower(trimmed).isin("true", "false"), literal(F.lower(trimmed), XSD + "boolean"))
        .when(trimmed.rlike(r"^-?\d+$"), literal(trimmed, XSD + "integer"))
        .when(trimmed.rlike(r"^-?\d+(\.\d+)?([eE]-?\d+)?$"), literal(trimmed, XSD + "float"))
        .otherwise(literal(text))
    )


def variant_literal(value: Column) -> Column:
    """A typed literal from a scalar VARIANT; booleans are told before numbers; null for containers and nulls."""
    kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    return (
        F.when(kind == "BOOLEAN", literal(text, XSD + "boolean"))
        .when(kind == "BIGINT", literal(text, XSD + "integer"))
        .when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), literal(text, XSD + "float"))
        .when(kind == "STRING", inferred_literal(text))
    )


def expanded(quads: DataFrame) -> DataFrame:
    """The quads with their terms taken apart: s_kind, o_kind, o, o_dt, o_lang, o_num, o_bool, o_date."""
    s, o = F.col("s"), F.col("o")
    kind = lambda t: F.when(is_iri(t), "iri").when(is_blank(t), "bnode").otherwise("lit")
    bare = lambda t: F.coalesce(lexical(t), t)
    return quads.select(
        "g",
        bare(s).alias("s"),
        kind(s).alias("s_kind"),
        bare(F.col("p")).alias("p"),
        kind(o).alias("o_kind"),
        bare(o).alias("o"),
        datatype(o).alias("o_dt"),
        F.nullif(lang(o), F.lit("")).alias("o_lang"),
        number(o).alias("o_num"),
        F.when(datatype(o) == XSD + "boolean", lexical(o).try_cast("boolean")).alias("o_bool"),
        F.when(datatype(o) == XSD + "date", lexical(o).try_cast("date")).alias("o_date"),
    )
