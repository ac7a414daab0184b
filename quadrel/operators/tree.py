"""Nested documents taken apart into their places, and put together again.

A place's path is an array of steps, ``struct<pos, key>``: a key within an object, a
position within a list, the other null.  Both ways stay in the JVM: a recursive query over
``variant_explode`` goes down, level by level for all documents at once, and one grouping
by document, whose leaves in order of their paths are written out as text, comes back up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = "array<struct<pos: int, key: string>>"


def nodes(docs: DataFrame, key: str, document: str, marks: str = "null", step_marks: str = "null") -> DataFrame:
    """(key, path, value, marks) of every place of VARIANT documents, the whole document first among them.

    ``marks`` is an SQL expression of what a root carries, ``step_marks`` of what a place
    carries, from ``t`` (key, path, value, marks of the one that holds it) and ``e`` (pos,
    key, value of the place).  Levels are kept by Spark while the next is made, as many as
    the deepest document has; keys of an object come in the order of their names.
    """
    spark = docs.sparkSession
    # The engine's own bound on a recursion's rows is for runaway queries; a document's places are finite.
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    root = docs.select(F.col(key).alias("doc"), F.col(document).alias("value")).where("value IS NOT NULL")
    return spark.sql(
        f"""
        WITH RECURSIVE t(doc, path, value, marks) AS (
          SELECT doc, CAST(array() AS {STEPS}), value, {marks} FROM {{root}}
          UNION ALL
          SELECT t.doc, array_append(t.path, named_struct('pos', IF(e.key IS NULL, e.pos, NULL), 'key', e.key)), e.value, {step_marks}
          FROM t, LATERAL variant_explode(t.value) AS e)
        SELECT doc AS `{key}`, path, value, marks FROM t""",
        root=root,
    )


def is_leaf(value: Column) -> Column:
    """Whether a place holds no other: a scalar, or an empty object or list."""
    kind = F.schema_of_variant(value)
    return ~(kind.startswith("OBJECT<") | kind.startswith("ARRAY<")) | F.to_json(value).isin("{}", "[]")


def _quoted(text: Column) -> Column:
    held = F.to_json(F.array(text))
    return F.substring(held, F.lit(2), F.length(held) - 2)


def assemble(leaves: DataFrame, key: str) -> DataFrame:
    """(key, document): the VARIANT that has each leaf (key, path, json) at its path.

    Leaves of a document must be at different places, none within another.  A document's
    leaves meet in one group, which is as large as the document.
    """
    sorted_ = leaves.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("path", "json"))).alias("leaves"))
    label = lambda s: F.when(s["key"].isNull(), "").otherwise(F.concat(_quoted(s["key"]), F.lit(":")))
    opened = lambda s: F.concat(F.when(s["key"].isNull(), "[").otherwise("{"), label(s))
    closed = lambda s: F.when(s["key"].isNull(), "]").otherwise("}")
    joined = lambda steps: F.array_join(steps, "")
    closing = lambda path, first: joined(F.reverse(F.transform(F.slice(path, first, F.greatest(F.size(path) - first + 1, F.lit(0))), closed)))

    def piece(leaf: Column, i: Column) -> Column:
        path, before = leaf["path"], F.get(F.col("leaves"), i - 1)["path"]
        same = F.transform(F.sequence(F.lit(1), F.least(F.size(path), F.size(before))), lambda k: F.get(path, k - 1).eqNullSafe(F.get(before, k - 1)))
        parted = F.array_position(same, False).cast("int")  # the first step in which the two differ
        rest = F.slice(path, parted + 1, F.size(path) - parted)
        next_ = F.concat(closing(before, parted + 1), F.lit(","), label(F.get(path, parted - 1)), joined(F.transform(rest, opened)))
        return F.concat(F.when(i == 0, joined(F.transform(path, opened))).otherwise(next_), leaf["json"])

    text = F.concat(joined(F.transform("leaves", piece)), closing(F.element_at("leaves", -1)["path"], F.lit(1)))
    return sorted_.select(key, F.parse_json(text).alias("document"))
