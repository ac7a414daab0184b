"""Fill-in-the-middle transformation in Spark SQL functions.

A text is taken apart into its code points by ``regexp_extract_all``.  Groups of eight
digits of a SHA-256 of the seed and the document's id, turned into numbers by ``conv``, say
where the two cuts fall, whether the text is transformed at all and in which order its
parts stand: prefix, suffix, middle (``psm``), or suffix, prefix, middle (``spm``), each
after its sentinel.  ``slice`` and ``array_join`` build the parts.  A text that holds a
sentinel itself is left plain, so that each sentinel of a transformed text stands once; as
``<`` is the first character of each and of no other place in them, none can come about
where a part meets a sentinel.

The way back parses sentinels: the labels found in a text, in their order, are paired with
what follows each, and prefix, middle and suffix are looked up by label.  It needs to know
only whether the text was transformed, not in which order.

All of it is one projection over the rows: nothing is shuffled, and a document's answer
depends on its id and text alone, so that a task that runs again gives the same.

A text's units take some 60 bytes of memory a code point while it is cut.

Defined cases: a null text is empty; an empty text is plain; a null id counts as the empty
string; texts of any length are cut whole; repeated rows are transformed each, alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrel.llm.shared import let, text_of

#: The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINEL = "<[PSM]>"
#: Of a hundred texts so many are transformed, and of a hundred of these so many in the order suffix, prefix, middle.
SHARE, SUFFIX_FIRST = 90, 20


def draw(ident: Column, seed: int, k: int) -> Column:
    """The k-th number (from one) that the seed and an id give, 0 to 2**32 - 1."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digits, 8 * k - 7, 8), 16, 10).cast("long")


def transform(df: DataFrame, text: str = "text", ident: str = "doc_id", seed: int = 1, share: int = SHARE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, text, output) for each row; another ``seed`` gives other cuts."""
    rows = df.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"))
    units = rows.select("*", F.regexp_extract_all("text", F.lit("(?s)."), F.lit(0)).alias("units")).withColumn("n", F.size("units").cast("long"))
    a, b = (F.expr(f"{x} % (n + 1)") for x in ("h1", "h2"))
    drawn = units.withColumns({f"h{k}": draw(F.col("doc_id"), seed, k) for k in (1, 2, 3, 4)}).withColumns({"first_cut": F.least(a, b), "last_cut": F.greatest(a, b)})
    plain = (F.col("n") == 0) | F.col("text").rlike(SENTINEL) | (F.col("h3") % 100 >= share)
    formed = drawn.withColumn("form", F.when(plain, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm"))
    transformed = F.col("form") != "plain"
    part = lambda lo, hi: F.array_join(F.slice("units", (lo + 1).cast("int"), (hi - lo).cast("int")), "")
    first, last = F.col("first_cut"), F.col("last_cut")
    prefix, middle, suffix = part(F.lit(0), first), part(first, last), part(last, F.col("n"))
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.col("text"))
    )
    return formed.select(
        "doc_id", "n", "form", F.when(transformed, first).alias("prefix_chars"), F.when(transformed, last - first).alias("middle_chars"), "text", output.alias("output")
    )


def restored(output: Column, form: Column) -> Column:
    """The text that a transformation made ``output`` of; null if a transformed text hasn't each sentinel once."""
    found = F.struct(F.regexp_extract_all(output, F.lit(SENTINEL), F.lit(0)).alias("labels"), F.split(output, SENTINEL, -1).alias("parts"))

    def put_together(x: Column) -> Column:
        whole = (F.size(x["labels"]) == 3) & (F.size(F.array_distinct(x["labels"])) == 3) & (F.element_at(x["parts"], 1) == "")
        part = lambda label: F.get(x["parts"], F.array_position(x["labels"], label).cast("int"))
        return F.when(whole, F.concat(part(PREFIX), part(MIDDLE), part(SUFFIX)))

    return F.when(form == "plain", output).otherwise(let(found, put_together))


def digests(df: DataFrame, text: str = "text", ident: str = "doc_id", seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and SHA-256 (lower-case hex) of the output and of the text restored from it."""
    made = transform(df, text, ident, seed)
    digest = lambda c: F.sha2(F.encode(c, "UTF-8"), 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256")
    )


def digests_sql(seed: int = 1, share: int = SHARE, suffix_first: int = SUFFIX_FIRST) -> str:
    """DuckDB SQL of :func:`digests` over ``documents``; the restored text has to be the text."""
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digits FROM documents),
h AS (SELECT *, {", ".join(f"CAST('0x' || substr(digits, {8 * k - 7}, 8) AS BIGINT) AS h{k}" for k in (1, 2, 3, 4))} FROM t),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}') OR h3 % 100 >= {share} THEN 'plain'
              WHEN h4 % 100 < {suffix_first} THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (SELECT *, left(text, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                        ELSE '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
