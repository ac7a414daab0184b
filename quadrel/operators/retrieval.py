"""Passages: chunking, tokens, and a ranker by the rarity of shared tokens.

Texts are taken apart by built-in functions.  Ranking scores only pairs of a query and a
passage that share a token, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A token is common if more passages than this, and than this share of them, hold it.
COMMON = 1000
COMMON_SHARE = 1 / 16
#: Different (query, token) rows that tasks hold at most, some 50 MB; passages that are scored together.
HELD = 500_000
BLOCK = 2048
# Words that are no tokens, and words that a query is expanded by.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "be", "by", "does", "for", "from",
    "how", "if", "in", "is", "it", "its", "of", "only", "or", "return",
    "such", "that", "the", "this", "to", "used", "value", "what", "which",
    "with", "item", "null", "name", "exact", "reported",
)
EXPANSIONS = {
    "architecture": "network model layer backbone head encoder decoder message passing graph transformer",
    "dataset": "data training validation test samples structures materials configurations corpus split",
    "evaluation": "evaluate benchmark metrics score performance accuracy mae rmse discovery test task",
    "hyperparameter": "learning rate batch epoch cutoff optimizer hidden dimension layers training settings",
    "materialization": "checkpoint pretrained weights model release output",
    "training": "train pretraining fine tuning loss optimizer objective sampling initialization distillation",
}


def tokenize(text: Column) -> Column:
    """array<string>: camel case and underscores parted, lower case, letters and digits of two characters at least, no stop words."""
    parted = F.replace(F.regexp_replace(text, "(?<=[a-z0-9])(?=[A-Z])", " "), F.lit("_"), F.lit(" "))
    found = F.regexp_extract_all(F.lower(parted), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.filter(found, lambda t: (F.length(t) > 1) & ~t.isin(*STOP_WORDS))


def expand(text: Column) -> Column:
    """The text and the words of each key that it holds."""
    out = text
    for key, words in EXPANSIONS.items():
        out = F.concat(out, F.when(F.lower(text).contains(key), F.lit(" " + words)).otherwise(F.lit("")))
    return out


def chunk_text(text: Column, limit: int = 900) -> Column:
    """array<string>: lines packed greedily up to ``limit`` characters; a full chunk's last line is carried over; lines stay whole."""
    lines = F.filter(F.transform(F.split(text, "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]", -1), lambda x: F.btrim(F.regexp_replace(x, r"(?U)\s+", " "))), lambda x: x != "")
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit(0).alias("size"))

    def add(state: Column, line: Column) -> Column:
        full = (F.size(state["open"]) > 0) & (state["size"] + F.length(line) + 1 > limit)
        carried = F.element_at(state["open"], -1)
        return F.when(
            full,
            F.struct(
                F.array_append(state["done"], F.array_join(state["open"], " ")).alias("done"),
                F.array(carried, line).alias("open"),
                (F.length(carried) + F.length(line) + 2).alias("size"),
            ),
        ).otherwise(F.struct(state["done"].alias("done"), F.array_append(state["open"], line).alias("open"), (state["size"] + F.length(line) + 1).alias("size")))

    return F.aggregate(
        F.coalesce(lines, F.array().cast("array<string>")), empty, add,
        lambda s: F.when(F.size(s["open"]) > 0, F.array_append(s["done"], F.array_join(s["open"], " "))).otherwise(s["done"]),
    )


def chunks(df: DataFrame, text: Column, ident: Column, kind: str, limit: int = 900) -> DataFrame:
    """df's columns and (id, kind, chunk) for each chunk; ``ident`` is the prefix of the ids, counted from one."""
    rows = df.select("*", F.posexplode(chunk_text(text, limit)).alias("_n", "chunk"))
    return rows.withColumn("id", F.concat(ident, (F.col("_n") + 1).cast("string"))).withColumn("kind", F.lit(kind)).drop("_n")


def page_chunks(pages: DataFrame) -> DataFrame:
    """Chunks of pages (page, text): ids P{page}-C{n}."""
    return chunks(pages, F.col("text"), F.concat(F.lit("P"), F.col("page").cast("string"), F.lit("-C")), "pdf")


def ontology_chunks(files: DataFrame) -> DataFrame:
    """Chunks of ontology files (file, text): ids O-{stem}-{n}."""
    return chunks(files, F.col("text"), F.concat(F.lit("O-"), F.regexp_replace("file", r"\.[^.]*$", ""), F.lit("-")), "ontology")


def yaml_chunks(facts: DataFrame) -> DataFrame:
    """One chunk for each fact (ordinal, path, value): ids Y{n}, text ``path = value``."""
    return facts.select("*", F.concat(F.lit("Y"), (F.col("ordinal") + 1).cast("string")).alias("id"), F.lit("yaml").alias("kind"), F.concat_ws(" = ", "path", "value").alias("chunk"))


def rank(queries: DataFrame, passages: DataFrame, top: int, expanded: bool = True, scope: list[str] | None = None) -> DataFrame:
    """(query, id, score, rank) of the ``top`` passages of each query.

    ``queries(query, text)``, ``passages(id, text)``; with ``scope``, both also have these
    columns, and passages are ranked, and token rarity is counted, within each value.  A
    passage's score is the sum over the query's tokens, repeats counted, that it holds of
    ln(1 + (N + 1) / (df + 1)), divided by 1 + max(0, tokens - 120) / 500; scores equal to
    nine decimals go by id; nothing scores zero and stays.

    The order is exact.  Passages are tokenised once, into a table in the shared folder.
    Without a scope, and with up to ``HELD`` different tokens of queries, every task keeps
    the best passages of each query of those that it reads (:func:`_best_of_task`), so no
    more than tasks x queries x top rows are exchanged.  Otherwise queries and passages meet
    on their tokens (:func:`_met_by_tokens`).
    """
    scope = scope or []
    text = expand(F.col("text")) if expanded else F.col("text")
    wanted = queries.select(*scope, "query", F.explode(tokenize(text)).alias("token")).groupBy(*scope, "query", "token").agg(F.count("*").alias("times"))
    found = F.struct(tokenize(F.coalesce("text", F.lit(""))).alias("tokens"))
    held = _written(passages.select(*scope, "id", found.alias("t")).select(*scope, "id", F.size("t.tokens").alias("length"), F.array_distinct("t.tokens").alias("tokens")), "tokens")
    each = held.select(*scope, F.explode("tokens").alias("token")).join(wanted.select(*scope, "token").distinct(), [*scope, "token"], "left_semi")
    rarity = each.groupBy(*scope, "token").agg(F.count("*").alias("df"))
    total = held.groupBy(*scope).agg(F.count("*").alias("n")) if scope else held.agg(F.count("*").alias("n"))
    weighted = rarity.join(F.broadcast(total), scope) if scope else rarity.withColumn("n", F.lit(total.first()[0]))
    common = F.col("df") > F.greatest(F.lit(COMMON), F.col("n") * COMMON_SHARE)
    # Weights are multiples of 2**-40, so that sums are the same in whatever order they are made, and equal passages tie.
    weight = F.round(F.log(1 + (F.col("n") + 1) / (F.col("df") + 1)) * 2.0**40) / 2.0**40
    weighted = weighted.select(*scope, "token", weight.alias("weight"), common.alias("common"))
    # The query side is narrow: its tokens' weights are attached before passages are met.
    asked = _written(wanted.join(weighted, [*scope, "token"]).select(*scope, "query", "token", (F.col("times") * F.col("weight")).alias("worth"), "common"), "asked")
    if not scope:
        rows = asked.select("query", "token", "worth").limit(HELD + 1).collect()
        if len(rows) <= HELD:
            best = _best_of_task(held, rows, top, queries.schema["query"].dataType.simpleString())
            order = Window.partitionBy("query").orderBy(F.round("score", 9).desc(), "id")
            return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return _met_by_tokens(held, asked, top, scope)


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: several plans read it, and none makes it again."""
    from quadrel.sources.sinks import scratch

    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _best_of_task(held: DataFrame, asked: list, top: int, kind: str) -> DataFrame:
    """(query, id, score) of the best passages of each query among those that one task reads.

    ``asked`` is the (query, token, worth) of all queries, ``HELD`` at most.  Passages come in
    blocks by length, so by what a sum is divided by; a query passes by a block whose
    tokens' worths together, divided by the block's least divisor, stay below the last of
    the best so far.  In a block that it can't pass by, tokens that can't reach that mark by
    themselves are counted for those passages only that hold a token beyond them.
    """
    vocabulary = sorted({r.token for r in asked})
    number = {t: i for i, t in enumerate(vocabulary)}
    by_query: dict = {}
    for r in sorted(asked, key=lambda r: r.token):
        by_query.setdefault(r.query, []).append((number[r.token], r.worth))
    names = list(by_query)
    tokens = [np.array([t for t, _ in by_query[q]]) for q in names]
    worths = [np.array([w for _, w in by_query[q]]) for q in names]
    del by_query, number

    def run(batches):
        best: list[list] = [[] for _ in names]  # (-rounded score, id, score), the best first
        words = pa.array(vocabulary, pa.string())
        for b in batches:
            lists = b.column(2)
            flat = pc.index_in(lists.flatten(), words)
            owner = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            known = flat.is_valid().to_numpy(zero_copy_only=False)
            token, owner = flat.filter(flat.is_valid()).to_numpy(zero_copy_only=False).astype(np.int64), owner[known]
            divisor = 1 + np.maximum(0, b.column(1).to_numpy().astype(np.int64) - 120) / 500
            by_length = np.argsort(divisor, kind="stable")
            block_of = np.empty(len(by_length), np.int64)
            block_of[by_length] = np.arange(len(by_length)) // BLOCK
            ids = b.column(0)
            for k in range(-(-b.num_rows // BLOCK)):
                members = by_length[k * BLOCK : (k + 1) * BLOCK]
                place = np.empty(b.num_rows, np.int64)
                place[members] = np.arange(len(members))
                inside = block_of[owner] == k
                t, p = token[inside], place[owner[inside]]
                in_order = np.lexsort((p, t))  # passages in order within a token, as candidates are searched for among them
                t, p = t[in_order], p[in_order]
                first, end = np.searchsorted(t, np.arange(len(words))), np.searchsorted(t, np.arange(len(words)), side="right")
                share = divisor[members]
                for q in range(len(names)):
                    own, worth = tokens[q], worths[q]
                    here = end[own] > first[own]
                    if not here.any():
                        continue
                    own, worth = own[here], worth[here]
                    least = -best[q][-1][0] if len(best[q]) == top else 0.0
                    if worth.sum() / share[0] < least - 1e-9:
                        continue
                    rising = np.argsort(worth, kind="stable")
                    beyond = rising[np.cumsum(worth[rising]) / share[0] >= least - 1e-9]
                    candidates = np.unique(np.concatenate([p[first[x] : end[x]] for x in own[beyond]]))
                    sums = np.zeros(len(members))
                    for x, w in zip(own.tolist(), worth.tolist(), strict=True):
                        listed = p[first[x] : end[x]]
                        if 20 * len(candidates) < len(listed):
                            at = np.minimum(np.searchsorted(listed, candidates), len(listed) - 1)
                            sums[candidates[listed[at] == candidates]] += w
                        else:
                            sums[listed] += w
                    score = sums[candidates] / share[candidates]
                    good = np.flatnonzero(score >= max(least - 1e-9, np.partition(score, -top)[-top] - 1e-9 if len(score) > top else 0.0))
                    if len(good):
                        rows = [(-round(float(score[i]), 9), ids[int(members[candidates[i]])].as_py(), float(score[i])) for i in good]
                        best[q] = sorted([*best[q], *rows], key=lambda r: (r[0], r[1] is not None, r[1]))[:top]
        out = [(names[q], i, s) for q in range(len(names)) for _, i, s in best[q]]
        for at in range(0, len(out), 50_000):
            columns = zip(*out[at : at + 50_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    ddl = f"query {kind}, id {held.schema['id'].dataType.simpleString()}, score double"
    schema = to_arrow_schema(held.sparkSession.createDataFrame([], ddl).schema)
    return held.select("id", "length", "tokens").mapInArrow(run, ddl)


def _met_by_tokens(held: DataFrame, asked: DataFrame, top: int, scope: list[str]) -> DataFrame:
    """The ranking by a join of queries and passages on their tokens.

    Passages are first met by rare tokens.  Where a query's ``top`` passages have more from
    these than common tokens could give to any other, only passages that can still be
    among them are scored by common tokens; other queries meet all passages of their tokens.
    """
    index = held.select(*scope, "id", "length", F.explode("tokens").alias("token"))
    key = [*scope, "query"]
    order = Window.partitionBy(*key).orderBy(F.round("score", 9).desc(), "id")

    def scored(hits: DataFrame) -> DataFrame:
        return hits.select(*key, "id", "length", "sum", (F.col("sum") / (1 + F.greatest(F.lit(0), F.col("length") - 120) / 500)).alias("score"))

    def met(tokens: DataFrame) -> DataFrame:
        return index.join(tokens, [*scope, "token"]).groupBy(*key, "id", "length").agg(F.sum("worth").alias("sum"))

    # What common tokens can add to any passage; a query is settled by its rare tokens if its top passages have more than that from them alone.
    rest = asked.groupBy(*key).agg(F.sum(F.when(F.col("common"), F.col("worth")).otherwise(0.0)).alias("rest"))
    rare = _written(scored(met(asked.where("NOT common"))), "rare")
    least = rare.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == top).select(*key, F.col("score").alias("least"))
    queries_ = rest.join(least, key, "left").select(*key, "rest", "least", (F.coalesce(F.col("least") > F.col("rest") + 1e-9, F.lit(False)) | (F.col("rest") == 0)).alias("settled"))
    near = rare.join(queries_.where("settled"), key)
    near = near.where(F.col("least").isNull() | ((F.col("sum") + F.col("rest")) / (1 + F.greatest(F.lit(0), F.col("length") - 120) / 500) >= F.col("least") - 1e-9)).select(*key, "id", "length", "sum")
    # Common tokens' lists meet the passages that are still in question, one to one.
    open_ = near.join(asked.where("common").select(*key, "token", "worth"), key)
    added = open_.join(index.select(*scope, "id", "token"), [*scope, "id", "token"], "left_semi").groupBy(*key, "id", "length").agg(F.sum("worth").alias("more"))
    full = near.join(added, [*key, "id", "length"], "left").select(*key, "id", "length", (F.col("sum") + F.coalesce("more", F.lit(0.0))).alias("sum"))
    others = met(asked.join(queries_.where("NOT settled").select(*key), key, "left_semi"))
    whole = scored(full.unionByName(others)).select(*key, "id", "score")
    return whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def best_sentence(text: Column, hint: Column) -> Column:
    """The sentence with most distinct tokens of the hint, the first on a tie, 350 characters at most; of a text without any, its first 300."""
    sentences = F.filter(F.transform(F.split(text, r"(?<=[.!?])(?U)\s+|\s*;\s*", -1), lambda s: F.btrim(s)), lambda s: s != "")
    scored = F.transform(sentences, lambda s, i: F.struct(F.size(F.array_intersect(tokenize(s), tokenize(hint))).alias("score"), (-i).alias("place"), s.alias("s")))
    return F.when(F.size(sentences) > 0, F.substring(F.array_max(scored)["s"], 1, 350)).otherwise(F.trim(F.substring(text, 1, 300)))


def class_catalog(files: DataFrame) -> DataFrame:
    """(class, file, line) of the classes declared in ontology texts (file, text); the first file by name counts."""
    shape = r"(?:[:#])([A-Za-z][A-Za-z0-9_-]*)>?\s+rdf:type\s+owl:Class\b"
    found = files.select("file", F.explode(F.regexp_extract_all("text", F.lit(shape), F.lit(1))).alias("class"))
    return found.groupBy("class").agg(F.min("file").alias("file")).withColumn("line", F.concat_ws(" | ", "class", "file", F.lit("declared rdf:type owl:Class")))


def packets(*ranked: tuple[int, DataFrame], scope: list[str] | None = None) -> DataFrame:
    """(query, ids): the ids of several rankings (priority, DataFrame(query, id, rank)), by priority, then rank, each id once; with ``scope``, within each value of its columns."""
    key = [*(scope or []), "query"]
    parts = None
    for priority, df in ranked:
        part = df.select(*key, "id", F.lit(priority).alias("priority"), "rank")
        parts = part if parts is None else parts.unionByName(part)
    first = parts.groupBy(*key, "id").agg(F.min(F.struct("priority", "rank")).alias("place"))
    ordered = F.sort_array(F.collect_list(F.struct("place", "id")))
    return first.groupBy(*key).agg(F.transform(ordered, lambda x: x["id"]).alias("ids"))


def question_packets(
    questions: DataFrame, facts: DataFrame, pages: DataFrame, ontology: DataFrame, known: DataFrame,
    top_pages: int = 2, top_facts: int = 4, top_ontology: int = 2, top_known: int = 2, catalog: str = "O-CLASS-CATALOG", scope: list[str] | None = None,
) -> DataFrame:
    """(query, ids): the context of each question (id, path, question, variable, source, yaml_path) and of each known hyperparameter (id, path, name, category, value).

    A question that maps to the ontology gets the class catalog and the best ontology chunks
    for its own words, and page chunks if it asks for a backbone's or a head's class.  Any
    other gets the fact that it points at, and the best facts and page chunks for its path,
    variable and question.  A known hyperparameter gets itself and the best page chunks for
    its name and value.  ``facts(id, path, chunk)``, ``pages(id, chunk)``, ``ontology(id, chunk)``.
    With ``scope``, the columns that tell documents apart, all tables have them, and each
    document's questions are answered from its own.
    """
    scope = scope or []
    passages = lambda df: df.select(*scope, "id", F.col("chunk").alias("text"))
    best = lambda asked, df, top, expanded=True: rank(asked, passages(df), top, expanded, scope)
    mapped = F.col("source") == "ontology_mapping"
    asks = lambda df: df.select(*scope, F.col("id").alias("query"), F.col("question").alias("text"))
    own = asks(questions.where(mapped))
    heads = asks(questions.where(mapped & F.col("variable").isin("backbone_ontology_class", "head_ontology_class")))
    others = questions.where(~mapped)
    words = others.select(*scope, F.col("id").alias("query"), F.concat_ws(" ", "path", "variable", "question").alias("text"))
    asked = known.select(*scope, F.concat(F.lit("known_hyperparameter::"), "path").alias("query"), F.col("id"), F.concat(F.coalesce("category", F.lit("")), F.lit(" "), "name", F.lit(" "), "value", F.lit(" hyperparameter training")).alias("text"))
    alone = lambda df: df.select(*scope, "query", "id", F.lit(1).alias("rank"))
    pointed = others.join(facts.select(*scope, F.col("path").alias("yaml_path"), F.col("id").alias("_id")), [*scope, "yaml_path"]).select(*scope, F.col("id").alias("query"), F.col("_id").alias("id"))
    return packets(
        (0, alone(own.select(*scope, "query", F.lit(catalog).alias("id")))),
        (1, best(own, ontology, top_ontology, False)),
        (2, best(heads, pages, top_pages)),
        (0, alone(pointed)),
        (1, best(words, facts, top_facts)),
        (2, best(words, pages, top_pages)),
        (0, alone(asked)),
        (1, best(asked.select(*scope, "query", "text"), pages, top_known, False)),
        scope=scope,
    )


#: What a field's path says about its class when the stated one is none, in this order.
CLASS_FALLBACKS = (
    ("hyperparameter", "MachineLearningHyperparameter"),
    ("dataset", "Dataset"),
    ("backbone", "MachineLearningArchitecture"),
    ("head", "MachineLearningArchitecture"),
    ("architecture", "MachineLearningArchitecture"),
)


def refined_classes(fields: DataFrame, catalog: DataFrame) -> DataFrame:
    """``fields(path, value, ...)`` that name a class, with (class, evidence): the class if the catalog (class, file) has it, else the first fallback of its path that it has, else null."""
    stated = F.substring_index(F.coalesce("value", F.lit("")), ":", -1)
    held = F.broadcast(catalog.where(F.col("class").isin(*{c for _, c in CLASS_FALLBACKS})).select(F.col("class").alias("_c"))) if CLASS_FALLBACKS else None
    known = held.agg(F.collect_set("_c").alias("_known"))  # as many as there are fallbacks
    fallback = F.coalesce(*[F.when(F.lower("path").contains(mark) & F.array_contains("_known", c), F.lit(c)) for mark, c in CLASS_FALLBACKS])
    files = catalog.select(F.col("class").alias("_stated"), F.col("file").alias("_file"))
    out = fields.withColumn("_stated", stated).join(files, "_stated", "left").crossJoin(known)
    out = out.withColumn("class", F.when(F.col("_file").isNotNull(), F.col("_stated")).otherwise(fallback)).drop("_file", "_stated", "_known")
    out = out.join(files.withColumnRenamed("_stated", "class"), "class", "left")
    cited = F.concat(F.lit("Ontology "), "_file", F.lit(" [O-CLASS-CATALOG]: "), "class", F.lit(" is declared rdf:type owl:Class."))
    return out.select(*fields.columns, "class", cited.alias("class_evidence"))


def cited_hyperparameters(evidence: Column, id_: Column, text: Column) -> Column:
    """Evidence that cites a known hyperparameter, in its own words; other evidence as it is."""
    words = F.concat(F.when(id_.startswith("M-HYP"), "Model page [").otherwise("YAML ["), id_, F.lit("]: "), text)
    return F.when(text.isNull(), evidence).otherwise(words)


def known_hyperparameters(page: DataFrame, yaml: DataFrame) -> DataFrame:
    """Facts (doc, ordinal, path, name, category, value) of the page; those of the YAML where the page has none; with ids."""
    fallback = yaml.join(page.select("doc").distinct(), "doc", "left_anti")
    of = lambda df, prefix: df.withColumn("id", F.concat(F.lit(prefix), (F.col("ordinal") + 1).cast("string")))
    return of(page, "M-HYP-").unionByName(of(fallback, "HY-HYP-"))


def label_of(kind: Column, id_: Column, page: Column, path: Column, file: Column, text: Column) -> Column:
    """A chunk as a prompt shows it."""
    where = F.when(kind == "pdf", F.concat(F.lit("PDF page "), page.cast("string"))).when(kind == "yaml", F.concat(F.lit("YAML "), path)).when(kind == "model_page", F.concat(F.lit("Model page "), path)).otherwise(F.concat(F.lit("Ontology "), file))
    return F.concat(F.lit("["), id_, F.lit(" | "), where, F.lit("]\n"), text)


def refined_evidence(evidence: Column, chunk_text_: Column, kind: Column, page: Column, hint: Column) -> Column:
    """Evidence that cites a chunk by id, as a quotation: a PDF chunk's best sentence with its page, any other chunk's text."""
    quoted = F.concat(F.lit("PDF page "), page.cast("string"), F.lit(': "'), best_sentence(chunk_text_, hint), F.lit('"'))
    return F.when(chunk_text_.isNull(), evidence).when(kind == "pdf", quoted).otherwise(chunk_text_)
