"""A store of named graphs: hashed buckets of quads and a manifest for each version.

Graphs are dealt into a fixed number of buckets by a hash of their names, so the number of
folders and files follows the number of buckets, not that of graphs.  Data files are never
changed: an operation writes new ones beside the old and then commits a manifest, which
says for each bucket which folders hold it.  That commit is a rename that fails if the
version is there already; so an operation takes place wholly or not at all, a reader sees
one version from plan to result, and of two writers the second starts anew from what the
first has left.  Files that no kept version names go with :meth:`QuadStore.vacuum`.

The commit is atomic where renaming is (HDFS and local file systems; an object store
without it needs one writer at a time).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrel.functions import terms as T

COLUMNS = ["g", "s", "p", "o"]


def lift(df: DataFrame, table: str, key: Column, literals: dict[str, tuple[Column, str | None]], edges: dict[str, Column] | None = None, namespace: str = "http://example.org/", graph: Column | None = None, one_pass: bool = False) -> DataFrame:
    """Quads of a table's rows: a type, a typed literal for each column, an IRI for each foreign key.

    ``literals`` maps a predicate's name to (column, datatype); ``edges`` maps one to the
    IRI's local part.  Null columns give no quad.

    The default form is a union with a branch for each predicate: a pattern with a constant
    predicate folds all other branches away, and its scan reads the columns of that one
    predicate.  ``one_pass`` reads the table once for all predicates, for writing a store.
    """
    name = lambda x: f"<{namespace}{x}>"
    pairs = [(T.TYPE, F.lit(name(table.capitalize())))]
    pairs += [(name(p), T.literal(c, d)) for p, (c, d) in literals.items()]
    pairs += [(name(p), T.iri(F.concat(F.lit(namespace), c))) for p, c in (edges or {}).items()]
    s = T.iri(F.concat(F.lit(f"{namespace}{table}/"), key.cast("string")))
    g = graph if graph is not None else F.lit(f"{namespace}graph/{table}")
    if one_pass:
        items = F.array(*[F.struct(F.lit(p).alias("p"), o.alias("o")) for p, o in pairs])
        return df.select(g.alias("g"), s.alias("s"), F.explode(items).alias("x")).select("g", "s", "x.p", "x.o").where("o IS NOT NULL")
    out = None
    for p, o in pairs:
        branch = df.select(g.alias("g"), s.alias("s"), F.lit(p).alias("p"), o.alias("o")).where("o IS NOT NULL")
        out = branch if out is None else out.unionByName(branch)
    return out


#: Buckets of a new store; folders that a bucket may be spread over before an append puts them together; attempts of a writer that others overtake.
BUCKETS = 64
FOLDERS = 8
ATTEMPTS = 10


class Overtaken(RuntimeError):
    """Another writer has committed the version."""


class QuadStore:
    """Quads below ``path``; ``keep`` are graphs that clearing never touches."""

    def __init__(self, spark: SparkSession, path: str, keep: set[str] | None = None, buckets: int = BUCKETS):
        self.spark, self.path, self.keep, self._buckets = spark, path.rstrip("/"), set(keep or ()), buckets

    # --- versions

    @cached_property
    def _files(self):
        path = self._path("")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, below: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{below}".rstrip("/"))

    def _names(self, below: str) -> list[str]:
        path = self._path(below)
        return sorted(s.getPath().getName() for s in self._files.listStatus(path)) if self._files.exists(path) else []

    def versions(self) -> list[int]:
        """The committed versions, the oldest first."""
        return [int(n.removesuffix(".json")) for n in self._names("manifests") if n.endswith(".json")]

    def _manifest(self, version: int | None = None) -> dict:
        """version, buckets (how many there are) and folders (of each bucket that has any)."""
        found = self.versions()
        if not found and version is None:
            return {"version": 0, "buckets": self._buckets, "folders": {}}
        number = found[-1] if version is None else version
        if number not in found:
            raise ValueError(f"no such version: {number}")
        stream = self._files.open(self._path(f"manifests/{number:012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        jvm = self.spark.sparkContext._jvm
        draft, final = self._path(f"manifests/.{uuid.uuid4().hex}"), self._path(f"manifests/{manifest['version']:012d}.json")
        stream = self._files.create(draft, False)
        stream.write(json.dumps(manifest).encode())
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri() if draft.toUri().getScheme() else self._files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(draft, final, options)
        except Exception as e:
            self._files.delete(draft, False)
            if self._files.exists(final):
                raise Overtaken(str(manifest["version"])) from e
            raise

    def _change(self, make: Callable[[dict], dict[int, list[str]] | None]) -> None:
        """Commit the folders that ``make`` makes of the newest manifest (None: no change); again if overtaken."""
        for _ in range(ATTEMPTS):
            old = self._manifest()
            folders = make(old)
            if folders is None:
                return
            try:
                return self._commit({"version": old["version"] + 1, "buckets": old["buckets"], "folders": {str(b): f for b, f in folders.items() if f}})
            except Overtaken:
                continue
        raise Overtaken(f"{ATTEMPTS} times")

    # --- data

    def _write(self, rows: DataFrame, buckets: int) -> dict[int, str]:
        """Write quads to a new folder; the folder below which each bucket's are, of those that have any."""
        folder = f"data/{uuid.uuid4().hex}"
        dealt = rows.select(*COLUMNS, self._bucket(buckets).alias("b"))
        dealt.hint("rebalance", F.col("b")).write.partitionBy("b").parquet(f"{self.path}/{folder}")
        return {int(n.removeprefix("b=")): folder for n in self._names(folder) if n.startswith("b=")}

    @staticmethod
    def _bucket(buckets: int) -> Column:
        return F.pmod(F.xxhash64("g"), F.lit(buckets)).cast("int")

    def _of(self, manifest: dict, buckets: set[int] | None = None) -> DataFrame:
        """The quads of a version, or of some of its buckets."""
        paths = [f"{self.path}/{f}/b={b}" for b, folders in manifest["folders"].items() if buckets is None or int(b) in buckets for f in folders]
        empty = "g string, s string, p string, o string"
        return self.spark.read.schema(empty).parquet(*paths) if paths else self.spark.createDataFrame([], empty)

    def _folders(self, manifest: dict) -> dict[int, list[str]]:
        return {int(b): list(f) for b, f in manifest["folders"].items()}

    def _buckets_of(self, graphs: list[str], manifest: dict) -> set[int]:
        if not graphs:
            return set()
        return {r[0] for r in self.spark.createDataFrame([(g,) for g in graphs], "g string").select(self._bucket(manifest["buckets"])).distinct().collect()}

    def read(self, version: int | None = None) -> DataFrame:
        """The quads of a version, the newest unless another is named."""
        return self._of(self._manifest(version))

    def graph(self, *names: str) -> DataFrame:
        """The quads of some graphs, from their buckets."""
        manifest = self._manifest()
        return self._of(manifest, self._buckets_of(list(names), manifest)).where(F.col("g").isin(list(names)))

    def exists(self) -> bool:
        """Whether anything has been committed."""
        return bool(self.versions())

    def graphs(self) -> DataFrame:
        """(g) of all graphs, in order."""
        return self.read().select("g").distinct().orderBy("g")

    # --- operations

    def append(self, quads: DataFrame) -> None:
        """Add triples to their graphs; those already there stay once."""
        staged: dict = {}

        def make(old: dict) -> dict | None:
            if not staged:
                staged.update(self._write(quads.select(*COLUMNS).distinct(), old["buckets"]) or {-1: ""})
            folders, new = self._folders(old), {b: f for b, f in staged.items() if b >= 0}
            met = {b: f for b, f in new.items() if b in folders}
            if met:
                there = self._of(old, set(met))
                rows = self._of({"folders": {b: [f] for b, f in met.items()}}).join(there, COLUMNS, "left_anti")
                new = {b: f for b, f in new.items() if b not in met} | self._write(rows, old["buckets"])
            for b, f in new.items():
                folders.setdefault(b, []).append(f)
            crowded = {b for b, f in folders.items() if len(f) > FOLDERS}
            if crowded:
                whole = self._write(self._of({"folders": {b: folders[b] for b in crowded}}), old["buckets"])
                folders |= {b: [whole[b]] for b in crowded}
            return folders if new else None

        self._change(make)

    def replace(self, quads: DataFrame) -> None:
        """Each graph of ``quads`` becomes just what ``quads`` has of it; other graphs stay."""
        self._put(quads, lambda old, new: (self._of(old, set(new)), {b: f for b, f in self._folders(old).items() if b not in new}))

    def _put(self, quads: DataFrame, rest: Callable[[dict, dict], tuple[DataFrame, dict[int, list[str]]]]) -> None:
        """Commit new graphs beside what ``rest`` leaves of the old ones: rows to write again, less those of the new graphs, and folders that stay as they are."""
        staged: dict = {}

        def make(old: dict) -> dict | None:
            if not staged:
                staged.update(self._write(quads.select(*COLUMNS).distinct(), old["buckets"]) or {-1: ""})
            new = {b: f for b, f in staged.items() if b >= 0}
            rows, folders = rest(old, new)
            fresh = self._of({"folders": {b: [f] for b, f in new.items()}})
            left = self._write(rows.join(fresh.select("g").distinct(), "g", "left_anti"), old["buckets"])
            for part in (left, new):
                for b, f in part.items():
                    folders.setdefault(b, []).append(f)
            return folders

        self._change(make)

    def clear(self, *graphs: str) -> list[str]:
        """Drop graphs; those dropped, in the order asked."""
        dropped: list[str] = []

        def make(old: dict) -> dict | None:
            touched = self._buckets_of(list(graphs), old)
            rows = self._of(old, touched)
            found = {r.g for r in rows.where(F.col("g").isin(list(graphs))).select("g").distinct().collect()}  # as many as were asked
            dropped[:] = [g for g in graphs if g in found]
            if not found:
                return None
            left = self._write(rows.where(~F.col("g").isin(list(graphs))), old["buckets"])
            return {b: f for b, f in self._folders(old).items() if b not in touched} | {b: [f] for b, f in left.items()}

        self._change(make)
        return dropped

    def clear_others(self) -> DataFrame:
        """Drop all graphs but those to keep; (g) of those dropped, in order, read from the version before."""
        before = self._manifest()

        def make(old: dict) -> dict | None:
            before.update(old)
            return {b: [f] for b, f in self._write(self._kept(old), old["buckets"]).items()}

        self._change(make)
        return self._of(before).where(~F.col("g").isin(sorted(self.keep))).select("g").distinct().orderBy("g")

    def _kept(self, manifest: dict) -> DataFrame:
        keep = sorted(self.keep)
        return self._of(manifest, self._buckets_of(keep, manifest)).where(F.col("g").isin(keep))

    def load(self, quads: DataFrame, mode: str = "replace_all") -> None:
        """``replace_one`` (the graphs of ``quads`` only), ``append``, or ``replace_all`` (all but those to keep); each one commit."""
        if mode == "append":
            self.append(quads)
        elif mode == "replace_one":
            self.replace(quads)
        elif mode == "replace_all":
            self._put(quads, lambda old, new: (self._kept(old), {}))
        else:
            raise ValueError(f"no such mode: {mode}")

    def vacuum(self, versions: int = 1) -> int:
        """Forget all but the newest ``versions`` and delete the folders that none of these names; how many went.

        Readers of forgotten versions and writers at work lose their files: not to be run beside them.
        """
        found = self.versions()
        kept = found[-versions:]
        named = {f.split("/")[1] for v in kept for folders in self._manifest(v)["folders"].values() for f in folders}
        gone = [n for n in self._names("data") if n not in named]
        for v in found[:-versions]:
            self._files.delete(self._path(f"manifests/{v:012d}.json"), False)
        for n in gone:
            self._files.delete(self._path(f"data/{n}"), True)
        return len(gone)


def kept_after_clear(quads: DataFrame, keep: DataFrame) -> DataFrame:
    """The quads that clearing all graphs but ``keep(g)`` leaves, as a plan."""
    return quads.join(keep, "g", "left_semi")


def replaced(quads: DataFrame, new: DataFrame) -> DataFrame:
    """The quads after the graphs of ``new`` are replaced, as a plan."""
    old = quads.join(new.select("g").distinct(), "g", "left_anti")
    return old.unionByName(new.select(*COLUMNS).distinct())
