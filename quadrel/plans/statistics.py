"""Join orders from characteristic sets.

A subject's characteristic set is the set of its predicates.  How many subjects have each
set, and how many triples of each predicate these have, says how many rows a star of
patterns around one subject gives far better than its number of constants; stars are put
together by the distinct values of the variables they share.  The figures are gathered once
for a store and used for any query on it; they steer the order of joins only, so old
figures cost time, never rows.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Most sets, and most objects of a predicate, that are kept one by one; the rest are kept as averages of their predicates.
SETS = 2000
OBJECTS = 32
#: Most patterns whose orders are all compared; beyond, the next is the one that leaves fewest rows.
EXHAUSTIVE = 10


@dataclass
class Statistics:
    #: (predicates of the set, its subjects, triples of each predicate)
    sets: list[tuple[frozenset[str], int, dict[str, int]]] = field(default_factory=list)
    #: Distinct objects, and triples, of each predicate.
    objects: dict[str, int] = field(default_factory=dict)
    triples: dict[str, int] = field(default_factory=dict)
    #: Triples of a predicate's commonest objects.
    common: dict[tuple[str, str], int] = field(default_factory=dict)
    subjects: int = 0

    @classmethod
    def gather(cls, quads: DataFrame) -> Statistics:
        """The figures of ``quads(g, s, p, o)``, its graphs taken together; three aggregations, bounded rows to the driver."""
        by_subject = quads.repartition("s").groupBy("s", "p").agg(F.count("*").alias("n")).groupBy("s").agg(F.sort_array(F.collect_list(F.struct("p", "n"))).alias("has"))
        # Subjects that are alike in their triples, too, become one row before anything is taken apart.
        alike = by_subject.groupBy(F.transform("has", lambda x: x["p"]).alias("set"), F.transform("has", lambda x: x["n"]).alias("each")).agg(F.count("*").alias("subjects"))
        of_set = alike.select("set", "subjects", F.posexplode("each").alias("at", "n"))
        totals = of_set.groupBy("set", "at").agg(F.sum("subjects").alias("subjects"), F.sum(F.col("n") * F.col("subjects")).alias("n"))
        rows = totals.groupBy("set").agg(F.max("subjects").alias("subjects"), F.sort_array(F.collect_list(F.struct("at", "n"))).alias("n")).persist()
        kept = rows.orderBy(F.desc("subjects"), "set").limit(SETS).collect()
        out = cls(subjects=rows.agg(F.sum("subjects")).first()[0] or 0)
        rows.unpersist()
        for r in kept:
            out.sets.append((frozenset(r.set), r.subjects, {p: x.n for p, x in zip(r.set, r.n, strict=True)}))
        pairs = quads.groupBy("p", "o").agg(F.count("*").alias("n"))
        for r in pairs.groupBy("p").agg(F.count("*").alias("objects"), F.sum("n").alias("n")).orderBy(F.desc("n")).limit(SETS).collect():
            out.objects[r.p], out.triples[r.p] = r.objects, r.n
        first = pairs.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy(F.desc("n"), "o"))).where(F.col("r") <= OBJECTS)
        out.common = {(r.p, r.o): r.n for r in first.orderBy(F.desc("n")).limit(SETS * OBJECTS).collect()}
        # Subjects of sets that were not kept count as if their predicates came alone.
        seen: dict[str, int] = defaultdict(int)
        for _, _, n in out.sets:
            for p, k in n.items():
                seen[p] += k
        out.sets += [(frozenset([p]), out.triples[p] - seen[p], {p: out.triples[p] - seen[p]}) for p in out.triples if out.triples[p] > seen[p]]
        return out

    def share(self, p: str, o: str) -> float:
        """The share of a predicate's triples that have an object."""
        total = max(1, self.triples.get(p, 0))
        if (p, o) in self.common:
            return self.common[p, o] / total
        listed = [n for (q, _), n in self.common.items() if q == p]
        others = self.objects.get(p, 0) - len(listed)
        return max(0.5, (total - sum(listed)) / others) / total if others > 0 else 0.5 / total

    def star(self, patterns: list) -> tuple[float, float]:
        """(rows, distinct subjects) of patterns around one subject: (predicate or None, constant object or None) each."""
        wanted = {p for p, _ in patterns if p is not None}
        rows = subjects = 0.0
        for have, count, n in self.sets:
            if wanted <= have:
                here, with_object = float(count), 1.0
                for p, o in patterns:
                    each = (n[p] if p is not None else sum(n.values())) / count
                    share = 1.0 if o is None else self.share(p, o) if p is not None else 1 / max(1, sum(self.objects.values()))
                    here *= each * share
                    with_object *= min(1.0, each * share)
                rows += here
                subjects += count * with_object
        return rows, subjects

    def rows(self, patterns: list[tuple], known: dict[str, float] | None = None) -> float:
        """Estimated rows of patterns (s, p, o), each ("var", name) or ("term", text); ``known`` variables have so many values."""
        stars: dict[tuple, list] = defaultdict(list)
        for s, p, o in patterns:
            stars[s].append((p, o))
        total, values = 1.0, defaultdict(list)
        for s, held in stars.items():
            shapes = [(p[1] if p[0] == "term" else None, o[1] if o[0] == "term" else None) for p, o in held]
            rows, subjects = self.star(shapes)
            if s[0] == "term":
                rows /= max(1.0, subjects)
            else:
                values[s[1]].append(max(subjects, 1e-9))
            for p, o in held:
                if o[0] == "var":
                    distinct = self.objects.get(p[1], 1) if p[0] == "term" else sum(self.objects.values())
                    values[o[1]].append(max(min(float(distinct), rows), 1e-9))
                if p[0] == "var":
                    values[p[1]].append(max(1.0, float(len(self.objects))))
            total *= rows
        for name, found in values.items():
            if known and name in known:
                found = [*found, max(known[name], 1e-9)]
                total *= known[name]
            for d in sorted(found)[1:]:  # one value's rows meet those of the others
                total /= d
        return total

    def order(self, patterns: list[tuple], known: dict[str, float] | None = None) -> list[int]:
        """Places of the patterns in the order in which the rows in between, all together, are fewest.

        A pattern follows one that it shares a variable with, as far as there is one.
        """
        known = known or {}
        names = [{t[1] for t in x if t[0] == "var"} for x in patterns]
        sizes: dict[frozenset, float] = {}

        def size(chosen: frozenset) -> float:
            if chosen not in sizes:
                sizes[chosen] = self.rows([patterns[i] for i in sorted(chosen)], known)
            return sizes[chosen]

        def nexts(chosen: frozenset) -> list[int]:
            left = [i for i in range(len(patterns)) if i not in chosen]
            bound = set(known).union(*(names[i] for i in chosen))
            return [i for i in left if not names[i] or names[i] & bound] or left if bound else left

        if len(patterns) > EXHAUSTIVE:
            chosen, out = frozenset(), []
            while len(out) < len(patterns):
                i = min(nexts(chosen), key=lambda i: (size(chosen | {i}), i))
                out.append(i)
                chosen |= {i}
            return out
        # Cost of an order: the rows after each of its joins, and those of each pattern that is joined.
        alone = [size(frozenset([i])) for i in range(len(patterns))]
        best: dict[frozenset, tuple[float, tuple]] = {frozenset(): (0.0, ())}
        for _ in patterns:
            ahead: dict[frozenset, tuple[float, tuple]] = {}
            for chosen, (cost, way) in best.items():
                for i in nexts(chosen):
                    whole = chosen | {i}
                    now = (cost + alone[i] + (size(whole) if chosen else 0.0), (*way, i))
                    if whole not in ahead or now < ahead[whole]:
                        ahead[whole] = now
            best = ahead
        return list(best[frozenset(range(len(patterns)))][1])
