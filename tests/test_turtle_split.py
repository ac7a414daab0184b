"""Turtle files cut anywhere, against the parser of whole files."""

import random
import re
from collections import Counter

import pytest

from quadrel.sources import turtle, turtle_split


def document(r, n):
    """A document with directives on the way, long strings that look like statements, comments, blank nodes and lists."""
    out = ["@prefix ex: <http://e/> .", "PREFIX o: <http://o/>"]
    literal = lambda: r.choice(['"a. b"', "'x'@en-GB", '"""one. \n ex:no ex:p "q" .\n\n# no "comment\n"" end"""', "'''it's\n. @prefix ex: <http://wrong/> .\n'''", "1.5", "3", '"7"^^ex:t', "true", '"esc \\" . \\n"', '""', "\"\"\"\\\"\"\"\""])
    node = lambda: r.choice(["ex:a.b", "o:c", "<http://x/y.z#f>", "_:n1", "_:2", "<rel.x>"])
    for i in range(n):
        form = r.randrange(9)
        if form == 0:
            out.append(f"@prefix ex: <http://e{r.randint(0, 3)}/> .")
        elif form == 1:
            out.append(r.choice(["# a comment. with ends .", "BASE <http://base/x/>", "@base <http://b.c/> .", '# """']))
        elif form == 2:
            out.append(f"{node()} ex:p [ ex:q {literal()} ; o:r [ a ex:T ] ] .")
        elif form == 3:
            out.append(f"{node()} ex:list ( {literal()} {node()}\n [ ex:i {i} ] ) .")
        elif form == 4:
            out.append(f"<< {node()} ex:p {literal()} >> <{turtle.PROV_DERIVED}> {literal()} ; <{turtle.DCT_SOURCE}> <http://s/{i}> .")
        else:
            out.append(f"{node()} ex:p{i}\n  {literal()} , {node()} ;\r\n\t a ex:C .")
    return "\n".join(out) + r.choice(["", "\n", "\n\n# end"])


def canonical(triples):
    """Triples with nodes that have no label named by what they hold."""
    by = {}
    for s, p, o in triples:
        by.setdefault(s, []).append((p, o))
    plain = lambda t: "{" + ",".join(sorted(f"{p} {plain(o)}" for p, o in by.get(t, []))) + "}" if re.fullmatch(r"_:[^ ]*\.\d+", t) else t
    return Counter((plain(s), p, plain(o)) for s, p, o in set(triples))


@pytest.mark.parametrize("size", ["150b", "1m"])
def test_files_cut_anywhere_equal_whole_files(spark, tmp_path, monkeypatch, size):
    r = random.Random(size)
    monkeypatch.setattr(turtle_split, "PIECE", 120)
    docs = {f"f{i}.ttl": document(r, r.choice((0, 3, 12))) for i in range(5)}
    docs["bad.ttl"] = "@prefix ex: <http://e/> .\n" + "ex:a ex:b ex:c .\n" * 9 + "ex:a ex:b .\n" + "ex:a ex:b ex:d .\n" * 9
    docs["open.ttl"] = '@prefix ex: <http://e/> .\nex:a ex:b """never ends . \n ex:a ex:b ex:c .\n'
    docs["none.ttl"], docs["__left.ttl"], docs["long é.ttl"] = "", "no turtle", '<http://s> <http://p> """' + "x . y\n" * 150 + '""" .'
    for name, text in docs.items():
        (tmp_path / name).write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        quads, notes, errors = turtle_split.read_parts(spark, str(tmp_path))
        quads, notes, errors = quads.collect(), notes.collect(), {x.g for x in errors.collect()}
        blocks = spark.read.text(str(tmp_path / "long é.ttl")).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert blocks > 5 or size == "1m"
    assert errors == {"urn:graph:bad", "urn:graph:open"}
    for name, text in docs.items():
        g = "urn:graph:" + name.removesuffix(".ttl").lower()
        own = [(q.s, q.p, q.o) for q in quads if q.g == g]
        if g in errors or name.startswith("__"):
            assert not own
            continue
        whole = turtle.parse(text, scope=g.rsplit("/", 1)[-1], base=g)
        assert canonical(own) == canonical(whole.triples), name
        assert Counter((a.s, a.p, a.o, a.evidence, a.source) for a in notes if a.g == g) == Counter(whole.annotations)


def test_states_and_ends():
    assert turtle_split.scan('a:b c:d "x. y" . # no. end\ne:f', 0) == ([16], 0)
    assert turtle_split.scan('x . """ . a:b c:d """', 1) == ([9], 1)
    assert turtle_split.scan("no end of it", 2) == ([], 2)
    with pytest.raises(turtle.TurtleError):
        turtle_split.scan("{{{ \x00", 0)
    assert turtle_split.directives('@prefix a: <x> .\nBASE <y>\na:b a:c "t"@prefix , "base" .') == [("prefix", "a:", "<x>"), ("base", "", "<y>")]
