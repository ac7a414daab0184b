import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quadrel.functions import terms as T
from quadrel.plans import shacl
from quadrel.sources import turtle


def test_grammar():
    p = turtle.parse(
        '@base <http://b/> . PREFIX e: <http://e/> # note\n'
        '<x> a e:C ; e:p "a\\"b\\n"@EN-us , """long "quoted" text""" , 5, -1.5, 2e3, true, e:κ_1, [ e:q e:r ; e:s ( 1 e:t ) ] ; .\n'
        '<< <http://b/x> e:p 5 >> <http://www.w3.org/ns/prov#wasDerivedFrom> "two\\nlines" ; <http://purl.org/dc/terms/source> <http://s> .\n'
    )
    objects = {o for s, q, o in p.triples if s == "<http://b/x>"}
    assert {'"a"b\n"@en-us', '"long "quoted" text"', f'"5"^^{T.XSD}integer', f'"-1.5"^^{T.XSD}decimal', f'"2e3"^^{T.XSD}double', f'"true"^^{T.XSD}boolean', "<http://e/κ_1>"} <= objects
    assert len(p.triples) == 9 + 2 + 4
    assert p.annotations == [("<http://b/x>", "<http://e/p>", f'"5"^^{T.XSD}integer', '"two\nlines"', "<http://s>")]
    for bad in ("<a> <b> .", "x:y <b> <c> .", '<a> <b> "c', "<a> <b> <c>"):
        with pytest.raises((turtle.TurtleError, IndexError)):
            turtle.parse(bad)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.text(min_size=0, max_size=12).filter(lambda x: "\x00" not in x and not any(0xD800 <= ord(c) < 0xE000 for c in x)), st.sampled_from(["", "@en", f"^^{T.XSD}date"])), max_size=6))
def test_written_text_reads_back(values):
    triples = {(f"<urn:{s}>", "<urn:p>", f'"{o}"{suffix}') for s, o, suffix in values}
    notes = [(*t, '"e"', None) for t in sorted(triples)]
    back = turtle.parse(turtle.write_text(triples, notes))
    assert set(back.triples) == triples and back.annotations == notes


def test_documents(spark, tmp_path):
    (tmp_path / "Good One.ttl").write_text('<urn:a> <urn:p> 1, 1 .\n<< <urn:a> <urn:p> 1 >> <http://www.w3.org/ns/prov#wasDerivedFrom> "e" .\n')
    (tmp_path / "bad.ttl").write_text("<urn:a> <urn:p>")
    (tmp_path / "__skip.ttl").write_text("<urn:z> <urn:p> 1 .")
    quads, notes, errors = turtle.parse_documents(turtle.read_documents(spark, str(tmp_path)))
    assert [tuple(r) for r in quads.collect()] == [("urn:graph:good one", "<urn:a>", "<urn:p>", f'"1"^^{T.XSD}integer')]
    assert notes.count() == 1 and [r.g for r in errors.collect()] == ["urn:graph:bad"]
    text = "<a> <b> <c> .\n  << x >> prov:wasDerivedFrom 1 .\ny >> prov:wasDerivedFrom\n"
    row = spark.createDataFrame([(text,)], "t string").select(
        turtle.strip_annotations(F.col("t")).alias("a"), turtle.strip_annotations(F.col("t"), repair=True).alias("b"), turtle.extract_annotations(F.col("t")).alias("c"),
        turtle.quoted_triple(F.lit('<< <urn:s> x:p "a b"@en >> x:q 1 .')).alias("d"), turtle.quoted_triple(F.lit("nothing")).alias("e"),
    ).first()
    assert row.a.count("\n") == 2 and "y >>" in row.a and "y >>" not in row.b and len(row.c) == 1
    assert tuple(row.d) == ("<urn:s>", "x:p", '"a b"@en') and row.e is None


SHAPES = """
@prefix sh: <http://www.w3.org/ns/shacl#> . @prefix : <http://x/> . @prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
:H a sh:NodeShape ; sh:or ( [ sh:class :A ] [ sh:class :B ] ) .
:S1 a sh:NodeShape ; sh:targetClass :C, :D ; sh:property [ sh:path :p ; sh:minCount 1 ; sh:maxCount 2 ; sh:node :H ] .
:S1 sh:property [ sh:path :p ; sh:minCount 1 ; sh:message "again" ] .
:S2 a sh:NodeShape ; sh:targetSubjectsOf :q ; sh:class :A .
:S3 a sh:NodeShape ; sh:targetObjectsOf :q ; sh:or ( [ sh:node :H ] [ sh:class :C ] ) ; sh:severity sh:Warning .
:S4 a sh:NodeShape ; sh:targetNode :n ; sh:property [ sh:path :v ; sh:datatype xsd:integer ; sh:minInclusive 0 ; sh:pattern "^[0-9]" ; sh:in ( 1 2 3 ) ] .
:S5 a sh:NodeShape ; sh:targetClass :E ; sh:node [ sh:property [ sh:path :w ; sh:minCount 1 ] ] ; sh:not [ sh:class :F ] .
"""
FAULTS = """
@prefix : <http://x/> .
:c1 a :C . :c2 a :C ; :p :a1, :a2, :x . :d1 a :D, :E ; :p :b1 ; :w 1 . :e1 a :E, :F .
:a1 a :A . :a2 a :A . :b1 a :B . :a1 :q :c1 , :x . :c1 :q :b1 .
:n :v 1, "x", -5 .
"""


def test_components_both_ways(spark):
    rows = [(g, *t) for g in ("g1", "g2") for t in turtle.parse(FAULTS).triples]
    rows += [("g2", "<http://x/c1>", "<http://x/p>", "<http://x/a1>")]
    report = shacl.validate(spark.createDataFrame(rows, "g string, s string, p string, o string"), SHAPES).cache()
    short = lambda x: None if x is None else x.replace("<http://x/", "").rstrip(">").replace(f"^^{T.XSD}integer", "")
    got = sorted((short(r.shape), short(r.focus), r.component, short(r.value), r.severity) for r in report.where("g = 'g1'").collect() if r.component not in ("pattern", "in", "datatype", "minInclusive"))
    none = None
    assert sorted(got, key=str) == sorted([
        ("S1", "c1", "minCount", none, "Violation"), ("S1", "c1", "minCount", none, "Violation"),
        ("S1", "c2", "maxCount", none, "Violation"), ("S1", "c2", "node", "x", "Violation"),
        ("S2", "c1", "class", "c1", "Violation"), ("S3", "x", "or", "x", "Warning"),
        ("S5", "e1", "node", "e1", "Violation"), ("S5", "e1", "not", "e1", "Violation"),
    ], key=str)
    of = lambda c: sorted(short(r.value) for r in report.where(f"g = 'g1' AND component = '{c}'").collect())
    assert of("datatype") == ['"x"'] and of("minInclusive") == ['"-5"', '"x"'] and of("pattern") == ['"-5"', '"x"'] and of("in") == ['"-5"', '"x"']
    assert report.where("g = 'g2' AND focus = '<http://x/c1>' AND component = 'minCount'").count() == 0
    graphs = spark.createDataFrame([("g1",), ("g2",), ("g3",)], "g string")
    verdicts = {r.g: r for r in shacl.verdicts(graphs, report).collect()}
    assert not verdicts["g1"].conforms and verdicts["g1"].warnings == 1 and verdicts["g3"].conforms
    assert shacl.rendered(report).count() == 2
    with pytest.raises(ValueError):
        shacl.read_shapes("@prefix sh: <http://www.w3.org/ns/shacl#> . <urn:s> sh:targetClass <urn:c> ; sh:lessThan <urn:d> .")


def test_sinks(spark, tmp_path):
    from quadrel.sources import sinks

    quads = spark.createDataFrame([("g1", "<urn:a>", "<urn:p>", '"x\ny"'), ("g2", "<urn:b>", T.TYPE, "<urn:C>")], "g string, s string, p string, o string")
    sinks.write_turtle(quads, str(tmp_path / "t"))
    assert "\\ny" in next((tmp_path / "t" / "g=g1").glob("*.txt")).read_text()
    report = shacl.validate(quads, "@prefix sh: <http://www.w3.org/ns/shacl#> . <urn:S> sh:targetClass <urn:C> ; sh:property [ sh:path <urn:p> ; sh:minCount 1 ; sh:message \"need p\" ] .")
    sinks.write_report(report, str(tmp_path / "r"))
    assert "need p" in next((tmp_path / "r" / "text" / "g=g2").glob("*.txt")).read_text()
    sinks.write_json(spark.createDataFrame([("κ", 1)], "a string, b int"), str(tmp_path / "j"))
    assert any("κ" in p.read_text() for p in (tmp_path / "j").glob("*.json"))
    filled = sinks.with_fallback(spark.createDataFrame([(1, None), (2, "x")], "k int, v string"), spark.createDataFrame([(1, "f"), (2, "g")], "k int, v string"), "k", "v")
    assert sorted(tuple(r) for r in filled.collect()) == [(1, "f"), (2, "x")]


def test_reports_of_many_graphs_share_files(spark, tmp_path, monkeypatch):
    """Every report and result is there, whole and with its graph, in as many files as were asked for, however many graphs there are."""
    from quadrel.plans import operator_catalog as catalog
    from quadrel.sources import sinks

    graphs = [*(f"g{i}" for i in range(60)), "007", "a/b=c", "x\ny", "é"]
    quads = spark.createDataFrame([(g, f"<urn:{k}>", T.TYPE, "<urn:C>") for g in graphs for k in "ab"], "g string, s string, p string, o string")
    report = shacl.validate(quads, "@prefix sh: <http://www.w3.org/ns/shacl#> . <urn:S> sh:targetClass <urn:C> ; sh:property [ sh:path <urn:p> ; sh:minCount 1 ; sh:message \"need é\" ] .").cache()
    sinks.write_report(report, str(tmp_path / "r"), parts=3)
    ordered = lambda df: sorted(map(tuple, df.collect()), key=str)
    want = ordered(shacl.rendered(report))
    assert ordered(sinks.read_reports(spark, str(tmp_path / "r"))) == want and len(want) == 64 and want[0][1].count("need é") == 2
    assert ordered(spark.read.parquet(str(tmp_path / "r" / "results")).select(report.columns)) == ordered(report)
    files = lambda of: [p for kind in ("text", "results") for p in (of / kind).rglob("part-*")]
    assert len(files(tmp_path / "r")) <= 6

    monkeypatch.setattr(sinks, "scratch", lambda spark, name: str(tmp_path / name))
    lines = catalog.report_files(spark, "/root/testdata/sf0.01").collect()
    assert len({x.g for x in lines}) > 8 * len(files(tmp_path / "report")) > 0
