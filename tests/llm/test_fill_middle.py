import hashlib
import random
import re

from quadrel.llm import fill_middle

SENTINELS = ("<P>", "<S>", "<M>")


def brute(ident, text, seed=1, share=90, suffix_first=20):
    """(n, form, prefix_chars, middle_chars, output) of a text, in plain Python."""
    text = text or ""
    digits = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    if not text or any(s in text for s in SENTINELS) or h3 % 100 >= share:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def more_rows():
    r = random.Random(11)
    parts = ["<", ">", "P", "S", "M", "<P", "S>", "<M>", "a", "é", "漢", "🎉", "\n", "\r\n", " ", "́", "$1", "\\"]
    return [(1000 + i, "".join(r.choice(parts) for _ in range(r.randint(0, 12)))) for i in range(600)] + [(9, "🎉" * 50), (-5, "minus"), (2**62, "large id"), (3, "<P>")]


def test_transform_equals_brute_force(make, odd_rows, none):
    rows = odd_rows + more_rows()
    for seed in (1, 7):
        made = fill_middle.transform(make(rows), seed=seed)
        got = sorted(map(repr, (tuple(r) for r in made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect())))
        assert got == sorted(repr((i, *brute(i, t, seed))) for i, t in rows)
    forms = [brute(i, t)[1] for i, t in rows]
    assert {"plain", "psm", "spm"} == set(forms)
    assert fill_middle.transform(none).count() == 0


def test_restoring_returns_every_text(make, odd_rows):
    rows = odd_rows + more_rows()
    made = fill_middle.transform(make(rows))
    back = made.select("text", fill_middle.restored(made["output"], made["form"]).alias("back")).collect()
    assert len(back) == len(rows) and all(r.text == r.back for r in back)
    assert fill_middle.digests(make(rows)).where("restored_sha256 IS NULL").count() == 0


def test_text_that_is_no_transformed_text_restores_to_null(spark):
    bad = ["", "<P>a<S>b", "x<P>a<S>b<M>c", "<P>a<P>b<M>c", "<P>a<S>b<M>c<M>", "plain"]
    df = spark.createDataFrame([(t, "psm") for t in bad] + [("<M>c<S>b<P>a", "psm")], "output string, form string")
    got = [r[0] for r in df.select(fill_middle.restored(df["output"], df["form"])).collect()]
    assert got == [None] * len(bad) + ["acb"]


def test_digests_are_native_and_cut_once(make, odd_rows):
    df = fill_middle.digests(make(odd_rows))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert plan.count("regexp_extract_all(text") == 1
    want = sorted(repr((i, *brute(i, t)[:4], hashlib.sha256(brute(i, t)[4].encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())) for i, t in odd_rows)
    assert sorted(repr(tuple(r)) for r in df.collect()) == want
