import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, run int, place long, digest string, row long, whole string, ident long, score double, key string, print long, stretch int, guest int"


def _words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(("th", "er", "on", "an", "re", "he", "in", "ed")) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls, blanks, copies, near copies, a very long text, repeated rows and odd characters."""
    base = _words(1, 300)
    texts = {
        1: None, 2: "", 3: " \t\n\r\x0b\x0c ", 4: "one", 5: "two words", 6: base, 7: base, 8: base.replace(" ", "\n"), 9: base + "  ",
        10: base.replace("the", "teh", 1), 11: _words(2, 15_000), 12: "é漢🎉 ́x  y z <|endoftext|> İΣς ﬁ ²½ don't I'VE", 13: "a" * 3000, 14: "ab " * 700,
        15: _words(3, 80) + " " + base[200:900], 16: base[200:900] + " " + _words(4, 80), 18: "Mail jane.roe@example.org or +1 (212) 555-0142.\nloser! you l.o.s.e.r",
    }
    rows = [(i, t) for i, t in texts.items()]
    rows += [(7, base), (7, base), (None, base), (None, None)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", None if t is None else len(t), *[None] * 11) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return _frame(spark, odd_rows).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: _frame(spark, rows)
