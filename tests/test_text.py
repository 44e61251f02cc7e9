"""String rules."""

import unicodedata

from pyspark.sql import functions as F

from citeweave.functions.maps import last_wins, zip_short
from citeweave.functions.text import candidate_title, collapse, match_key, nfkd, normalize_text, strip, whole_number


def column(spark, values, *builders):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [tuple(r)[1:] for r in df.select("i", *[b(F.col("s")) for b in builders]).orderBy("i").collect()]


def test_nfkd_of_every_assigned_character(spark):
    """The JVM's tables are newer: they may only differ for characters this Python does not know."""
    points = [c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn"]
    texts = ["".join("x" + chr(c) for c in points[i:i + 500]) for i in range(0, len(points), 500)]
    for text, (found,) in zip(texts, column(spark, texts, nfkd)):
        assert found == unicodedata.normalize("NFKD", text)


def test_white_space(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [f"{s}a{s}{s}b{s}" for s in spaces] + ["", " ", "a"]
    for text, (stripped, collapsed) in zip(texts, column(spark, texts, strip, collapse)):
        assert (stripped, collapsed) == (text.strip(), " ".join(text.split()))


def test_normalize(spark):
    cases = {
        "“A’s – b”": "A's - b",
        "ﬁ ½": "fi 1⁄2",
        "a\xa0\t b": "a b",
        '"x"': "x",
        "'x'": "x",
        '""x""': '"x"',
        "\"'x'\"": "'x'",
        '"': "",
        "": "",
        "'a\"": "'a\"",
        None: None,
    }
    assert column(spark, list(cases), normalize_text) == [(v,) for v in cases.values()]


def test_candidate_and_key(spark):
    cases = {
        "[CITATION] [C] A  title": ("A title", "a title"),
        "“\"Quoted twice\"”": ("Quoted twice", "quoted twice"),
        "Uptake of [18F] in X": ("Uptake of in X", "uptake of in x"),
        "[open bracket": ("[open bracket", "[open bracket"),
        "[PDF] 'Late quotes'": ("'Late quotes'", "late quotes"),
    }
    found = column(spark, list(cases), candidate_title, lambda s: match_key(candidate_title(s)))
    assert found == list(cases.values())


def test_whole_number(spark):
    cases = {"12": 12, "+3": 3, "-4": -4, "1_000": 1000, "1,234": None, "": None, "1.5": None, "x": None, "9" * 19: None}
    assert column(spark, list(cases), whole_number) == [(v,) for v in cases.values()]


def test_maps(spark):
    df = spark.createDataFrame(
        [(["a", "b", "a", "c"], ["1", "2", "3"]), (["a"], ["1", "2"]), ([], ["1"]), (["a"], [None])],
        "k array<string>, v array<string>",
    )
    found = [dict(r[0]) for r in df.select(last_wins(zip_short(F.col("k"), F.col("v")))).collect()]
    assert found == [{"a": "3", "b": "2"}, {"a": "1"}, {}, {"a": None}]


def test_last_wins_on_a_long_list(spark):
    pairs = F.transform(F.sequence(F.lit(0), F.lit(99_999)), lambda i: F.struct((i % 50_000).alias("k"), i.alias("v")))
    (found,) = spark.range(1).select(last_wins(pairs).alias("m")).collect()
    assert found.m == {k: k + 50_000 for k in range(50_000)}
