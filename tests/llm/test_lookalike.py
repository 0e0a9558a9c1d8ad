import unicodedata

from kinfold.llm.lookalike import lookalike_groups, lookalike_pairs, normalize_text, width_forms


def forms(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.y for r in normalize_text(df, "t", "y").orderBy("i").collect()]


def test_forms(spark):
    cases = {
        "Ｔｅｓｔ１２，（ａ）": "Test12,(a)", "été": "été", "zero​width⁠­﻿": "zerowidth", "a b c　d e\tf": "a b c d e f",
        "Ваbylоn": "Babylon", "Νοva": "Nova", "ﬁn ﬂow": "fin flow", "ӧ": "ö", "Ёё": "Ëë", "plain text": "plain text", "": "", "Déjà vu": "Déjà vu", "a’b": "a’b", "x–y": "x–y", "中文。": "中文。",
    }
    assert forms(spark, [*cases, None]) == [*cases.values(), None]


def test_stable_and_apart(spark):
    texts = ["Case", "case", "é", "e", "a-b", "a–b", "ſ", "s", "²", "2"]
    got = forms(spark, texts)
    assert len(set(got)) == len(texts) and forms(spark, got) == got
    one, by, longer = width_forms()
    assert all(unicodedata.normalize("NFKC", a) == b for a, b in [*zip(one, by, strict=True), *longer])


def test_pairs(spark):
    rows = [("t", "1", "аbc"), ("t", "2", "abc"), ("t", "3", "ａｂｃ"), ("t", "3", "ａｂｃ"), ("t", "4", "Abc"), ("u", "5", "abc"), ("t", "6", None), ("t", "7", ""), ("t", "8", "​"), ("t", None, "abc"), (None, "9", "abc")]
    df = spark.createDataFrame(rows, "f string, h string, v string").selectExpr("*", "'x' AS form", "1 AS digest", "0 AS y")
    assert sorted(tuple(r) for r in lookalike_pairs(df, ["f"], "h", "v").collect()) == [("t", "1", "2"), ("t", "1", "3"), ("t", "2", "3")]
    assert lookalike_pairs(df.limit(0), ["f"], "h", "v").count() == 0


def test_long(spark):
    assert forms(spark, ["ｘ" * 200_000])[0] == "x" * 200_000


def test_faces_and_ligatures(spark):
    cases = {"𝔸𝕭𝐜": "ABc", "ℌℓ": "Hl", "㎏ 5": "kg 5", "Ǆ": "DŽ", "Ⅳ": "IV", "﹐": ",", "ﺑ": "ب", "ｶﾞ": "ガ", "½": "½", "①": "①", "x²": "x²", "ﷺ": "ﷺ"}
    assert forms(spark, [*cases]) == [*cases.values()]
    assert all(f == g for f, g in zip(forms(spark, [*cases.values()]), cases.values(), strict=True))


def test_groups(spark):
    rows = [("t", "1", "аbc"), ("t", "2", "abc"), ("t", "3", "ａｂｃ"), ("t", "3", "ａｂｃ"), ("t", "4", "Abc"), ("u", "5", "abc"), ("t", "6", None), ("t", "7", ""), ("t", None, "abc")]
    df = spark.createDataFrame(rows, "f string, h string, v string").selectExpr("*", "'x' AS form", "1 AS copies")
    got = {(r.f, r.h): (r.group_key, r.copies) for r in lookalike_groups(df, ["f"], "h", "v").collect()}
    assert got == {("t", "1"): ("1", 3), ("t", "2"): ("1", 3), ("t", "3"): ("1", 3), ("t", "4"): ("4", 1), ("u", "5"): ("5", 1)}
    assert lookalike_groups(df.limit(0), ["f"], "h", "v").count() == 0
