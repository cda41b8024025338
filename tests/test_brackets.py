from addrloom.operators.multivalue import Plain, split_field, split_values

A, B = "12, MG ROAD, SHANTI NAGAR, RIBELHALLI 862149", "14/B, STATION ROAD, GANDHI NAGAR, RIBELHALLI 862149"


def test_bracketed_values_come_without_brackets_and_flags():
    for text in (f"({A}) ({B})", f"[{A}], [{B}]", f"({A.replace('MG', '(OLD) MG')}); ({B})"):
        got = split_field(text)
        assert [x[0] for x in got] == [1, 2] and got[1][1:] == (B, "") and got[0][2] == ""
        assert got[0][1].startswith("12, ") and got[0][1].endswith("862149")


def test_an_unclosed_bracket_falls_back_and_is_flagged():
    got = split_field(f"({A}) ({B}")
    assert len(got) == 2 and all("unclosed_bracket" in x[2] for x in got)


def test_values_come_from_the_source_whatever_folding_does():
    a = A.replace("SHANTI", "Sha\u200bnti")
    got = split_field(f"\u200b{a} ;; {B.replace('STATION', 'ＳＴＡＴＩＯＮ')}")
    assert [x[1] for x in got] == [a, B.replace("STATION", "ＳＴＡＴＩＯＮ")]


def test_an_open_quote_is_flagged_even_in_one_value():
    assert split_field(f'"{A}') == [(1, f'"{A}', "malformed_quote")]
    assert split_field(A) == [(1, A, "")] and split_field("") == split_field(None) == split_field(" , nan") == []
    assert split_field("x") == [(1, "x", "")]


def test_plain_values_by_the_first_rule_that_gives_two():
    assert [x[1] for x in split_field("red; green, dark; blue", Plain)] == ["red", "green, dark", "blue"]
    assert [x[1] for x in split_field('"a ""b"" c", "d"', Plain)] == ['a "b" c', "d"]
    assert [x[1] for x in split_field("[a; b] [c]", Plain)] == ["a; b", "c"]
    assert split_field("one", Plain) == [(1, "one", "")]
    assert split_field("a;;b;;;;c", Plain)[0][2] == "" and [x[1] for x in split_field("a;;b;; ;;c", Plain)] == ["a", "b", "c"]


def test_the_filter_before_the_parser_loses_nothing(spark):
    rows = [(i, t) for i, t in enumerate([None, "", A, f"{A} ;; {B}", f"{A}\n{B}", "x" * 100_000, f"१२, MG ROAD, SHANTI NAGAR ;; {B}"])]
    df = spark.createDataFrame(rows, "id long, full string").selectExpr("id", "full", "1 AS pos")
    want = {(i, x[0]) for i, t in rows for x in split_field(t) if len(split_field(t)) > 1}
    assert {(r.id, r[1]) for r in split_values(df, "full", ["id"], several_only=True).collect()} == want and len(want) >= 4
