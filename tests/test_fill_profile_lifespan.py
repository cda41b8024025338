import itertools
import json
from datetime import datetime

from pyspark.sql import functions as F

import __spark_entry__
from addrloom.operators import gapfill, profile


def rows(spark, name, folder):
    return sorted(tuple(r) for r in __spark_entry__.queries()[name](spark, str(folder)).collect())


def test_p2_fills_over_pin_or_post_office_only(spark, tmp_path):
    data = [
        (1, "A", "S", "123456", "P"),
        (2, None, "n/a", "PIN 123-456", None),  # over the PIN, written differently
        (3, "-", "S", None, "P"),  # over the post office
        (4, " ", "S", "999999", "Q"),  # nobody else knows
        (5, None, None, None, "UNKNOWN"),  # no key
        (6, "B", "S", "12345", None),
        (7, None, "S", "12345", None),  # a malformed PIN is no key
    ]
    spark.createDataFrame(data, "row_id long, city string, state string, pincode string, post_office string").write.parquet(f"{tmp_path}/cleaned_address_data.parquet")
    assert rows(spark, "p2_found", tmp_path) == [(2, "city"), (2, "state"), (3, "city"), (3, "pincode")]
    filled = {(r[0], r[1]): r[2] for r in rows(spark, "p2_filled", tmp_path)}
    assert filled[2, "city"] == "A" and filled[3, "pincode"] == "123456"
    assert filled[4, "city"] is None and filled[5, "state"] is None and filled[7, "city"] is None


def test_p5_names_the_loads_that_stand_out(spark, tmp_path):
    pins = [(n, "123456") for n in (1, 2, 3, 4) for _ in range(10)]
    pins[0] = (1, "NIL")  # 0.1 above none
    pins[10] = (2, "12345 ")  # 0.1 invalid
    pins[20:25] = [(3, "923456")] * 5  # drift
    spark.createDataFrame(pins, "load_no int, pincode string").write.parquet(f"{tmp_path}/cleaned_address_data.parquet")
    scores = [(n, "GOOD", 50.0) for n in (1, 2) for _ in range(10)]
    scores[0] = (1, "good", float("nan"))
    spark.createDataFrame(scores, "load_no int, quality_class string, raw_quality_score double").write.parquet(f"{tmp_path}/quality_outputs.parquet")
    assert rows(spark, "p5_found", tmp_path) == [(1, "pincode", "missing"), (1, "quality_class", "invalid"), (1, "raw_quality_score", "missing"), (2, "pincode", "invalid"), (3, "pincode", "drift")]


def test_p7_tells_renamed_from_removed_and_added(spark, tmp_path):
    files = {  # by date; file 9 comes first
        9: lambda i: {"Id": f"L{i}", "Addr": f"ROAD {i}", "Old": f"x{i}", "Flag": i % 3 == 0},
        2: lambda i: {"ID": f"L{i}", "Addr": {"no": str(i), "area": "ROAD"}, "old": None if i == 3 else f"x{i}", "Zone": f"z{i}"},
        5: lambda i: {"ID": f"L{i}", "Addr": {"no": str(i), "area": "ROAD"}, "old": f"x{i}", **({"Rare": 1} if i == 7 else {})},
    }
    data = [(f, i, 1, "X", datetime(2024, m, 1), json.dumps(make(i))) for m, (f, make) in enumerate(files.items(), 1) for i in range(1, 11)]
    spark.createDataFrame(data, "file_id long, line_no long, feed_id long, lender string, file_date timestamp, payload string").write.parquet(f"{tmp_path}/raw_lender_records.parquet")
    spark.createDataFrame([("X", ["Id"], ["Addr"])], "lender string, lan_cols array<string>, current_cols array<string>").write.parquet(f"{tmp_path}/lender_configs.parquet")
    assert rows(spark, "p7_found", tmp_path) == [
        (2, "added", "Zone", ""), (2, "removed", "Flag", ""), (2, "renamed", "ID", "Id"), (2, "renamed", "old", "Old"), (2, "retyped", "Addr", ""),
        (5, "added", "Rare", ""), (5, "removed", "Zone", ""),
    ]


def test_p7_names_types_and_rows_are_one_table(spark, tmp_path):
    data = [(1, 1, 1, "X", datetime(2024, 1, 1), '{"Id":"L1","Addr":"MG ROAD 3","Emi":5}'), (1, 2, 1, "X", datetime(2024, 1, 1), "broken"), (1, 3, 1, "X", datetime(2024, 1, 1), None)]
    data += [(2, 1, 1, "X", datetime(2024, 2, 1), '{"ID":"L1","Home":["MG ROAD",3],"Emi":null}'), (3, 1, None, None, None, "{}")]
    spark.createDataFrame(data, "file_id long, line_no long, feed_id long, lender string, file_date timestamp, payload string").write.parquet(f"{tmp_path}/raw_lender_records.parquet")
    spark.createDataFrame([("X", ["Id"], ["Addr"])], "lender string, lan_cols array<string>, current_cols array<string>").write.parquet(f"{tmp_path}/lender_configs.parquet")
    assert rows(spark, "p7_found", tmp_path) == [(2, "renamed", "Home", "Addr"), (2, "renamed", "ID", "Id"), (2, "retyped", "Home", "")]
    got = {(r.file_id, r.line_no): (r.lan, r.current_address) for r in __spark_entry__.queries()["p7_records"](spark, str(tmp_path)).collect()}
    assert got == {(1, 1): ("L1", "MG ROAD 3"), (1, 2): (None, None), (1, 3): (None, None), (2, 1): ("L1", "MG ROAD 3"), (3, 1): (None, None)}
    spans = {(r.field, r.kind, r.first_file_no, r.last_file_no) for r in __spark_entry__.queries()["p7_lifespans"](spark, str(tmp_path)).collect()}
    assert ("Addr", "text", 1, 1) in spans and ("Home", "list", 2, 2) in spans


def test_tree_passes_messages_over_a_hidden_field_and_bins_numbers(spark):
    # key k fixes m, m fixes t; k and t never meet in a row, so only the way over m can fill t
    data = [(i, f"K{i % 3}", f"M{i % 3}", None, float(i % 3 * 100 + 1)) for i in range(30)]
    data += [(100 + i, None, f"M{i % 3}", f"T{i % 3}", None) for i in range(30)]
    df = spark.createDataFrame(data, "id long, k string, m string, t string, x double")
    fields = ["k", "m", "t"]
    pairs = gapfill.pair_counts(df.select("id", *fields), fields, "t-pairs")
    mi, totals = gapfill.information(pairs)
    edges = gapfill.spanning_tree(fields, mi)
    assert set(edges) == {("k", "m"), ("m", "t")}
    evidence = spark.createDataFrame([("e", "K1")], "eid string, k string")
    best = gapfill.Tree(pairs, edges, evidence, ["k"], totals).belief("t").orderBy("w", ascending=False).first()
    assert (best.v, round(best.w, 3)) == ("T1", 1.0)
    out = {(r.id, r.field_name): r.value for r in gapfill.impute(df, "id", ["k", "m"], ["x"], ["m"]).collect()}
    assert out[101, "x"] == "101.0" and out[101, "k"] == "K1"


def test_p2_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "row_id long, city string, state string, pincode string, post_office string").write.parquet(f"{tmp_path}/cleaned_address_data.parquet")
    assert rows(spark, "p2_found", tmp_path) == []


def test_expressions_are_the_shorter_description(spark):
    good = [("c", f"{100000 + 7 * i}", 1) for i in range(200)]
    odd = [("c", "12-34", 1), ("c", "x", 2), ("d", "GOOD", 90), ("d", "BAD", 80), ("d", "NEVER SEEN", 1), ("d", None, 4)]
    got = {(r.column_name, r.value): (r.expression, r.listed) for r in profile.expressions(spark.createDataFrame(good + odd, "column_name string, value string, n long")).collect()}
    assert got["c", "100007"] == ("999999", False) and got["c", "12-34"] == ("=12-34", True)
    assert got["d", "GOOD"] == ("=GOOD", True) and ("d", None) not in got


def test_p5_findings_follow_the_induced_expressions(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(n, "123456") for n in (1, 2) for _ in range(5)] + [(1, "654321")], "load_no int, pincode string").write.parquet(f"{tmp_path}/cleaned_address_data.parquet")
    spark.createDataFrame([], "load_no int, quality_class string, raw_quality_score double").write.parquet(f"{tmp_path}/quality_outputs.parquet")
    assert rows(spark, "p5_found", tmp_path) == []
    induced = profile.expressions
    other = F.when(F.col("value") == "654321", "99-9999").otherwise(F.col("expression"))
    monkeypatch.setattr(profile, "expressions", lambda counted: induced(counted).withColumns({"expression": other, "listed": F.lit(False)}))
    assert (1, "pincode", "invalid") in rows(spark, "p5_found", tmp_path)


def test_buckets_by_expression_are_the_declared_ones(spark):
    pins = [f"{100000 + 7 * i}" for i in range(200)] + [f"0{10000 + i}" for i in range(50)] + [f"{i:0{i % 9 + 1}d}" for i in range(300)]
    pins += ["12-34", "123456\n", " 123456", "123456.0", "१२३४५६", "12345６", "9+", "999999+", "=123456", "A"]
    classes = [*profile.CLASSES, *("".join(w) for w in itertools.product("ABCD", repeat=4)), *(f"{'Q' * n}_{'R' * n}" for n in range(1, 30)), "good", "GOOD ", "=GOOD", "A+", "AAAA", "A+_A+", "EXCELLENT\n"]
    scores = [str(i / 7) for i in range(-20, 800, 3)] + [str(i / 10) for i in range(100)] + ["Infinity", "-Infinity", "-0.0", "0.0", "100.0", "100.00000000000001", "1.0E-4", "1.0E10", "39.99", "40.0", "9.9+", "x"]
    for several in (1, 40):  # alone, and beside others of its shapes
        data = [(c, v, several) for c, vs in (("pincode", pins), ("quality_class", classes), ("raw_quality_score", scores)) for v in (vs if several > 1 else vs[-12:])]
        found = profile.expressions(spark.createDataFrame(data, "column_name string, value string, n long"))
        want = F.coalesce(profile.declared(F.col("column_name"), F.col("value")), F.lit("invalid"))
        both = found.join(profile.bucketed(found), ["column_name", "value"]).withColumn("want", want).collect()
        assert len(both) == len({d[:2] for d in data}) and [r for r in both if r.bucket != r.want] == []
        kinds = {(r.column_name, r.listed, r.whole) for r in both}
    assert {("pincode", False, False), ("quality_class", False, True), ("raw_quality_score", False, False)} <= kinds and {k[1:] for k in kinds} == {(True, False), (False, True), (False, False)}


def test_profile_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "load_no int, pincode string").write.parquet(f"{tmp_path}/cleaned_address_data.parquet")
    spark.createDataFrame([], "load_no int, quality_class string, raw_quality_score double").write.parquet(f"{tmp_path}/quality_outputs.parquet")
    for name in ("p5_found", "p5_profile", "p5_coverage", "p5_expressions"):
        assert rows(spark, name, tmp_path) == []
