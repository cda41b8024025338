"""Address pairs, canonical names and character forms on small fixtures, against brute force where there is one."""

import random


import __spark_entry__
from addrloom.llm.canonical import match
from addrloom.llm.confusables import normalize, scripts_in_use

PINS = [("862149", "S1", "D1", "RIBELHALLI", "A S.O"), ("862150", "S1", "D1", "RIBELHALLI", "B S.O"), ("700001", "S2", "D2", "OTHERPUR", "C S.O")]
GEO = [(1, "ULB", "RIBELHALLI", "S1", None, None), (2, "ULB", "OTHERPUR", "S2", None, "OLDPUR"), (3, "STATE", "SOUTHERN STATE", "SOUTHERN STATE", "SS", None), (4, "ULB", "OTHERPUR", "S1", None, None), (5, "STATE", "S1", "S1", None, None)]


def tables(spark, folder, addresses):
    spark.createDataFrame(PINS, "pincode string, statename string, district string, city string, officename string").write.parquet(f"{folder}/pin_directory.parquet")
    spark.createDataFrame(GEO, "geo_code long, entity_type string, geo_name string, statename string, abbrev string, former_name string").write.parquet(f"{folder}/geo_directory.parquet")
    spark.createDataFrame(addresses, "row_id long, full_address string, city string, state string, pincode string").write.parquet(f"{folder}/cleaned_address_data.parquet")


def test_p3_pairs_of_one_location(spark, tmp_path):
    rows = [
        (1, "H NO 12/A, MOTARI ROAD, SHANTI NAGAR, RIBELHALLI 862149", "RIBELHALLI", "S1", "862149"),
        (2, "shanti ngr, motari rd., house no. 12-A", "Ribelhalli", None, None),  # order, abbreviations, no PIN
        (3, "12A MOTARI ROAD, NEAR TEMPLE", "RIBELHALLI", None, "862149"),  # lacks the locality
        (4, "12/B, MOTARI ROAD, SHANTI NAGAR", "RIBELHALLI", "S1", "862149"),  # another letter
        (5, "12/A, MOTARI ROAD, SHANTI NAGAR", "OTHERPUR", "S2", "700001"),  # another town
        (6, "12/A, MOTARI ROAD, SHANTI NAGAR", "RIBELHALLI", "S1", "862150"),  # another PIN area
        (7, None, None, None, None), (8, "", "", "", ""), (9, "x" * 50_000, None, None, None), (10, "RIBELHALLI", "RIBELHALLI", None, None),
        (11, "FLAT 7, 12/A, MOTARI ROAD, SHANTI NAGAR", "RIBELHALLI", None, "862149"),  # a flat of its own
    ]
    rows += [(100 + i, f"{i}, STREETNAME{chr(65 + i % 20)} ROAD, FILLER{chr(65 + i % 7)} NAGAR", "RIBELHALLI", "S1", "862149") for i in range(1, 60)]
    tables(spark, tmp_path, rows)
    got = [tuple(r) for r in __spark_entry__.queries()["p3_found"](spark, str(tmp_path)).collect()]
    assert len(got) == len(set(got)) and {p for p in got if p[1] < 100} >= {(1, 2), (1, 3), (2, 3)}
    assert not {x for p in got if p[1] < 100 for x in p} & {4, 5, 7, 8, 9, 10, 11}


def test_p3_of_an_empty_table(spark, tmp_path):
    tables(spark, tmp_path, [])
    assert __spark_entry__.queries()["p3_found"](spark, str(tmp_path)).collect() == []


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_the_pigeonhole_join_loses_nothing_against_brute_force(spark):
    rng = random.Random(5)
    names = sorted({"".join(rng.choice("BCDKLMNRST") + rng.choice("AIU") for _ in range(rng.randint(2, 6))) for _ in range(40)})
    typed = set()
    for n in names:
        for _ in range(12):
            w = list(n)
            for _ in range(rng.randint(0, 4)):
                i = rng.randrange(len(w))
                kind = rng.random()
                if kind < 0.3 and len(w) > 2:
                    del w[i]
                elif kind < 0.6:
                    w.insert(i, rng.choice("BCDKLMNRSTAIU"))
                elif kind < 0.8:
                    w[i] = rng.choice("BCDKLMNRSTAIU")
                elif i + 1 < len(w):
                    w[i], w[i + 1] = w[i + 1], w[i]
            typed.add("".join(w))
    entries = spark.createDataFrame([(i, "ULB", n, "S", None, None) for i, n in enumerate(names)], "geo_code long, entity_type string, geo_name string, statename string, abbrev string, former_name string")
    values = spark.createDataFrame([("ULB", v) for v in sorted(typed)] + [("ULB", None), (None, "X"), ("ULB", "")], "kind string, value string")
    got = {r.value: r.entries[0].code for r in match(values, entries).collect() if len(r.entries) == 1}

    def within(v, n):
        k = 0 if len(n) < 4 else 1 if len(n) == 4 else 2 if len(n) <= 7 else 3
        d = edits(v, n)
        return d if d <= k else None

    for v in typed:
        near = sorted((d, i) for i, n in enumerate(names) if (d := within(v, n)) is not None)
        if near and (len(near) == 1 or near[0][0] < near[1][0]):
            assert got.get(v) == near[0][1], (v, names[near[0][1]])
        elif not near and v in got:  # only two exchanges in a long name go further
            n = names[got[v]]
            assert len(n) >= 8 and sorted(v) == sorted(n) and edits(v, n) == 4


def test_p6_names_states_and_the_unmatched(spark, tmp_path):
    rows = [(1, "Ribelhali City", "ss", "862149"), (2, "RIBELHALLI", "SOUTHERN STATE", None), (3, "oldpur", "S1", None), (4, "OTHERPUR dist", "S1", None), (5, "Zzzzzz", "N/A", None), (6, None, "", None)]
    tables(spark, tmp_path, [(i, None, c, s, p) for i, c, s, p in rows])
    spark.createDataFrame([(1, 4, "ULB", "otherpurr", None), (2, None, "DISTRICT", "x", None), (3, None, None, "y", None)], "res_id long, row_id long, entity_type string, input_value string, state string").write.parquet(f"{tmp_path}/resolution.parquet")
    q = __spark_entry__.queries()
    got = {(r.field_name.split(".")[1], r.rec_id): r.geo_code for r in q["p6_found"](spark, str(tmp_path)).collect()}
    assert got == {("city", 1): 1, ("state", 1): 3, ("city", 3): 2, ("city", 4): 4, ("city", 5): 0, ("input_value", 1): 4, ("input_value", 2): 0, ("input_value", 3): 0}
    assert {(r.value, r.n) for r in q["p6_unmatched"](spark, str(tmp_path)).collect()} == {("Zzzzzz", 1), ("x", 1), ("y", 1)}


def test_real_text_of_other_scripts_stays(spark):
    for text in ("Москва", "Ромашка", "Ереван вокзал", "सड़क के पास", "café", "a  b\nc", ""):
        assert normalize(text) == (text, ()), text
    assert normalize("РAТIALA")[0] == "PATIALA" and normalize("ＡＢＣ")[1] == ("compatibility",) and normalize("a\u200bb\u00a0c") == ("ab c", ("invisible", "space"))
    assert normalize("café") == ("café", ("accent",))
    assert normalize("МОСКВА")[0] == "MOCKBA" and normalize("МОСКВА", frozenset({"Cyrillic"}))[0] == "МОСКВА"
    df = spark.createDataFrame([("Жуков",), ("МОСКВА",), ("PATNA",), (None,)], "c string")
    assert scripts_in_use(df, ["c"]) == {"c": frozenset({"Cyrillic"})}
    assert scripts_in_use(df.limit(0), ["c"]) == {"c": frozenset()}


def test_normal_forms_are_stable():
    rng = random.Random(2)
    letters = "abc АВСеαΒ０１  ​ȩ́क्‍षﬁ½"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 12)))
        once = normalize(text)[0]
        assert normalize(once)[0] == once, repr(text)
