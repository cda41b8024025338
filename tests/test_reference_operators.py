"""Text, extraction, sources, resolution, routing and streaming against values stated by hand or plain Python."""

from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from addrloom.functions import extract as x
from addrloom.functions import text as t
from addrloom.functions.similar import collapse, without_repeats
from addrloom.operators import checks, infer, resolve, route, score
from addrloom.operators.indexes import pin_context
from addrloom.sources import files
from addrloom.streaming.checks import checked_stream


def one(spark, value, **columns):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(*[c.alias(k) for k, c in columns.items()]).collect()[0].asDict()


def test_text_forms(spark):
    c = F.col("v")
    got = one(spark, "  a-13 ;  Mg\tRoad |, x & y,, ", clean=t.clean_text(c), match=t.for_matching(c), check=t.for_checking(c), resolve=t.for_resolving(c), flat=t.collapsed(c))
    assert got == {"clean": "A-13,MG ROAD,X & Y", "match": "A 13 MG ROAD X Y", "check": "A 13 MG ROAD X Y", "resolve": "A 13 MG ROAD X AND Y", "flat": "a-13 ; Mg Road |, x & y,,"}
    assert set(one(spark, None, a=t.clean_text(c), b=t.entity(c), d=t.last_pin(c), e=t.plain_pin(c)).values()) == {""}
    assert one(spark, "Vill. Dist Poona", a=t.entity(c))["a"] == "PUNE"
    assert one(spark, "J&K", a=t.cleaner_state(c), b=t.validator_state(c), d=t.resolver_state(c)) == {"a": "J K", "b": "JAMMU AND KASHMIR", "d": "JAMMU AND KASHMIR"}
    assert one(spark, "122001.0", a=t.last_pin(c), b=t.six_digits(c), d=t.plain_pin(c), e=t.loose_pin(c)) == {"a": "122001", "b": "", "d": "122001", "e": "122001"}
    assert one(spark, "1220012, 110001 then 110 005", a=t.last_pin(c))["a"] == "110001"


def test_labels_parts_and_types(spark):
    c = F.col("v")
    a = "VILL RAMPUR, PO SOHNA; TEHSIL SOHNA, DIST. GURUGRAM"
    assert one(spark, a, **{k: x.labelled(c, k) for k in x.LABELLED}) == {"village": "RAMPUR", "post_office": "SOHNA", "subdistrict": "SOHNA", "district": "GURUGRAM", "locality": ""}
    assert one(spark, "POST OFFICE KARNAL", a=x.labelled(c, "post_office"))["a"] == "ST OFFICE KARNAL"  # PO matches inside POST, as it always has
    got = one(spark, "E-49/C-24, MG ROAD, LAXMI NAGAR", p=x.has_premise(c), s=x.has(c, "street"), b=x.has(c, "building"), l=x.has(c, "locality"), k=x.address_type(c))
    assert got == {"p": True, "s": True, "b": False, "l": True, "k": "URBAN"}
    assert one(spark, "", p=x.has_premise(c), k=x.address_type(c)) == {"p": False, "k": "UNKNOWN"}
    assert one(spark, "FLAT 4, KAROL BAGH, DELHI 110005", s=x.state_in_text(c), c=x.city_by_segment(c, F.lit("DELHI"), F.lit("110005"))) == {"s": "DELHI", "c": "KAROL BAGH"}
    assert one(spark, "A-13, LAXMI NAGAR, DELHI 110092", b=x.without_metadata(c, F.lit("DELHI"), F.lit("110092")))["b"] == "A 13 LAXMI NAGAR"  # a state takes all punctuation along
    assert one(spark, "JAIPUR,GANDHI NAGAR,JAIPUR,X JAIPUR", b=x.first_of_repeats(c, F.lit("JAIPUR"), 3))["b"] == "JAIPUR,GANDHI NAGAR,X"


def test_repeated_blocks_go_and_the_first_copy_stays():
    assert collapse([]) == [] and collapse("A B A B A B C".split()) == [0, 1, 6]
    assert without_repeats("GANDHI NAGAR GANDHI NAGAR,JAIPUR JAIPUR") == "GANDHI NAGAR,JAIPUR"
    assert without_repeats("") == "" and without_repeats(None) is None and without_repeats("A-1 A.1 B") == "A-1 B"


def test_pairs_that_share_no_two_letters_are_never_similar():
    import itertools
    import random

    rng = random.Random(3)
    words = ["".join(rng.choice("ABCD") for _ in range(rng.randint(1, 9))) for _ in range(250)]
    for a, b in itertools.product(words[:125], words[125:]):
        pieces = [{w[i : i + 2] for i in range(max(1, len(w) - 1))} for w in (a, b)]
        if not pieces[0] & pieces[1]:
            assert SequenceMatcher(None, a, b).ratio() < resolve.REVIEW


@pytest.fixture(scope="module")
def ref(spark):
    class Small:
        pass

    r = Small()
    post = [("122001", "HARYANA", "GURUGRAM", "SOHNA"), ("122001", "HARYANA", "GURUGRAM", "SECTOR 12"), ("302001", "RAJASTHAN", "JAIPUR", "JAIPUR CITY")]
    post = spark.createDataFrame(post, "pincode_clean string, statename_clean string, district_clean string, officename_clean string")
    r.pins = pin_context(post.select("*", F.col("statename_clean").alias("statename"), F.col("district_clean").alias("district"), F.col("officename_clean").alias("officename"))).cache()
    r.context = r.pins.select("pin", F.col("district_entities").alias("pin_districts"), F.col("canonical_states").alias("pin_states"))
    names = "name string, m_district string, m_subdistrict string, m_state string, code string"
    r.names = {
        "district": spark.createDataFrame([("GURUGRAM", "GURUGRAM", "", "HARYANA", "58"), ("JAIPUR", "JAIPUR", "", "RAJASTHAN", "1"), ("AURANGABAD", "AURANGABAD", "", "BIHAR", "2"), ("AURANGABAD", "AURANGABAD", "", "MAHARASHTRA", "3")], names),
        "ulb": spark.createDataFrame([("GURUGRAM", "", "", "", "8"), ("RAMPURAM", "", "", "", "9"), ("RAMPURAN", "", "", "", "10")], names),
        "village": spark.createDataFrame([("RAMPUR", "GURUGRAM", "SOHNA", "HARYANA", "v1"), ("RAMPUR", "JAIPUR", "AMBER", "RAJASTHAN", "v2"), ("BADSHAHPUR", "GURUGRAM", "SOHNA", "HARYANA", "v3")], names),
    }
    return r


def test_resolution_exact_context_fuzzy_and_none(spark, ref):
    def ask(kind, *rows):
        df = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], "id string, q string, s string, d string, u string, p string")
        k = resolve.keyed(df, F.col("q"), F.col("s"), F.col("d"), F.col("u"), F.col("p"))
        got = {r.id: (r.status, r.match_value, r.source) for r in resolve.answered(k, resolve.resolved(k, kind, ref)).collect()}
        return [got[str(i)] for i in range(len(rows))]

    none = ("", "", "", "")
    assert ask("district", ("Gurgaon", *none), ("Aurangabad", *none), ("Aurangabad", "Bihar", "", "", ""), ("Gurugrum", *none), ("Zzz", *none), (None, *none)) == [
        ("PASS", "GURUGRAM", "LGD_EXACT"), ("AMBIGUOUS", "AURANGABAD", "LGD_EXACT"), ("PASS", "AURANGABAD", "LGD_EXACT"), ("AMBIGUOUS", "GURUGRAM", "LGD_FUZZY"), ("FAIL", "", "LGD"), ("NOT_CHECKED", "", ""),
    ]
    assert ask("ulb", ("Rampura", *none), ("nowhere", *none)) == [("PASS", "RAMPURAN", "LGD_FUZZY"), ("NOT_CHECKED", "", "LGD")]
    assert ask("village", ("Rampur", "", "", "", "122001"), ("Rampur", *none), ("Badshapur", "", "Gurugram", "Sohna", "")) == [("PASS", "RAMPUR", "LGD_EXACT"), ("AMBIGUOUS", "RAMPUR", "LGD_EXACT"), ("PASS", "BADSHAHPUR", "LGD_FUZZY")]
    assert ask("post_office", ("PO Sohna", "", "", "", "122001"), ("Sohna", "", "", "", "999999"), ("Jaipur", "", "", "", "122001")) == [("PASS", "SOHNA", "INDIA_POST_EXACT"), ("NOT_CHECKED", "", ""), ("FAIL", "", "INDIA_POST")]


def test_repair_and_containment(spark, ref):
    rows = spark.createDataFrame([(1, "H NO 4, SOHNA, HARYANA", "Old", None, "122001.0"), (2, "MG ROAD GURUGRAM", None, "RJ", "12"), (3, None, None, None, None)], "row_id long, full_address string, city string, state string, pincode string")
    got = {r.row_id: r for r in infer.auto_resolved(rows, ref).collect()}
    assert (got[1].state, got[1].pincode, got[1].city) == ("HARYANA", "122001", "") and got[1].remark.startswith("state auto resolved from null->HARYANA")
    assert (got[2].city, got[2].state) == ("GURUGRAM", "RAJASTHAN") and got[3].remark == "Missing: Complete Address, City, State, Pincode"
    assert {r.row_id: r.city for r in infer.auto_resolved(rows, ref, respect_clean_city=True).collect()}[1] == "Old"
    assert [tuple(r) for r in infer.contained(rows, t.entity(F.col("full_address")), ref.names["ulb"]).collect()] == [(2, "GURUGRAM")]


def test_layouts_joins_and_assembly(spark):
    layouts = {"B": {"signature": ["LAN", "A1"], "lan": ["LAN"], "current": ["A1", "A2", "PIN"], "office": ["O"]}, "C": {"signature": ["LAN"], "lan": ["LAN"], "current": ["X"]}}
    df = spark.createDataFrame([("7", " MG ROAD ", "NaN", "0"), ("", "x", None, "1"), ("8", None, None, None)], "LAN string, A1 string, A2 string, PIN string")
    assert route.identify(df.columns, layouts) == "B" and route.identify(["LAN"], layouts) == "C"
    with pytest.raises(ValueError):
        route.identify(["Z"], layouts)
    assert [tuple(r) for r in route.standardised_input(df, layouts).collect()] == [("'7'", "MG ROAD", "", ""), ("'8'", "", "", "")]
    got = spark.createDataFrame([("12 MG ROAD Jaipur", "JAIPUR", "RAJASTHAN", "302001.0"), (None, None, "", "1")], "a string, c string, s string, p string").select(route.combined(F.col("a"), F.col("c"), F.col("s"), F.col("p")).alias("x"))
    assert [r.x for r in got.collect()] == ["12 MG ROAD Jaipur, RAJASTHAN, 302001", ""]
    a = spark.createDataFrame([(1, "L1"), (2, "L2")], "row_id long, lan string")
    route.check_alignment(a, a)
    for other in ([(1, "L1")], [(1, "L2"), (2, "L1")]):
        with pytest.raises(ValueError):
            route.check_alignment(a, spark.createDataFrame(other, "row_id long, lan string"))


def test_score_arithmetic(spark):
    df = spark.createDataFrame([(95.0,), (89.99,), (60.0,), (40.0,), (39.99,), (float("nan"),), (None,)], "s double")
    assert [r.c for r in df.select(score.quality_class(F.col("s")).alias("c")).collect()] == ["EXCELLENT", "GOOD", "USABLE", "REQUIRES_CALL", "INVALID", "INVALID", "INVALID"]
    yes, no = F.lit(True), F.lit(False)
    got = df.limit(1).select(score.premise_fraction(no, yes, yes), score.street_fraction(yes, no, yes), score.confidence_fraction(F.lit("PASS"), F.lit("PASS"), no), score.standard_fraction(F.lit("PASS"), yes)).collect()[0]
    assert tuple(got) == (0.75, 0.65, 0.85, 0.9)


def test_sources_by_suffix_and_alias(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "the_subdistrict_master.csv").write_text("a\n1\n")
    (tmp_path / "district.csv").write_text("﻿District Code,District Name (In English)\n58,Gurugram\n,\"Leh, Ladakh\"\nNA,\n", encoding="utf-8")
    assert files.find_file(str(tmp_path), "district").endswith("/district.csv")
    df = files.standardised(files.load_table(spark, files.find_file(str(tmp_path), "district")), "district")
    assert [(r.district_code, r.district_name_clean) for r in df.collect()] == [("58", "GURUGRAM"), ("", "LEH LADAKH"), ("NA", "")]
    assert files.with_gaps(df).collect()[2].district_code == ""
    with pytest.raises(ValueError):
        files.standardised(df.select("district_code"), "ulb")
    ss = "urn:schemas-microsoft-com:office:spreadsheet"
    cell = lambda v: f'<Cell><Data ss:Type="String">{v}</Data></Cell>'
    rows = "".join(f"<Row>{''.join(map(cell, r))}</Row>" for r in (["Local Body Code", "Local Body Name"], ["8", "Gurugram"], ["9"], ["10", "Sohna", "more"]))
    (tmp_path / "ulb.xls").write_text(f'<?xml version="1.0"?><Workbook xmlns="{ss}" xmlns:ss="{ss}"><Worksheet><Table>{rows}</Table></Worksheet></Workbook>')
    ulb = files.standardised(files.load_table(spark, str(tmp_path / "ulb.xls")), "ulb")
    assert sorted((r.ulb_code, r.ulb_name, r.ulb_type) for r in ulb.collect()) == [("10", "Sohna", ""), ("8", "Gurugram", ""), ("9", "", "")]
    assert files.customer_columns(["PIN", "Clean State", "Address", "x"]) == {"address": "Address", "pincode": "PIN", "state": "Clean State"}
    with pytest.raises(ValueError):
        files.load_table(spark, "x.parquet")


def test_checks_on_a_stream_are_those_on_a_table(spark, ref, tmp_path):
    rows = [(1, "12 MG ROAD GURUGRAM", "GURUGRAM", "HARYANA", "122001"), (2, "NA", None, "RAJASTHAN", "122001"), (3, None, None, None, "1 2 2 0 0 1"), (4, "NA HOUSE 12 MAIN ROAD", "X", "GOA", "999999")]
    df = spark.createDataFrame(rows, "row_id long, full_address string, city string, state string, pincode string")
    df.write.parquet(f"{tmp_path}/in")
    names = ("present", "pin_format", "pin_exists", "pin_state", "garbage", "district_evidence")
    want = {r.row_id: tuple(r[n].status for n in names) for r in checks.checked(df, ref.pins).collect()}
    assert want == {1: ("PASS",) * 6, 2: ("FAIL", "PASS", "PASS", "FAIL", "FAIL", "NOT_FOUND"), 3: ("FAIL", "PASS", "PASS", "NOT_CHECKED", "FAIL", "NOT_CHECKED"), 4: ("PASS", "PASS", "FAIL", "FAIL", "AMBIGUOUS", "NOT_CHECKED")}
    out = checked_stream(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), ref.pins)
    query = out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {r.row_id: tuple(r[n] for n in names) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == want
    with pytest.raises(ValueError):
        checks.preflight(df.limit(0), {"pincode": "pincode"}, strict=True)
