import numpy as np

import __spark_entry__
from addrloom.llm.stuffing import FEATURES, scored
from addrloom.llm.trees import BaggedTrees

PROSE = "The ward office kept a list of every lane that had lost its board, and we sent it to the post office before noon."
TEXTS = {
    1: "rent agreement Khebeyu, loan agent Nisahuabad, " * 10,
    2: " ".join(f"https://loan{i}.example/p{i}" for i in range(30)),
    3: " ".join(f"#bestloan{i}" for i in range(30)),
    4: "best courier near me in Satara. courier near me Satara online! " * 10,
    5: PROSE + "\n" + " | ".join(["instant loan Repigudi"] * 40),
    6: "पिन कोड सस्ता लोन ऑनलाइन फ्लैट " * 10,
    11: PROSE,
    12: PROSE + "\nKeywords: pin code, visit, score #ward #lane https://a.example/x",
    13: "\n".join(f"{i}. {i + 20}, MG ROAD, SHANTI NAGAR, RIBELHALLI 86216{i}" for i in range(1, 9)),
    14: "\n".join(f"86216{i} - Rannai Bazar S.O, Nisahuabad" for i in range(9)),
    15: "\n".join(f"2024-08-1{i} 22:57 load=1 row=2126{i} class=GOOD score=19.5" for i in range(9)),
    16: "पुराना मकान के पास बंद सड़क 71 देखा गया। नया मकान वाला गलत चिट्ठी 47 लिखा गया। " * 4,
    17: "",
    19: "We merged the two rows near Belruabad.\nKeywords: district, visit, landmark, address, post office, pin code, score",
    18: None,
}


def test_p10_finds_stuffing_and_leaves_records_and_prose(spark, tmp_path):
    spark.createDataFrame([(i, t, None if i % 3 else "a.example") for i, t in TEXTS.items()], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r.doc_id for r in __spark_entry__.queries()["p10_found"](spark, str(tmp_path)).collect()) == [1, 2, 3, 4, 5, 6]


def test_trees_learn_a_conjunction_and_fall_back_without_both_labels():
    rng = np.random.default_rng(1)
    x = rng.random((2000, 4))
    y = ((x[:, 0] > 0.5) & (x[:, 2] < 0.3)).astype(float)
    got = BaggedTrees().fit(x[:1500], y[:1500]).score(x[1500:])
    assert ((got > 0.5) == y[1500:]).mean() > 0.97
    assert BaggedTrees().fit(x, np.zeros(2000)).score(x[:3]).tolist() == [0, 0, 0]
    assert BaggedTrees().fit(x[:0], y[:0]).score(x[:2]).tolist() == [0, 0]


def test_p10_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert __spark_entry__.queries()["p10_found"](spark, str(tmp_path)).collect() == []


def test_host_rate_moves_only_doubtful_pages(spark):
    class Fixed:
        def score(self, x):
            return x[:, 0]

    wide = [0.0] * (len(FEATURES) - 1)
    pages = [(i, "bad", [0.95, *wide]) for i in range(200)] + [(900, "bad", [0.45, *wide]), (901, "good", [0.45, *wide]), (902, None, [0.45, *wide])]
    pages += [(1000 + i, "good", [0.02, *wide]) for i in range(600)] + [(903, "bad", [0.01, *wide])]
    got = {r.doc_id: r.smoothed for r in scored(spark.createDataFrame(pages, "doc_id long, source string, features array<double>"), Fixed()).collect()}
    assert got[900] > 0.5 > got[902] > got[901] and got[903] < 0.05 and len(got) == len(pages)
