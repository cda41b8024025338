import json

import regex

import __spark_entry__
from addrloom.llm.bpe import PATTERN, byte_letters, loaded
from addrloom.plans.tables import tokenizer_path

TEXTS = ["", None, "Flat 12,  MG Road\n\n 560001 ", "naïve café's पिन कोड <|endoftext|>", "  \t x y   ", "aaaaaaaaaaaaaaaaaaaa" * 20, "a\x85b  c \n d", "tokenization of Karvesgapuram isn't 100,000"]


def replayed(text, model, letters):
    """Ids by merging the pair of least rank again and again."""
    ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
    out = []
    for piece in regex.findall(PATTERN, text or ""):
        w = [letters[b] for b in piece.encode()]
        while len(w) > 1:
            rank, i = min((ranks.get(p, 1e9), i) for i, p in enumerate(zip(w, w[1:])))
            if rank == 1e9:
                break
            w[i : i + 2] = [w[i] + w[i + 1]]
        out += [model["vocab"][x] for x in w]
    return out


def test_p8_ids_is_registered_and_replays_the_merges(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    path = tokenizer_path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    letters = {b: c for c, b in byte_letters().items()}
    got = {r.doc_id: r.ids for r in __spark_entry__.queries()["p8_ids"](spark, str(tmp_path)).collect()}
    assert got == {i: replayed(t, model, letters) for i, t in enumerate(TEXTS)}
    assert loaded(path).decode(got[3]) == TEXTS[3]


def test_p9_queries_are_registered_and_find_a_changed_passage(spark, tmp_path):
    item = "The ward office kept a list of every lane that had lost its board during the rains and sent it to the post office"
    leak = item.upper().replace("LIST", "<b>list</b> now").replace(" LANE", ",\nlane")
    docs = [(1, "Before noon we met. " + leak + " and so on."), (2, "The ward office kept a list of every lane."), (3, None), (4, "")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, item), (8, "too short to leak")], "item_id long, text string").write.parquet(f"{tmp_path}/evaluation_items.parquet")
    queries = __spark_entry__.queries()
    assert [tuple(r) for r in queries["p9_found"](spark, str(tmp_path)).collect()] == [(1, 7)]
    assert [(r.doc_id, r.item_id) for r in queries["p9_spans"](spark, str(tmp_path)).collect()] == [(1, 7)]
