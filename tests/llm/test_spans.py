import __spark_entry__
from addrloom.llm.leakage import words_of

ITEM = "the ward office kept a list of every lane that had lost its board during the rains and sent it to the post office"


def test_overlapping_stretches_of_two_items_are_one_span(spark, tmp_path):
    tail = " before noon on the day when the branch clerk asked every family for a photo of the door"
    spark.createDataFrame([(1, "Once more " + ITEM + tail + " and left.")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    second = ITEM.split(" rains ")[1] + tail
    spark.createDataFrame([(7, ITEM), (8, second)], "item_id long, text string").write.parquet(f"{tmp_path}/evaluation_items.parquet")
    queries = __spark_entry__.queries()
    n = len((ITEM + tail).split())
    assert [tuple(r) for r in queries["p9_removals"](spark, str(tmp_path)).collect()] == [(1, 2, 2 + n, [7, 8])]
    spans = queries["p9_spans"](spark, str(tmp_path)).collect()
    assert {(r.item_id, r.first_word, r.last_word) for r in spans} == {(7, 2, 2 + n), (8, 2, 2 + n)}


def test_words_of_a_long_tag_are_no_words_of_the_text():
    assert words_of('one <a\n href="' + "x y " * 100 + '"\n class=z>two</a> three') == ["one", "two", "three"]
    assert words_of("if a <b then\nfour > three") == ["if", "a", "b", "then", "four", "three"]
