from cellamp.llm import decontaminate


def test_items_of_repeated_words_are_found_without_their_rare_words(spark):
    item = "la " * 15 + "one two three four five"
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "la " * 15), (2, "one two three four five"), (3, "nothing of it")], "doc_id bigint, text string")
    # One of the six words is a seed whatever is cut; with fewer seeds the repeats alone were never aligned.
    assert decontaminate.gram_length(item.encode().split(), 8) == (1, 1)
    assert {r.doc_id for r in decontaminate.find_leaks(docs, bench).collect()} == {1}
