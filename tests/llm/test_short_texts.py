"""The pipeline's language stage keeps clean texts of a few words."""

import corpus_pipeline
from cellamp.llm.tables import table


def test_clean_texts_of_a_few_words_stay(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    short = ["Avec.", "Die tz.", "Edstou reinan ed for.", "Asos oscorr cota.", "Erö.", "Die tz. " * 40]
    junk = ["", "12 34 !!", " ".join("qxzjvkw"[k % 7 :] + "qjxzvwkp"[: k % 8] + chr(0x3B1 + k % 20) * 3 for k in range(60))]
    rows = [(10**9 + k, t, "en", "s", len(t)) for k, t in enumerate(short + junk)]
    added = spark.createDataFrame(rows, docs.schema)
    left = {r.doc_id for r in dict(corpus_pipeline.STAGES)["language"](spark, docs.union(added), sf_dir).collect()}
    # Rows of the same text with an empty label would not be learned; the junk is labelled and yet too long and too far off.
    assert {10**9 + k for k in range(len(short))} <= left
    assert 10**9 + len(short) not in left and 10**9 + len(short) + 1 not in left
    assert 10**9 + len(short + junk) - 1 not in left
