"""A search asks for every row of its query table, against all rows."""

import __spark_entry__


def test_every_vector_is_asked(spark, tmp_path):
    rows = [(i, [float(i % 7 + 1), float(i % 5 - 2), float(i % 3)], 0) for i in range(1, 60)] + [(200, [0.0] * 3, 1), (201, None, 1), (None, [1.0, 2.0, 3.0], 1)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    hits = __spark_entry__.queries()["similar_vectors"](spark, str(tmp_path)).collect()
    assert {h["query_id"] for h in hits} == set(range(1, 60)) and len(hits) == 59 * 20


def test_every_conversation_is_asked(spark, tmp_path):
    words = ["alpha", "beta", "gamma", "delta"]
    docs = [(i, " ".join([words[i % 4]] * 9 + [words[(i + 1) % 4]] * 9)) for i in range(1, 25)]
    turns = [(c, t, f"{words[(c + t) % 4]} unknown{c}") for c in range(1, 45) for t in range(2)] + [(99, 0, "nothing known"), (None, 0, "alpha")]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(turns, "conv_id bigint, turn bigint, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    hits = __spark_entry__.queries()["fold_in_search"](spark, str(tmp_path)).collect()
    assert {(h["query_id"], h["query_name"]) for h in hits} == {(c, str(c)) for c in range(1, 45)}
    assert len(hits) == 44 * 20 and {h["row_id"] for h in hits} <= {i for i, _ in docs}
