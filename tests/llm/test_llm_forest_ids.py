from tokenloom.llm import forest


def test_documents_with_int_ids_stay(spark):
    words = " ".join(f"word{i}" for i in range(40))
    rows = [(1, words), (2, words), (3, " ".join(f"other{i}" for i in range(40))), (4, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    kept = forest.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5]
