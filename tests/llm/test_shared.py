from corpusloom.llm.shared import hash_sample, labelled_sample, stored, visiting


def test_a_sample_is_the_same_with_and_without_the_first_cut(spark):
    rows = spark.range(5_000).withColumnRenamed("id", "key")
    small = {r["key"] for r in hash_sample(rows, "key", 50).collect()}
    larger = {r["key"] for r in hash_sample(rows, "key", 1_000).collect()}
    assert len(small) == 50 and len(larger) == 1_000 and small <= larger


def test_samples_of_few_and_no_rows(spark):
    rows = spark.range(7).withColumnRenamed("id", "key")
    assert hash_sample(rows, "key", 50).count() == 7
    assert hash_sample(rows.limit(0), "key", 50).count() == 0


def test_stored_rows_are_the_rows(spark):
    rows = spark.range(9).selectExpr("id", "IF(id % 2 = 0, id, null) AS half")
    again = stored(rows, "test")
    assert again.schema.fieldNames() == ["id", "half"] and again.exceptAll(rows).count() == 0


def test_labelled_sample_is_bounded_in_rows(spark):
    docs = spark.createDataFrame(
        [(i % 40, f"text {i}" if i % 7 else None) for i in range(4_000)], "doc_id long, text string"
    )
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2, "doc_id long, quality int")
    first = labelled_sample(docs, labels, "quality", 10).collect()
    assert len(first) == 10 == len({r["doc_id"] for r in first})
    assert sorted(first) == sorted(labelled_sample(docs.repartition(5), labels, "quality", 10).collect())


def test_every_two_tiles_meet_in_one_lane(spark):
    for n in (1, 2, 3, 4, 7, 8):
        packs = spark.range(n).selectExpr("id AS tile", f"{n}L AS tiles")
        rows = [(r["tile"], r["lane"]) for r in visiting(packs).collect()]
        pairs = sorted(tuple(sorted(p)) for p in rows)
        assert pairs == [(a, b) for a in range(n) for b in range(a, n)]
