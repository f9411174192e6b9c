from gleanmark.streaming.row_local import normalise, normalise_to


def test_stream_equals_batch(spark, tmp_path, rows):
    data = [(1, "  a \t b "), (2, "ﬁne"), (3, "\n"), (4, "plain")]
    df = spark.createDataFrame(data, "id long, text string")
    for i in range(3):
        df.where(f"id % 3 = {i}").write.parquet(str(tmp_path / "in"), mode="append")
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = normalise_to(stream, "text", str(tmp_path / "out"), str(tmp_path / "check"))
    assert query.awaitTermination(120)
    got = rows(spark.read.schema(df.schema).parquet(str(tmp_path / "out")))
    assert got == rows(normalise(df, "text")) == [(1, "a b"), (2, "fine"), (4, "plain")]
