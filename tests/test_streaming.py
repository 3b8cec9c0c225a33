import datetime as dt

from foliograph.operators.mentions import sentence_index
from foliograph.streaming import incremental as S

ELEMENT = "doc_id string, element_id string, text string, page int, anchor_id string"


def test_streams_equal_batches(spark, tmp_path):
    rows = [("d", "e1", "See Pub. 550 now. Hold it 61 days.", 1, None), ("d", "e2", "", 1, None), ("x", "e3", None, 1, None)]
    spark.createDataFrame(rows, ELEMENT).write.parquet(str(tmp_path / "in"))
    out = S.mention_streams(S.element_stream(spark, str(tmp_path / "in"), ELEMENT))
    for name, df in out.items():
        q = df.writeStream.format("memory").queryName(f"t_{name}").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    assert spark.table("t_element_sentences").count() == 2
    assert {r.ref_type for r in spark.table("t_references").collect()} == {"publication"}
    assert spark.table("t_constraints").where("unit = 'days' and value_int = 61").count() == 1


def test_windows_of_events(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    spark.createDataFrame([(at(1), "view", 1.0), (at(2), "view", 2.0), (at(59), "click", 3.0)], "ts timestamp, event_type string, value double").write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema("ts timestamp, event_type string, value double").parquet(str(tmp_path / "ev"))
    S.event_windows(stream).writeStream.format("memory").queryName("t_windows").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r.event_type, r.n, r.total) for r in spark.table("t_windows").collect()) == [("click", 1, 3.0), ("view", 2, 3.0)]


def test_documents_are_recomputed(spark, tmp_path):
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path / "ck"))
    source, sink = str(tmp_path / "el"), str(tmp_path / "sink")
    compute = lambda d: sentence_index(d)
    for k, rows in enumerate(([("d", "e1", "One. Two.", 1, None), ("x", "e9", "Nine.", 1, None)], [("d", "e2", "Three.", 1, None)])):
        spark.createDataFrame(rows, ELEMENT).write.mode("append").parquet(source)
        S.per_document(S.element_stream(spark, source, ELEMENT), lambda: spark.read.schema(ELEMENT).parquet(source), compute, sink, str(tmp_path / "cp")).awaitTermination()
        assert spark.read.parquet(sink).count() == (3, 4)[k]
