"""Streams over tables that are one file, or a folder of parts."""

from curatio.plans.streams import stream_event_windows, stream_new_pages


def test_tables_of_several_parts_are_read_whole(spark, tmp_path):
    rows = [(i, f"https://x.example/{i % 30}", "<p>x</p>") for i in range(50)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in stream_new_pages(spark, str(tmp_path)).select("n").collect()]
    assert got == [(1,)] * 30
    spark.sql("SELECT id AS event_id, timestamp_ntz'2024-01-01 10:00:00' AS ts, id AS user_id, 'a' AS event_type, 1.0D AS value, '' AS props FROM range(20)").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    assert [(r.n, r.total) for r in stream_event_windows(spark, str(tmp_path)).collect()] == [(20, 20.0)]


def test_a_table_of_one_file_beside_others(spark, tmp_path):
    from curatio.streaming.incremental import drained, file_stream

    for name in ("pages.parquet", "other.parquet"):
        spark.range(7).toPandas().to_parquet(f"{tmp_path}/{name}")
    seen = []
    drained(file_stream(spark, str(tmp_path), "pages"), lambda batch, _: seen.append(batch.count()))
    assert sum(seen) == 7
