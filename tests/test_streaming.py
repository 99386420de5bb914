from tessella.streaming import incremental

SCHEMA = "ts timestamp, raster string, row int, col int, value double"


def test_stream_and_batch_agree(spark, tmp_path):
    cells = spark.createDataFrame([(1, 0, 0), (1, 0, 1), (2, 1, 1)], "fid bigint, row int, col int")
    zones = spark.createDataFrame([(1, "a"), (2, None)], "fid bigint, group string")
    rows = [(f"2024-01-01 00:{m:02d}:00", "r", m % 2, m % 3 % 2, float(m)) for m in range(40)] + [("2024-01-01 00:05:00", "r", 0, 0, -1.0), ("2024-01-01 00:05:00", "r", 9, 9, 5.0)]
    df = spark.createDataFrame(rows, "ts string, raster string, row int, col int, value double").selectExpr("cast(ts as timestamp) ts", "raster", "row", "col", "value")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    want = {tuple(r) for r in incremental.windowed_sums(df, cells, zones, "10 minutes", "1 hour", -1.0).collect()}
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = incremental.windowed_sums(stream, cells, zones, "10 minutes", "1 hour", -1.0)
    q = out.writeStream.outputMode("complete").format("memory").queryName("sums").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.table("sums").collect()} == want and len(want) == 8
    assert sum(r[4] for r in want) == sum(1 for t in rows if (t[2], t[3]) in {(0, 0), (0, 1), (1, 1)}) and sum(r[5] for r in want) == 1
