"""The ledger of rows behind the watermark."""

import datetime as dt

from wayfleet.streaming.late import LateLedger, start_ledger

ROW = "entity_id string, event_time timestamp"
START = dt.datetime(2024, 5, 1, 12)


def rows(spark, *seconds):
    return spark.createDataFrame([(f"t{s}", None if s is None else START + dt.timedelta(seconds=s)) for s in seconds], ROW).coalesce(1)


def held(ledger):
    return sorted((r.batch, r.entity_id, r.late, r.behind_ms) for r in ledger.rows(ROW).collect())


def counted(ledger):
    return [(r.batch, r.rows, r.late) for r in ledger.progress().orderBy("batch").collect()]


def test_late_rows_are_kept_apart_and_replays_change_nothing(spark, tmp_path):
    ledger = LateLedger(spark, f"{tmp_path}/ledger")
    batches = [rows(spark, 0, 30), rows(spark, 19, 20, 21, None), rows(spark).where("false"), rows(spark, 5, 100), rows(spark, 89, 90)]
    for k, batch in enumerate(batches):
        ledger.take(batch, k)
    want = [(0, "t0", False, None), (0, "t30", False, None), (1, "t19", True, 1000), (1, "t20", False, None), (1, "t21", False, None),
            (1, "tNone", False, None), (3, "t100", False, None), (3, "t5", True, 15000), (4, "t89", True, 1000), (4, "t90", False, None)]
    assert held(ledger) == want
    assert counted(ledger) == [(0, 2, 0), (1, 4, 1), (2, 0, 0), (3, 2, 1), (4, 2, 1)]
    ledger.take(rows(spark, 1, 2, 3), 1)                       # a finished batch that comes again
    assert held(ledger) == want


def test_a_batch_that_was_cut_off_is_not_read_and_is_written_anew(spark, tmp_path):
    ledger = LateLedger(spark, f"{tmp_path}/ledger")
    ledger.take(rows(spark, 0, 30), 0)
    wrong = LateLedger(spark, f"{tmp_path}/wrong")
    wrong.take(rows(spark, 7), 0)
    wrong.spark.read.parquet(f"{tmp_path}/wrong/rows/batch=0").write.partitionBy("late").parquet(f"{tmp_path}/ledger/rows/batch=1")
    assert [r[0] for r in held(ledger)] == [0, 0]
    ledger.take(rows(spark, 10, 40), 1)
    assert held(ledger)[2:] == [(1, "t10", True, 10000), (1, "t40", False, None)]


def test_the_stream_takes_every_row_once(spark, tmp_path):
    for seconds in ((0, 50), (10, 60), (45, 49, 70)):
        rows(spark, *seconds).write.mode("append").parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    ledger = LateLedger(spark, f"{tmp_path}/ledger")
    for _ in range(2):                                          # the second run finds nothing new
        start_ledger(source, ledger, f"{tmp_path}/ckpt", every=None).awaitTermination()
    got = held(ledger)
    assert sorted(r[1] for r in got) == sorted(f"t{s}" for s in (0, 50, 10, 60, 45, 49, 70))
    assert [(r[1], r[3]) for r in got if r[2]] == [("t10", 30000), ("t45", 5000), ("t49", 1000)]
    assert counted(ledger) == [(0, 2, 0), (1, 2, 1), (2, 3, 2)]
