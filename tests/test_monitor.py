import datetime as dt
import json

from pyspark.sql import functions as F

from millrace.streaming import monitor

START = dt.datetime(2024, 1, 1)
COUNTS = [0, 3, 6, 6, 6, 6, 20, 22, 23, 23, 23, 23, 30]
TIMES = [0, 30, 60, 90, 250, 370, 400, 430, 460, 490, 700, 900, 930]


def _expected():
    streak, alerts, moved, told, out = 0, [], TIMES[0], False, []
    for i in range(1, len(COUNTS)):
        gain = COUNTS[i] - COUNTS[i - 1]
        alert = False
        if 0 < gain < 5:
            streak += 1
            if streak >= 2:
                alert, streak = True, 0
        else:
            streak = max(0, streak - 1)
        if gain > 0:
            moved, told = TIMES[i], False
        stall = gain <= 0 and TIMES[i] - moved > 300 and not told
        told = told or stall
        alerts.append(alert)
        out.append((gain, alert, stall))
    return out


def _frame(spark):
    rows = [("r", START + dt.timedelta(seconds=t), c) for t, c in zip(TIMES, COUNTS, strict=True)]
    return spark.createDataFrame(rows, "run string, ts timestamp, accepted_count long")


def test_batch_forms(spark):
    rows = monitor.deltas(_frame(spark), "run", "ts", "accepted_count")
    want = _expected()
    assert [r.new_count for r in rows.orderBy("ts").collect()] == [None] + [w[0] for w in want]
    assert [r.elapsed for r in rows.orderBy("ts").collect()][1:3] == [30.0, 30.0]
    end = monitor.low_yield_alerts(rows, "run", "ts", "new_count").first()
    assert end.alerts == sum(w[1] for w in want)
    assert [r.stall for r in monitor.stalls(rows, "run", "ts", "new_count").orderBy("ts").collect()][1:] == [w[2] for w in want]


def test_stream_form(spark, tmp_path):
    lines = [json.dumps({"run": "r", "ts": (START + dt.timedelta(seconds=t)).isoformat(), "accepted_count": c}) for t, c in zip(TIMES, COUNTS, strict=True)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines[:5]) + "\n")
    (tmp_path / "in" / "b.json").write_text("\n".join(lines[5:]) + "\n")
    source = spark.readStream.schema("run string, ts timestamp, accepted_count bigint").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = monitor.follow(source).writeStream.format("memory").queryName("alerts").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination(180)
    rows = spark.table("alerts").orderBy("ts").collect()
    assert [(r.new_count, r.low_yield_alert, r.stall_alert) for r in rows[1:]] == _expected() and rows[0].new_count is None


def test_diagnosis(spark):
    df = spark.createDataFrame([({"download_failed": 9, "download_failed_Timeout": 9, "blurry": 4},), ({"blurry": 1},), ({},)], "m map<string,bigint>")
    got = [tuple(r[0]) for r in df.select(monitor.diagnosis(F.col("m"))).collect()]
    assert got == [(9, 4, "downloads"), (0, 1, "candidates"), (0, 0, "candidates")]
