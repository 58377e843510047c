import hashlib

from millrace.operators import select
from millrace.sources import readers, writers


def test_accepted_and_history(spark, tmp_path):
    head = ",".join(readers.ACCEPTED.fieldNames())
    row = 'f.jpg,bing,http://p,http://h/A_tn.jpg?x,"a ""quoted""\ntitle",800,600,99.5,51,0.9,abc,,True'
    for folder in ("one", "two/deep", "current"):
        (tmp_path / folder).mkdir(parents=True)
    (tmp_path / "one/accepted.csv").write_text(f"﻿{head}\n{row}\n", encoding="utf-8")
    (tmp_path / "two/deep/accepted_china.csv").write_text(f"{head}\n{row.replace('abc', '')}\n")
    (tmp_path / "two/accepted_other.csv").write_text(f"{head}\n{row}\n")
    (tmp_path / "current/accepted.csv").write_text(f"{head}\n{row}\n")
    got = readers.accepted(spark, str(tmp_path / "current/accepted.csv")).first()
    assert got.title == 'a "quoted"\ntitle' and got.orig_width == 800 and got.hull_in_title is True and got.dhash == ""
    keys = readers.history(spark, str(tmp_path), exclude=str(tmp_path / "current")).collect()
    assert sorted((k.canonical_url, k.sha1) for k in keys) == [("http://h/a.jpg", ""), ("http://h/a.jpg", "abc")]
    assert [r.file_name for r in readers.accepted(spark, str(tmp_path / "one/accepted.csv")).collect()] == ["f.jpg"]


def test_candidates(spark, tmp_path):
    assert readers.candidates(spark, str(tmp_path / "none.csv")) is None
    (tmp_path / "c.csv").write_text("source,image_url,page_url,title,has_hull_in_title\nbing, http://h/a ,,,True\nusni,http://h/b,p,t,False\n")
    rows = readers.candidates(spark, str(tmp_path / "c.csv")).orderBy("source").collect()
    assert [(r.image_url, r.page_url, r.has_hull_in_title) for r in rows] == [("http://h/a", "", True), ("http://h/b", "p", False)]
    assert rows[0].source_id == hashlib.md5(b"http://h/a").hexdigest()[:16]


def test_state_and_pictures(spark, tmp_path):
    (tmp_path / "state.json").write_text('{"accepted_count": 3,\n "rejection_counts": {"blurry": 2}}')
    (tmp_path / "half.json").write_text('{"accepted_count": 3, "rej')
    assert readers.state(spark, str(tmp_path / "state.json")).first().rejection_counts == {"blurry": 2}
    assert readers.state(spark, str(tmp_path / "half.json")).count() <= 1
    (tmp_path / "run/train/images").mkdir(parents=True)
    (tmp_path / "run/other").mkdir()
    (tmp_path / "run/train/images/a.jpg").write_bytes(b"x")
    (tmp_path / "run/other/b.jpg").write_bytes(b"y")
    assert [r.sha1 for r in readers.picture_hashes(spark, str(tmp_path)).collect()] == [hashlib.sha1(b"x").hexdigest()]


def test_writers(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i, f"f{i}.jpg") for i in range(20)], "id int, file_name string")
    writers.export_split(select.split(rows, F.col("id")), str(tmp_path / "split"))
    assert spark.read.parquet(str(tmp_path / "split")).filter("split = 'train'").count() == 17
    for _ in range(2):
        writers.append_batch(rows, str(tmp_path / "acc"), 1)
    writers.append_batch(rows.limit(5), str(tmp_path / "acc"), 2)
    assert spark.read.parquet(str(tmp_path / "acc")).count() == 25
    full = rows.select("file_name", *(F.lit('x,"y"').alias(c) for c in writers.REVIEW_COLUMNS[1:]))
    writers.export_review(full, str(tmp_path / "review"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "review"))
    assert back.columns == list(writers.REVIEW_COLUMNS) and back.first().title == 'x,"y"'
    writers.export_json(rows, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 20
    assert "nc: 1" in writers.class_files("/x")["dataset.yaml"]
    made = spark.createDataFrame([("bing", "id", "A b", "p", "i", 800, 600, 1.005, "t" * 200, 0.123456, "s", "d", True)], "source string, source_id string, title string, page_url string, image_url string, w int, h int, sharpness double, ocr_text string, ocr_conf double, sha1 string, dhash string, has_hull_in_title boolean")
    one = made.select(*writers.accepted_row(F.col("source"), F.col("source_id"), F.lit("bi_id_a_b"))).first()
    assert one.file_name == "bi_id_a_b.jpg" and len(one.ocr_text) == 100 and one.ocr_conf == 0.1235 and one.hull_in_title == "True"
