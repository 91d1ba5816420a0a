"""Incremental ingest: each export file lands once in the dataset, rejects are kept."""

import gzip
import os

from pyspark.sql import functions as F

from leadscope.sources import dataset
from leadscope.streaming import start_activity_ingest

LINE = '"{i}",s,"{key}","2013-05-{day:02d}","1","2",x,"3",a,b,c,d,1.0,0,e,"{mob}",f,"term {i}"'


def _write(folder, name, lines):
    with gzip.open(os.path.join(folder, name), "wt") as fh:
        fh.write("\n".join(lines) + "\n")


def test_stream_ingest_is_incremental_and_exactly_once(spark, scratch):
    src, out, rej, ckpt = (os.path.join(scratch, d) for d in ("src", "dataset", "rejects", "ckpt"))
    os.makedirs(src)
    _write(src, "deduped-2013-05-01.csv.gz", [LINE.format(i=i, key=i % 5, day=1, mob=0) for i in range(20)] + ["x,y"])
    _write(src, "API_DTA_D_2013-05-01.csv.gz", [LINE.format(i=i, key=i % 5, day=1, mob=1) for i in range(10)])
    start_activity_ingest(spark, src, out, rej, ckpt).await_all()

    ds = dataset.read_activity_dataset(spark, out)
    got = {(r.channel, str(r.activity_date)): r.n for r in dataset.rows_per_day(ds).collect()}
    assert got == {("online", "2013-05-01"): 20, ("mobile", "2013-05-01"): 10}
    assert [r.reason for r in spark.read.parquet(rej).collect()] == ["short_row"]

    # a new day arrives; the rerun converts only the new file
    _write(src, "deduped-2013-05-02.csv.gz", [LINE.format(i=i, key=1, day=2, mob=0) for i in range(7)])
    start_activity_ingest(spark, src, out, rej, ckpt).await_all()
    ds = dataset.read_activity_dataset(spark, out)
    assert ds.count() == 37
    assert dataset.day_range(ds, "2013-05-02", "2013-05-02", "online").count() == 7
    assert ds.filter(F.col("snapshot") == "full").count() == 37


def test_files_that_are_not_exports_are_rejected(spark, scratch):
    src, out, rej, ckpt = (os.path.join(scratch, d) for d in ("src", "dataset", "rejects", "ckpt"))
    os.makedirs(src)
    _write(src, "deduped-2013-05-03.csv.gz", [LINE.format(i=i, key=1, day=3, mob=0) for i in range(4)])
    _write(src, "activity_extra.csv.gz", [LINE.format(i=i, key=1, day=3, mob=0) for i in range(3)])
    start_activity_ingest(spark, src, out, rej, ckpt).await_all()
    assert dataset.read_activity_dataset(spark, out).count() == 4
    reasons = [r.reason for r in spark.read.parquet(rej).collect()]
    assert reasons == ["unknown_export"] * 3
