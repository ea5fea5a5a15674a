"""Row-wise cleaning and watermark de-duplication on a file stream."""

import os

from baobab.streaming import clean_customer_stream

SCHEMA = "customer_id string, email string, ville string, telephone string, date_naissance string, ts timestamp"


def test_clean_customer_stream(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("1, A@B.COM ,  thiès ,+221 77 123 45 67,1990-01-01,2025-01-01 10:00:00\n")
        f.write("1,a@b.com,Thiès,771234567,1990-01-01,2025-01-01 10:05:00\n")
        f.write("2,N/A,DAKAR,691234567,15/01/1990,2025-01-01 11:00:00\n")
    stream = spark.readStream.schema(SCHEMA).csv(src)
    out = clean_customer_stream(stream, "ts", "1 hour", as_of="2025-06-30")
    q = (
        out.writeStream.format("memory").queryName("clean_stream_out")
        .option("checkpointLocation", os.path.join(tmp_dir, "ckpt"))
        .trigger(availableNow=True).start()
    )
    q.awaitTermination(120)
    rows = {r.customer_id: r for r in spark.sql("SELECT * FROM clean_stream_out").collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"].email == "a@b.com" and rows["1"].ville_norm == "thies" and rows["1"].telephone_valide
    assert rows["2"].email is None and rows["2"].telephone_valide is False and rows["2"].date_naissance is None


def test_clean_customer_job_resumes(spark, tmp_dir):
    from baobab.streaming import run_clean_customer_job

    src, sink, ckpt = (os.path.join(tmp_dir, d) for d in ("src", "sink", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "1.csv"), "w") as f:
        f.write("1,a@b.com,Dakar,771234567,1990-01-01,2025-01-01 10:00:00\n")
    q = run_clean_customer_job(spark, src, SCHEMA, sink, "ts", "1 hour", checkpoint_dir=ckpt, as_of="2025-06-30")
    q.awaitTermination(120)
    assert spark.read.parquet(sink).count() == 1
    # a new file, and a re-run from the same checkpoint: only the new rows are added
    with open(os.path.join(src, "2.csv"), "w") as f:
        f.write("2,c@d.com,Thies,781234567,1991-01-01,2025-01-01 12:00:00\n")
    q = run_clean_customer_job(spark, src, SCHEMA, sink, "ts", "1 hour", checkpoint_dir=ckpt, as_of="2025-06-30")
    q.awaitTermination(120)
    assert sorted(r.customer_id for r in spark.read.parquet(sink).collect()) == ["1", "2"]
