"""Share statistics over a file stream (processed with availableNow)."""

import os

import pytest

from casebook.operators import stats
from casebook.streaming import shares


def test_running_shares_equal_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    rows = [("i", 1)] * 6 + [("i", 0)] * 4 + [("t", 1)] * 3 + [("t", 0)] * 7
    df = spark.createDataFrame(rows, "type string, from_mobile int")
    df.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    got = {}
    batches = []

    def keep(batch, batch_id):
        for r in batch.collect():
            got[r["type"]] = r

    q = (shares.running_shares(stream, "type", "from_mobile").writeStream.outputMode("complete")
         .foreachBatch(keep).option("checkpointLocation", os.path.join(tmp_dir, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    batch = {r["type"]: r for r in stats.share_interval(df, "type", "from_mobile", digits=None).collect()}
    for k in ("i", "t"):
        assert got[k]["n"] == batch[k]["n"] and got[k]["lo"] == pytest.approx(batch[k]["lo"])

    # one file a micro-batch: groups meet the control only in the totals
    rows = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q2 = (shares.running_shares(rows, "type", "from_mobile").writeStream.outputMode("complete")
          .foreachBatch(shares.ztest_totals("type", "i", lambda d, b: batches.append(d.collect())))
          .option("checkpointLocation", os.path.join(tmp_dir, "ck2")).trigger(availableNow=True).start())
    q2.awaitTermination(120)
    whole = stats.two_share_ztest(df, "type", "from_mobile", "i", digits=None).first()
    last = batches[-1][0]
    assert len(batches) > 1 and last["treatment"] == "t" and last["n_treatment"] == 10
    assert last["z"] == pytest.approx(whole["z"]) and last["equal_shares"] == whole["equal_shares"]
