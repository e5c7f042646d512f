"""The streaming log counts equal the batch counts over the same files."""

import tempfile

from quarry.operators import weblog as wl
from quarry.sources import standins as si
from quarry.sources.files import read_access_log
from quarry.streaming import start_group_counts


def test_stream_equals_batch(spark, sf_small):
    folder = tempfile.mkdtemp(prefix="quarry-stream-")
    lines = si.access_log(spark.read.parquet(f"{sf_small}/events.parquet"))
    lines.repartition(3).write.mode("overwrite").text(folder + "/in")
    q = start_group_counts(spark, folder + "/in", name="t_stream_counts",
                           checkpoint=folder + "/ckpt")
    try:
        q.processAllAvailable()
        got = {r.grp: r.requests for r in spark.sql("SELECT * FROM t_stream_counts").collect()}
    finally:
        q.stop()
    batch = wl.requests_by_group(wl.parse_log(read_access_log(spark, folder + "/in")))
    want = {r.grp: r.requests for r in batch.collect() if r.requests}
    assert got == want
