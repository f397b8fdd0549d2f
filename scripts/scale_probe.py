"""Scaling probe: time line-item-heavy queries on sf0.1 and on a 10x
line-item table that Spark derives from it (ten copies with shifted order
keys, written to the checkpoint folder; the other tables are linked).
Prints one JSON object {query: [seconds at 1x, seconds at 10x]}.

usage: python scripts/scale_probe.py [sf_dir]   (local file system only)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from terracat.plans.driver_tables import TABLES  # noqa: E402
from terracat.queries import QUERIES  # noqa: E402
from terracat.session import get_session, scratch_path  # noqa: E402

NAMES = ["dense_ids", "check_key", "eav", "load_edges", "reverse_edges", "attr_index", "valid_on",
         "eav_decoded"]


def main():
    base = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    big = scratch_path(spark, "sf_x10").replace("file:", "")
    os.makedirs(big)
    for t in TABLES:
        if t != "lineitem":
            os.symlink(f"{base}/{t}.parquet", f"{big}/{t}.parquet")
    li = spark.read.parquet(f"{base}/lineitem.parquet")
    step = li.agg(F.max("l_orderkey")).first()[0] + 1
    (li.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(9))))          # ten copies per row
       .withColumn("l_orderkey", F.col("l_orderkey") + F.col("c") * step)
       .drop("c").repartition(16).write.parquet(f"{big}/lineitem.parquet"))
    for n in NAMES:  # warm-up
        QUERIES[n][0](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    res = {}
    for d in (base, big):
        for n in NAMES:
            t = time.time()
            QUERIES[n][0](spark, d).write.format("noop").mode("overwrite").save()
            res.setdefault(n, []).append(round(time.time() - t, 2))
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
