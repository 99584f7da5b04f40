"""Skew and scale check (BASELINE protocol): the packet view replicated x50
with shifted time and ids, and the packet view with every packet on one
sender MAC.  Times the sliding rules and checks the x50 counts.

Usage: python tools/scale_check.py [sf_dir] [copies]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from lanwatch.operators import features as W  # noqa: E402
from lanwatch.operators import rules as R  # noqa: E402
from lanwatch.session import local_session  # noqa: E402
from lanwatch.sources import fixture  # noqa: E402


def run(make) -> float:
    t0 = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 2)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 50
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), shuffle_partitions=64, app="lanwatch-scale")
    base = fixture.packets(spark, sf_dir)
    lo, hi, n = W.time_bounds(base)
    shift = hi - lo + 600 * 1_000_000           # copies never share a 60 s window
    rep = (base.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_c"))
           .select((F.col("seq") + F.col("_c") * F.lit(n)).alias("seq"),
                   (F.col("ts_us") + F.col("_c") * F.lit(shift)).alias("ts_us"),
                   "op", "src_mac", "dst_mac", "src_ip", "dst_ip"))
    hot = base.withColumn("src_mac", F.lit("02:00:00:00:99:99"))
    out = {"sf_dir": sf_dir, "copies": copies, "rows_replicated": n * copies, "rows_hot": n}
    rules = {"rule_duplicate_ip": R.rule_duplicate_ip, "rule_unusual_rate": R.rule_unusual_rate,
             "rule_request_storm": R.rule_request_storm}
    for name, fn in rules.items():
        out[f"{name}_x{copies}_sec"] = run(lambda: fn(rep))
        out[f"{name}_x{copies}_exact"] = fn(rep).count() == fn(base).count() * copies
        out[f"{name}_hot_sec"] = run(lambda: fn(hot))
        out[f"{name}_hot_rows"] = fn(hot).count()
    out[f"rule_ip_mac_change_x{copies}_sec"] = run(lambda: R.rule_ip_mac_change(rep))
    out[f"window_features_x{copies}_sec"] = run(lambda: W.engineer_features(rep))
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
