"""Compare moving-average strategies on a larger synthetic input.

Generates N readings (default 10 million) on the executors, then times the
7-day neighborhood moving average (a few very large keys) with each strategy
into the noop sink.  Usage: python tools/scale_probe.py [N]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(n: int) -> None:
    from thermograph.operators.enrich import enrich
    from thermograph.operators.moving import moving_average
    from thermograph.operators.readings import generate_readings
    from thermograph.session import local_session

    spark = local_session(shuffle_partitions=64)
    df = enrich(generate_readings(spark, n, seed=5, num_partitions=16))
    spark.conf.set("spark.thermograph.smallInputBytes", "0")  # treat as large
    for strategy, bucket in (("plain", None), ("halo", "auto"), ("prefix", "auto"), ("auto", "auto")):
        for level in ("neighborhood", "room"):
            t0 = time.perf_counter()
            moving_average(df, level, "week", strategy=strategy, bucket=bucket) \
                .write.format("noop").mode("overwrite").save()
            print(f"{n} rows  {level:12s} week  {strategy:6s} {time.perf_counter() - t0:7.2f}s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000)
