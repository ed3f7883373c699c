"""Time every catalogue query (noop sink) in one warm session: python scripts/time_queries.py SF_DIR [names]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zonecast.plans import catalog  # noqa: E402
from zonecast.session import get_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(catalog.QUERIES)
    spark = get_session("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "16g"})
    catalog.QUERIES["hourly_demand"](spark, sf).write.format("noop").mode("overwrite").save()
    for n in names:
        t0 = time.perf_counter()
        df = catalog.QUERIES[n](spark, sf)
        t1 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        t2 = time.perf_counter()
        print(f"{n:26s} build {t1 - t0:6.2f}s  run {t2 - t1:6.2f}s", flush=True)


if __name__ == "__main__":
    main()
