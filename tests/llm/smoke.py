"""python tests/llm/smoke.py DIR NAME...: run queries on local[8] and print their time and first rows."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from aerolake.llm.oracle import ORACLE_SQL  # noqa: E402
from aerolake.llm.queries import QUERIES  # noqa: E402
from aerolake.session import build_session  # noqa: E402

if __name__ == "__main__":
    spark = build_session("local[8]", shuffle_partitions=12, extra={"spark.driver.memory": "6g"})
    spark.sparkContext.setLogLevel("ERROR")
    import corpus_pipeline

    for name in sys.argv[2:] or QUERIES:
        t0 = time.time()
        try:
            df = corpus_pipeline.run(spark, sys.argv[1]) if name == "pipeline" else QUERIES[name](spark, sys.argv[1])
            df.write.mode("overwrite").parquet(out := f"{os.environ.get('OUT', '/tmp/smoke')}/{name}")
            back = spark.read.parquet(out)
            print(f"{name}: {back.count()} rows in {time.time() - t0:.1f} s {back.dtypes}\n  ", *back.limit(3).collect(), sep="\n   ", flush=True)
        except Exception as e:  # noqa: BLE001
            print(f"{name}: FAILED {type(e).__name__}: {str(e)[:1500]}", flush=True)
    print(len(ORACLE_SQL), "oracles")
    spark.stop()
