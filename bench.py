"""Time the headline queries over whole tables and print one JSON line.

Each query is run once to warm up and then `BENCH_RUNS` times; its time is the
median of writing the full result to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from rivulet.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
HEADLINE = (
    "filter if_route switch_route map split merge render_template partition_assign "
    "agg_sum agg_nested agg_window ledger_balance incr_ts_id keyset_page incr_per_group recent_n rowkey_range select_expand "
    "batch_count batch_key_change batch_bytes batch_json_array cdc_events cdc_pair_updates cdc_apply kv_latest state_change "
    "write_upsert write_merge write_increment points_range graph_nodes graph_edges "
    "chunk_chars chunk_words chunk_sentences chunk_recursive vector_upsert vector_topk "
    "pii_redact detect_language sentiment key_phrases tokens offset_translate checkpoints"
).split()


def main() -> None:
    spark = local_session(CPUS, "rivulet-bench", **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "12g"})
    from rivulet.plans import QUERIES

    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    seconds = {}
    for name in names:
        times = []
        for _ in range(RUNS + 1):
            begin = time.perf_counter()
            QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(times[1:]), 3)
    scale = FOLDER.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(scale) if scale.replace(".", "").isdigit() else scale, "cpus": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
