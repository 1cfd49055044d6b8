"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the threads, BENCH_QUERIES (comma list, or ``all``)
other queries than the headline ones.
"""

from __future__ import annotations

import json
import os
import re
import time

from millrace.catalog import QUERIES
from millrace.session import build_session

HEADLINE = (
    "W03_load_merge W04_load_delete_insert W06_load_scd2 W09_dedup_by_key T15_queue_dedup_merge "
    "W06_history_load W08_full_refresh W22_commit_then_ack T16_ack_after_commit W01_load_replace W02_load_append W05_load_merge_two_keys W11_route_tables W12_partition_by W13_cluster_by "
    "W15_write_dataset W19_shred_nested W21_evolve_schema I01_read_incremental I02_boundary_dedup I05_custom_query "
    "I14_lookback I17_offset_partitions S01_scan_csv S05_scan_json S08_scan_xml "
    "M01_mask_sha256 M03_mask_hmac M06_mask_credit_card M12_mask_partial M17_mask_sequential M22_mask_table "
    "T01_drain_topic T02_envelope_v1 T15_stream_dedup R03_unwrap_nodes R08_unnest_series R09_map_to_rows "
    "R10_rollup_nested R15_repair_dates R21_fan_out R34_link_rows"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first job pays for starting the engine, not for any query.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
