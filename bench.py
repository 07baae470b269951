"""Times the headline queries: BENCH_SF_DIR (tables), BENCH_CPUS (cores); prints one JSON line."""

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "src_json_topic", "prj_json_fields", "flt_like_any", "flt_relevant", "sc_shift_decimal",
    "jn_interval", "jn_as_of", "jn_latest", "jn_zip_changes", "jn_hydrate", "jn_enrich",
    "ag_count_by", "ag_changelog", "ag_latest_by", "ag_collect", "wn_first", "wn_monotone", "wn_leaderboard",
    "wn_next_number", "set_dedup", "set_exclude", "rq_classify", "rq_flatten",
    "ex_two_level", "ex_decode_args", "ex_balance_changes",
    "ds_token_bonding_initializes", "ds_collective_create_unclaimed_tokens", "ds_collective_users_table",
    "ds_latest_bonding_token_account_balances", "ds_top_holders",
]
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    best = {}
    for name in HEADLINE:
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
            best[name] = min(seconds, best.get(name, seconds))
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": f"total of best of {RUNS} runs, {len(HEADLINE)} queries", "value": round(sum(best.values()), 3),
        "unit": "sec", "queries": {n: round(s, 3) for n, s in best.items()},
        "sf": float(scale.group(1)) if scale else None}))
    spark.stop()


if __name__ == "__main__":
    main()
