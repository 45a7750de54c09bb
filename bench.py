"""Headline queries at one scale factor, one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores.  Each query is run once cold (a query of its own shape has not
run before) and once warm; `queries` holds the warm seconds, `cold` the cold
ones.  Results go to Spark's no-op sink: every column of every row is computed,
nothing is sent to Python.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harborline import build_session
from harborline.queries import QUERIES

HEADLINE = [
    "flagship_route", "env_create", "env_mime_by_ext", "val_first_failure", "dd_batch",
    "dd_two_tier", "dd_content_hash", "pipe_route", "pipe_batch", "repo_write",
    "repo_current_status", "agg_dlq_stats", "agg_job_counters", "agg_histogram",
    "cur_stamp_running", "win_job_transitions", "retry_due", "res_circuit_state",
    "src_table_snapshot", "src_table_row_docs", "src_row_pk", "src_cdc_docs", "src_object_scan",
    "src_web_docs", "src_api_items", "src_feed_docs", "src_slack_messages", "src_mail_messages",
    "src_wiki_content", "src_note_pages", "src_code_files", "src_code_issues", "src_code_pulls",
    "jn_mime_route", "fn_html_to_text", "fn_html_to_markdown", "crawl_link_graph",
    "crawl_bfs_depth", "src_webhook_events", "win_push_file_status", "st_polling", "st_webhook",
    "st_process",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold, warm = {}, {}
    for name in names:
        cold[name], warm[name] = once(name), once(name)
        print(f"{name:24s} cold {cold[name]:7.2f} warm {warm[name]:7.2f}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "cold": cold,
                      "sf": os.path.basename(root.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
