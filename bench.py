"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list).
Each query is planned and fully run into a no-op sink; the first run of each is a warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from concordat import bindings  # noqa: E402
from concordat.session import build_session  # noqa: E402

HEADLINE = (
    "scan_diff", "dominant_license", "bucket_scoped_match", "expression_histogram", "file_conflicts",
    "conflict_topk", "scan_summary", "verdict_counts", "fp_filter", "spdx_split", "spdx_normalize",
    "classify_verdict", "source_plan", "component_fields", "first_wins", "curation_override", "curation_anti",
    "upstream_ladder", "repo_conflicts", "url_repo_id", "html_probe_reject", "plausible_license_text",
    "redact_paths", "base64_roundtrip", "license_fingerprint", "drift_detect", "best_file_match",
    "longest_body", "body_assignment", "canonical_fallback", "first_n_per_group", "copyright_harvest",
    "header_evidence", "notices_semi", "hash_verify", "checksum_consistency", "release_notes",
    "release_delta", "release_delta_ranged", "verdict_pivot", "retro_flag", "retro_flag_ranged",
    "daily_flags", "errata_overlay", "enrichment", "stream_retro_flags",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, _ = bindings.load()
    names = wanted.split(",") if wanted else HEADLINE
    times = {}
    for name in names if wanted != "all" else queries:
        best = None
        for _ in range(2):
            t = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            spent = time.perf_counter() - t
            best = spent if best is None else min(best, spent)
        times[name] = round(best, 3)
        print(f"{name} {best:.2f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds over headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
