"""Time the headline queries: one warm-up, then the median of three runs.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cantiga.plans.queries import QUERIES  # noqa: E402
from cantiga.session import CHECKPOINT_DIR, build_session  # noqa: E402

HEADLINES = [
    "extract_links",
    "extract_lyrics",
    "clean_text",
    "exclude_listed_phrases",
    "lang_profile",
    "lang_detect",
    "artist_delta",
    "upsert_artists",
    "upsert_songs",
    "upsert_lyrics",
    "assign_ids",
    "constraint_report",
    "release_rows",
    "top_artists",
    "artist_stats",
    "incremental_run",
]
# A run writes a whole catalogue twice; it is timed once, when all else is warm.
RUNS = {"incremental_run": 1}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            CHECKPOINT_DIR: shared,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    queries = {}
    for name in HEADLINES:
        if name not in RUNS:
            once(name)
        queries[name] = round(statistics.median(once(name) for _ in range(RUNS.get(name, 3))), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": float(Path(sf_dir).name.removeprefix("sf")),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
