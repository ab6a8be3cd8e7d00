"""Time the headline queries at one scale and print one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from scriptloom.operators.catalog import catalog
from scriptloom.plans.queries import QUERIES
from scriptloom.session import local_session
from scriptloom.sources import corpora

HEADLINES = (
    "dedent",
    "strip_comments",
    "clean_body",
    "rejects",
    "full_catalog",
    "routine_arguments",
    "options_table",
    "free_text_tokens",
    "free_text_names",
    "references",
    "foreign_datasets",
    "qualified_bodies",
    "layers_chain",
    "layers_turns",
    "layers_star",
    "creation_layers",
    "access_grants",
)


def full_catalog(spark, sf_dir):
    return catalog(corpora.order_scripts(spark, sf_dir))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus=cpus)
    runs = dict(QUERIES, full_catalog=full_catalog)
    # Start the session's workers and read one table, so that no query pays for it.
    corpora.read_table(spark, sf_dir, "orders").count()

    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        # Every column of every row is computed; nothing is written or collected.
        runs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
