"""Headline timings: prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4).
Each query runs to completion with the ``noop`` sink (no collect to the driver) after one
warm-up run of the smallest query; jobs that write (migrate) are timed end to end.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ferry.functions.normalise import normalise  # noqa: E402
from ferry.operators import compare as C  # noqa: E402
from ferry.operators import graph as G  # noqa: E402
from ferry.operators import keys as K  # noqa: E402
from ferry.operators.profile import column_stats  # noqa: E402
from ferry.plans import fixtures as FX  # noqa: E402
from ferry.plans import migrate as M  # noqa: E402
from ferry.plans import quality as Q  # noqa: E402
from ferry.plans.catalog import star_configs  # noqa: E402
from ferry.session import build_session, run_dir  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    spark = build_session(f"local[{cpus}]", app="ferry-bench", shuffle_partitions=max(8, 2 * cpus))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    def sink(df):
        df.write.format("noop").mode("overwrite").save()

    # the test tables are one file with one row group, which a single task would read; large tables
    # arrive in many splits, so only the bench deals the rows out
    def dealt(name):
        return FX.read(spark, sf_dir, name).repartition(2 * cpus)

    lineitem = dealt("lineitem")
    li_text = normalise(lineitem, "load")
    documents = normalise(dealt("documents"), "load")
    orders_src = normalise(dealt("orders"), "load")

    queries = {
        # Every lineitem value through the read and load rules
        "normalise_lineitem": lambda: sink(li_text),
        # N6/N7/N12 on long text: padding, NFC, truncation
        "normalise_documents": lambda: sink(documents),
        # Q3/Q4/Q7: exact profile of every lineitem column
        "column_stats_lineitem": lambda: sink(column_stats(li_text, normalise_booleans=True)),
        "column_stats_documents": lambda: sink(column_stats(documents, normalise_booleans=True)),
        # Q1 + Q6-Q11 + Q14: a full table check of lineitem against a target copy
        "table_check_lineitem": lambda: sink(Q.table_check(
            spark, li_text, dealt("lineitem").transform(lambda d: normalise(d, "load"))
            .toDF(*[c.upper() for c in lineitem.columns]), "LINEITEM")),
        # Q12: keyed row comparison of orders against a damaged copy
        "compare_rows_by_key_orders": lambda: sink(C.compare_rows_by_key(
            orders_src.toDF(*[c.upper() for c in orders_src.columns]), FX.damaged_orders(spark, sf_dir, 2),
            ["O_ORDERKEY"])),
        # K5: primary-key violations of lineitem
        "pk_violations_lineitem": lambda: sink(K.pk_violations(lineitem, ["l_orderkey", "l_linenumber"])),
        # Load levels of the row-level foreign-key graph with reply chains and a cyclic part
        "dep_levels": lambda: sink(G.dependency_levels(FX.graph_edges(spark, sf_dir))),
        # Copy orders end to end (read, clean, stage, verify, check, publish)
        "migrate_orders": lambda: M.migrate_table(
            spark, [c for c in star_configs(sf_dir) if c["target_table"] == "ORDERS"][0],
            run_dir(spark, "bench-migrate")),
    }

    sink(FX.read(spark, sf_dir, "region"))  # warm-up: JVM, file listing
    sink(li_text)
    timings = {}
    for name, fn in queries.items():
        start = time.time()
        out = fn()
        if isinstance(out, dict) and out.get("error"):
            raise RuntimeError(out["error"])
        timings[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
