"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind import queries as registry  # noqa: E402
from tradewind import session  # noqa: E402
from tradewind.plans.warehouse import Warehouse  # noqa: E402

HEADLINE = [
    "silver_geolocation_dedup", "gold_dim_customer", "gold_dim_unique_customer",
    "gold_fact_orders", "gold_fact_order_items", "gold_customer_rfm", "dash_kpi_monthly",
    "dash_kpi_daily", "dash_category_monthly", "dash_retention_snapshot",
    "dash_retention_monthly", "dq_feature_readiness", "dq_primary_key_dup",
    "dq_payment_percentiles", "dq_payment_reconciliation", "dq_referential_integrity",
    "eda_pareto_customers", "bi_top_categories", "ml_features", "ml_random_forest", "ml_recursive_forecast",
    "layered_build",
]


def timed(name: str, spark, folder: str) -> float:
    start = time.perf_counter()
    if name == "layered_build":  # every table of every layer, each written once
        Warehouse.from_testdata(spark, folder).materialise(session.scratch_path(spark, "layers"))
    else:
        registry.run(name, spark, folder).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    session.clear(spark)
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.create("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    session.use_local_folder(spark)
    registry.load_all()
    names = sys.argv[1:] or HEADLINE
    timed("dash_kpi_daily", spark, folder)  # start the session's threads and code paths
    seconds, failed = {}, {}
    for name in names:
        try:
            seconds[name] = round(timed(name, spark, folder), 3)
        except Exception as error:  # the other figures still count
            failed[name] = str(error).splitlines()[0][:200]
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")),
        **({"failed": failed} if failed else {})}))
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
