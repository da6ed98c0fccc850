"""Print the physical operator trees of the main plans (for PLANS.md).

    python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordersmith import operators as op  # noqa: E402
from ordersmith.plans import pipeline  # noqa: E402
from ordersmith.plans.sinks import LAYOUTS, read_table, write_table  # noqa: E402
from ordersmith.session import local_session, scratch_path  # noqa: E402
from ordersmith.sources.feeds import AS_OF, feeds_from_dir  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0].replace("== Physical Plan ==\n", "")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    m, s = feeds_from_dir(spark, sf_dir)
    canon = pipeline.canonical(m, s, AS_OF)
    fact = op.fact_orders(canon)
    path = scratch_path(spark, "plans-fact")
    write_table(fact, path, LAYOUTS["mart_fact_orders"])
    written = read_table(spark, path, fact.schema)
    for title, df in [
        ("canonical_orders (raw feeds -> dedupe -> canonical)", canon),
        ("kpi_daily_currency (over the written fact)", op.kpi_daily_currency(written, orders_unique=True)),
        ("kpi_country_daily (over the written fact)", op.kpi_country_daily(written, orders_unique=True)),
        ("dim_customers, no join (over the written fact)", op.dim_customers(written, AS_OF)),
        ("dim_customers_joined, reference form (over the written fact)", op.dim_customers_joined(written, AS_OF)),
        ("kpi_freshness_lag (over the written fact)", op.kpi_freshness_lag(written, orders_unique=True)),
    ]:
        print(f"### {title}\n\n```\n{tree(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
