"""Staging, a dimension, the status breakdown and totals over the events repeated many times, a third
of all rows on one repository and a third on one actor.

    python tools/bench_scale.py [sf_dir] [copies]

Prints one line per step. The rows are written once to the session's scratch folder.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from catalogue.models import enriched  # noqa: E402
from forgelake.operators.rollups import activity_by_repo_actor  # noqa: E402
from forgelake.plans import exports, marts  # noqa: E402
from forgelake.plans.staging import stg_events  # noqa: E402
from forgelake.session import local_session  # noqa: E402
from forgelake.sinks.files import Scratch  # noqa: E402


def main(sf_dir: str, copies: int) -> None:
    spark = local_session()

    def timed(label: str, df) -> None:
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        print(f"{label}: {time.perf_counter() - start:.1f} s", flush=True)

    with Scratch(spark) as scratch:
        copy = spark.range(copies).withColumnRenamed("id", "copy")
        many = enriched(spark, sf_dir).join(F.broadcast(copy))
        third = F.pmod(F.xxhash64("event_id", "copy"), F.lit(3))
        many = many.withColumns(
            {
                "event_id": F.concat_ws("-", "copy", "event_id"),
                "repo_name": F.when(third == 0, F.lit("hot/repo")).otherwise(F.col("repo_name")),
                "actor": F.when(third == 1, F.lit("hot-bot")).otherwise(F.col("actor")),
            }
        )
        rows = scratch.write(many.drop("copy"), "many")
        print(f"rows: {rows.count()}", flush=True)
        timed("staging", stg_events(rows, ["c"]))
        stg = scratch.write(stg_events(rows, ["c"]), "many-staged")
        timed("dimension", marts.dim_repos(stg))
        timed("status breakdown", exports.pr_breakdown(marts.fact_prs(stg), 10_000, per_repo=True))
        timed("totals", exports.kpi_totals(activity_by_repo_actor(stg)))
    spark.stop()


if __name__ == "__main__":
    args = sys.argv[1:]
    main(args[0] if args else "/root/testdata/sf0.1", int(args[1]) if len(args) > 1 else 60)
