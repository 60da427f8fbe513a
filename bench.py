"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from touchline.plans.catalog import as_spark_queries
from touchline.session import local_session
from touchline.sources.adapter import Tables

HEADLINE = [
    "a01_team_passing", "a03_pass_map", "a04_team_passing_adv", "a12_shots", "a14_sca_totals", "a17_team_defending", "a23_team_poss_adv", "a24_state_agg",
    "w10_sequence_rows", "w12_states", "x03_player_xwalk", "m16_fct_shots", "m25_agg_player_season", "s12_upsert", "s26_odds_long",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, times = as_spark_queries(), {}
    spark.range(1000).selectExpr("sum(id)").collect()

    def timed(work) -> float:
        start = time.perf_counter()
        work().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    times["feed_derivation"] = timed(lambda: Tables(spark, sf_dir).feed)
    times |= {name: timed(lambda: queries[name](spark, sf_dir)) for name in HEADLINE}
    warm = {name: timed(lambda: queries[name](spark, sf_dir)) for name in HEADLINE}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "warm": warm, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}), flush=True)


if __name__ == "__main__":
    main()
