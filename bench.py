"""Headline queries, timed: prints one JSON line.

``BENCH_SF_DIR`` (default the sf0.1 tables) and ``BENCH_CPUS`` (default 4) choose data and cores;
``BENCH_RUNS`` (default 3) timed runs follow one warm-up, and the median counts.  Every result is
consumed whole through the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagloom.operators import clustering, profiles  # noqa: E402
from tagloom.operators.tagging import level5_rules  # noqa: E402
from tagloom.plans.all_queries import PLANS, Data  # noqa: E402
from tagloom.plans.q_tags import register_standard_models  # noqa: E402
from tagloom.plans.registry import Run, definitions, model_result  # noqa: E402
from tagloom.session import build_session, cut_lineage  # noqa: E402

HEADLINE = [
    "tag_match", "tag_age_range", "tag_consume_cycle", "tag_pay_type", "rfm_metrics", "rfm_scores", "rfe_metrics",
    "psm_score", "usg_features", "tag_usg_rule", "tag_rfm_value", "tag_psm_sensitivity", "tag_model_run",
    "prf_batch_merge", "prf_tag_index", "prf_tag_counts", "prf_audience_all", "prf_audience_any",
    "prf_merge_tag_eval", "prf_user_portrait", "prf_tag_tree", "join_interval_lookup", "sink_keyed_upsert",
    "sink_cell_bulk_load", "stm_batched_commit",
]


def rfm_value_per_user(data: Data):
    """The same tag model trained on one row per user, for comparison with score compression."""
    scores = PLANS["rfm_scores"](data)
    columns = ["r_score", "f_score", "m_score"]
    vectors = clustering.assembled(scores, columns)
    model = clustering.fit_kmeans(vectors, 5)
    predicted = model.transform(vectors).select("uid", "prediction")
    return clustering.cluster_tags(
        predicted, clustering.ranked_clusters(model, vectors), level5_rules(data.model_tags, 361)
    )


def merge_one_after_another(data: Data):
    """Three models merged by three passes over the profile, for comparison with the one-pass merge."""
    data.view("orders"), data.view("customer")
    register_standard_models(data)
    profile = data.profile
    for run in (Run(347, "consume_cycle"), Run(356, "pay_type"), Run(332, "nationality")):
        result = model_result(data.spark, data.tags, run)
        profile = cut_lineage(profiles.merge_results([(run.tag_id, result)], profile, definitions(data.tags)), "profile")
    return profiles.render_profile(profile)


def timed(plan, spark, folder: str, runs: int) -> float:
    seconds = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        plan(Data(spark, folder)).write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:] or seconds), 4)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "tagloom-bench", master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {key: timed(PLANS[key], spark, folder, runs) for key in HEADLINE}
    compared = {
        "tag_rfm_value_per_user": timed(rfm_value_per_user, spark, folder, runs),
        "prf_merge_one_after_another": timed(merge_one_after_another, spark, folder, runs),
    }
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline queries, total of medians", "value": round(sum(queries.values()), 4), "unit": "sec",
        "queries": queries, "compared": compared, "sf": scale, "cpus": cpus, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
