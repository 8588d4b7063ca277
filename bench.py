"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs per
query after one that warms up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from dataclasses import replace

from cohortry.operators.cohort import eligibility, keep_eligible
from cohortry.operators.exposure import require_lookback
from cohortry.operators.flags import baseline_exposure_flag
from cohortry.operators.keyfilter import early_filter
from cohortry.operators.outcome import add_outcome
from cohortry.plans import QUERIES
from cohortry.plans.cohorts import exposed
from cohortry.plans.views import MEDICATIONS, Views
from cohortry.plans.whole import whole_study
from cohortry.session import local_session
from cohortry.sources.tables import materialise

HEADLINE = (
    "add_first_exposure", "attrition_table", "acceptable_cohort", "add_outcome", "add_study_end", "baseline_exposure_flags",
    "condition_flags", "latest_measurement", "research_dataset", "first_treatment_share", "treatment_sequence", "rollup_codes",
    "rollup_values", "value_timeline", "cross_section", "smd_pairs", "table_one", "chi_square_pairs", "welch_t_pairs",
    "profile_columns", "box_summary", "tmle_binary", "whole_research", "whole_research_bucketed", "whole_research_early", "running_counts",
    "tmle_crossfit",
)


def one_join_per_list(spark, sf_dir):
    """The eleven medication flags added one after the other, to compare with ``baseline_exposure_flags``."""
    v = Views(spark, sf_dir)
    patients = require_lookback(exposed(v)).withColumnRenamed("first_exposure_date", "index_date").select("patid", "study_entry_date", "index_date")
    for name in MEDICATIONS:
        codes = v.medication_lists.filter(f"list_name = '{name}'")
        patients = baseline_exposure_flag(patients, v.drug_issue, codes, name)
    return patients


def outcomes(early: bool):
    """Outcomes of stored, eligible patients, from all observations or from those a filter of the patients leaves."""

    def build(spark, sf_dir):
        v = Views(spark, sf_dir)
        study = whole_study(v)
        patients = materialise(keep_eligible(eligibility(v.patient, v.drug_issue, None, replace(study, outcome=None, exclusion=None)), study, False))
        events = early_filter(v.rare_observation, patients) if early else v.rare_observation
        return add_outcome(patients, events, study.outcome)

    return build


def seconds(build, spark, sf_dir) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def plan_counts(build, spark, sf_dir) -> dict[str, int]:
    """File scans and exchanges in the plan as first made."""
    text = build(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    return {"scans": text.count("FileScan "), "exchanges": text.count("Exchange hashpartitioning")}


def shuffled_bytes(build, spark, sf_dir) -> int:
    """Bytes written by the exchanges of the query's last step, from the metrics of its executed plan."""
    df = build(spark, sf_dir)
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            written = node.metrics().get("shuffleBytesWritten")
            total += written.get().value() if kind == "ShuffleExchangeExec" and written.isDefined() else 0
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus, runs = os.environ.get("BENCH_CPUS", "8"), int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    times, plans = {}, {}
    for name, build in [*((n, QUERIES[n]) for n in HEADLINE), ("flags_one_join_per_list", one_join_per_list)]:
        seconds(build, spark, sf_dir)
        plans[name] = plan_counts(build, spark, sf_dir)
        times[name] = round(statistics.median(seconds(build, spark, sf_dir) for _ in range(runs)), 3)
    per_list = times.pop("flags_one_join_per_list")
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or "nan"),
        "one_join_per_list_sec": per_list, "one_pass_speedup": round(per_list / times["baseline_exposure_flags"], 2),
        "shuffled_bytes": {name: shuffled_bytes(outcomes(early), spark, sf_dir) for name, early in (("outcomes", False), ("outcomes_early", True))},
        "plans": plans,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
