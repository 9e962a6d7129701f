"""Input and shuffle bytes per bench phase, from Spark's event log.

Shuffle and output bytes come from task metrics (Parquet input bytes are not
reliable in local mode and are left out). Runs the cleaning job, the model build and a few serving queries once with the
event log written to a fresh scratch folder, then sums task metrics per phase
(job description → stages → task-end events).

    python tools/io_report.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll import queries as Q  # noqa: E402
from tillroll.operators.materialize import written  # noqa: E402
from tillroll.params import FIXTURE  # noqa: E402
from tillroll.plans import staging  # noqa: E402
from tillroll.plans.models import ModelSet, models  # noqa: E402
from tillroll.session import build_session  # noqa: E402

PHASES = ["cleaning_job", "build_models", "reject_reasons", "shops", "recent_daily",
          "revenue_by_weekday", "calendar_spine_daily"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-evlog-", dir="/tmp")
    spark = build_session("local[8]", 16, app_name="tillroll-io", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    sc = spark.sparkContext
    processed = models(spark, sf_dir).processed()
    for phase in PHASES:
        sc.setJobDescription(phase)
        if phase == "cleaning_job":
            written(staging.fixture_processed(spark, sf_dir, FIXTURE), "io_processed")
        elif phase == "build_models":
            ModelSet.over(processed, sf_dir, FIXTURE).build_all(parallel=False)
            sc.setJobDescription("prebuild")
            models(spark, sf_dir).build_all()     # the tables the serving queries read
        else:
            Q.QUERIES[phase](spark, sf_dir).write.format("noop").mode("overwrite").save()
    sc.setJobDescription(None)
    spark.stop()

    stage_phase, totals = {}, defaultdict(lambda: defaultdict(int))
    for path in [p for p in glob.glob(f"{log_dir}/**/*", recursive=True)
                 if os.path.isfile(p)]:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        stage_phase[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    phase = stage_phase.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if phase is None or not m:
                        continue
                    t = totals[phase]
                    t["shuffle_write_bytes"] += (m.get("Shuffle Write Metrics") or {}).get(
                        "Shuffle Bytes Written", 0)
                    t["output_bytes"] += (m.get("Output Metrics") or {}).get("Bytes Written", 0)
                    t["tasks"] += 1
    print(json.dumps({p: dict(totals[p]) for p in PHASES if p in totals}, indent=1))


if __name__ == "__main__":
    main()
