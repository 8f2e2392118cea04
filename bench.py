"""Time the headline jobs on one table folder; prints one JSON line.

``BENCH_SF_DIR`` names the folder (default sf0.1), ``BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession
from pyspark.sql import functions as F  # noqa: E402

from changefeed.operators.rules import load_rules  # noqa: E402
from changefeed.plans import reads  # noqa: E402
from changefeed.plans.capture import Capture  # noqa: E402
from changefeed.plans.materialize import resolve_epoch  # noqa: E402
from changefeed.plans.replay import replay  # noqa: E402
from changefeed.queries import QUERIES, load_all  # noqa: E402
from changefeed.session import local_session, shared_dir, stage  # noqa: E402
from changefeed.sources.feed import change_log  # noqa: E402
from changefeed.sources.orders import ORDERS_SPEC, order_rows  # noqa: E402
from changefeed.streaming.tables import Generations  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
AS_OF = datetime(2030, 1, 1, tzinfo=UTC)
READS = (
    "keyset_scan",
    "keyset_page",
    "batch_slices",
    "change_events",
    "rule_report",
    "events_page",
    "entity_history",
    "lag_stats",
)


def warm_up(spark: SparkSession, root: str) -> None:
    """One untimed pass over the smallest tables: the published numbers to compare
    with are those of long-running processes, not of a JVM that just started."""
    small = Path(SF_DIR).parent / "sf0.001"
    if not small.exists():
        return
    source = stage(order_rows(spark, str(small)), "source", path=f"{root}/source")
    Capture(spark, f"{root}/capture", ORDERS_SPEC).run_cycle(source, as_of=AS_OF)
    log = stage(change_log(spark, str(small)), "log", path=f"{root}/log")
    tables = Generations(spark, f"{root}/sink").current()
    for epoch in range(2):
        resolve_epoch(log, tables, load_rules(), epoch)


def main() -> None:
    spark = local_session(CPUS, memory="16g")
    load_all()
    root = f"{shared_dir(spark)}/changefeed/bench-{uuid.uuid4().hex}"
    rules, generations = load_rules(), Generations(spark, f"{root}/sink")
    seconds: dict[str, float] = {}
    rates: dict[str, int] = {}

    def timed(name: str, job: Callable[[], int | None]) -> None:
        started = time.perf_counter()
        rows = job()
        seconds[name] = round(time.perf_counter() - started, 3)
        if rows:
            rates[name] = round(rows / seconds[name])

    warm_up(spark, f"{root}/warm")
    source = stage(order_rows(spark, SF_DIR), "source", path=f"{root}/source")
    log = stage(change_log(spark, SF_DIR), "log", path=f"{root}/log")

    def capture() -> int:
        return Capture(spark, f"{root}/capture", ORDERS_SPEC).run_cycle(source, as_of=AS_OF).rows

    timed("capture_cycle", capture)
    timed("resolve_new", lambda: resolve_epoch(log, generations.current(), rules, 0))
    timed("resolve_redelivered", lambda: resolve_epoch(log, generations.current(), rules, 1))

    def rebuild() -> int:
        replay(log, generations, rules, rebuild=True)
        tables = generations.current()
        return tables.epoch_outcomes(tables.last_commit().epoch).agg(F.sum("records")).first()[0]

    timed("rebuild", rebuild)
    tables = generations.current()

    def noop(df: object) -> None:
        df.write.format("noop").mode("overwrite").save()

    timed("current_state", lambda: noop(tables.current_state()))
    timed(
        "checksums",
        lambda: noop(
            reads.table_checksums(
                tables.current_state(), tables.event_log(), tables.quarantine()
            )
        ),
    )
    timed(
        "entity_view",
        lambda: noop(
            reads.entity_view(
                tables.current_state(), tables.event_log(), tables.quarantine(), limit=10
            )
        ),
    )
    for name in READS:
        timed(name, lambda name=name: noop(QUERIES[name](spark, SF_DIR)))
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
                "rows_per_second": rates,
            }
        )
    )


if __name__ == "__main__":
    main()
