"""``python -m agrolith build|rebuild|monitor|preprocess``: the flows over files, with Parquet results.

``--archive`` is a folder with the store of uploads and the archive by days; one with an archive in a single table can be read.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime
from pathlib import Path

from agrolith import config
from agrolith.operators import alerts, archive, ledger, store
from agrolith.plans import flows
from agrolith.session import session
from agrolith.sources import logger_files


def _yaml(path: str | None) -> dict | None:
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8")) if path else None


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="agrolith", description=__doc__)
    p.add_argument("flow", choices=["build", "rebuild", "monitor", "preprocess"])
    p.add_argument("--archive", required=True)
    p.add_argument("--files", nargs="*", default=[])
    p.add_argument("--registry", default="registry.yaml")
    p.add_argument("--config")
    p.add_argument("--growth")
    p.add_argument("--surveys", nargs="*")
    p.add_argument("--lag-days", type=int)
    p.add_argument("--window-days", type=int)
    p.add_argument("--alerts", help="folder of a log of alerts that are due, and of the cool-down's state")
    p.add_argument("--sensor-map", help="YAML: loggers, their treatments and shared channels")
    p.add_argument("--overrides", help="YAML: variables of column names")
    p.add_argument("--out", default="out")
    p.add_argument("--format", choices=["parquet", "csv"], default="parquet", help="of the stored results")
    p.add_argument("--now", type=datetime.fromisoformat, default=None)
    a = p.parse_args(args)
    spark, cfg, now = session(), config.load(a.config), a.now or datetime.now().replace(microsecond=0)
    if a.flow in ("build", "rebuild"):
        registry, overrides = store.load_registry(a.registry), _yaml(a.overrides)
        told = flows.add_uploads(spark, a.files, a.archive, registry, now, cfg, overrides) if a.flow == "build" else flows.rebuild(spark, a.archive, registry, cfg, overrides)
        if "problems" in told:
            archive.summary(ledger.read(spark, f"{a.archive}/archive")).show(truncate=False)
            told["problems"].show(truncate=False)
        return 0
    master = ledger.read(spark, f"{a.archive}/archive")
    if master is None:
        master = archive.read(spark, a.archive)
    if master is None:
        p.error(f"no archive at {a.archive}")
    if a.flow == "monitor":
        found, state = flows.monitor(master, cfg, now)
        if cfg["alerts"]["console"]:
            print(alerts.text(found, a.archive))
        if a.alerts and cfg["alerts"]["log"]:
            _, outcome = flows.send(found, cfg, now, f"{a.alerts}/state", {"log": lambda df: alerts.to_json(df, f"{a.alerts}/log", now)})
            print(outcome)
        store.save_result({"alerts": found, "health": state}, a.out, "monitor", now, kind=a.format)
        return alerts.exit_code(found)
    growth = logger_files.growth(spark, a.growth) if a.growth else None
    tables = flows.preprocess(master, cfg, growth, a.surveys, _yaml(a.sensor_map), lag_days=a.lag_days, window_days=a.window_days)
    print(store.save_result(tables, a.out, "preprocess", now, kind=a.format))
    return 0


if __name__ == "__main__":
    sys.exit(main())
