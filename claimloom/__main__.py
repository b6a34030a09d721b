"""``python -m claimloom SETTINGS``: one run. SETTINGS is a JSON file, or ``-`` for standard input; it names the
workspace, the store, the run's id and time, and may name the scorer's answers (``folder`` or ``file``) or ``command``."""

from __future__ import annotations

import json
import os
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from claimloom.plans.engine import Engine, Settings
from claimloom.plans.scorers import AskingScorer, Command, Records, RuleScorer


def main(place: str) -> int:
    given = json.loads(sys.stdin.read() if place == "-" else Path(place).read_text())
    scorer_of = given.pop("scorer", {})
    fixed = {k: given.pop(k) for k in list(given) if k not in ("workspace", "store", "profile", "timezone", "config")}
    settings = Settings.resolve(given, dict(os.environ), given.pop("config", {}), **fixed)
    if "command" in scorer_of:
        ask = Command(scorer_of["command"])
    elif scorer_of:
        ask = Records(scorer_of.get("folder"), scorer_of.get("file"))
    else:
        ask = None
    scorer = RuleScorer() if ask is None else AskingScorer(ask, settings.run_id, settings.mode, settings.profile)
    report = Engine(SparkSession.builder.getOrCreate(), settings, scorer).run()
    print(json.dumps(report, default=str, ensure_ascii=False))
    return 0 if report["status"] in ("ok", "skipped", "skipped_superseded") else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1]))
