"""Which stages of a run have finished, so that a restarted run goes on after the last."""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from forecourt.commits import Files


class Ledger:
    """Results of the finished stages of one run, one small file each, under ``root``.

    A stage is recorded after its work, so a run that dies in between does that stage again:
    each must come to the same result then. Stages that store a table do, as they are one commit.
    """

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.files, self.run = Files(spark, root), run

    def step(self, name: str, work: Callable[[], Any]) -> Any:
        """The recorded result of the stage, or that of ``work``, which is then recorded."""
        if f"{name}.json" in self.files.names(self.run):
            return json.loads(self.files.read(f"{self.run}/{name}.json"))["result"]
        result = work()
        draft = f"{self.run}/.{name}.draft"
        self.files.delete(draft)
        self.files.write(draft, json.dumps({"result": result}))
        self.files.publish(draft, f"{self.run}/{name}.json")
        self.files.delete(draft)
        return result
