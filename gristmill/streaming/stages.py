"""Stage state: PENDING, RUNNING, PASS, BLOCKED, PARTIAL or ERROR, in one JSON file
beside the outputs.  A stage may be skipped only if it passed on the same inputs
and the same configuration."""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import atomic_write

STATES = ("PENDING", "RUNNING", "PASS", "BLOCKED", "PARTIAL", "ERROR")


class Blocked(RuntimeError):
    """A stage cannot go on with what there is; a result, not a failure."""


def config_hash(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def input_fingerprint(spark: SparkSession, path: str) -> str:
    """Hash of path, size and time of every input file, as Spark's reader lists them."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.concat_ws("|", "path", F.col("length").cast("string"), F.col("modificationTime").cast("string")).alias("x"))
    return f.agg(F.sha2(F.array_join(F.sort_array(F.collect_list("x")), "\n"), 256)).first()[0]


class Stages:
    def __init__(self, path: str):
        self.path = path
        self.state: dict[str, dict] = {}
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                self.state = json.load(f)
        for s in self.state.values():
            if s["state"] == "RUNNING":  # its process is gone
                s["state"] = "PARTIAL"

    def can_skip(self, name: str, inputs: str, config: str, expected: dict | None = None) -> bool:
        """expected are further details that the finished stage must have recorded."""
        s = self.state.get(name, {})
        return s.get("state") == "PASS" and s.get("inputs") == inputs and s.get("config") == config and all(s.get(k) == v for k, v in (expected or {}).items())

    def mark(self, name: str, state: str, **more) -> None:
        if state not in STATES:
            raise ValueError(state)
        self.state[name] = {**self.state.get(name, {}), **more, "state": state}
        atomic_write(self.path, json.dumps(self.state, sort_keys=True, indent=1))

    def run(self, name: str, f, inputs: str, config: dict) -> str:
        """Run a stage unless it passed already; exceptions become states."""
        c = config_hash(config)
        if self.can_skip(name, inputs, c):
            return "PASS"
        self.mark(name, "RUNNING", inputs=inputs, config=c)
        try:
            f()
            state, why = "PASS", ""
        except (Blocked, OSError) as e:
            state, why = "BLOCKED", str(e)
        except KeyboardInterrupt:
            state, why = "PARTIAL", "interrupted"
        except Exception as e:  # noqa: BLE001  (every other failure is the stage's result)
            state, why = "ERROR", f"{type(e).__name__}: {e}"
        self.mark(name, state, reason=why)
        return state


def sequence_check(chunks: DataFrame, key: str) -> None:
    """Chunk numbers must be 0 to n - 1."""
    r = chunks.agg(F.count_distinct(key), F.min(key), F.max(key)).first()
    if r[0] and (r[1] != 0 or r[2] != r[0] - 1):
        raise Blocked(f"chunks {r[1]} to {r[2]} are not contiguous")
