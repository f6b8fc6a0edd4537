"""Ordered stages over DataFrames with a run ledger, so that a stopped run goes on where it ended.

A stage is a function of the session and of the tables before it. Its result is
written to ``folder/<name>`` and reread, which cuts the lineage. The ledger
(``folder/run_ledger.json``) holds a fingerprint for each finished stage; a later
run reuses the longest prefix whose fingerprints are the same.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from types import CodeType

from pyspark.sql import DataFrame, SparkSession

LEDGER = "run_ledger.json"


@dataclass(frozen=True)
class Stage:
    """``needs``: tables the function takes, of inputs or earlier stages; ``params`` count for the fingerprint."""

    name: str
    run: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    params: Mapping[str, object] = field(default_factory=dict)


def check_plan(stages: list[Stage], inputs: Mapping[str, str]) -> None:
    """Refuses repeated names and tables that no input or earlier stage gives."""
    known = set(inputs)
    for s in stages:
        if s.name in known:
            raise ValueError(f"two tables are named {s.name}")
        if missing := [n for n in s.needs if n not in known]:
            raise ValueError(f"{s.name} needs {', '.join(missing)}, which nothing before it gives")
        known.add(s.name)


def _code(code: CodeType) -> list:
    """A function's instructions, names and constants, those of inner functions included."""
    fixed = [_code(c) if isinstance(c, CodeType) else sorted(map(repr, c)) if isinstance(c, frozenset) else repr(c) for c in code.co_consts]
    return [code.co_code.hex(), code.co_names, fixed]


def fingerprint(stage: Stage, before: Mapping[str, str]) -> str:
    """SHA-256 of the stage's name, code, parameters and what it reads.

    The code is that of the function itself; when one that it calls changes, give the stage a new parameter.
    """
    run = getattr(stage.run, "func", stage.run)
    code = _code(run.__code__) if hasattr(run, "__code__") else getattr(run, "__qualname__", "")
    said = {"name": stage.name, "code": code, "params": stage.params, "reads": {n: before[n] for n in stage.needs}}
    return hashlib.sha256(json.dumps(said, sort_keys=True, default=str).encode()).hexdigest()


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Path, length and time of every file below ``path``, by any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(path)
    it, out = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(top, True), []
    while it.hasNext():
        f = it.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def _read_ledger(spark: SparkSession, folder: str) -> dict[str, dict]:
    jvm = spark.sparkContext._jvm
    for name in (LEDGER, f"new_{LEDGER}"):  # a run that broke off between delete and rename left the new one, whole
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return json.loads("\n".join(r.value for r in spark.read.text(path.toString()).collect()))  # a line for each stage
    return {}


def _write_ledger(spark: SparkSession, folder: str, ledger: dict[str, dict]) -> None:
    jvm = spark.sparkContext._jvm
    path, new = (jvm.org.apache.hadoop.fs.Path(f"{folder}/{x}") for x in (LEDGER, f"new_{LEDGER}"))
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(ledger, indent=1, sort_keys=True).encode()))
    out.close()
    fs.delete(path, False)
    fs.rename(new, path)


def run_stages(spark: SparkSession, stages: list[Stage], inputs: Mapping[str, str], folder: str, resume: bool = True) -> dict[str, DataFrame]:
    """All tables by name. ``inputs``: name to Parquet path.

    The first failure stops the run: its stage is in the ledger as failed, with the
    error, and the stages before it stay reusable.
    """
    check_plan(stages, inputs)
    tables = {n: spark.read.parquet(p) for n, p in inputs.items()}
    prints = {n: hashlib.sha256(json.dumps(_files(spark, p)).encode()).hexdigest() for n, p in inputs.items()}
    old = _read_ledger(spark, folder) if resume else {}
    ledger: dict[str, dict] = {}
    for s in stages:
        prints[s.name] = fingerprint(s, prints)
        done, path = old.get(s.name, {}), f"{folder}/{s.name}"
        if resume and done.get("status") == "done" and done.get("fingerprint") == prints[s.name]:
            ledger[s.name] = done | {"reused": True}
        else:
            resume, began = False, time.time()  # nothing after a stage that ran is reused
            try:
                s.run(spark, *(tables[n] for n in s.needs), **s.params).write.mode("overwrite").parquet(path)
            except Exception as error:
                ledger[s.name] = {"status": "failed", "fingerprint": prints[s.name], "error": str(error)[:500]}
                _write_ledger(spark, folder, ledger)
                raise
            ledger[s.name] = {"status": "done", "fingerprint": prints[s.name], "rows": spark.read.parquet(path).count(), "seconds": round(time.time() - began, 3), "reused": False}
        tables[s.name] = spark.read.parquet(path)
        _write_ledger(spark, folder, ledger)
    return tables
