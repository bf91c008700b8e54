"""Run intents: a marker that a run takes before it publishes and gives back after its ledger append.

The marker is a file beside the ledger, created only where there is none. HDFS
and object stores with conditional writes do this atomically, so two runs of one
ledger at once cannot both take it; Hadoop's local file system, and stores
without such writes, look first and then create. A run that died
leaves it behind, with what it was about to publish, so the next run does not
publish those days a second time unnoticed: it stops with
:class:`RunIntentError` until somebody says ``recover``, which finishes or drops
the dead run.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from daybar.errors import RunIntentError
from daybar.plans.ledger import append_ledger, ledger_days, read_ledger
from daybar.session import delete_path, hadoop_path, path_exists


@dataclass(frozen=True)
class Intent:
    run_id: str
    as_of: str
    cutoff: str | None = None           # set once the run has planned its days
    days: tuple[str, ...] = ()          # days to record
    target: str | None = None           # where the report goes


def _paths(ledger_path: str) -> tuple[str, str]:
    parent, _, leaf = ledger_path.rstrip("/").rpartition("/")
    base = f"{parent}/_runs-{leaf}" if parent else f"_runs-{leaf}"
    return f"{base}/open", f"{base}/planned"


def _write(spark: SparkSession, path: str, text: str, overwrite: bool) -> bool:
    p, fs = hadoop_path(spark, path)
    try:
        out = fs.create(p, overwrite)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception) or "already exists" in str(e.java_exception):
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def _read(spark: SparkSession, path: str) -> Intent | None:
    if not path_exists(spark, path):
        return None
    text = "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())  # one short line
    try:
        got = json.loads(text)
    except ValueError:  # its run died while it wrote the file
        return Intent("unknown", "unknown")
    return Intent(**{**got, "days": tuple(got["days"])})


def open_intent(spark: SparkSession, ledger_path: str) -> Intent | None:
    """The intent of a run that has not ended (or died), with its plan if it got that far."""
    opened, planned = (_read(spark, p) for p in _paths(ledger_path))
    return planned if opened and planned and planned.run_id == opened.run_id else opened


def take_intent(spark: SparkSession, ledger_path: str, as_of: str) -> Intent:
    """Take the ledger's marker, before the ledger is read; raises :class:`RunIntentError` where it is taken."""
    mine = Intent(uuid.uuid4().hex, as_of)
    if not _write(spark, _paths(ledger_path)[0], json.dumps(asdict(mine)), overwrite=False):
        other = open_intent(spark, ledger_path)
        raise RunIntentError(f"another run of {ledger_path} is open, or died: {other}; "
                             "if it is dead, run again with recover")
    return mine


def plan_intent(spark: SparkSession, ledger_path: str, mine: Intent, cutoff: str, days, target: str) -> Intent:
    """Note what the run is about to publish and record."""
    mine = replace(mine, cutoff=cutoff, days=tuple(days), target=target)
    _write(spark, _paths(ledger_path)[1], json.dumps(asdict(mine)), overwrite=True)
    return mine


def close_intent(spark: SparkSession, ledger_path: str) -> None:
    opened, planned = _paths(ledger_path)
    delete_path(spark, planned)
    delete_path(spark, opened)


def recover_intent(spark: SparkSession, ledger_path: str) -> str | None:
    """End a dead run: ``recorded`` its days, ``closed`` it (all was done), ``dropped`` it, or None (there is none).

    If its report is there and the ledger lacks its cutoff day (a day that no
    ledger held when it was planned), its days are recorded now, so they are
    not published again. Without a report nothing was published, and the next
    plan takes the days up again. Only call it for a run known to be dead.
    """
    dead = open_intent(spark, ledger_path)
    if dead is None:
        return None
    done = "dropped"
    if dead.target and path_exists(spark, dead.target):
        ledger = read_ledger(spark, ledger_path)
        if ledger is not None and ledger_days(ledger).where(F.col("day") == F.lit(dead.cutoff).cast("date")).take(1):
            done = "closed"
        else:
            append_ledger(spark, ledger_path, list(dead.days), dead.as_of)
            done = "recorded"
    close_intent(spark, ledger_path)
    return done
