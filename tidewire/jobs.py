"""Bounded jobs: what a plan would read, and runs that stop at a limit of bytes or of time."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame


class TooMuch(RuntimeError):
    """A plan that would read more than it may."""


def bytes_read(df: DataFrame) -> int:
    """What the optimised plan's scans hold by the files' own statistics, after pruning of files but not of columns."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def bounded(df: DataFrame, action: Callable[[DataFrame], Any], most_bytes: int | None = None, seconds: float | None = None, dry_run: bool = False) -> dict[str, Any]:
    """Run ``action`` on a frame within limits: {'bytes', 'result', 'ended'}.

    A plan above ``most_bytes`` raises TooMuch before anything runs; a dry run only tells the bytes. After ``seconds`` the
    action's jobs are cancelled and ``ended`` is False; errors of the action are raised as they are.
    """
    size = bytes_read(df)
    if most_bytes is not None and size > most_bytes:
        raise TooMuch(f"{size} bytes to read, {most_bytes} allowed")
    if dry_run:
        return {"bytes": size, "result": None, "ended": False}
    context, group, held = df.sparkSession.sparkContext, f"bounded-{uuid.uuid4().hex}", {}

    def run() -> None:
        context.setJobGroup(group, "bounded job", interruptOnCancel=True)
        try:
            held["result"] = action(df)
        except Exception as e:  # noqa: BLE001
            held["error"] = e

    thread = threading.Thread(target=inheritable_thread_target(df.sparkSession)(run), daemon=True)
    thread.start()
    thread.join(seconds)
    late = thread.is_alive()
    if late:
        context.cancelJobGroup(group)
        thread.join(30)
    if not late and "error" in held:
        raise held["error"]
    return {"bytes": size, "result": None if late else held.get("result"), "ended": not late}
