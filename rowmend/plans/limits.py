"""Running tasks beside each other, none of which can block or starve the others."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, wait
from typing import TypeVar

from pyspark import InheritableThread
from pyspark.sql import SparkSession

Task = TypeVar("Task")
# Seconds between two looks at tasks that run, and those a cancelled task has to come to an end.
LOOK, GRACE = 0.2, 5.0


class TimeLimit(RuntimeError):
    """A task took longer than it may."""


class _Run:
    """One task in a thread of its own; its jobs carry a tag and go to a pool."""

    def __init__(self, spark: SparkSession, work: Callable, task) -> None:
        self.spark, self.task, self.tag = spark, task, f"rowmend-{uuid.uuid4().hex}"
        self.result: Future = Future()
        self.started = time.monotonic()
        # Spark keeps tags and pools by thread, and a thread of this kind has one of its own in the JVM.
        self.thread = InheritableThread(target=self._run, args=(work,), daemon=True)
        self.thread.start()

    def _run(self, work: Callable) -> None:
        context = self.spark.sparkContext
        try:
            context.addJobTag(self.tag)
            context.setLocalProperty("spark.scheduler.pool", self.tag)
            self.result.set_result(work(self.task))
        except BaseException as error:
            self.result.set_exception(error)
        finally:
            context.removeJobTag(self.tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    def cancel(self) -> None:
        self.spark.sparkContext.cancelJobsWithTag(self.tag)


def timed(
    spark: SparkSession, work: Callable[[Task], tuple], tasks: Sequence[Task], concurrency: int, limit: float | None = None
) -> Iterator[tuple]:
    """Results of ``work`` as they come, ``concurrency`` at a time.

    A result is ``(task, row, failed)``; that of a task beyond ``limit`` seconds is ``(task, TimeLimit, True)``.

    The jobs of such a task are cancelled until it ends. If it does not within GRACE seconds,
    because it waits for something outside of Spark, its place is given to the next one and its
    own result is never taken; jobs that it begins later are cancelled as long as this runs.
    """
    waiting, running, lost = list(tasks), [], []
    while waiting or running:
        while waiting and len(running) < concurrency:
            running.append(_Run(spark, work, waiting.pop(0)))
        ended, _ = wait([r.result for r in running], LOOK, FIRST_COMPLETED)
        for r in lost:
            r.cancel()
        for r in list(running):
            late = limit is not None and time.monotonic() - r.started > limit
            if late and not r.result.done():
                r.cancel()
            gone = late and time.monotonic() - r.started > limit + GRACE
            if r.result in ended or gone:
                running.remove(r)
                if not r.result.done():
                    lost.append(r)
                # What ended well before it was cancelled has ended well.
                done = r.result.result() if r.result.done() else (r.task, None, True)
                yield (r.task, TimeLimit(f"took longer than {limit:g} seconds"), True) if late and done[-1] else done
