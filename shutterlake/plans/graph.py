"""Steps that run as soon as what they need is there, independent ones at the same time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

WORKERS = 4


@dataclass(frozen=True)
class Step:
    """``needs`` must have succeeded before the step, ``after`` must be over."""

    work: Callable[[], object]
    needs: tuple[str, ...] = ()
    after: tuple[str, ...] = ()


class Skipped(Exception):
    """A step did not run because one that it needs has failed or was skipped itself."""


def run(
    spark: SparkSession, steps: Mapping[str, Step], workers: int = WORKERS
) -> dict[str, object]:
    """The result of every step, or the exception it ended with, in the order of ``steps``.

    Each step runs in a thread and a scheduler pool of its own, so that under Spark's fair
    scheduler steps share the cluster. A step that fails skips those that need it and no others.
    """
    _check(steps)
    done: dict[str, object] = {}
    running: dict[Future, str] = {}
    waiting = dict(steps)

    def job(name: str, work: Callable[[], object]) -> object:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        return work()

    with ThreadPoolExecutor(max_workers=workers) as pool:
        while waiting or running:
            for name, step in list(waiting.items()):
                failed = [n for n in step.needs if isinstance(done.get(n), Exception)]
                if failed:
                    done[name] = Skipped(f"{name} needs {', '.join(failed)}")
                    del waiting[name]
                elif all(n in done for n in (*step.needs, *step.after)):
                    target = inheritable_thread_target(spark)(job)
                    running[pool.submit(target, name, step.work)] = name
                    del waiting[name]
            if running:
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    name = running.pop(future)
                    done[name] = future.exception() or future.result()
    return {name: done[name] for name in steps}


def _check(steps: Mapping[str, Step]) -> None:
    """Steps must name known ones and must not wait for each other in a circle."""
    left = dict(steps)
    while left:
        free = [
            n for n, s in left.items() if not any(d in left for d in (*s.needs, *s.after))
        ]
        unknown = {d for s in left.values() for d in (*s.needs, *s.after)} - set(steps)
        if unknown or not free:
            raise ValueError(f"steps wait for {', '.join(sorted(unknown)) or 'each other'}")
        for name in free:
            del left[name]
