"""Calls of user functions that may hang or die: each is given a time, and ends with it.

A task keeps a few helper processes. Rows go to them in portions and results come back one by one; a
helper that does not answer in time, or ends, is replaced, its row gets the reason, and the rest of its
portion goes to another helper.
"""

from __future__ import annotations

import gc
import multiprocessing
import time
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.connection import Connection, wait

#: Rows that a helper is given at a time.
PORTION = 32


def _serve(call: Callable, pipe: Connection) -> None:
    gc.freeze()  # a collection that visits what the task has loaded would copy its memory
    while (rows := pipe.recv()) is not None:
        for row in rows:
            pipe.send(call(*row))


class Helper:
    """A process that answers ``call``; ``rows`` are the numbers of the rows it has not answered."""

    def __init__(self, call: Callable):
        context = multiprocessing.get_context("fork")  # the function need not be importable
        self.pipe, other = context.Pipe()
        self.process = context.Process(target=_serve, args=(call, other), daemon=True)
        self.process.start()
        other.close()
        self.rows: deque[int] = deque()
        self.until = 0.0

    def end(self) -> None:
        self.process.kill()
        self.process.join()
        self.pipe.close()


class Helpers:
    """``call(*row)`` for many rows, each in ``seconds``; ``failed(reason)`` is the result of a lost one."""

    def __init__(self, call: Callable, failed: Callable[[str], object], seconds: float, helpers: int = 4, portion: int = PORTION):
        self.call, self.failed, self.seconds, self.most, self.portion = call, failed, seconds, helpers, portion
        self.idle: list[Helper] = []

    def run(self, rows: Sequence[tuple]) -> list:
        results: list = [None] * len(rows)
        todo = deque(deque(range(at, min(at + self.portion, len(rows)))) for at in range(0, len(rows), self.portion))
        busy: dict[Connection, Helper] = {}
        while todo or busy:
            while todo and len(busy) < self.most:
                helper = self.idle.pop() if self.idle else Helper(self.call)
                helper.rows = todo.popleft()
                helper.until = time.monotonic() + self.seconds
                helper.pipe.send([rows[i] for i in helper.rows])
                busy[helper.pipe] = helper
            first = min(h.until for h in busy.values())
            for pipe in wait(list(busy), max(0.0, first - time.monotonic())):
                helper = busy[pipe]
                try:
                    while helper.rows and pipe.poll():
                        results[helper.rows[0]] = pipe.recv()
                        helper.rows.popleft()
                        helper.until = time.monotonic() + self.seconds
                except (EOFError, ConnectionResetError):
                    self._lost(busy, helper, results, todo, "the scorer's process ended")
                    continue
                if not helper.rows:
                    del busy[pipe]
                    self.idle.append(helper)
            now = time.monotonic()
            for helper in [h for h in busy.values() if h.until <= now and not h.pipe.poll()]:
                self._lost(busy, helper, results, todo, f"timeout after {self.seconds:g} s")
        return results

    def _lost(self, busy: dict[Connection, Helper], helper: Helper, results: list, todo: deque, reason: str) -> None:
        del busy[helper.pipe]
        helper.end()
        results[helper.rows.popleft()] = self.failed(reason)
        if helper.rows:
            todo.appendleft(helper.rows)

    def close(self) -> None:
        for helper in self.idle:
            helper.end()
        self.idle = []


@contextmanager
def helpers(call: Callable, failed: Callable[[str], object], seconds: float, most: int = 4, portion: int = PORTION) -> Iterator[Helpers]:
    pool = Helpers(call, failed, seconds, most, portion)
    try:
        yield pool
    finally:
        pool.close()
