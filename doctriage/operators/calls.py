"""Calls that can be ended: each runs in a child process, which is killed at the time limit (K6).

A task has a few children of its own, started once and used for call after call.  A call that has
not come back in time costs its child: it is ended by its own process id, and another takes
its place.  Children also end with their task.
"""

from __future__ import annotations

import os
import signal
import time
from collections.abc import Callable
from multiprocessing import get_context
from multiprocessing.connection import wait

Outcome = tuple[str | None, str, str | None]  # text, stage, error


def _serve(conn, answer: Callable[[str], Outcome]) -> None:
    try:
        while True:
            prompt = conn.recv()
            try:
                conn.send(answer(prompt))
            except (EOFError, BrokenPipeError):
                raise
            except BaseException as e:  # an answer that cannot be sent
                conn.send((None, "batch", f"{type(e).__name__}: {e}"))
    except (EOFError, BrokenPipeError, KeyboardInterrupt):
        pass
    finally:
        os._exit(0)  # nothing of the parent's is run again here


class CallPool:
    """``size`` children that answer prompts; ``make`` builds the answering function in each child."""

    def __init__(self, make: Callable[[], Callable[[str], Outcome]], size: int, timeout_s: float):
        self._context, self._make, self._size, self._timeout = get_context("fork"), make, size, timeout_s
        self._idle: list = []

    def _start(self):
        ours, theirs = self._context.Pipe()

        def run():
            ours.close()
            _serve(theirs, self._make())

        child = self._context.Process(target=run, daemon=True)
        child.start()
        theirs.close()
        return child, ours

    def _end(self, child, conn) -> None:
        conn.close()
        if child.is_alive():
            os.kill(child.pid, signal.SIGKILL)
        child.join()

    def run(self, prompts: list[str | None], before: Callable[[str], None] = lambda prompt: None) -> list[tuple]:
        """(text, stage, error, milliseconds, end time) of each prompt, in their order; None is skipped.

        ``before(prompt)`` is called (and may wait) before a call is sent.  A child that dies gives its call an error.
        """
        out: list[tuple] = [(None, "skipped", None, None, None)] * len(prompts)
        todo = [i for i, p in enumerate(prompts) if p is not None][::-1]
        busy: dict = {}  # connection -> (child, row, start)
        try:
            while todo or busy:
                while todo and len(busy) < self._size:
                    i = todo.pop()
                    before(prompts[i])
                    child, conn = self._idle.pop() if self._idle else self._start()
                    try:
                        conn.send(prompts[i])
                    except (BrokenPipeError, OSError):
                        self._end(child, conn)
                        out[i] = (None, "batch", "the call's process ended", 0.0, time.time())
                        continue
                    busy[conn] = (child, i, time.monotonic())
                if not busy:
                    continue
                first = min(start for _, _, start in busy.values()) + self._timeout
                ready = set(wait(list(busy), max(0.0, first - time.monotonic())))
                now = time.monotonic()
                for conn, (child, i, start) in list(busy.items()):
                    if conn in ready:
                        del busy[conn]
                        try:
                            text, stage, error = conn.recv()
                            self._idle.append((child, conn))
                        except (EOFError, OSError):
                            self._end(child, conn)
                            text, stage, error = None, "batch", "the call's process ended"
                    elif now - start >= self._timeout:
                        del busy[conn]
                        self._end(child, conn)
                        text, stage, error = None, "timeout", f"Processing timed out after {self._timeout:g} seconds"
                    else:
                        continue
                    out[i] = (text, stage, error, (now - start) * 1000.0, time.time())
            return out
        finally:  # an exception (a task that is ended) leaves no child at work
            for conn, (child, _, _) in busy.items():
                self._end(child, conn)

    def close(self) -> None:
        for child, conn in self._idle:
            self._end(child, conn)
        self._idle = []
