"""One budget of calls and prompt tokens for a run, shared by its tasks (K1, K7).

A window's budget is cut into units.  A task claims a unit by making a folder of that name below
the shared folder, which succeeds for one claimant only, and then sends calls against what it
claimed.  A task with much to send claims more units than others; when all of a window are
claimed, tasks wait for the next.  So no split is fixed beforehand, all tasks together never
pass the budget, and a task that is lost takes only what it had claimed.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from dataclasses import dataclass

UNITS = 64  # of a window, at most


def claim_folder(path: str) -> bool:
    """Make the folder; False where another has made it before (one of several claimants succeeds)."""
    path = "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path
    try:
        os.mkdir(path)
        return True
    except FileExistsError:
        return False
    except FileNotFoundError:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return claim_folder(path)


def about_tokens(prompt: str) -> int:
    """Tokens that a prompt is counted as: a quarter of its UTF-8 bytes, at least one."""
    return max(1, -(-len(prompt.encode()) // 4))


@dataclass
class Budget:
    """``calls`` and ``tokens`` (None: no limit) for each window of ``window_s`` seconds, below ``folder``.

    ``folder`` is one that all tasks share (``session.scratch_dir``), new for each run.  On a store where making
    a folder does not fail when it exists, give a ``claim`` that does.  Machines' clocks should
    agree to well under a window: those of a window are told apart by the clock alone.
    """
    folder: str
    calls: int | None = None
    tokens: int | None = None
    window_s: float = 60.0
    claim: Callable[[str], bool] = claim_folder
    count: Callable[[str], int] = about_tokens

    def __post_init__(self):
        if self.calls is None and self.tokens is None:
            raise ValueError("a budget needs calls or tokens")
        for n in (self.calls, self.tokens):
            if n is not None and n <= 0:
                raise ValueError("calls and tokens must be greater than 0")
        if self.window_s <= 0:
            raise ValueError("window_s must be greater than 0")

    def units(self) -> list[tuple[float, float]]:
        """(calls, tokens) of each unit; whole numbers that add up to the budget."""
        n = min(UNITS, *(x for x in (self.calls, self.tokens) if x is not None))

        def part(total: int | None, i: int) -> float:
            return float("inf") if total is None else total * (i + 1) // n - total * i // n
        return [(part(self.calls, i), part(self.tokens, i)) for i in range(n)]

    def spender(self) -> Spender:
        return Spender(self)


class Spender:
    """A task's share, claimed unit by unit.  ``wait(prompt)`` returns when the prompt may be sent."""

    def __init__(self, budget: Budget, now: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep):
        self._budget, self._now, self._sleep = budget, now, sleep
        self._window, self._left, self._open = -1, [0.0, 0.0], []

    def _enter(self, window: int) -> None:
        if window != self._window:  # what was left of the last window is gone
            units = self._budget.units()
            first = os.getpid() * 7919 % len(units)  # tasks begin at different units
            self._window, self._left = window, [0.0, 0.0]
            self._open = [((first + k) % len(units), *units[(first + k) % len(units)]) for k in range(len(units))]

    def wait(self, prompt: str) -> None:
        """Claim until one call and the prompt's tokens are there; a prompt beyond a window's tokens takes a whole window's."""
        b = self._budget
        need = b.count(prompt) if b.tokens is not None else 0
        need = min(need, b.tokens) if b.tokens is not None else 0
        while True:
            at = self._now()
            self._enter(int(at // b.window_s))
            while self._open and (self._left[0] < 1 or self._left[1] < need):
                unit, calls, tokens = self._open.pop(0)
                if b.claim(f"{b.folder.rstrip('/')}/{self._window}/{unit}"):
                    self._left = [self._left[0] + calls, self._left[1] + tokens]
            if self._left[0] >= 1 and self._left[1] >= need:
                self._left = [self._left[0] - 1, self._left[1] - need]
                return
            self._sleep(max(0.0, (self._window + 1) * b.window_s - at) + 1e-3)
