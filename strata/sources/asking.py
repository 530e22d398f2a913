"""How requests are asked (A1-A4): a few at a time, at a bounded rate, again after an error that may pass.

One ``Asker`` lives as long as its task.  It keeps a bounded window of requests under
way, starts them no faster than its share of the rate, and asks again after a status
or a broken connection that a later try may mend.  A request that stays without an
answer gives the reason beside its key, so one bad key costs no other its answer.
"""

from __future__ import annotations

import email.utils
import http.client
import random
import threading
import time
import urllib.error
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import NamedTuple

#: Statuses that say the server has nothing under this address.
MISSING = (404, 410)
#: Statuses that a later try may mend.
PASSING = (408, 425, 429, 500, 502, 503, 504)


class Answer(NamedTuple):
    """A response text (``None``: the server has none), or the error that it failed with for good."""
    text: str | None
    error: str | None = None


@dataclass(frozen=True)
class AskPolicy:
    """``tries`` requests a key at most; waits of ``first_wait`` seconds, doubled up to
    ``longest_wait`` (a longer ``Retry-After`` is cut to that); ``window`` requests of a task
    under way at once; ``per_second`` requests a second over all tasks of a fetch."""
    tries: int = 5
    first_wait: float = 0.5
    longest_wait: float = 30.0
    window: int = 4
    per_second: float | None = None

    def __post_init__(self):
        if self.tries < 1 or self.window < 1 or (self.per_second is not None and self.per_second <= 0):
            raise ValueError("tries and window must be 1 or more, per_second above 0")


class Pace:
    """Start times at least ``gap`` seconds apart, shared by the threads of a task."""

    def __init__(self, gap: float, clock: Callable[[], float], sleep: Callable[[float], None]):
        self.gap, self.clock, self.sleep = gap, clock, sleep
        self.lock, self.free = threading.Lock(), 0.0

    def wait(self) -> None:
        if not self.gap:
            return
        with self.lock:
            now = self.clock()
            start = max(now, self.free)
            self.free = start + self.gap
        if start > now:
            self.sleep(start - now)


def retry_after(headers, now: float) -> float:
    """Seconds that a ``Retry-After`` header asks for (a number or a date); 0 without one."""
    value = (headers.get("Retry-After") or "").strip() if headers is not None else ""
    if value.isdigit():
        return float(value)
    try:
        return max(0.0, email.utils.parsedate_to_datetime(value).timestamp() - now) if value else 0.0
    except (TypeError, ValueError):
        return 0.0


class Asker:
    """Asks ``request(key) -> text`` under a policy.  ``tasks`` share the rate evenly."""

    def __init__(self, request: Callable[[dict], str], policy: AskPolicy, tasks: int = 1,
                 clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.request, self.policy, self.sleep = request, policy, sleep
        self.pace = Pace(tasks / policy.per_second if policy.per_second else 0.0, clock, sleep)

    def ask(self, keys: list[dict]) -> list[Answer]:
        """The answers in the order of ``keys``."""
        if self.policy.window == 1 or len(keys) < 2:
            return [self.one(k) for k in keys]
        with ThreadPoolExecutor(self.policy.window) as pool:
            return list(pool.map(self.one, keys))

    def one(self, key: dict) -> Answer:
        for tried in range(1, self.policy.tries + 1):
            self.pace.wait()
            asked_wait = 0.0
            try:
                return Answer(self.request(key))
            except urllib.error.HTTPError as e:
                e.close()
                if e.code in MISSING:
                    return Answer(None)
                reason = f"status {e.code}"
                if e.code not in PASSING:
                    return Answer(None, reason)
                asked_wait = retry_after(e.headers, time.time())
            except (OSError, http.client.HTTPException) as e:       # URLError and time-outs are OSErrors
                reason = f"{type(e).__name__}: {e}"
            except UnicodeDecodeError:
                return Answer(None, "the body is not UTF-8")
            if tried < self.policy.tries:
                wait = self.policy.first_wait * 2 ** (tried - 1) * random.uniform(0.5, 1.0)
                self.sleep(min(self.policy.longest_wait, max(wait, asked_wait)))
        return Answer(None, f"{reason} after {self.policy.tries} tries")
