"""Model calls of one task: a pace that adapts to throttling, retries with jitter, a bounded number in flight."""

from __future__ import annotations

import random
import threading
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field

#: Answer, error, and how often the client was called.
Outcome = tuple[str | None, str | None, int]


class Throttled(Exception):
    """What a client raises when the service asks for fewer calls."""


#: Signs of throttling in errors that services raise.
THROTTLE_SIGNS = ("throttl", "too many requests", "rate exceeded", "slow down", "429")


def looks_throttled(error: Exception) -> bool:
    text = f"{type(error).__name__} {error}".lower()
    return isinstance(error, Throttled) or any(sign in text for sign in THROTTLE_SIGNS)


@dataclass(frozen=True)
class CallPolicy:
    """How one task calls.

    ``rate`` is the most calls a second: a throttled call halves it, down to ``rate * floor``, and every answer gives
    ``rate * gain`` back. Calls that came in the same ``hold`` seconds cut it once. A failed call is made again up to
    ``attempts`` times in all, after a wait drawn evenly between nothing and ``backoff`` doubled per attempt, at most
    ``longest_wait``: tasks that were throttled together do not come back together. ``in_flight`` calls run at once.
    """

    attempts: int = 1
    backoff: float = 5.0
    longest_wait: float = 60.0
    rate: float | None = None
    floor: float = 0.01
    gain: float = 0.02
    hold: float = 1.0
    in_flight: int = 1
    throttled: Callable[[Exception], bool] = looks_throttled

    def __post_init__(self) -> None:
        if self.rate is not None and self.rate <= 0:
            raise ValueError("the rate of calls must be positive")
        if self.attempts < 1 or self.in_flight < 1:
            raise ValueError("attempts and calls in flight are at least 1")


@dataclass
class Clock:
    """Time as calls see it; tests bring their own."""

    now: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    draw: Callable[[], float] = field(default_factory=lambda: random.Random().random)


class Pace:
    """A bucket of one call that fills at the current rate, shared by the calls in flight of a task."""

    def __init__(self, policy: CallPolicy, clock: Clock) -> None:
        self.policy, self.clock, self.rate = policy, clock, policy.rate
        self._lock = threading.Lock()
        self._free = self._cut = float("-inf")

    def wait(self) -> None:
        """Returns when the next call may be made."""
        if self.rate is None:
            return
        with self._lock:
            now = self.clock.now()
            at = max(now, self._free)
            self._free = at + 1 / self.rate
        if at > now:
            self.clock.sleep(at - now)

    def slower(self) -> None:
        if self.rate is None:
            return
        with self._lock:
            now = self.clock.now()
            if now - self._cut >= self.policy.hold:
                self.rate = max(self.rate / 2, self.policy.rate * self.policy.floor)
                self._cut = now

    def faster(self) -> None:
        if self.rate is None:
            return
        with self._lock:
            self.rate = min(self.rate + self.policy.rate * self.policy.gain, self.policy.rate)


def call_once(client: Callable[[str], str], body: str, policy: CallPolicy, pace: Pace, clock: Clock) -> Outcome:
    """The answer to one request, or the error of its last attempt."""
    error = None
    for tries in range(1, policy.attempts + 1):
        if tries > 1:
            clock.sleep(clock.draw() * min(policy.longest_wait, policy.backoff * 2 ** (tries - 2)))
        pace.wait()
        try:
            answer = client(body)
        except Exception as exc:
            error = str(exc)
            if policy.throttled(exc):
                pace.slower()
        else:
            pace.faster()
            return answer, None, tries
    return None, error, policy.attempts


def call_all(
    client: Callable[[str], str], bodies: Iterable[str], policy: CallPolicy, pace: Pace, clock: Clock
) -> Iterator[Outcome]:
    """Outcomes of all requests in their order; at most ``in_flight`` calls run, and as many outcomes wait."""
    if policy.in_flight == 1:
        for body in bodies:
            yield call_once(client, body, policy, pace, clock)
        return
    waiting: deque[Future[Outcome]] = deque()
    with ThreadPoolExecutor(policy.in_flight) as pool:
        for body in bodies:
            if len(waiting) == policy.in_flight:
                yield waiting.popleft().result()
            waiting.append(pool.submit(call_once, client, body, policy, pace, clock))
        while waiting:
            yield waiting.popleft().result()
