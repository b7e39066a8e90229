"""Reading archives that fail: bounded retries with growing waits, from the byte the last attempt reached.

``Resumed`` is a stream over a store's ``open(location, offset)``. A read that breaks is tried again after a wait that
doubles, from its position, so nothing is read twice; after the last attempt ``ArchiveUnavailable`` ends this archive and
no other. What can't get better by waiting (no such file, a folder) is raised at once. The waits happen inside the
task and are bounded by the policy; Spark's own retries are left for lost tasks and executors.
"""

from __future__ import annotations

import http.client
import io
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

# Errors that no wait mends.
LASTING = (FileNotFoundError, IsADirectoryError, NotADirectoryError)
PASSING = (OSError, http.client.HTTPException)      # URLError, HTTPError and timeouts are OSErrors


class ArchiveUnavailable(Exception):
    """An archive that could not be read after all attempts."""


@dataclass(frozen=True)
class Retry:
    """Attempts an archive gets, and the waits between them in seconds (fixed values: five attempts, the first wait one
    second, each wait twice the last)."""

    attempts: int = 5
    first_wait: float = 1.0
    factor: float = 2.0
    longest_wait: float = 60.0

    def waits(self) -> Iterator[float]:
        wait = self.first_wait
        for _ in range(self.attempts - 1):
            yield min(wait, self.longest_wait)
            wait *= self.factor


class Resumed(io.RawIOBase):
    """Raw stream of an archive's stored bytes that goes on where a broken attempt ended; ``retries`` counts the
    attempts after the first."""

    def __init__(self, location: str, opener: Callable[[str, int], io.IOBase], retry: Retry = Retry(),
                 sleep: Callable[[float], None] = time.sleep):
        self.location, self.opener, self.sleep = location, opener, sleep
        self.left, self.retries, self.position, self.raw = retry.waits(), 0, 0, None

    def readable(self):
        return True

    def readinto(self, buffer):
        while True:
            try:
                if self.raw is None:
                    self.raw = self.opener(self.location, self.position)
                data = self.raw.read(len(buffer))
            except LASTING:
                raise
            except PASSING as e:
                self._wait(e)
                continue
            buffer[:len(data)] = data
            self.position += len(data)
            return len(data)

    def _wait(self, error: Exception) -> None:
        self._drop()
        wait = next(self.left, None)
        if wait is None:
            raise ArchiveUnavailable(f"{self.location} failed {self.retries + 1} times, at byte {self.position} of it the last time: "
                                     f"{type(error).__name__}: {error}") from error
        self.retries += 1
        self.sleep(wait)

    def _drop(self) -> None:
        raw, self.raw = self.raw, None
        try:
            if raw is not None:
                raw.close()
        except PASSING:
            pass        # the connection is gone anyway

    def close(self):
        self._drop()
        super().close()
