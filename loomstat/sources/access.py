"""Access policy of live sources and a polite single-threaded fetcher. Nothing here runs inside a Spark job."""

from __future__ import annotations

import hashlib
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from email.utils import parsedate_to_datetime
from urllib.parse import urlparse


class AccessPolicyError(PermissionError):
    """The policy doesn't allow this."""


class FetchError(RuntimeError):
    def __init__(self, message: str, status: int | None = None) -> None:
        super().__init__(message)
        self.status = status


@dataclass(frozen=True)
class AccessPolicy:
    """What was decided on a source, by whom, and which addresses are allowed."""

    source_name: str
    decision: str  # APPROVED, DENIED or PENDING
    hosts: tuple[str, ...]
    path_prefixes: tuple[str, ...]
    reviewed_by: str = ""
    reviewed_at: str = ""
    requests_per_minute: int = 20
    max_retries: int = 2
    timeout_s: float = 20.0

    def assert_live(self) -> None:
        if self.decision != "APPROVED" or not self.reviewed_by or not self.reviewed_at:
            raise AccessPolicyError(f"{self.source_name}: live collection isn't approved")

    def assert_url(self, url: str) -> None:
        parts = urlparse(url)
        if parts.scheme != "https" or (parts.hostname or "").lower() not in self.hosts or not parts.path.startswith(self.path_prefixes):
            raise AccessPolicyError(f"{url} isn't allowed")


@dataclass
class Fetched:
    url: str
    status: int
    text: str
    sha256: str
    attempts: int


@dataclass
class PoliteFetcher:
    """GETs one page at a time, no faster than the policy says, with retries that back off."""

    policy: AccessPolicy
    user_agent: str = "loomstat"
    max_bytes: int = 5_000_000
    opener: Callable = urllib.request.urlopen
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    _last: float | None = field(default=None, init=False)

    def fetch(self, url: str) -> Fetched:
        self.policy.assert_live()
        self.policy.assert_url(url)
        for attempt in range(1, self.policy.max_retries + 2):
            gap = 60.0 / self.policy.requests_per_minute
            if self._last is not None and (rest := self._last + gap - self.clock()) > 0:
                self.sleep(rest)
            self._last = self.clock()
            try:
                with self.opener(urllib.request.Request(url, headers={"User-Agent": self.user_agent}), timeout=self.policy.timeout_s) as answer:
                    self.policy.assert_url(answer.geturl())
                    body = answer.read(self.max_bytes + 1)
                    if len(body) > self.max_bytes:
                        raise FetchError("the response is too large")
                    return Fetched(url, answer.status, body.decode("utf-8", "replace"), hashlib.sha256(body).hexdigest(), attempt)
            except urllib.error.HTTPError as e:
                if e.code not in (429, 500, 502, 503, 504) or attempt > self.policy.max_retries:
                    raise FetchError(f"HTTP {e.code}", e.code) from e
                self.sleep(_retry_after(e.headers.get("Retry-After")) or min(30.0, 2.0**attempt))
            except (urllib.error.URLError, TimeoutError) as e:
                if attempt > self.policy.max_retries:
                    raise FetchError(str(e)) from e
                self.sleep(min(30.0, 2.0**attempt))
        raise FetchError("no attempt was made")


def _retry_after(value: str | None) -> float | None:
    if not value:
        return None
    if value.strip().isdigit():
        return float(value)
    try:
        return max(0.0, parsedate_to_datetime(value).timestamp() - time.time())
    except (TypeError, ValueError):
        return None
