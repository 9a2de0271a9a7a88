"""A client for services that take and return JSON over HTTP, for use inside tasks."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from dataclasses import dataclass, field


@dataclass(frozen=True)
class HttpClient:
    """Posts a request to target + path. A target is a base address; `names` maps short names to them."""

    path: str = ""
    names: dict[str, str] = field(default_factory=dict)
    headers: dict[str, str] = field(default_factory=dict)
    timeout_seconds: float = 1500.0

    def ask(self, target: str, request: str) -> tuple[int, str | None, int]:
        """(HTTP status, 0 if the connection failed; body; milliseconds)."""
        address = self.names.get(target, target).removesuffix("/") + self.path
        post = urllib.request.Request(address, request.encode(), {"Content-Type": "application/json", **self.headers}, method="POST")
        began = time.monotonic()
        try:
            with urllib.request.urlopen(post, timeout=self.timeout_seconds) as answer:
                status, body = answer.status, answer.read().decode("utf-8", "replace")
        except urllib.error.HTTPError as e:
            status, body = e.code, e.read().decode("utf-8", "replace")
        except (OSError, ValueError):
            status, body = 0, None
        return status, body, round((time.monotonic() - began) * 1000)


def alive(address: str, timeout_seconds: float = 5.0) -> bool:
    """A health probe: any answer counts, only a failed connection does not."""
    try:
        urllib.request.urlopen(address, timeout=timeout_seconds).close()
    except urllib.error.HTTPError:
        return True
    except (OSError, ValueError):
        return False
    return True
