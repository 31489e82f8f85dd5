"""One JSON request, and the rule for making it again."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator

# Statuses worth sending the same payload again for.
RETRYABLE_STATUS = frozenset({429, 500, 502, 503, 504})


def post_json(url: str, headers: dict[str, str], body: dict, timeout: float = 120.0) -> dict:
    request = urllib.request.Request(
        url, json.dumps(body, ensure_ascii=False).encode("utf-8"), {"Content-Type": "application/json", **headers})
    with urllib.request.urlopen(request, timeout=timeout) as response:
        data = response.read()
    return json.loads(data) if data else {}


def is_retryable(exc: Exception) -> bool:
    """Later may help for a busy node or a lost connection, not for a bad payload."""
    status = getattr(exc, "status", None) or getattr(exc, "code", None)
    if isinstance(status, int):
        return status in RETRYABLE_STATUS
    return isinstance(exc, (urllib.error.URLError, ConnectionError, TimeoutError))


def growing(attempts: int, first: float) -> Iterator[float]:
    """How long to wait before each further attempt."""
    for k in range(max(1, attempts) - 1):
        yield first * 2 ** k


def insist(request: Callable[[], dict], pauses: Iterable[float], sleep: Callable[[float], None] = time.sleep) -> dict:
    """A further attempt follows each pause as long as waiting may help; what the last one raises is the outcome."""
    for pause in pauses:
        try:
            return request()
        except Exception as failure:
            if not is_retryable(failure):
                raise
        sleep(pause)
    return request()
