"""Getting feeds over HTTP: what to ask for, what an answer means, and pages until a short one. The driver fetches and lands; Spark reads what has landed."""

from __future__ import annotations

import email.utils
import json
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from .readers import AuthError, TransientError

PAGE = 5000


class StaleTagError(RuntimeError):
    """The feed says that nothing changed, and in the same breath that it changed. Another try won't help."""


@dataclass(frozen=True)
class Answer:
    status: int
    headers: dict[str, str]
    body: bytes

    def header(self, name: str) -> str | None:
        return next((v for k, v in self.headers.items() if k.lower() == name.lower()), None)


def conditional(etag: str | None, modified: str | None) -> dict[str, str]:
    """Headers that ask for the dataset only if it isn't the one seen before."""
    return ({"If-None-Match": etag} if etag else {}) | ({"If-Modified-Since": modified} if modified else {})


def since(url: str, **dates: str) -> str:
    """A url with a date window given to the source, so that it filters and not we."""
    return f"{url}{'&' if '?' in url else '?'}{urllib.parse.urlencode({k: v for k, v in dates.items() if v})}" if any(dates.values()) else url


def get(url: str, headers: dict[str, str] | None = None, data: bytes | None = None, timeout: float = 60) -> Answer:
    request = urllib.request.Request(url, data, headers or {})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return Answer(answer.status, dict(answer.headers), answer.read())
    except urllib.error.HTTPError as error:
        return Answer(error.code, dict(error.headers), error.read())
    except OSError as error:
        raise TransientError(f"{url}: {error}") from error


def changed(answer: Answer, modified: str | None) -> bool:
    """Whether an answer brings a dataset (200) or says that there is no other than the one seen before (304).

    A 304 whose Last-Modified is later than the one seen, or can't be read, raises: the cache in between is stale.
    401 and 403 raise AuthError, all else TransientError.
    """
    if answer.status == 200:
        return True
    if answer.status in (401, 403):
        raise AuthError(f"status {answer.status}")
    if answer.status != 304:
        raise TransientError(f"status {answer.status}")
    now = answer.header("Last-Modified")
    if modified and now and now != modified:
        try:
            later = email.utils.parsedate_to_datetime(now) > email.utils.parsedate_to_datetime(modified)
        except ValueError:
            later = True
        if later:
            raise StaleTagError(f"not modified, but last modified went from {modified} to {now}")
    return False


def pages(fetch: Callable[[int], list], size: int = PAGE) -> Iterator[list]:
    """The pages of a paginated feed, whose rows count from 1; a page with fewer than ``size`` rows is the last."""
    start = 1
    while True:
        page = fetch(start)
        yield page
        if len(page) < size:
            return
        start += size


def unwrapped(body: bytes) -> list:
    """The rows of {"STATUSCODE", "MESSAGE", "RESULT"}: 400 has rows, 412 none; 401 and others raise."""
    envelope = json.loads(body)
    status = str(envelope.get("STATUSCODE"))
    if status not in ("400", "412"):
        raise (AuthError if status == "401" else TransientError)(f"status {status}: {envelope.get('MESSAGE')}")
    return envelope.get("RESULT") or [] if status == "400" else []
