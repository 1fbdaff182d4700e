"""Calls to a chat model over HTTP, bounded in time, for use on executors.

``chat`` gives a function that makes a client on the worker; a client takes (system, prompt) and gives (text, tokens of the
completion). A call ends at its deadline whatever the server does, as an error of its row."""

from __future__ import annotations

import functools
import json
import urllib.request
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late

Client = Callable[[str, str], tuple[str, int]]
#: Calls of one worker that may hang at a time: one that passed its deadline holds its thread until its socket gives up.
THREADS = 16
_pool: list[ThreadPoolExecutor] = []


class CallTimeout(Exception):
    """A call passed its deadline."""


def post_json(url: str, payload: dict, read_s: float = 120.0, deadline_s: float = 180.0) -> dict:
    """The JSON answer to ``payload``; CallTimeout after ``deadline_s`` in all, OSError on transport and HTTP errors."""
    if not _pool:
        _pool.append(ThreadPoolExecutor(THREADS))
    ask = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json"})

    def call() -> dict:
        with urllib.request.urlopen(ask, timeout=read_s) as answer:
            return json.load(answer)

    job = _pool[0].submit(call)
    try:
        return job.result(deadline_s)
    except Late:
        job.cancel()
        raise CallTimeout(f"no answer within {deadline_s:g} s") from None


def _client(url: str, model: str, tokens: int, read_s: float, deadline_s: float, extra: dict) -> Client:
    def ask(system: str, prompt: str) -> tuple[str, int]:
        said = [{"role": "system", "content": system}, {"role": "user", "content": prompt}]
        body = post_json(f"{url.rstrip('/')}/v1/chat/completions", {"model": model, "messages": said, "temperature": 0, "max_tokens": tokens, **extra}, read_s, deadline_s)
        return body["choices"][0]["message"]["content"], int((body.get("usage") or {}).get("completion_tokens") or 0)

    return ask


def chat(url: str, model: str, tokens: int, deadline_s: float, read_s: float = 120.0, as_json: bool = False, extra: dict | None = None) -> Callable[[], Client]:
    """Temperature 0; ``extra`` is merged into the body of the request."""
    more = ({"response_format": {"type": "json_object"}} if as_json else {}) | (extra or {})
    return functools.partial(_client, url, model, tokens, min(read_s, deadline_s), deadline_s, more)
