"""Multimodal model calls as a source: chat-completion requests made from executors.

A runner is any callable (prompt, image bytes) -> reply text; ``ChatRunner`` is one over HTTP.
``replies`` calls it for each row, a bounded number at a time in each task.
"""

from __future__ import annotations

import base64
import json
import logging
import time
import urllib.request
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame

Runner = Callable[[str, bytes], str]


def base_url(host: str, port: int | None = None, scheme: str = "http") -> str:
    return f"{scheme}://{host}:{port}" if port else f"{scheme}://{host}"


def headers(api_key: str | None, extra: dict[str, str] | None = None) -> dict[str, str]:
    """JSON headers; a bearer token unless the caller sets Authorization."""
    out = {"Content-Type": "application/json", **(extra or {})}
    if api_key and not any(k.lower() == "authorization" for k in out):
        out["Authorization"] = f"Bearer {api_key}"
    return out


def payload(model: str, messages: list[dict], *, stream: bool = False, temperature: float = 0.0, top_p: float = 1.0, video: dict | None = None) -> dict:
    """A request: plain sampling settings, or video settings as extra body."""
    if video:
        return {"model": model, "messages": messages, "extra_body": {"mm_processor_kwargs": video}}
    return {"model": model, "messages": messages, "stream": stream, "temperature": temperature, "top_p": top_p}


#: First bytes of image files and their media types (fixed values).
MEDIA_TYPES = {b"\xff\xd8\xff": "image/jpeg", b"\x89PNG": "image/png", b"P6": "image/x-portable-pixmap", b"P5": "image/x-portable-graymap"}


def media_type(image: bytes) -> str:
    return next((kind for head, kind in MEDIA_TYPES.items() if image.startswith(head)), "application/octet-stream")


def messages(prompt: str, images: list[bytes]) -> list[dict]:
    """One user message: all images, each with its own media type, then the prompt."""
    parts = [{"type": "image_url", "image_url": {"url": f"data:{media_type(i)};base64,{base64.b64encode(i).decode()}"}} for i in images]
    return [{"role": "user", "content": [*parts, {"type": "text", "text": prompt}]}]


def content(body: bytes) -> str:
    """The reply's text; an error where it is empty."""
    if not body:
        raise ValueError("empty response")
    text = json.loads(body)["choices"][0]["message"]["content"]
    if not text:
        raise ValueError("empty reply")
    return text


class ChatRunner:
    """Posts to a chat-completions endpoint with retries and exponential waits between them."""

    def __init__(self, url: str, model: str, api_key: str | None = None, *, timeout: float = 720, attempts: int = 3, wait: tuple[float, float] = (2, 10), post: Callable[[str, bytes, dict, float], bytes] | None = None):
        self.url, self.model, self.api_key = url.rstrip("/") + "/v1/chat/completions", model, api_key
        self.timeout, self.attempts, self.wait, self.post = timeout, attempts, wait, post or self._post

    @staticmethod
    def _post(url: str, data: bytes, head: dict, timeout: float) -> bytes:
        with urllib.request.urlopen(urllib.request.Request(url, data, head), timeout=timeout) as reply:
            return reply.read()

    def __call__(self, prompt: str, image: bytes) -> str:
        data = json.dumps(payload(self.model, messages(prompt, [image]))).encode()
        for attempt in range(self.attempts):
            try:
                return content(self.post(self.url, data, headers(self.api_key), self.timeout))
            except Exception:
                if attempt + 1 == self.attempts:
                    raise
                time.sleep(min(self.wait[1], max(self.wait[0], 2**attempt)))
        raise AssertionError("attempts must be positive")


def replies(rows: DataFrame, runner: Runner, *, key: str, prompt: str = "prompt", image: str = "image", concurrency: int = 4, log: bool = False) -> DataFrame:
    """key, reply, error and invalid of every row; ``concurrency`` calls at a time in a task. An error of one row leaves the others.

    invalid: the error says that a value is not valid (a ValueError), not that the call failed.
    With ``log``, replies go to the worker's log as they come.
    """

    def run(frames):
        said = logging.getLogger("gridloom.replies")

        def one(k, p, i):
            try:
                text = runner(p, bytes(i))
            except Exception as e:
                return None, f"{type(e).__name__}: {e}", isinstance(e, ValueError)
            if log:
                said.warning("%s: %s", k, text)
            return text, None, False

        with ThreadPoolExecutor(concurrency) as pool:
            for frame in frames:
                made = list(pool.map(one, frame[key], frame[prompt], frame[image]))
                yield pd.DataFrame({key: frame[key], "reply": [m[0] for m in made], "error": [m[1] for m in made], "invalid": [m[2] for m in made]})

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, prompt, image).mapInPandas(run, f"{key} {kind}, reply string, error string, invalid boolean")
