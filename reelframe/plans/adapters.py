"""Boundaries of the engine: decoders, encoders, models and remote services as protocols, with recorded stand-ins for tests.

Everything that a codec, a neural model, a language model or an editor does stays behind one of these. An adapter must be
idempotent, since tasks are tried again; ``Recorded`` gives the same answer for the same request.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame


class Decoder(Protocol):
    """Media to durations, frames, colours, levels and samples."""

    def duration(self, path: str) -> float | None: ...
    def frames(self, path: str, start: float, end: float) -> Iterator[tuple[int, float, bool]]: ...
    def colour(self, path: str, at: float) -> tuple[int, int, int] | None: ...
    def samples(self, path: str, rate: int) -> list[float]: ...


class Encoder(Protocol):
    """An edit decision, a filter graph or samples to a file."""

    def trim(self, path: str, target: str, seek: float, length: float | None) -> None: ...
    def render(self, inputs: list[str], filter_graph: str, target: str) -> None: ...
    def write(self, samples: list[float], rate: int, form: str, target: str) -> None: ...


class Recognizer(Protocol):
    """Samples to raw model output."""

    def transcribe(self, samples: list[float], prompt: str) -> str: ...


class Aligner(Protocol):
    """Samples and words to interleaved timestamps in milliseconds."""

    def align(self, samples: list[float], words: list[str]) -> list[int]: ...


class Separator(Protocol):
    """A chunk of a mix to its stems."""

    def separate(self, chunk: list[float]) -> dict[str, list[float]]: ...


class LanguageModel(Protocol):
    """A prompt to an answer."""

    def complete(self, prompt: str) -> str: ...


class Draft(Protocol):
    """A timeline to an editor's project."""

    def save(self, name: str, timeline: list[dict[str, Any]]) -> None: ...


class ServerError(Exception):
    """An answer with a status of its own."""

    def __init__(self, status: int) -> None:
        super().__init__(f"status {status}")
        self.status = status


def with_retries(call: Callable[[], Any], tries: int = 3, wait: float = 2.0, limited: float = 10.0, sleep: Callable[[float], None] = time.sleep) -> Any:
    """Server errors and time-outs are tried again after a fixed wait, too many requests after a doubling one; other client errors are not."""
    for n in range(tries):
        try:
            return call()
        except ServerError as e:
            if n + 1 == tries or (400 <= e.status < 500 and e.status != 429):
                raise
            sleep(limited * 2**n if e.status == 429 else wait)
        except TimeoutError:
            if n + 1 == tries:
                raise
            sleep(wait)
    return None


@dataclass
class Recorded:
    """A stand-in for any adapter: answers by request, and keeps what was asked."""

    answers: dict[str, Any] = field(default_factory=dict)
    default: Any = None
    asked: list[str] = field(default_factory=list)

    def __call__(self, name: str, *args: Any) -> Any:
        key = json.dumps([name, *args], ensure_ascii=False, default=str)
        self.asked.append(key)
        return self.answers.get(key, self.default)

    def __getattr__(self, name: str) -> Callable[..., Any]:
        if name.startswith("_"):
            raise AttributeError(name)
        return lambda *args: self(name, *args)


def map_requests(df: DataFrame, keys: list[str], request: str, answer: str, make: Callable[[], Callable[[str], str]]) -> DataFrame:
    """Send a column through an adapter that is made once per task; keys, request and answer come back. Equal requests of a batch are sent once."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make()
        seen: dict[str, str] = {}
        for pdf in it:
            asked = [r if isinstance(r, str) else None for r in pdf[request]]
            for r in asked:
                if r is not None and r not in seen:
                    seen[r] = ask(r)
            yield pd.DataFrame({**{k: pdf[k].tolist() for k in keys}, request: asked, answer: [seen.get(r) for r in asked]}, dtype=object)
            seen.clear()

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keys, request).schema)
    return df.select(*keys, request).mapInPandas(run, f"{ddl}, `{answer}` string")
