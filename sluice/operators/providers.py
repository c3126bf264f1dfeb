"""A chain of external text providers over chunked rows, in Arrow batches.

Providers go in order for each chunk. One that answers with a non-empty object ends
its chunk; when the wanted keys are all filled the row is done, else the next chunk
starts with the first provider again. A provider over its limit is asked again after
a growing wait, or after what it asks for, ``limit_retries`` times; one that refuses
the size gets the first chunk of the text cut to half the budget, ``size_retries``
times; one that fails or gives nothing usable passes the chunk on. A row never fails
the job: its last error is a column.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any, ClassVar, Protocol

import pandas as pd
from pyspark.sql import DataFrame

from sluice.functions.salvage import salvage
from sluice.sources.http import Answer, send, wait_seconds


class RateLimited(RuntimeError):
    """The provider asks to wait (429), perhaps for so many seconds."""

    def __init__(self, message: str, asked: float | None = None):
        super().__init__(message)
        self.asked = asked


class TooLarge(RuntimeError):
    """The provider refuses the size (413)."""


@dataclass
class Reply:
    text: str
    prompt_tokens: int = 0
    completion_tokens: int = 0


class Provider(Protocol):
    name: str

    def configured(self) -> bool: ...

    def ask(self, prompt: str, text: str) -> Reply: ...


#: Posts a JSON body with headers to an address.
Post = Callable[[str, dict[str, Any], dict[str, str]], Answer]


def _post(url: str, body: dict[str, Any], headers: dict[str, str]) -> Answer:
    return send(url, json.dumps(body).encode(), {"Content-Type": "application/json"} | headers, timeout=30.0)


def _at(value: Any, *path: str | int) -> Any:
    """What stands at a path of keys and places, or null."""
    for step in path:
        try:
            value = value[step]
        except (KeyError, IndexError, TypeError):
            return None
    return value


@dataclass
class RestProvider:
    """What all adapters share: one POST, and its status, text and token counts read the same way."""

    name: str
    key: str
    model: str
    url: str = ""
    most_tokens: int = 2000
    post: Post = _post

    #: Where the reply's text and token counts stand; an adapter's format.
    text_at: ClassVar[tuple] = ()
    tokens_at: ClassVar[tuple] = ((), ())

    def configured(self) -> bool:
        return bool(self.key and self.key.strip())

    def request(self, prompt: str, text: str) -> tuple[str, dict[str, Any], dict[str, str]]:
        raise NotImplementedError

    def ask(self, prompt: str, text: str) -> Reply:
        got = self.post(*self.request(prompt, text))
        if got.status == 429:
            raise RateLimited(self.name, got.asked)
        if got.status == 413:
            raise TooLarge(self.name)
        if got.status >= 400:
            raise RuntimeError(f"status {got.status}: {(got.body or '')[:300]}")
        try:
            value = json.loads(got.body or "")
        except ValueError:
            raise RuntimeError("not JSON") from None
        said = _at(value, *self.text_at)
        if not isinstance(said, str):
            raise RuntimeError("unexpected shape")
        counts = [_at(value, *path) for path in self.tokens_at]
        return Reply(said, *[c if isinstance(c, int) else 0 for c in counts])


class ChatCompletions(RestProvider):
    """The chat completions format, which several providers share; url is the whole address."""

    text_at = ("choices", 0, "message", "content")
    tokens_at = (("usage", "prompt_tokens"), ("usage", "completion_tokens"))

    def request(self, prompt, text):
        messages = [{"role": "system", "content": prompt}, {"role": "user", "content": text}]
        body = {"model": self.model, "messages": messages, "max_tokens": self.most_tokens, "temperature": 0.1, "response_format": {"type": "json_object"}}
        return self.url, body, {"Authorization": f"Bearer {self.key}"}


class GenerateContent(RestProvider):
    """The generateContent format; url is the address of the models, and the key travels in a header."""

    text_at = ("candidates", 0, "content", "parts", 0, "text")
    tokens_at = (("usageMetadata", "promptTokenCount"), ("usageMetadata", "candidatesTokenCount"))

    def request(self, prompt, text):
        config = {"maxOutputTokens": self.most_tokens, "temperature": 0.1, "response_mime_type": "application/json"}
        body = {"contents": [{"role": "user", "parts": [{"text": f"{prompt}\n\n{text}"}]}], "generationConfig": config}
        return f"{self.url.rstrip('/')}/{self.model}:generateContent", body, {"x-goog-api-key": self.key}


# The providers in their usual order: format, address, variables of key and model, default model.
PROVIDERS: dict[str, tuple[type[RestProvider], str, str, str, str]] = {
    "gemini": (GenerateContent, "https://generativelanguage.googleapis.com/v1beta/models", "GEMINI_API_KEY", "GEMINI_MODEL", "gemini-2.0-flash"),
    "groq": (ChatCompletions, "https://api.groq.com/openai/v1/chat/completions", "GROQ_API_KEY", "GROQ_MODEL", "llama-3.3-70b-versatile"),
    "deepseek": (ChatCompletions, "https://api.deepseek.com/chat/completions", "DEEPSEEK_API_KEY", "DEEPSEEK_MODEL", "deepseek-chat"),
}


@dataclass(frozen=True)
class ChainConfig:
    order: tuple[str, ...] = tuple(PROVIDERS)
    chunk_tokens: int = 3500
    chunk_overlap: int = 200
    most_tokens: int = 2000
    limit_retries: int = 5
    size_retries: int = 3


def chain_config(settings: Mapping[str, Any]) -> ChainConfig:
    """The chain's settings of a section ``llm``; names that it lacks have their defaults."""
    own = settings.get("llm") or {}
    names = {"order": "provider_order", "chunk_tokens": "chunk_token_budget", "chunk_overlap": "chunk_overlap_tokens", "most_tokens": "max_tokens_per_request", "limit_retries": "max_429_retries", "size_retries": "max_413_retries"}
    found = {k: own[n] for k, n in names.items() if n in own}
    return ChainConfig(**found | ({"order": tuple(found["order"])} if "order" in found else {}))


def build_providers(config: ChainConfig, env: Mapping[str, str], post: Post = _post) -> list[Provider]:
    """The providers of the order that are known, with keys and models from env; one without a key is not configured."""
    out: list[Provider] = []
    for name in config.order:
        if name in PROVIDERS:
            kind, url, key, model, usual = PROVIDERS[name]
            out.append(kind(name, env.get(key, ""), env.get(model) or usual, url, config.most_tokens, post))
    return out


@dataclass
class ScriptedProvider:
    """A double: outcomes in turn, each a reply's text, a status code or an error."""

    name: str
    outcomes: list
    key: str = "key"
    asked: list[str] = field(default_factory=list)

    def configured(self) -> bool:
        return bool(self.key.strip())

    def ask(self, prompt: str, text: str) -> Reply:
        self.asked.append(text)
        out = self.outcomes[min(len(self.asked), len(self.outcomes)) - 1]
        if out == 429:
            raise RateLimited(self.name)
        if out == 413:
            raise TooLarge(self.name)
        if isinstance(out, int):
            raise RuntimeError(f"status {out}")
        if isinstance(out, Exception):
            raise out
        return Reply(out, len(text) // 4, len(out) // 4)


def _tokens(t: str) -> int:
    return max(1, (len(t) + 3) // 4)


def cut_text(text: str, budget: int) -> str:
    """The first chunk of a text within a budget: its lead paragraph and what fits behind it; a paragraph is never cut."""
    parts = [p.strip() for p in text.split("\n\n") if p.strip()]
    if not parts:
        return ""
    room, body, used = max(budget - _tokens(parts[0]), 500), [], 0
    for p in parts[1:]:
        if body and used + _tokens(p) > room:
            break
        body.append(p)
        used += _tokens(p)
    return "\n\n".join([parts[0], *body])


def _ask(provider: Provider, prompt: str, text: str, limit_retries: int, sleep: Callable[[float], None]) -> Reply:
    """The provider's reply, after waits where it is over its limit or too slow."""
    for attempt in range(limit_retries + 1):
        try:
            return provider.ask(prompt, text)
        except (RateLimited, TimeoutError) as e:
            if attempt == limit_retries:
                raise
            sleep(wait_seconds(attempt, jitter=0.5, asked=getattr(e, "asked", None)))
    raise AssertionError("unreachable")


def _call(provider: Provider, prompt: str, text: str, budget: int, size_retries: int, limit_retries: int, sleep: Callable[[float], None]) -> Reply:
    for attempt in range(size_retries + 1):
        try:
            return _ask(provider, prompt, text, limit_retries, sleep)
        except TooLarge:
            if attempt == size_retries:
                raise
            budget = max(budget // 2, 500)
            text = cut_text(text, budget)
    raise AssertionError("unreachable")


def run_chain(
    chunks: list[str], providers: list[Provider], prompt: str, keys: list[str], budget: int = 3500, size_retries: int = 3, limit_retries: int = 5,
    sleep: Callable[[float], None] = time.sleep,
) -> dict:
    """What the chain makes of one row: data (or null), provider, error, and tokens by provider."""
    usage: dict[str, list[int]] = {}
    out = {"data": None, "provider": "none", "error": "empty_content" if not chunks else "no_providers_configured"}
    usable = [p for p in providers if p.configured()]
    for chunk in chunks if usable else []:
        for p in usable:
            try:
                reply = _call(p, prompt, chunk, budget, size_retries, limit_retries, sleep)
            except Exception as e:  # any failure goes on to the next provider
                out = {"data": None, "provider": p.name, "error": f"{type(e).__name__}: {e}"[:300]}
                continue
            spent = usage.setdefault(p.name, [0, 0])
            spent[0] += reply.prompt_tokens
            spent[1] += reply.completion_tokens
            data = salvage(reply.text)
            value = json.loads(data) if data else {}
            out = {"data": data if value else None, "provider": p.name, "error": None if value else "no usable object"}
            if value:
                if all(value.get(k) not in (None, "") for k in keys):
                    return out | {"usage": usage}
                break
    return out | {"usage": usage}


def extract(df: DataFrame, chunks: str, make: Callable[[], list[Provider]], prompt: str, keys: list[str], id_col: str = "id", config: ChainConfig = ChainConfig()) -> DataFrame:
    """(id, data, provider, error, usage): the chain over an array column of chunk texts; make builds the providers in each task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        providers = make()
        for f in frames:
            got = [run_chain(list(c) if c is not None else [], providers, prompt, keys, config.chunk_tokens, config.size_retries, config.limit_retries) for c in f[chunks]]
            yield pd.DataFrame({
                id_col: f[id_col], "data": [g["data"] for g in got], "provider": [g["provider"] for g in got], "error": [g["error"] for g in got],
                "usage": [json.dumps(g["usage"], sort_keys=True) for g in got],
            })

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, chunks).mapInPandas(run, f"`{id_col}` {kind}, data string, provider string, error string, usage string")
