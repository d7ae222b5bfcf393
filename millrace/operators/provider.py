"""Text realization is a provider: a template that needs no network, or a client that is made once in each task.

A provider is a function from inputs to results; realize() runs it with rules and retries, in passes over what still fails.
"""

from __future__ import annotations

import json
import os
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.dims import CUES
from .text_rules import text_issues

RETRYABLE = (408, 429, 500, 502, 503, 504)


class Provider(Protocol):
    """Adds columns belief and thinking to rows of realization inputs; feedback has the issues of the last try."""

    def __call__(self, rows: DataFrame) -> DataFrame: ...


def template(rows: DataFrame) -> DataFrame:
    """Texts that keep all rules by their making: the name, the first person, and the first cue of the decision."""
    decision, language, name = F.col("policy_decision"), F.col("language"), F.col("name")
    cue = lambda k: F.create_map(*[x for d, (must, _) in CUES.items() for x in (F.lit(d), F.lit(must[k][0]))])[decision]
    belief = F.when(language == "zh", F.concat(F.lit("我认识"), name, F.lit("，眼下手头有别的事。"))).otherwise(F.concat(F.lit("I know "), name, F.lit(" and my day is rather full.")))
    thinking = F.when(language == "zh", F.concat(name, F.lit("的请求，我想好了："), cue("zh"), F.lit("。"))).otherwise(F.concat(F.lit("About "), name, F.lit(": "), cue("en"), F.lit(".")))
    return rows.withColumns({"belief": belief, "thinking": thinking})


class ClientProvider:
    """Runs connect() once in each task and its client for each row; client(row dict) gives (belief, thinking).

    An error with a retryable status is tried again after a growing pause; any other, or the last, leaves empty texts and the error.
    """

    def __init__(self, connect: Callable[[], Callable[[dict], tuple[str, str]]], attempts: int = 5, pause: tuple[float, float] = (2.0, 60.0)):
        self.connect, self.attempts, self.pause = connect, attempts, pause

    def __call__(self, rows: DataFrame) -> DataFrame:
        connect, attempts, pause = self.connect, self.attempts, self.pause

        def f(batches: Iterator):
            client = connect()
            for b in batches:
                out = []
                for row in b.to_dict("records"):
                    out.append(called(client, row, attempts, pause))
                yield b.assign(belief=[x[0] for x in out], thinking=[x[1] for x in out], error=[x[2] for x in out])

        kept = rows.drop("belief", "thinking", "error")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
        return kept.mapInPandas(f, f"{schema}, belief string, thinking string, error string")


def called(client, row: dict, attempts: int, pause: tuple[float, float], sleep=time.sleep) -> tuple[str, str, str | None]:
    for n in range(1, attempts + 1):
        try:
            return (*client(row), None)
        except Exception as e:  # noqa: BLE001  every error of a client is the item's
            status = getattr(e, "status", None)
            if n == attempts or (status is not None and status not in RETRYABLE):
                return "", "", f"{type(e).__name__}: {e}"
            sleep(min(pause[1], pause[0] * 2 ** (n - 1)) * (0.5 + random.random() / 2))
    return "", "", "not tried"


class HttpError(Exception):
    """A response with a status that is no success."""

    def __init__(self, status: int, text: str):
        super().__init__(f"status {status}: {text[:200]}")
        self.status = status


def settings(spark) -> dict:
    """Where a client of chat completions finds its service: Spark's configuration first, then the environment."""
    names = {"url": "MILLRACE_CHAT_URL", "key": "MILLRACE_CHAT_KEY", "model": "MILLRACE_CHAT_MODEL"}
    found = {k: spark.conf.get(f"spark.millrace.chat.{k}", None) or os.environ.get(v) for k, v in names.items()}
    if lost := [k for k in ("url", "model") if not found[k]]:
        raise ValueError(f"no {' and '.join(lost)} for the chat service: set spark.millrace.chat.* or MILLRACE_CHAT_*")
    return found


class ChatClient:
    """Posts chat completions; gives the response's text. Pickled with its settings alone, so each task makes its own requests."""

    def __init__(self, url: str, key: str | None, model: str, timeout: float = 120.0):
        self.url, self.key, self.model, self.timeout = url.rstrip("/"), key, model, timeout

    def body(self, messages: list[dict], tool: dict | None = None, json_only: bool = False, temperature: float = 0.3, max_tokens: int | None = None) -> dict:
        out = {"model": self.model, "messages": messages, "temperature": temperature} | ({"max_tokens": max_tokens} if max_tokens else {})
        if tool:
            out |= {"tools": [tool], "tool_choice": {"type": "function", "function": {"name": tool["function"]["name"]}}}
        return out | ({"response_format": {"type": "json_object"}} if json_only else {})

    def __call__(self, messages: list[dict], **more) -> str:
        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        request = urllib.request.Request(f"{self.url}/chat/completions", json.dumps(self.body(messages, **more)).encode(), headers)
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as response:
                return response.read().decode()
        except urllib.error.HTTPError as e:
            raise HttpError(e.code, e.read().decode(errors="replace")) from e


def asked(rows: DataFrame, client: Callable[[list[dict]], str], messages: str = "messages", attempts: int = 5, pause: tuple[float, float] = (2.0, 60.0)) -> DataFrame:
    """rows with response (a raw text, null after the last failed try) and error; one request at a time in each task."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def f(batches):
        for b in batches:
            got = [called(lambda m: (client(m), ""), [{"role": m["role"], "content": m["content"]} for m in own], attempts, pause) for own in b[messages]]
            yield b.assign(response=[x[0] or None for x in got], error=[x[2] for x in got])

    return rows.mapInPandas(f, f"{schema}, response string, error string")


def realize(inputs: DataFrame, provider: Provider, checkpoint: Callable[[DataFrame], DataFrame], attempts: int = 3, judge: Callable[[DataFrame], Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, tries): up to so many passes, each over the rows whose last try broke a rule or was not passed by the judge.

    inputs: record_id, policy_decision, language, name, mention. checkpoint keeps a pass's rows (a written table), so that a
    provider is asked once for each. Feedback of a try is the issues of the one before.
    """
    left = inputs.withColumn("feedback", F.array().cast("array<struct<code: string, origin: string, field: string, message: string>>"))
    good, tries = None, None
    for n in range(1, attempts + 1):
        told = provider(left)
        c = F.col
        told = told.withColumn("issues", text_issues(c("belief"), c("thinking"), c("policy_decision"), c("language"), c("name"), c("mention"))).withColumn("attempt", F.lit(n))
        passes = F.size("issues") == 0
        told = checkpoint(told.withColumn("ok", passes & judge(told) if judge else passes))
        own = told.where("ok").drop("feedback", "ok")
        log = told.select("record_id", "attempt", "ok", "issues")
        good, tries = (own, log) if good is None else (good.unionByName(own, allowMissingColumns=True), tries.unionByName(log))
        left = told.where("not ok").withColumn("feedback", F.when(F.size("issues") > 0, c("issues")).otherwise(c("feedback"))).select(*inputs.columns, "feedback")
        if left.isEmpty():
            break
    return good, tries
