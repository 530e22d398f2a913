"""Transports: how a request key becomes a response document.

A transport is a small picklable object with ``fetch(keys) -> texts``; it
runs on executors, one call per Arrow batch.  Every part of a key is text.  A
missing response is NULL; what else comes back is checked before it is stored.
A transport whose requests can fail also has ``asker(tasks)``, made once a task,
whose ``ask(keys)`` gives an ``Answer`` per key: the text, or the error.

``TableTransport`` is different: when the responses already sit in a Spark
table (a replay of earlier landings, or test feeds), fetching is a join and
stays entirely in Spark.
"""

from __future__ import annotations

import time
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from .asking import Asker, AskPolicy


@dataclass
class HttpTransport:
    """GET ``url.format(**key)`` per key; the body text is the document.

    A request that the server has nothing for (status 404 or 410) is a missing
    response.  One that fails is asked again as ``policy`` says; ``fetch`` raises when a key
    stays without an answer.  ``opener`` takes a request and a timeout and gives the
    open response, ``sleep`` waits; tests put their own in their place.
    """
    url: str
    headers: dict = field(default_factory=dict)
    timeout: float = 30.0
    opener: Callable = urllib.request.urlopen
    policy: AskPolicy = AskPolicy()
    sleep: Callable = time.sleep

    def request(self, key: dict) -> str:
        req = urllib.request.Request(self.url.format(**key), headers=self.headers)
        with self.opener(req, timeout=self.timeout) as resp:
            return resp.read().decode("utf-8")

    def asker(self, tasks: int = 1) -> Asker:
        return Asker(self.request, self.policy, tasks, sleep=self.sleep)

    def fetch(self, keys: list[dict]) -> list[str | None]:
        answers = self.asker().ask(keys)
        for k, a in zip(keys, answers):
            if a.error is not None:
                raise RuntimeError(f"no answer for {k}: {a.error}")
        return [a.text for a in answers]


@dataclass
class TableTransport:
    """Responses in a DataFrame: ``key_cols`` + ``doc_col``; fetch = join."""
    responses: DataFrame
    key_cols: tuple[str, ...]
    doc_col: str


@dataclass
class MemoryTransport:
    """Responses held in a dict (request key -> text); for tests and replays
    of a handful of saved responses.  Keys are the first key column's value, as text."""
    responses: dict
    key_col: str

    def __post_init__(self):
        self.responses = {str(k): v for k, v in self.responses.items()}

    def fetch(self, keys: list[dict]) -> list[str | None]:
        return [self.responses.get(str(k[self.key_col])) for k in keys]


@dataclass
class PageFiles:
    """Pages kept as files that Spark wrote, one folder ``block=N`` for every
    ``block`` page numbers (columns ``page_no``, ``json_data``); a request opens
    the one block that holds its page."""
    path: str
    block: int = 256

    def fetch(self, keys: list[dict]) -> list[str | None]:
        import pyarrow.dataset as ds
        import pyarrow.fs as fs

        filesystem, root = fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")
        out = []
        for k in keys:
            page = int(k["page_no"])
            folder = f"{root}/block={page // self.block}"
            if filesystem.get_file_info(folder).type == fs.FileType.NotFound:
                out.append(None)
                continue
            rows = ds.dataset(folder, format="parquet", filesystem=filesystem).to_table(columns=["json_data"], filter=ds.field("page_no") == page)
            out.append(rows.column(0)[0].as_py() if len(rows) else None)
        return out
