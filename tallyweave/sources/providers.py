"""Edges to native readers: text, images and recognition run where the bytes are, behind one interface; failures become rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "path string, page int, content string, confidence double, x0 double, y0 double, x1 double, y1 double, status string, error string"


class Recognizer(Protocol):
    """Reads the blocks of one file: dicts with page, content, confidence and a box."""

    def read(self, path: str, content: bytes) -> Iterator[dict]: ...


class NoRecognizer:
    """The default where no engine is installed: every file fails with a message and the job goes on."""

    def read(self, path: str, content: bytes) -> Iterator[dict]:
        raise RuntimeError("no recognition engine is installed")


def recognized(files: DataFrame, make: Callable[[], Recognizer]) -> DataFrame:
    """Blocks of files (path, content) by a recognizer that each task makes once, on its first file (none on an empty split).

    A file that fails gives one row with status 'failed' and the error; the others are not affected.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = None
        for f in frames:
            out = []
            for path, content in zip(f["path"], f["content"]):
                try:
                    engine = engine or make()
                    for b in engine.read(path, content):
                        x = b.get("bbox") or [None] * 4
                        out.append((path, b.get("page", 1), b.get("content"), b.get("confidence"), *x, "success", None))
                except Exception as e:  # noqa: BLE001
                    out.append((path, None, None, None, None, None, None, None, "failed", str(e)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"page": "Int64"})

    return files.select("path", "content").mapInPandas(run, SCHEMA)


RENDERED = "path string, page int, image binary, width int, height int, status string, error string"


class Renderer(Protocol):
    """Draws the pages of one file: dicts with page, image (PNG bytes), width and height."""

    def render(self, path: str, content: bytes, dpi: int) -> Iterator[dict]: ...


def rendered(files: DataFrame, make: Callable[[], Renderer], dpi: int = 200) -> DataFrame:
    """Images of the pages of files (path, content) by a renderer that each task makes once; a file that fails gives one row with status 'failed'."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = None
        for f in frames:
            out = []
            for path, content in zip(f["path"], f["content"]):
                try:
                    engine = engine or make()
                    out += [(path, p["page"], p["image"], p["width"], p["height"], "success", None) for p in engine.render(path, content, dpi)]
                except Exception as e:  # noqa: BLE001
                    out.append((path, None, None, None, None, "failed", str(e)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in RENDERED.split(", ")])

    return files.select("path", "content").mapInPandas(run, RENDERED)


ANSWERED = "doc_id string, page int, answer string, ok boolean, error string"


class VisionClient(Protocol):
    """Asks a hosted model about one page's image."""

    def ask(self, image: str, prompt: str) -> str: ...


class NoVision:
    """The default without a client: every page stays unanswered and the job goes on."""

    def ask(self, image: str, prompt: str) -> str:
        raise RuntimeError("no vision client is set up")


def asked(pages: DataFrame, make: Callable[[], VisionClient], prompt: str, secrets: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, page, answer, ok, error) of pages (doc_id, page, path): a client is made once a task, on its first page; errors become rows, without the secrets."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = None
        for f in frames:
            out = []
            for doc, page, path in zip(f["doc_id"], f["page"], f["path"]):
                try:
                    client = client or make()
                    out.append((doc, page, client.ask(path, prompt), True, None))
                except Exception as e:  # noqa: BLE001
                    text = str(e)
                    for s in secrets:
                        text = text.replace(s, "***")
                    out.append((doc, page, None, False, text))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in ANSWERED.split(", ")])

    return pages.selectExpr("cast(doc_id as string) as doc_id", "cast(page as int) as page", "path").mapInPandas(run, ANSWERED)
