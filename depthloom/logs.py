"""Logging and the progress of streams. The level comes from DEPTHLOOM_LOG, else from ``log_level`` of the configuration file, else INFO."""

from __future__ import annotations

import json
import logging
import os
from pathlib import Path

from pyspark.sql.streaming import StreamingQueryListener

FORM = logging.Formatter("%(asctime)s %(levelname)s [%(processName)s] %(name)s: %(message)s", datefmt="%H:%M:%S")


def level(file: str = "config.json") -> int:
    said = os.environ.get("DEPTHLOOM_LOG")
    path = Path(os.environ.get("DEPTHLOOM_CONFIG", file))
    if not said and path.exists():
        said = json.loads(path.read_text()).get("log_level")
    return logging.getLevelNamesMapping().get((said or "INFO").upper(), logging.INFO)


def logger(name: str = "depthloom") -> logging.Logger:
    """A logger with one handler of its own, whatever the number of calls."""
    out = logging.getLogger(name)
    if not out.handlers:
        handler = logging.StreamHandler()
        handler.setFormatter(FORM)
        out.addHandler(handler)
        out.setLevel(level())
        out.propagate = False
    return out


def to_file(log: logging.Logger, path: str) -> str:
    """Writes what ``log`` says to a file of the driver too."""
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    handler = logging.FileHandler(path, encoding="utf-8")
    handler.setFormatter(FORM)
    log.addHandler(handler)
    return path


class Progress(StreamingQueryListener):
    """Logs the rows and the rate of each batch; for ``spark.streams.addListener``."""

    def __init__(self, log: logging.Logger | None = None) -> None:
        self.log = log or logger()

    def onQueryStarted(self, event: object) -> None:
        self.log.info("stream %s started", event.id)

    def onQueryProgress(self, event: object) -> None:
        p = event.progress
        self.log.info("batch %d: %d rows, %.1f a second", p.batchId, p.numInputRows, p.processedRowsPerSecond or 0.0)

    def onQueryIdle(self, event: object) -> None:
        pass

    def onQueryTerminated(self, event: object) -> None:
        self.log.info("stream %s ended%s", event.id, f": {event.exception}" if event.exception else "")
