"""One JSON object a line, with fields bound once and carried along."""

from __future__ import annotations

import json
import logging
from datetime import datetime, timezone

#: Names a line has itself; a field of such a name gets a prefix.
OWN = ("ts", "level", "message", "logger", "error")


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        line = {
            "ts": datetime.fromtimestamp(record.created, timezone.utc).isoformat(), "level": record.levelname, "logger": record.name,
            "message": record.getMessage()
        }
        for k, v in (getattr(record, "bound", None) or {}).items():
            line[f"field_{k}" if k in OWN else k] = v
        if record.exc_info:
            line["error"] = self.formatException(record.exc_info)
        return json.dumps(line, default=str)


class Log:
    """A logger and the fields bound to it; bind() gives another and leaves this one as it is."""

    def __init__(self, name: str = "tidewright", **bound):
        self.logger, self.bound = logging.getLogger(name), bound

    def bind(self, **more) -> Log:
        return Log(self.logger.name, **(self.bound | more))

    def _say(self, level: int, message: str, exc: bool, fields: dict) -> None:
        self.logger.log(level, message, exc_info=exc, extra={"bound": self.bound | fields})

    def info(self, message: str, **fields) -> None:
        self._say(logging.INFO, message, False, fields)

    def warning(self, message: str, **fields) -> None:
        self._say(logging.WARNING, message, False, fields)

    def error(self, message: str, exc: bool = False, **fields) -> None:
        self._say(logging.ERROR, message, exc, fields)


def configure(level: str = "INFO", stream=None) -> None:
    """JSON lines on a stream (standard error where none is given); configuring again replaces what was."""
    logger = logging.getLogger("tidewright")
    for h in list(logger.handlers):
        logger.removeHandler(h)
    handler = logging.StreamHandler(stream)
    handler.setFormatter(JsonLines())
    logger.addHandler(handler)
    logger.setLevel(level.upper())
    logger.propagate = False
