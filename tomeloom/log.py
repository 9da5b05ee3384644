"""Driver logs: one JSON object a line, or plain text."""

from __future__ import annotations

import datetime
import json
import logging
import sys


class JsonLines(logging.Formatter):
    """time, level, logger and message of a record, its error, and what was passed as extra={"data": {...}}."""

    def format(self, record: logging.LogRecord) -> str:
        row = {"time": datetime.datetime.fromtimestamp(record.created, datetime.UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        if record.exc_info:
            row["error"] = self.formatException(record.exc_info)
        return json.dumps(row | getattr(record, "data", {}), ensure_ascii=False, default=str)


def get_logger(name: str = "tomeloom", level: str = "INFO", as_json: bool = False) -> logging.Logger:
    """A logger to standard output; asked again, the same one with the new settings."""
    logger = logging.getLogger(name)
    logger.handlers.clear()
    handler = logging.StreamHandler(sys.stdout)
    handler.setFormatter(JsonLines() if as_json else logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))
    logger.addHandler(handler)
    logger.setLevel(level)
    logger.propagate = False
    return logger
