"""Session and settings."""

from __future__ import annotations

import os
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """From the environment, whatever the case of a name; a ``.env`` file fills in what it lacks, and unknown names are ignored."""

    legiscan_api_key: str | None = None
    state_root: str | None = None
    log_level: str = "INFO"

    @staticmethod
    def load(env: dict[str, str] | None = None, file: str = ".env") -> Settings:
        found: dict[str, str] = {}
        if env is None and os.path.exists(file):
            with open(file) as f:
                for line in f:
                    name, eq, value = line.strip().partition("=")
                    if eq and not name.startswith("#"):
                        found[name.strip().lower()] = value.strip().strip("\"'")
        found |= {k.lower(): v for k, v in (os.environ if env is None else env).items()}
        return Settings(**{k: found[k] for k in Settings.__dataclass_fields__ if k in found})


@lru_cache(maxsize=1)
def settings() -> Settings:
    return Settings.load()


def session(name: str = "tidemark") -> SparkSession:
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
