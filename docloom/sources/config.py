"""Site configuration: a closed YAML schema, checked on the driver, as rows."""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.schema import TOPICS


class ConfigError(ValueError):
    """The configuration does not fit its schema."""


@dataclass(frozen=True)
class Topic:
    name: str
    path: list[str] | None = None
    url: str | None = None
    subtopics: list[str] | None = None
    instructions: str = ""


@dataclass(frozen=True)
class Site:
    site: str
    root_url: str
    topics: list[Topic] = field(default_factory=list)

    def topic(self, name: str) -> Topic:
        found = [t for t in self.topics if t.name == name]
        if not found:
            raise KeyError(name)
        return found[0]


def checked(kind: type, given: object, where: str) -> dict:
    if not isinstance(given, dict):
        raise ConfigError(f"{where}: a mapping is needed")
    known = kind.__dataclass_fields__
    if extra := sorted(set(given) - set(known)):
        raise ConfigError(f"{where}: unknown {', '.join(extra)}")
    return given


def topic_of(given: object, n: int) -> Topic:
    where = f"topic {n}"
    row = checked(Topic, given, where)
    if not isinstance(row.get("name"), str):
        raise ConfigError(f"{where}: name is needed")
    for key in ("path", "subtopics"):
        value = row.get(key)
        if value is not None and not (isinstance(value, list) and all(isinstance(x, str) for x in value)):
            raise ConfigError(f"{where}: {key} must be a list of texts")
    if not row.get("path") and not row.get("url"):
        raise ConfigError(f"{where}: path or url is needed")
    if row.get("subtopics") and not row.get("url"):
        raise ConfigError(f"{where}: subtopics need url")
    return Topic(**row)


def load_site(path: str | Path) -> Site:
    """Read and check a site file. Raises FileNotFoundError or ConfigError; duplicate topic names are rejected."""
    with open(path, encoding="utf-8") as file:
        row = checked(Site, yaml.safe_load(file), "site")
    for key in ("site", "root_url"):
        if not isinstance(row.get(key), str):
            raise ConfigError(f"site: {key} is needed")
    topics = [topic_of(t, n) for n, t in enumerate(row.get("topics") or [])]
    names = [t.name for t in topics]
    if len(set(names)) < len(names):
        raise ConfigError("site: topic names repeat")
    return Site(row["site"], row["root_url"], topics)


def topics_table(spark: SparkSession, site: Site) -> DataFrame:
    return spark.createDataFrame([(t.name, t.path, t.url, t.subtopics, t.instructions) for t in site.topics], TOPICS)


def select_topics(topics: DataFrame, wanted: str | None) -> DataFrame:
    """(…, ord): the wanted topics in the order asked for, repeats kept; all without a wish. Raises KeyError for unknown names."""
    names = [x.strip() for x in (wanted or "").split(",") if x.strip()]
    if not names:
        return topics.withColumn("ord", F.monotonically_increasing_id())
    asked = topics.sparkSession.createDataFrame(list(enumerate(names)), "ord long, name string")
    unknown = [r["name"] for r in asked.join(topics, "name", "left_anti").select("name").collect()]  # as many as were typed
    if unknown:
        raise KeyError(", ".join(sorted(unknown)))
    return topics.join(F.broadcast(asked), "name").orderBy("ord")
