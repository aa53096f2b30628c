"""Project files: flags, profiles and packages, many projects at a time.

The files are YAML, so each one is parsed by a short Python function inside the tasks; what
follows is columns again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def project_files(spark: SparkSession, root: str, file_name: str) -> DataFrame:
    """``file_name`` of every project folder below ``root``, as project and whole text."""
    path = F.col("_metadata.file_path")
    return spark.read.text(f"{root}/*/{file_name}", wholetext=True).select(
        F.element_at(F.split(path, "/"), -2).alias("project"), F.col("value").alias("content")
    )


def _parser(extract: Callable, columns: list[str]) -> Callable:
    """A ``mapInPandas`` function over ``extract(project, content)`` rows.

    Built from nested functions throughout, so it travels to the executors by value and the
    package need not be installed there.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        for batch in batches:
            rows = []
            for project, text in zip(batch["project"], batch["content"]):
                try:
                    content = yaml.load(text or "", Loader=loader)
                except yaml.YAMLError:
                    content = None
                rows.extend(extract(project, content if isinstance(content, dict) else {}))
            yield pd.DataFrame(rows, columns=columns)

    return parse


def _flag_rows() -> Callable:
    def text(value) -> str:
        if isinstance(value, (dict, list)):
            return json.dumps(leaves(value), ensure_ascii=False)
        return str(value)

    def leaves(value):
        if isinstance(value, dict):
            return {str(k): leaves(v) for k, v in value.items()}
        if isinstance(value, list):
            return [leaves(v) for v in value]
        return str(value)

    def extract(project: str, content: dict):
        if not content:
            yield project, 0, None, {}
        for position, (key, flags) in enumerate(content.items()):
            flags = flags if isinstance(flags, dict) else {}
            yield project, position, str(key), {str(k): text(v) for k, v in flags.items()}

    return extract


def _package_rows() -> Callable:
    def extract(project: str, content: dict):
        for entry in content.get("packages") or ():
            if isinstance(entry, dict) and "package" in entry and "version" in entry:
                yield project, str(entry["package"]), str(entry["version"])

    return extract


def project_configs(files: DataFrame) -> DataFrame:
    """Every top-level entry of every flag file: project, position, key and flag map.

    A file that is empty, not YAML or no mapping gives one row without a key and without flags,
    so its project still shows, with all defaults.
    """
    return files.select("project", "content").mapInPandas(
        _parser(_flag_rows(), ["project", "ord", "config_key", "vars"]),
        "project string, ord int, config_key string, vars map<string,string>",
    )


def project_flags(configs: DataFrame) -> DataFrame:
    """The flags in force: those of a file's first entry, whatever its key."""
    return configs.where("ord = 0").select("project", "config_key", "vars")


def project_profiles(files: DataFrame) -> DataFrame:
    """Every profile of every profile file, with its settings as text."""
    return project_configs(files).where("config_key IS NOT NULL").select(
        "project", F.col("config_key").alias("profile"), F.col("vars").alias("settings")
    )


def project_packages(files: DataFrame) -> DataFrame:
    """Packages that name both a package and a version."""
    return files.select("project", "content").mapInPandas(
        _parser(_package_rows(), ["project", "package", "version"]),
        "project string, package string, version string",
    )
