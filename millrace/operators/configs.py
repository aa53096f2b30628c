"""Changes to project configurations: override, owner, rename, profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The key pattern of a configuration and the flags that hold its project's name.
KEY_INFIX = "_DBT_PRJ_"
OWNER_FLAG = "DAG_OWNER"
NAMED_FLAGS = ("DAG_ID", "DBT_PROJECT_NAME", "DBT_PROJECT_DIRECTORY", "MANIFEST_NAME")


def as_text(vars: Column) -> Column:
    """Every flag as text; a NULL reads as the word the files use for it."""
    return F.transform_values(vars, lambda _, v: F.coalesce(v.cast("string"), F.lit("None")))


def override(configs: DataFrame, overrides: DataFrame) -> DataFrame:
    """Configurations after an update: a given key replaces that key whole, others stay.

    New keys only join projects that exist. A project that is given something has all of its
    flags written as text; the others stay as they are.
    """
    known = configs.select("project").distinct()
    given = overrides.join(known, "project", "left_semi").select(
        "project", "config_key", F.col("vars").alias("_given"), F.lit(True).alias("_replaced")
    )
    updated = given.select("project").distinct().withColumn("_updated", F.lit(True))
    merged = configs.join(given, ["project", "config_key"], "full").select(
        "project", "config_key",
        F.when(F.col("_replaced"), F.col("_given")).otherwise(F.col("vars")).alias("vars"),
    )
    return merged.join(updated, "project", "left").select(
        "project", "config_key",
        F.when(F.col("_updated"), as_text(F.col("vars"))).otherwise(F.col("vars")).alias("vars"),
    )


def _put(vars: Column, key: str, value: Column) -> Column:
    others = F.map_filter(vars, lambda k, _: k != key)
    return F.map_concat(others, F.create_map(F.lit(key), value))


def set_owner(configs: DataFrame, project: Column, owner: Column) -> DataFrame:
    """A new owner in every configuration of the chosen projects."""
    changed = as_text(_put(F.col("vars"), OWNER_FLAG, owner))
    return configs.withColumn("vars", F.when(project, changed).otherwise(F.col("vars")))


def rename(configs: DataFrame, old: str | Column, new: str | Column) -> DataFrame:
    """Configurations of one project, or of each row's own, under a new project name.

    The first key that belongs to the old name, in order of the keys, keeps its prefix and
    is renamed together with the flags that hold the name; a project's other keys stay as they
    are. A project without such a key is an error.
    """
    names = [
        (F.lit(n) if isinstance(n, str) else n).alias(alias)
        for n, alias in ((old, "_old"), (new, "_new"))
    ]
    rows = configs.select("project", "config_key", "vars", *names)
    old, new, key = F.col("_old"), F.col("_new"), F.col("config_key")
    suffix = F.concat(F.lit(KEY_INFIX), F.upper(old))
    # a project has a handful of keys
    first = F.min(F.when(F.endswith(key, suffix), key)).over(Window.partitionBy("project"))
    own = F.coalesce(key == F.col("_first"), F.lit(False))
    fault = F.raise_error(F.concat(F.lit("no configuration key for project "), old))
    prefix = F.substring_index(key, KEY_INFIX, 1)
    values = F.transform_values(
        "vars",
        lambda k, v: F.when(k.isin(*NAMED_FLAGS), F.replace(v, old, new)).otherwise(v),
    )
    return rows.withColumn("_first", first).select(
        F.when(F.col("project") == old, new).otherwise(F.col("project")).alias("project"),
        F.when(F.col("_first").isNull(), fault)
        .when(own, F.concat(prefix, F.lit(KEY_INFIX), F.upper(new))).otherwise(key).alias("config_key"),
        F.when(own, values).otherwise(F.col("vars")).alias("vars"),
    )


def rename_profiles(profiles: DataFrame, old: Column, new: Column) -> DataFrame:
    """Profile files: the profile under the old name moves to the new one, others stay.

    ``profiles`` holds the project and a map of its profiles.
    """
    rows = profiles.select("project", "profiles", old.alias("_old"), new.alias("_new"))
    return rows.select(
        F.when(F.col("project") == F.col("_old"), F.col("_new")).otherwise(F.col("project")).alias("project"),
        rename_key(F.col("profiles"), F.col("_old"), F.col("_new")).alias("profiles"),
    )


def rename_key(entries: Column, old: Column, new: Column) -> Column:
    """A map with one key renamed, as the profile and model sections of a project are."""
    return F.transform_keys(entries, lambda k, _: F.when(k == old, new).otherwise(k))


def rename_project_file(projects: DataFrame, old: Column, new: Column) -> DataFrame:
    """Project files: name and profile are replaced, the old name's model section moves."""
    rows = projects.select("models", old.alias("_old"), new.alias("_new"))
    return rows.select(
        F.col("_new").alias("name"), F.col("_new").alias("profile"),
        rename_key(F.col("models"), F.col("_old"), F.col("_new")).alias("models"),
    )


def replace_profiles(profiles: DataFrame, given: DataFrame) -> DataFrame:
    """Profiles after an update: the given projects' are replaced as a whole."""
    return profiles.join(given.select("project").distinct(), "project", "left_anti").select(
        *profiles.columns
    ).unionByName(given.select(*profiles.columns))
