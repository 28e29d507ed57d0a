"""Topic configurations: JSON documents to one current row per topic, and the join to lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import render_template

CONFIG_DDL = (
    "version bigint, id string, hdfsRootDir string, proxyUser string, "
    "defaultDirectory string, filterSet array<string>"
)


def topic_configs(docs: DataFrame, column: str = "json") -> DataFrame:
    """Newest version of each topic's configuration; documents may leave field names unquoted."""
    parsed = F.from_json(F.col(column), CONFIG_DDL, {"allowUnquotedFieldNames": "true"})
    rows = docs.select(parsed.alias("c")).filter("c.id IS NOT NULL")
    return rows.groupBy(F.col("c.id").alias("id")).agg(F.max_by("c", "c.version").alias("c")).select("c.*")


def configured(lines: DataFrame, configs: DataFrame) -> DataFrame:
    """Lines of configured topics with ``root_template`` and the default ``data_dir``.

    A stored table of configurations is broadcast if its measured size allows it; beyond that
    the join shuffles and adaptive execution splits hot topics.
    """
    side = configs.select(
        F.col("id").alias("topic"),
        F.col("hdfsRootDir").alias("root_template"),
        F.col("defaultDirectory").alias("default_dir"),
    )
    return lines.join(side, "topic")


def unique_roots(configs: DataFrame) -> DataFrame:
    """Static folder above the first time token of each template, once, with its topic count.

    ``/service/logs/%y%M%d/%H/web`` has the root ``/service/logs``.
    """
    template = F.col("hdfsRootDir")
    static = F.regexp_replace(F.split(template, "%", 2)[0], "/[^/]*$", "")
    root = F.when(F.contains(template, F.lit("%")), static).otherwise(template)
    return configs.groupBy(root.alias("root")).agg(F.countDistinct("id").alias("topics"))


def render_paths(lines: DataFrame, configs: DataFrame, time: str = "dir_ms", data_dir: str | None = "data_dir"):
    """Inner-join the configuration and add ``path``, the directory of each line.

    ``time`` is the column the template is expanded at; ``data_dir`` a column that, where not
    NULL, replaces the configured directory.
    """
    joined = configured(lines, configs)
    folder = F.coalesce(F.col(data_dir), F.col("default_dir")) if data_dir else F.col("default_dir")
    template = F.concat_ws("/", F.col("root_template"), folder)
    return joined.withColumn("path", render_template(template, F.col(time))).drop("root_template", "default_dir")
