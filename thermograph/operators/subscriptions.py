"""Many subscriptions at once: topics against a table of topic patterns.

A pattern's levels are names, ``+`` (any one level) or a last ``#`` (the level before
it and everything below).  The patterns are a trie whose nodes are named by their
path; each different topic walks down it, one join per level: to the child of its own
name and to the child ``+``.  Only nodes that exist survive, so a topic holds as many
rows as there are nodes that fit it, and no topic meets a pattern it cannot match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pattern_nodes(patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """(depth, path): the nodes of the trie of valid patterns, one row each.

    Valid: not empty, ``#`` only as the whole last level, ``+`` only as a whole level."""
    levels = F.split(F.col("pattern"), "/", -1)
    return (valid_patterns(patterns, pattern).select(F.explode(F.transform(
        F.sequence(F.lit(1), F.size(levels)), lambda n: F.struct(
            n.alias("depth"), F.array_join(F.slice(levels, F.lit(1), n), "/").alias("path")))).alias("x"))
        .select("x.depth", "x.path").distinct())


def valid_patterns(patterns: DataFrame, pattern: str = "pattern") -> DataFrame:
    """(pattern): the different valid patterns."""
    p = patterns.select(F.col(pattern).alias("pattern")).distinct()
    return p.where(F.col("pattern").rlike(r"\A([^/+#]*|\+)(/([^/+#]*|\+))*(/#)?\z|\A#\z")
                   & (F.col("pattern") != ""))


def match_topics(topics: DataFrame, patterns: DataFrame, topic: str = "topic",
                 pattern: str = "pattern") -> DataFrame:
    """(topic, pattern): the patterns that each different topic of ``topics`` fits.

    Topics that begin with ``$`` fit no pattern that begins with a wildcard; a null
    topic or pattern fits nothing, nor does an empty one."""
    valid = valid_patterns(patterns, pattern)
    nodes = pattern_nodes(patterns, pattern)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0  # one number
    at = topics.select(F.col(topic).alias("topic")).where("topic is not null and topic <> ''").distinct()
    at = at.withColumns({"_levels": F.split("topic", "/", -1), "path": F.lit(None).cast("string")})
    found = None
    for depth in range(deepest):
        here = nodes.where(F.col("depth") == depth + 1).select(F.col("path").alias("_next"))
        begin = F.when(F.lit(depth > 0), F.concat("path", F.lit("/"))).otherwise(F.lit(""))
        inside = F.size("_levels") > depth
        name = F.get("_levels", F.lit(depth))
        # A level named like a wildcard is no wildcard; only wildcards fit it.
        step = F.array(F.when(inside & ~name.isin("+", "#"), name))
        wild = F.array(F.when(inside, F.lit("+")), F.lit("#"))
        if depth == 0:
            wild = F.when(~F.col("topic").startswith("$"), wild).otherwise(F.array().cast("array<string>"))
        ahead = at.withColumn("_name", F.explode(F.filter(F.concat(step, wild), F.isnotnull)))
        ahead = ahead.withColumn("_next", F.concat(begin, "_name"))
        ahead = ahead.join(here, "_next").select("topic", "_levels", F.col("_next").alias("path"), "_name")
        done = ahead.where((F.col("_name") == "#") | (F.size("_levels") == depth + 1)).select("topic", "path")
        found = done if found is None else found.unionByName(done)
        at = ahead.where((F.col("_name") != "#") & (F.size("_levels") >= depth + 1)).drop("_name")
    if found is None:
        return at.select("topic", F.lit("").alias("pattern")).limit(0)
    return found.withColumnRenamed("path", "pattern").join(valid, "pattern", "left_semi").select(
        "topic", "pattern").distinct()


def match_messages(messages: DataFrame, patterns: DataFrame, topic: str = "topic",
                   pattern: str = "pattern") -> DataFrame:
    """Each message once for each pattern that its topic fits (column ``pattern``).

    The trie is walked by different topics; a topic of a third of all messages is one
    row there, and skewed partitions of the last join are split by the engine."""
    matched = match_topics(messages, patterns, topic, pattern)
    return messages.join(matched.withColumnRenamed("topic", topic), topic)
