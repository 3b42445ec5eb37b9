"""Where a file comes from: all files behind it, level by level, from each file's own inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rounds of joins, as many as the longest chain of inputs; data levels are fewer.
MOST_STEPS = 64


def ancestors(inputs: DataFrame, most_steps: int = MOST_STEPS) -> DataFrame:
    """(file, ancestor, steps) from direct inputs (file, input): every file behind a file, by the shortest chain.

    Each round joins only what the last one found new, and is written to the checkpoint folder; a file that leads back to
    itself is its own ancestor.  Rows with a null on either side are left out; repeated rows count once.
    """
    direct = inputs.select("file", F.col("input").alias("ancestor")).dropna().distinct().checkpoint()
    known = direct.withColumn("steps", F.lit(1))
    new = known
    for step in range(2, most_steps + 2):
        further = new.select("file", F.col("ancestor").alias("file_")).join(direct.withColumnRenamed("file", "file_"), "file_").select("file", "ancestor").distinct()
        new = further.join(known, ["file", "ancestor"], "left_anti").withColumn("steps", F.lit(step)).checkpoint()
        if new.isEmpty():
            return known
        if step > most_steps:
            break
        known = known.unionByName(new)  # each part is written once, in its round
    raise ValueError(f"chains of inputs of more than {most_steps} steps")


def lists_behind(inputs: DataFrame, most_steps: int = MOST_STEPS) -> list[DataFrame]:
    """For each number of steps a table (file, behind) of the lists of files that many steps behind, by the shortest chain.

    The rounds of ``ancestors`` with a row for each file instead of one for each pair, which takes less than half of a
    shuffle.  Only what the last round found is sent, and only from files that are inputs to files that have users for it.
    """
    direct = inputs.select("file", "input").dropna().checkpoint()
    used = direct.select(F.col("input").alias("file")).distinct().withColumn("used", F.lit(True))
    new = direct.groupBy("file").agg(F.collect_set("input").alias("behind")).join(used, "file", "left").checkpoint()
    users = new.select("file", F.explode("behind").alias("input")).join(new.select(F.col("file").alias("input")), "input", "left_semi").checkpoint()
    found = [new]
    for step in range(2, most_steps + 2):
        sending = new.where("used")
        if sending.isEmpty():
            break
        sent = users.join(sending.select(F.col("file").alias("input"), "behind"), "input").select("file", "behind")
        new = sent.repartition("file").groupBy("file").agg(F.array_distinct(F.flatten(F.collect_list("behind"))).alias("behind"))
        new = new.join(found[0].select("file", "used"), "file")
        for known in found:
            left = F.when(F.col("known").isNull(), F.col("behind")).otherwise(F.array_except("behind", "known"))
            new = new.join(known.select("file", F.col("behind").alias("known")), "file", "left").select("file", left.alias("behind"), "used")
        new = new.where(F.size("behind") > 0).checkpoint()
        if new.isEmpty():
            break
        if step > most_steps:
            raise ValueError(f"chains of inputs of more than {most_steps} steps")
        found.append(new)
    return [f.select("file", "behind") for f in found]


def input_history(inputs: DataFrame, files: DataFrame, most_steps: int = MOST_STEPS) -> DataFrame:
    """(file, history): per file the levels behind it, in order, each with its files and their hashes, as nested structs.

    ``files`` has (file, level, hash); a file behind another that is not among them has the level "unknown".  A file
    without inputs has an empty history.  A file's history is one row, as long as the number of files behind it.

    What is shuffled most, a hash for each file behind each file, goes once and as bytes, by range of the names: files
    next to each other mostly have the same files behind them, and the repeated hashes then lie side by side and compress.
    """
    pairs = reduce(DataFrame.unionByName, lists_behind(inputs, most_steps)).select("file", F.explode("behind").alias("ancestor"))
    raw = F.unhex("hash")
    known = files.select(F.col("file").alias("ancestor"), "level", F.when(F.lower(F.hex(raw)) == F.col("hash"), raw).alias("raw"), "hash")
    known = known.withColumn("hash", F.when(F.col("raw").isNull(), F.col("hash")))
    entry = F.struct(F.coalesce("level", F.lit("unknown")).alias("level"), F.col("ancestor").alias("path"), "raw", "hash")
    named = pairs.join(known, "ancestor", "left").select("file", entry.alias("entry"), F.lit(0).cast("long").alias("times"))
    # a row for each name in files, so that the histories need no join, which would shuffle them
    own = files.groupBy("file").agg(F.count("*").alias("times")).withColumn("entry", F.lit(None).cast(named.schema["entry"].dataType))
    rows = named.unionByName(own).repartitionByRange("file").groupBy("file").agg(F.collect_set("entry").alias("entries"), F.max("times").alias("times"))
    text = lambda e: F.struct(e["level"].alias("level"), e["path"].alias("path"), F.coalesce(F.lower(F.hex(e["raw"])), e["hash"]).alias("hash"))
    rows = rows.where("times > 0").select("file", "times", F.sort_array(F.transform("entries", text)).alias("entries"))
    rows = rows.withColumn("levels", F.array_distinct("entries.level"))
    whole = lambda e: F.struct(e["path"].alias("path"), F.substring_index(e["path"], "/", -1).alias("filename"), F.struct(F.lit("SHA-256").alias("algorithm"), e["hash"].alias("value")).alias("hash"))
    of = lambda level: F.struct(level.alias("level"), F.transform(F.filter("entries", lambda e: e["level"] == level), whole).alias("files"))
    rows = rows.select("file", "times", F.transform("levels", of).alias("history"))
    return rows.withColumn("times", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("file", "history")


def history_json(history: str = "history"):
    """A history as the text that files carry: an object of levels, each a list of files."""
    return F.to_json(F.map_from_entries(F.transform(history, lambda h: F.struct(h["level"], h["files"]))))


def parse_history(text: str = "input_history_json"):
    """The nested structs of such a text, levels in order; null where it is none."""
    entry = "map<string, array<struct<path: string, filename: string, hash: struct<algorithm: string, value: string>>>>"
    return F.array_sort(F.transform(F.map_entries(F.from_json(text, entry)), lambda e: F.struct(e["key"].alias("level"), e["value"].alias("files"))))


def changed_inputs(recorded: DataFrame, files: DataFrame) -> DataFrame:
    """(file, level, path, recorded, current) of recorded inputs (file, history) whose file is gone or has another hash now."""
    rows = recorded.select("file", F.explode("history").alias("h")).select("file", "h.level", F.explode("h.files").alias("f"))
    rows = rows.select("file", "level", F.col("f.path").alias("path"), F.col("f.hash.value").alias("recorded"))
    now = files.select(F.col("file").alias("path"), F.col("hash").alias("current"))
    return rows.join(now, "path", "left").where(~F.col("recorded").eqNullSafe(F.col("current"))).select("file", "level", "path", "recorded", "current")


def roots(inputs: DataFrame, most_steps: int = MOST_STEPS) -> DataFrame:
    """(file, root, steps): the ancestors of each file that have no inputs of their own, the farthest first."""
    behind = ancestors(inputs, most_steps)
    made = inputs.select(F.col("file").alias("ancestor")).dropna().distinct()
    out = behind.join(made, "ancestor", "left_anti").select("file", F.col("ancestor").alias("root"), "steps")
    return out.withColumn("place", F.row_number().over(Window.partitionBy("file").orderBy(F.desc("steps"), "root")))
