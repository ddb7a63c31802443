"""The state of marks at the end of an event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def replay(log: DataFrame) -> DataFrame:
    """Marks in effect of log (seq, op, image, label, px, py, names): a mark sets (image, label); a removal drops all
    marks of the labels it names. Two combined aggregations and a join on label; no ordered pass."""
    marks = log.where("op = 'MarkTiePoint' and image is not null and label is not null")
    last = marks.groupBy("image", "label").agg(F.max_by(F.struct("seq", "px", "py"), "seq").alias("m"))
    gone = log.where("op = 'RemoveTiePoints'").select("seq", F.explode("names").alias("label")).groupBy("label").agg(F.max("seq").alias("gone"))
    live = last.join(gone, "label", "left").where("gone is null or m.seq > gone")
    return live.select("image", "label", F.col("m.px").alias("px"), F.col("m.py").alias("py"), F.col("m.seq").alias("seq"))
