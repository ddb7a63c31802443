"""Structured Streaming: telemetry windows, rates, watchdogs, replay of marks, deduplication. All take a stream or a batch."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """A stream of a folder's Parquet files; times without a zone become timestamps, as watermarks need."""
    raw = spark.readStream.schema(schema).parquet(folder)
    return raw.withColumns({c: F.col(c).cast("timestamp") for c, t in raw.dtypes if t == "timestamp_ntz"})


def windowed(events: DataFrame, length: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """count, sum, mean, least and most of value by type and tumbling or sliding window."""
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    g = events.withWatermark("ts", late).groupBy(w, "event_type")
    out = g.agg(F.count("*").alias("n"), F.sum("value").alias("total"), F.avg("value").alias("mean"), F.min("value").alias("low"), F.max("value").alias("high"))
    return out.select(F.col("window.start").alias("w_start"), F.col("window.end").alias("w_end"), "event_type", "n", "total", "mean", "low", "high")


def sliding_rate(events: DataFrame, keys: list[str], value: str, order: str, length: str, slide: str, late: str = "10 minutes") -> DataFrame:
    """A counter's rise per second within each sliding window, falls counting as resets. A window's values of one key
    are put in order in one row, as many as it has."""
    w = F.window("ts", length, slide)
    g = events.withWatermark("ts", late).groupBy(w, *keys).agg(F.sort_array(F.collect_list(F.struct("ts", F.col(order).alias("o"), F.col(value).cast("double").alias("v")))).alias("l"))
    rise = F.aggregate("l", F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("sum")), lambda a, x: F.struct(x["v"].alias("last"), (a["sum"] + F.when(a["last"].isNull(), 0.0).when(x["v"] < a["last"], x["v"]).otherwise(x["v"] - a["last"])).alias("sum")))["sum"]
    seconds = F.unix_timestamp("window.end") - F.unix_timestamp("window.start")
    return g.select(*keys, F.col("window.start").alias("w_start"), F.col("window.end").alias("w_end"), (rise / seconds).alias("rate"))


def sessions(events: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    g = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id")
    return g.agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("s_start"), F.col("session_window.end").alias("s_end"), "n")


def deduplicated(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def live_marks(log: DataFrame):
    """T01 on a stream of (seq, op, image, label, px, py, names): the state of each label is its marks by image.

    A removal clears the marks before it of every label in its names (without that column, of its own label). A row that
    comes late doesn't override one of a higher seq, and a mark from before a removal stays away. Emits rows (label, image,
    px, py, seq, removed) for every mark that a batch sets or removes; the last row of an image is its state."""
    import pandas as pd

    own = ["seq", "op", "image", "label", "px", "py"]
    if "names" in log.columns:
        who = F.when(F.col("op") == "RemoveTiePoints", F.col("names")).otherwise(F.array("label"))
        log = log.withColumn("label", F.explode(who)).select(*own)

    def step(key, parts, state):
        gone, marks = json.loads(state.get[0]) if state.exists else (-1, {})
        before = {i: list(m) for i, m in marks.items()}
        for p in parts:
            for r in p.itertuples():
                if r.op == "RemoveTiePoints":
                    gone = max(gone, int(r.seq))
                elif int(r.seq) > marks.get(str(r.image), [0, 0, -1])[2]:
                    marks[str(r.image)] = [float(r.px), float(r.py), int(r.seq)]
        marks = {i: m for i, m in marks.items() if m[2] > gone}
        state.update((json.dumps([gone, marks]),))
        out = [(key[0], i, *m, False) for i, m in marks.items() if before.get(i) != m] + [(key[0], i, None, None, gone, True) for i in before if i not in marks]
        yield pd.DataFrame(out, columns=["label", "image", "px", "py", "seq", "removed"]).astype({"px": "float64", "py": "float64"})

    return log.groupBy("label").applyInPandasWithState(step, "label string, image string, px double, py double, seq long, removed boolean", "marks string", "update", "NoTimeout")


def watchdog(probes: DataFrame, limit: int = 9):
    """T04 on a stream of (host, seq, busy): the idle count after each probe, and whether it has reached the limit."""
    import pandas as pd

    def step(key, parts, state):
        run = state.get[0] if state.exists else 0
        out = []
        for p in parts:
            for r in p.sort_values("seq").itertuples():
                run = 0 if r.busy else run + 1
                out.append((key[0], int(r.seq), run, run >= limit))
        state.update((run,))
        yield pd.DataFrame(out, columns=["host", "seq", "run", "kill"])

    return probes.groupBy("host").applyInPandasWithState(step, "host string, seq long, run int, kill boolean", "run int", "append", "NoTimeout")


def phase_changes(phases: DataFrame) -> DataFrame:
    """Rows (project, seq, phase) whose phase differs from the one before it in the project, in order of seq. On a stream
    the last phase is kept in state: a batch's rows are put in order, and rows older than that state are left out."""
    from pyspark.sql import Window

    if phases.isStreaming:
        import pandas as pd

        def step(key, parts, state):
            last, phase = state.get if state.exists else (None, None)
            out = []
            for r in pd.concat(list(parts)).sort_values("seq").itertuples():
                if last is None or int(r.seq) > last:
                    if phase != r.phase:
                        out.append((key[0], int(r.seq), r.phase))
                    last, phase = int(r.seq), r.phase
            state.update((last, phase))
            yield pd.DataFrame(out, columns=["project", "seq", "phase"])

        kind = phases.schema["project"].dataType.simpleString()
        return phases.select("project", "seq", "phase").groupBy("project").applyInPandasWithState(step, f"project {kind}, seq long, phase string", "seq long, phase string", "append", "NoTimeout")
    before = F.lag("phase").over(Window.partitionBy("project").orderBy("seq"))
    return phases.withColumn("_b", before).where(F.col("_b").isNull() | (F.col("_b") != F.col("phase"))).drop("_b")


def gauges(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The gauges (metric, value, ts) that the last batch left at path, or the last below `before`; none: no rows."""
    from pyspark.errors import AnalysisException

    try:
        every = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "metric string, value double, ts timestamp")
    every = every if before is None else every.where(F.col("batch") < before)
    last = every.agg(F.max("batch")).first()[0]
    return every.where(F.col("batch") == last).drop("batch")


def upsert_gauges(batch: DataFrame, batch_id: int, path: str) -> None:
    """T02, for foreachBatch: the latest value of each gauge (metric, value, ts), those that the batch lacks included. Each batch writes
    a folder of its own, so a batch that runs again gives the same."""
    rows = batch.select("metric", F.col("value").cast("double").alias("value"), F.col("ts").cast("timestamp").alias("ts"))
    every = gauges(batch.sparkSession, path, batch_id).select("metric", "value", "ts").unionByName(rows)
    latest = every.groupBy("metric").agg(F.max(F.struct("ts", "value")).alias("m")).select("metric", "m.value", "m.ts")
    latest.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")
