"""Incremental collection as Structured Streaming: T1-T8.

The reference kept JSON checkpoint files of done keys and rows, saved every N units, with a
retry pass for error keys. Here:

* T1 resume      -- the stream's checkpoint records which landed files were processed;
                    a restart (or ``availableNow`` rerun) only reads new files, and a batch that
                    died is replayed and replaces its own output.
* T2/T6 pacing   -- ``maxFilesPerTrigger`` bounds each micro-batch.
* T3 dead letters -- malformed lines, failed pages and elements without an id are written by the
                    same batch function as the rows; ``retry_dead_letters`` is the one retry pass.
* T4 exactly-once rows -- keyed state in a RocksDB state store: per id the copy that was delivered
                    first (file time, file, hash of the line). A batch writes the ids it met first;
                    each batch overwrites its own ``batch=<id>`` directory, so a replayed batch
                    replaces rather than duplicates.
* T5 progress    -- files, lines, rows and dead letters per micro-batch, one small table folder per
                    batch (kept for all batches).
* T7 labelling   -- stream-static join with the user dimension (stored once per run) + title class.
* T8 volume      -- partial daily counts per micro-batch, summed on read.

No watermark is used: nothing is dropped however late it lands. The state holds a few words per id, file
and dead letter (never a row's payload) and lives on the executors' disks with changelog checkpoints, so
a batch costs its own lines, however many ids were delivered before.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pullscope.functions.scalars import classify_title, rate_per_hour, to_utc_ts
from pullscope.operators.labels import label_author, source_of
from pullscope.plans.collect import retry_pull_requests
from pullscope.schemas import PR_PAYLOAD_DDL
from pullscope.sources.payloads import pull_requests_from_json
from pullscope.sources.tables import read_or_none

#: Session settings of streams that keep keyed state.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def read_landed_text(spark: SparkSession, landing_dir: str, max_files: int = 100, form: str = "text") -> DataFrame:
    """Streaming read of landed JSON lines as a ``value`` column (T2/T6 pacing); ``form`` is text, or
    parquet for lines that were landed in a table."""
    return spark.readStream.schema("value STRING").format(form).option("maxFilesPerTrigger", max_files).load(landing_dir)


def label_rows(rows: DataFrame, user_dim: DataFrame) -> DataFrame:
    """Label authors (left join with the static dimension), classify titles."""
    rows = label_author(rows, user_dim)
    return (rows.withColumn("type", classify_title("title")).withColumn("source", source_of())
            .withColumn("created_ts", to_utc_ts("created_at")))


def stored_dim(user_dim: DataFrame, out_dir: str) -> DataFrame:
    """The user dimension written once, so that micro-batches scan it instead of planning it again."""
    path = f"{out_dir}_dim"
    user_dim.write.mode("overwrite").parquet(path)
    return user_dim.sparkSession.read.schema(user_dim.schema).parquet(path)


# ---- T3 / T4: keyed state ------------------------------------------------------------------
def _parsed(value: str = "value") -> F.Column:
    return F.from_json(F.col(value), PR_PAYLOAD_DDL + ", _corrupt_record STRING",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})


def dead_kind(parsed: str = "p") -> F.Column:
    """Why a landed line gives no row: malformed, page_failed, no_id; null for a good line."""
    p = F.col(parsed)
    return (F.when(p.isNull() | p["_corrupt_record"].isNotNull(), F.lit("malformed"))
            .when(F.coalesce(p["page_failed"], F.lit(False)), F.lit("page_failed"))
            .when(p["id"].isNull(), F.lit("no_id")))


def _file() -> F.Column:
    # the metadata column is URL-encoded, paths to load are not
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def first_deliveries(lines: DataFrame) -> DataFrame:
    """T4: one row per id, per dead letter and per file that a micro-batch delivered, from keyed state.

    Exactly one of ``id``, ``line`` (a dead letter's text) and ``file`` is set. ``copy`` names the first copy of an
    id: of several the one from the earlier landed file, then by file name, then by the hash of the line, whatever
    batch or partition they are in. ``first_at`` and ``last_at`` are the times of the first and the
    latest batch that delivered the key, equal for a key that is new in this batch (a replayed batch has the
    time of its first attempt). ``lines`` counts a key's deliveries.
    """
    whole = lines.select("value", _file().alias("from"), F.col("_metadata.file_modification_time").alias("landed"),
                         _parsed().alias("p"))
    kind = dead_kind()
    null = F.lit(None).cast("string")
    own = F.struct(F.when(kind.isNull(), F.col("p.id")).alias("id"),
                   F.when(kind.isNotNull(), F.coalesce("value", F.lit(""))).alias("line"), null.alias("file"))
    of_file = F.struct(F.lit(None).cast("long").alias("id"), null.alias("line"), F.col("from").alias("file"))
    keyed = whole.select(F.struct("landed", "from", F.xxhash64("value").alias("hash")).alias("copy"),
                         F.current_timestamp().alias("at"), F.explode(F.array(own, of_file)).alias("k"))
    return (keyed.groupBy("k.id", "k.line", "k.file")
            .agg(F.min("copy").alias("copy"), F.min("at").alias("first_at"), F.max("at").alias("last_at"),
                 F.count(F.lit(1)).alias("lines")))


def _lines_of(spark: SparkSession, files: list[str], form: str, chosen: DataFrame) -> DataFrame:
    """The chosen lines (by file and hash) of a micro-batch's files; dropped before they are parsed."""
    if not files:
        return spark.createDataFrame([], "value string")
    landed = spark.read.schema("value STRING").format(form).load(files)
    return (landed.select("value", _file().alias("_from"), F.xxhash64("value").alias("_hash"))
            .join(chosen, ["_from", "_hash"], "left_semi").select("value"))


def _batch_writer(out_dir: str, user_dim: DataFrame, form: str, after_batch: Callable[[int], None] | None):
    """Rows, dead letters and progress of a batch, each replacing what an earlier attempt wrote."""

    def write(found: DataFrame, batch_id: int) -> None:
        spark, started = found.sparkSession, time.time()
        found = found.persist()  # the state is read once; a lost part is computed again from the same version
        try:
            new = found.where("first_at = last_at")
            files = {r["file"]: r["lines"] for r in new.where("file is not null").select("file", "lines").collect()}  # paced
            chosen = new.where("id is not null").select(F.col("copy.from").alias("_from"), F.col("copy.hash").alias("_hash"))
            rows, _none = pull_requests_from_json(_lines_of(spark, list(files), form, chosen))
            rows = label_rows(rows.dropDuplicates(["id"]), user_dim)  # equal lines of one file
            seen = Observation(f"rows-{batch_id}")
            rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}")
            dead = (new.where("line is not null").select(F.col("line").alias("raw"), _parsed("line").alias("p"))
                    .select(dead_kind().alias("kind"), F.col("p.repo").alias("repo"), "raw"))
            failed = Observation(f"dead-{batch_id}")
            (dead.observe(failed, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
             .parquet(f"{out_dir}_dead/batch={batch_id}"))
            done = (batch_id, len(files), sum(files.values()), int(seen.get.get("n", 0)), int(failed.get.get("n", 0)),
                    started, time.time())
            spark.createDataFrame([done], PROGRESS).coalesce(1).write.mode("overwrite").parquet(f"{out_dir}_progress/run={batch_id}")
        finally:
            found.unpersist()
        if after_batch:
            after_batch(batch_id)

    return write


PROGRESS = "batch_id long, files long, input_rows long, written_rows long, dead_rows long, started double, ended double"


def ingest_prs(spark: SparkSession, landing_dir: str, user_dim: DataFrame, out_dir: str,
               checkpoint: str, max_files: int = 100, available_now: bool = True,
               form: str = "text", after_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """T1-T5 + T7: landed PR payloads -> labelled, classified PR table with one row per id, dead letters
    (``dead_letters``) and progress (``progress_table``).

    A malformed creation time is kept (``created_ts`` is null). ``after_batch`` is called with a batch's number when it is
    written and not yet committed: what it raises stops the stream there, and a restart replays the batch."""
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    dim = stored_dim(user_dim, out_dir)
    found = first_deliveries(read_landed_text(spark, landing_dir, max_files, form))
    w = (found.writeStream.outputMode("update").foreachBatch(_batch_writer(out_dir, dim, form, after_batch))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    # every batch opens and commits every state store: as many as the cluster works on at once, however many parts a batch job's
    # shuffles have (the stream keeps the session's settings as of its start)
    spark.conf.set("spark.sql.shuffle.partitions", str(min(int(parts), state_stores(spark))))
    try:
        return w.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)


def state_stores(spark: SparkSession) -> int:
    """How many state stores the keyed state of a stream is dealt to, at most: two for each core."""
    return 2 * spark.sparkContext.defaultParallelism


def dead_letters(spark: SparkSession, out_dir: str) -> DataFrame:
    """(kind, repo, raw) of every line of ``ingest_prs`` that gave no row, once each."""
    found = read_or_none(spark, f"{out_dir}_dead", "kind string, repo string, raw string, batch int")
    found = spark.createDataFrame([], "kind string, repo string, raw string") if found is None else found
    return found.select("kind", "repo", "raw")


def retry_dead_letters(spark: SparkSession, out_dir: str, second: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The one retry pass over the repositories among the dead letters, with the lines (``value``) that
    were delivered when they were asked for again: their rows, and what fails again."""
    dead = dead_letters(spark, out_dir).where("repo is not null").select("kind", F.col("repo").alias("key"))
    return retry_pull_requests(second, dead)


def _partial_counts(out_dir: str, keys: list[str]):
    """Write a micro-batch's counts per key as ``batch=<id>``; sums over batches are the totals."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
         .write.mode("overwrite").parquet(f"{out_dir}/batch={batch_id}"))
    return write


def volume_stream(spark: SparkSession, landing_dir: str, user_dim: DataFrame, out_dir: str,
                  checkpoint: str, max_files: int = 100, form: str = "text") -> StreamingQuery:
    """Daily PR counts per source. Each batch writes its partial counts; :func:`volume_table`
    sums them, so rows count whenever they land and a replayed batch replaces its own part."""
    raw = read_landed_text(spark, landing_dir, max_files, form)
    rows = label_rows(pull_requests_from_json(raw)[0], stored_dim(user_dim, out_dir))
    days = rows.select(F.date_format("created_ts", "yyyy-MM-dd").alias("day"), "source")
    return (days.writeStream.foreachBatch(_partial_counts(out_dir, ["day", "source"]))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def volume_table(spark: SparkSession, out_dir: str) -> DataFrame:
    """Count per (day, source) over all batches (a partial aggregate)."""
    t = spark.read.parquet(out_dir)
    return t.groupBy("day", "source").agg(F.sum("count").alias("count"))


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    """A14 from the daily stream: calendar months are not fixed windows, so roll up in batch."""
    return (daily.groupBy(F.substring("day", 1, 7).alias("month"))
            .agg(F.sum(F.when(F.col("source") == "agent", F.col("count")).otherwise(0)).alias("agent"),
                 F.sum(F.when(F.col("source") == "human", F.col("count")).otherwise(0)).alias("human"),
                 F.sum("count").alias("total")))


def progress_table(spark: SparkSession, out_dir: str, total: int | None = None, phase: str = "pull_requests") -> DataFrame:
    """T5: every micro-batch that ``ingest_prs`` finished, with the lines done so far, of how many (if
    ``total`` is known), and the rate per hour since the first batch began (H25). One row per batch."""
    runs = spark.read.parquet(f"{out_dir}_progress/run=*")
    so_far = Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)  # as many rows as batches
    return (runs.withColumn("done", F.sum("input_rows").over(so_far)).withColumn("since", F.min("started").over(so_far))
            .select(F.lit(phase).alias("phase"), "batch_id", "files", "input_rows", "written_rows", "dead_rows", "done",
                    F.lit(total).cast("long").alias("total"), (F.col("ended") - F.col("started")).alias("seconds"),
                    rate_per_hour("done", F.col("ended") - F.col("since")).alias("rate_per_hour")))


def event_volume_stream(spark: SparkSession, source_glob: str, out_dir: str, checkpoint: str,
                        max_files: int = 100) -> StreamingQuery:
    """T8 over an event table read as a file stream: each event's type is classified like a
    title (H1) and counted per UTC day and class; partial counts per micro-batch.

    Works on any landing folder of Parquet files with the ``events`` schema."""
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    ev = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(source_glob)
    rows = ev.select(F.date_format(F.col("ts"), "yyyy-MM-dd").alias("day"), classify_title("event_type").alias("type"))
    return (rows.writeStream.foreachBatch(_partial_counts(out_dir, ["day", "type"]))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def event_volume_table(spark: SparkSession, out_dir: str) -> DataFrame:
    t = spark.read.parquet(out_dir)
    return t.groupBy("day", "type").agg(F.sum("count").alias("count"))
