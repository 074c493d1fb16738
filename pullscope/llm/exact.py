"""Exact deduplication by deterministic block naming.

Every text is cut into blocks of a fixed number of bytes. Distinct blocks are sorted, and each
gets its place as an integer name, so equal names mean equal blocks: there is no hash to
collide. A text is then a list of names. Round after round, adjacent names form pairs, distinct
pairs are sorted and named in turn, and the lists halve, until one name is left of each text.
Texts are equal exactly when their numbers of blocks and their last names are equal.

Scale: blocks are first collapsed within a task, so a block that a third of all rows
share reaches the sort once per task, not once per row; pairs are collapsed by a map-side
aggregate. Joins that carry a hot name back to its holders are inner joins on plain shuffles,
which AQE splits. Every round's names are written to the shared folder, as a name is only valid
within one run of the sort. The number of rounds is the binary logarithm of the longest text's
number of blocks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pullscope.llm.text import mapped, new_folder, partitions, stored

#: Bytes in a block.
BLOCK_BYTES = 4096
#: Bytes of blocks that a task remembers, so that it sends a frequent one once.
KEPT_BYTES = 32 << 20

_BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def normalise(text: str | None) -> str:
    """Null counts as empty; each run of blanks becomes one space."""
    return _BLANKS.sub(" ", text or "")


def _cut(block_bytes: int):
    """Rows of two kinds: documents with the references of their blocks, and the blocks of a
    task, each once while they are remembered. A reference is unique over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        row = block = 0
        refs: dict[bytes, int] = {}
        for batch in batches:
            if len(refs) * block_bytes > KEPT_BYTES:
                refs = {}
            first = len(refs)
            rids, shas, lists = [], [], []
            for text in batch.column("text"):
                data = normalise(text.as_py()).encode()
                shas.append(hashlib.sha256(data).hexdigest())
                rids.append(base + row)
                row += 1
                own = []
                for i in range(0, max(len(data), 1), block_bytes):
                    piece = data[i:i + block_bytes]
                    if piece not in refs:
                        refs[piece] = base + block
                        block += 1
                    own.append(refs[piece])
                lists.append(own)
            new = list(islice(refs.items(), first, None))
            n, m = len(rids), len(new)
            yield pa.RecordBatch.from_arrays([
                pa.array(rids + [None] * m, pa.int64()),
                pa.concat_arrays([batch.column("doc_id").cast(pa.int64()), pa.nulls(m, pa.int64())]),
                pa.array(shas + [None] * m, pa.string()),
                pa.array(lists + [None] * m, pa.list_(pa.int64())),
                pa.array([None] * n + [ref for _, ref in new], pa.int64()),
                pa.array([None] * n + [piece for piece, _ in new], pa.binary()),
            ], names=["rid", "doc_id", "text_sha256", "refs", "ref", "block"])

    return run


def _name_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the distinct blocks of a sorted partition; partitions have disjoint numbers."""
    name, last = (TaskContext.get().partitionId() << 40) - 1, None
    for batch in batches:
        names = []
        for piece in batch.column("block").to_pylist():
            if piece != last:
                name, last = name + 1, piece
            names.append(name)
        yield pa.RecordBatch.from_arrays([batch.column("ref"), pa.array(names, pa.int64())], names=["ref", "name"])


def identities(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: rid (a row reference), doc_id, text_sha256 (of the normalised
    text), n_blocks and name. Two texts are equal exactly when (n_blocks, name) are equal.

    Null texts count as empty; an empty text is one empty block. Repeated rows and null ids are
    rows like others. Columns other than doc_id and text are not looked at. An empty table gives
    an empty table.
    """
    spark = docs.sparkSession
    folder, n = new_folder(spark, "exact"), partitions(spark)
    cut = stored(mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _cut(block_bytes),
                        "rid long, doc_id long, text_sha256 string, refs array<long>, ref long, block binary"),
                 f"{folder}/cut")
    rows = cut.where("rid is not null")
    sorted_blocks = (cut.where("ref is not null").select("ref", "block")
                     .repartition(n, "block").sortWithinPartitions("block"))
    names = stored(mapped(sorted_blocks, _name_blocks, "ref long, name long"), f"{folder}/names-0")
    held = rows.select("rid", F.size("refs").alias("n"), F.posexplode("refs").alias("pos", "ref"))
    level = stored(held.join(names, "ref").select("rid", "n", "pos", "name"), f"{folder}/level-0")
    done = [level.where("n = 1").select("rid", "name")]
    longest, k = level.agg(F.max("n")).first()[0] or 0, 0
    while longest > 1:
        k, longest = k + 1, (longest + 1) // 2
        pairs = (level.where("n > 1").groupBy("rid", F.expr("pos div 2").cast("int").alias("pos"))
                 .agg(F.first(((F.col("n") + 1) / 2).cast("int")).alias("n"), F.min_by("name", "pos").alias("left"),
                      F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("right"))
                 .withColumn("right", F.coalesce("right", F.lit(-1))))
        pairs = stored(pairs, f"{folder}/pairs-{k}")
        names = stored(pairs.select("left", "right").distinct().repartition(n, "left", "right")
                       .sortWithinPartitions("left", "right")
                       .withColumn("name", F.monotonically_increasing_id()), f"{folder}/names-{k}")
        level = stored(pairs.join(names, ["left", "right"]).select("rid", "n", "pos", "name"), f"{folder}/level-{k}")
        done.append(level.where("n = 1").select("rid", "name"))
    last = done[0]
    for more in done[1:]:
        last = last.union(more)
    return rows.select("rid", "doc_id", "text_sha256", F.size("refs").alias("n_blocks")).join(last, "rid")


def exact_dedup(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest doc_id stays (a null id comes last; of rows that
    also share the id, the one read first), so exactly one row of a group has ``kept``.
    """
    folder = new_folder(docs.sparkSession, "exact-groups")
    named = stored(identities(docs, block_bytes), f"{folder}/named")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("rid").alias("rid"))
    groups = (named.groupBy("n_blocks", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
              .select("n_blocks", "name", F.col("first.id").alias("keep_id"), F.col("first.rid").alias("keep_rid"),
                      "group_size"))
    groups = stored(groups, f"{folder}/groups")  # a plain table, so that the join below can split a hot group
    return (named.join(groups, ["n_blocks", "name"])
            .select("doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"),
                    "text_sha256"))
