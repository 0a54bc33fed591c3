"""Token ids of whole texts in Arrow files of equal-length sequences with masks.

The corpus is ordered by id and cut into shards by ranges of ids. Each shard is one Arrow file whose
batches hold fixed-size lists: ``tokens`` (unsigned 16 bits where the vocabulary fits, else 32) and
``mask`` (false where the last sequence of a shard is padded). The buffers are stored plainly, so a
reader maps the file and takes any sequence, or the ids of any document, as a view. A second file per
shard lists its documents: id, place of the first id in the shard, number of ids.

Tasks write under a name of their own and then rename, so a repeated task replaces a file by an
equal one and no reader sees half a file.

Null texts count as empty and hold the end id alone. Rows with a null id come first. Rows with equal
ids follow each other ordered by their text, equal rows are all written. Other columns are not
written. An empty table gives no document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import small_batches, whole_text
from tidepool.llm.encoders import encoder

SEQUENCE = 2048
#: Sequences of one record batch.
BATCH = 128


def _place(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


class ShardWriter:
    """Appends ids to one file of equal-length sequences, holding one batch in memory."""

    def __init__(self, folder: str, shard: int, attempt: int, length: int, dtype: np.dtype):
        self.fs, base = _place(folder)
        self.fs.create_dir(base, recursive=True)
        self.names = [f"{base}/part-{shard:06d}.{kind}.arrow" for kind in ("tokens", "index")]
        self.parts = [f"{name}.{attempt}" for name in self.names]
        self.length, self.dtype = length, dtype
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("tokens", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sinks = [self.fs.open_output_stream(p) for p in self.parts]
        self.file = pa.ipc.new_file(self.sinks[0], self.schema)
        self.index = None
        self.held: list[np.ndarray] = []
        self.n_held = self.n_docs = self.n_tokens = 0

    def _flush(self, last: bool) -> None:
        if not self.n_held:
            return
        ids = np.concatenate(self.held)
        step = self.length * BATCH
        whole = len(ids) if last else len(ids) // step * step
        for at in range(0, whole, step):
            part = ids[at : min(at + step, whole)]
            rows = -(-len(part) // self.length)
            tokens, mask = np.zeros(rows * self.length, self.dtype), np.zeros(rows * self.length, bool)
            tokens[: len(part)], mask[: len(part)] = part, True
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (tokens, mask)]
            self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.held = [ids[whole:].copy()]
        self.n_held = len(ids) - whole

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray, end_id: int) -> None:
        """Documents one after the other: their ids, and how many each has without its end."""
        self.held.append(np.insert(ids, np.cumsum(sizes), end_id))
        sizes = sizes + 1
        self.n_held += len(self.held[-1])
        if self.n_held >= self.length * BATCH:
            self._flush(last=False)
        starts = self.n_tokens + np.cumsum(sizes) - sizes
        rows = pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), pa.array(sizes)], names=["doc_id", "start", "n_tokens"])
        if self.index is None:
            self.index = pa.ipc.new_file(self.sinks[1], rows.schema)
        self.index.write_batch(rows)
        self.n_docs += len(sizes)
        self.n_tokens += int(sizes.sum())

    def close(self) -> None:
        self._flush(last=True)
        self.file.close()
        self.index.close()
        for sink in self.sinks:
            sink.close()
        for part, name in zip(self.parts, self.names, strict=True):
            self.fs.move(part, name)


def write_token_files(docs: DataFrame, path: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", length: int = SEQUENCE) -> DataFrame:
    """Write the shards below ``folder``; return the manifest: a row per shard with its first place in the corpus."""
    spark = docs.sparkSession
    small_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    key = [F.col("doc_id"), F.xxhash64("text")]
    ordered = given.repartitionByRange(n, *key).sortWithinPartitions(*key, "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, writer = TaskContext.get(), None
        encode = encoder(path)
        for batch in batches:
            if batch.num_rows:
                writer = writer or ShardWriter(folder, task.partitionId(), task.taskAttemptId(), length, encode.dtype)
                writer.add(batch.column("doc_id"), *encode.encode(batch.column("text")), end_id)
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"shard": [task.partitionId()], "n_docs": [writer.n_docs], "n_tokens": [writer.n_tokens]})

    # one small row per shard
    shards = sorted(ordered.mapInArrow(write, "shard bigint, n_docs bigint, n_tokens bigint").collect())
    rows, start = [], 0
    for s in shards:
        rows.append((folder, s["shard"], start, s["n_docs"], s["n_tokens"]))
        start += s["n_tokens"]
    manifest = spark.createDataFrame(rows, "folder string, shard bigint, start bigint, n_docs bigint, n_tokens bigint")
    return manifest.withColumn("id_type", F.lit(kind))


class ShardReader:
    """Random access to a shard: sequences and documents as views of the mapped file where it is local."""

    def __init__(self, folder: str, shard: int):
        fs, base = _place(folder)
        tokens, index = (f"{base}/part-{shard:06d}.{kind}.arrow" for kind in ("tokens", "index"))
        local = isinstance(fs, pa.fs.LocalFileSystem)
        opened = [pa.memory_map(p) if local else fs.open_input_file(p) for p in (tokens, index)]
        self.file = pa.ipc.open_file(opened[0])
        self.index = pa.ipc.open_file(opened[1])
        self.length = self.file.schema.field("tokens").type.list_size
        self.at, self.values = -1, None  # the batch read last

    def sequence(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of sequence ``k`` of the shard."""
        batch = self.file.get_batch(k // BATCH)
        return tuple(batch.column(c)[k % BATCH].values.to_numpy(zero_copy_only=c == "tokens") for c in ("tokens", "mask"))

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the shard."""
        step, found = self.length * BATCH, []
        while n:
            if start // step != self.at:
                self.at = start // step
                self.values = self.file.get_batch(self.at).column("tokens").flatten().to_numpy(zero_copy_only=True)
            values = self.values
            found.append(values[start % step : start % step + n])
            start, n = start + len(found[-1]), n - len(found[-1])
        return found[0] if len(found) == 1 else np.concatenate(found)


def read_documents(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files alone.

    A task reads the shards of its rows and streams their index, one batch of documents at a time.
    """
    first = manifest.select("id_type").first()
    kind = first[0] if first else "bigint"
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    spread = manifest.repartition(max(1, manifest.count()), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = ShardReader(row["folder"], row["shard"])
                for k in range(shard.index.num_record_batches):
                    docs = shard.index.get_batch(k)
                    places = zip(docs.column("start").to_pylist(), docs.column("n_tokens").to_pylist(), strict=True)
                    crcs = [zlib.crc32(shard.ids(s, n).astype("<u4")) for s, n in places]
                    starts = pa.compute.add(docs.column("start"), row["start"])
                    yield pa.RecordBatch.from_arrays([docs.column("doc_id"), starts, docs.column("n_tokens"), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return spread.mapInArrow(read, schema)
