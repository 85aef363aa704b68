"""Token ids as Arrow files of equal-length sequences.

A shard is one Arrow IPC file whose record batches hold two fixed-size lists: ``ids`` and ``mask`` (false
where the last sequence is padded). Nothing is compressed, so a reader that maps the file gets any
sequence as a view, without a copy. Beside it stands an index file, one row for each document: its id
and its number of tokens. Shards follow each other in ascending document id.

Files are written to a folder that all executors share, under a name of the attempt, and moved to their
final name when complete: a task that is repeated replaces its own shard with the same bytes.

Defined results: NULL text is empty and gives the end id alone; repeated ids and rows stay, ordered by
id, then a hash of the text; NULL ids come first; an empty table gives no shard and no row.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir, stage
from .encoding import encoder, with_last_id
from .ragged import text_slices

#: Tokens in a sequence, and sequences in a record batch.
LENGTH, BATCH = 1024, 512
_MOST_READERS = 10_000


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Writes one shard: ids in document order, cut into sequences of ``length``."""

    def __init__(self, folder: str, name: str, id_type: pa.DataType, dtype, length: int = LENGTH):
        self.store, self.path = _folder(folder)
        self.store.create_dir(self.path, recursive=True)
        self.name, self.length, self.dtype = name, length, dtype
        self.attempt = f".{name}-{uuid.uuid4().hex}"
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.index_schema = pa.schema([("doc_id", id_type), ("n_tokens", pa.int64())])
        self.streams = [self.store.open_output_stream(f"{self.path}/{self.attempt}{end}") for end in ("", ".index")]
        self.writer = pa.ipc.new_file(self.streams[0], self.schema)
        self.index = pa.ipc.new_file(self.streams[1], self.index_schema)
        self.rest: list[np.ndarray] = []
        self.waiting = self.n_ids = self.n_docs = 0

    def add(self, doc_ids: pa.Array, flat: np.ndarray, bounds: np.ndarray) -> None:
        self.index.write_batch(pa.record_batch([doc_ids, pa.array(np.diff(bounds))], schema=self.index_schema))
        self.rest.append(flat.astype(self.dtype))
        self.waiting += len(flat)
        self.n_ids += len(flat)
        self.n_docs += len(doc_ids)
        if self.waiting >= self.length * BATCH:
            self._write(last=False)

    def _write(self, last: bool) -> None:
        flat = np.concatenate(self.rest) if self.rest else np.zeros(0, self.dtype)
        step = self.length * BATCH
        whole = len(flat) if last else len(flat) // step * step
        for at in range(0, whole, step):
            ids = flat[at:at + step]
            rows = -(-len(ids) // self.length)
            mask = np.arange(rows * self.length) < len(ids)
            ids = np.pad(ids, (0, rows * self.length - len(ids)))
            self.writer.write_batch(pa.record_batch([
                pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))
        self.rest = [flat[whole:]]
        self.waiting = len(flat) - whole

    def close(self) -> str:
        self._write(last=True)
        for writer, stream in zip((self.writer, self.index), self.streams):
            writer.close()
            stream.close()
        for end in (".index", ""):
            final = f"{self.path}/{self.name}{end}"
            if self.store.get_file_info(final).type != fs.FileType.NotFound:
                self.store.delete_file(final)
            self.store.move(f"{self.path}/{self.attempt}{end}", final)
        return self.name


class TokenFile:
    """Random access to one shard. A local file is mapped and its sequences are views into the map."""

    def __init__(self, folder: str, name: str):
        self.store, path = _folder(folder)
        self.reader = pa.ipc.open_file(self._open(f"{path}/{name}"))
        self.index = pa.ipc.open_file(self._open(f"{path}/{name}.index"))
        self.length = self.reader.schema.field("ids").type.list_size

    def _open(self, path: str):
        return pa.memory_map(path) if isinstance(self.store, fs.LocalFileSystem) else self.store.open_input_file(path)

    def _values(self, batch: int) -> np.ndarray:
        return self.reader.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, mask) of sequence ``i``; the ids are not copied."""
        batch, row = divmod(i, BATCH)
        mask = self.reader.get_batch(batch).column(1)[row].values.to_numpy(zero_copy_only=False)
        return self._values(batch)[row * self.length:(row + 1) * self.length], mask

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end`` of the shard, over sequence edges."""
        step = self.length * BATCH
        parts = [self._values(b)[max(start - b * step, 0):end - b * step] for b in range(start // step, -(-end // step))]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def documents(self) -> Iterator[tuple[pa.Array, np.ndarray]]:
        """Batches of (document ids, token counts) in file order."""
        for i in range(self.index.num_record_batches):
            batch = self.index.get_batch(i)
            yield batch.column(0), batch.column(1).to_numpy()


def write_token_files(documents: DataFrame, tokenizer: str, folder: str, end_id: int = 0, kind: str = "byte",
                      id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH) -> DataFrame:
    """Write all documents in ascending id; gives the stored manifest ``shard, name, n_docs, n_ids, start``.

    ``start`` is the number of ids in all shards before.
    """
    def run(batches):
        writer = None
        coder = encoder(tokenizer, kind)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for first, last, data, bounds in text_slices(texts):
                flat, id_bounds = with_last_id(*coder.encode(data, bounds), end_id)
                if writer is None:
                    shard = TaskContext.get().partitionId()
                    writer = ShardWriter(folder, f"shard-{shard:06d}.arrow", ids.type, coder.memo.dtype, length)
                writer.add(ids.slice(first, last - first), flat, id_bounds)
        if writer is not None:
            name = writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard]), pa.array([name]), pa.array([writer.n_docs]), pa.array([writer.n_ids])],
                ["shard", "name", "n_docs", "n_ids"])

    ordered = (documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text")))
    shards = stage(ordered.mapInArrow(run, "shard bigint, name string, n_docs bigint, n_ids bigint"))
    # One row for each shard: small enough for one window.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("bigint")))


def read_token_files(manifest: DataFrame, folder: str, id_type: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files that ``manifest`` names."""
    def run(batches):
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file, at = TokenFile(folder, name), 0
                for ids, counts in file.documents():
                    ends = at + np.cumsum(counts)
                    flat = file.ids(at, int(ends[-1])).astype("<u4")
                    cuts = np.append(0, ends - at).tolist()
                    crc = [zlib.crc32(flat[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [ids, pa.array(before + ends - counts), pa.array(counts), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
                    at = int(ends[-1])

    shards = manifest.count()
    return (manifest.select("name", "start").repartition(max(1, min(shards, _MOST_READERS)))
            .mapInArrow(run, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"))


def round_trip(documents: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0) -> DataFrame:
    """Write the documents' ids to files in ``folder`` (a new one of the shared folder) and read them back."""
    if folder is None:
        folder = f"{shared_dir(documents.sparkSession)}/tokens-{uuid.uuid4().hex}"
    manifest = write_token_files(documents, tokenizer, folder, end_id)
    return read_token_files(manifest, folder, documents.schema["doc_id"].dataType.simpleString())
