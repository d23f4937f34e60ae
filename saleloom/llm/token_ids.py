"""Token-id output: documents as one concatenated id array with Elias-Fano coded document boundaries.

The documents are range-partitioned by id, encoded where they lie, and each task writes shard files of a bounded
number of ids. A shard file holds the ids as little-endian unsigned integers of two bytes (four if the vocabulary
needs them), then the document ends and the document ids as Elias-Fano sequences, then a footer::

    ids | ends (Elias-Fano) | doc ids (Elias-Fano) | footer: magic, n_ids, n_docs, n_null, section sizes, width, crc32

The manifest, a Parquet table that the write job returns, names the shards of the successful tasks. A task that is
repeated writes a file with a new name, so a lost executor leaves at most an unnamed file, never a half-read one.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleloom.llm.chunks import slices
from saleloom.llm.elias_fano import EliasFano
from saleloom.llm.library_ids import library_ids
from saleloom.operators.keys import running_offsets
from saleloom.operators.work import freeze, work_folder

SHARD_IDS = 2_000_000  # a shard is closed once it holds so many ids (4 MB)
READ_TASKS = 4  # read tasks for each shuffle partition at most
_FOOTER = struct.Struct("<8sQQQQQBI")
_MAGIC = b"EFTOKEN1"
_MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"
_DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"


def _file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def shard_bytes(doc_ids: list[int | None], documents: list[bytes], width: int) -> bytes:
    """One shard of documents whose ids take ``width`` bytes. Null document ids must come first; the others must not decrease."""
    known = [d for d in doc_ids if d is not None]
    ids = b"".join(documents)
    ends = EliasFano.encode(np.cumsum([len(d) // width for d in documents], dtype=np.int64)).to_bytes()
    names = EliasFano.encode(np.array(known, dtype=np.int64)).to_bytes()
    body = ids + ends + names
    sizes = (len(ids) // width, len(documents), len(documents) - len(known), len(ends), len(names), width)
    return body + _FOOTER.pack(_MAGIC, *sizes, zlib.crc32(body))


class Shard:
    """Reader of one shard: any document's ids by two selects and one ranged read."""

    def __init__(self, path: str):
        system, self.path = _file_system(path)
        self.file = system.open_input_file(self.path)
        size = self.file.size()
        magic, self.n_ids, self.n_docs, self.n_null, n_ends, n_names, self.width, self.crc = _FOOTER.unpack(
            self.file.read_at(_FOOTER.size, size - _FOOTER.size)
        )
        if magic != _MAGIC:
            raise ValueError(f"not a token shard: {path}")
        at = self.width * self.n_ids
        self.ends = EliasFano.from_bytes(self.file.read_at(n_ends, at))
        self.names = EliasFano.from_bytes(self.file.read_at(n_names, at + n_ends))

    def span(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def document(self, i: int) -> np.ndarray:
        start, end = self.span(i)
        data = self.file.read_at(self.width * (end - start), self.width * start)
        return np.frombuffer(data, dtype=f"<u{self.width}")

    def doc_id(self, i: int) -> int | None:
        return None if i < self.n_null else self.names.select(i - self.n_null)

    def batch(self, base: int) -> pa.RecordBatch:
        """All documents, checked against the stored crc32."""
        body = self.file.read_at(self.file.size() - _FOOTER.size, 0)
        if zlib.crc32(body) != self.crc:
            raise ValueError(f"damaged token shard: {self.path}")
        ends = self.ends.decode()
        starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]]) if self.n_docs else ends
        names = np.concatenate([np.zeros(self.n_null, np.int64), self.names.decode()])
        unknown = np.arange(self.n_docs) < self.n_null
        wide = np.frombuffer(body, dtype=f"<u{self.width}", count=self.n_ids).astype("<u4").tobytes()
        ids = [wide[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        columns = [pa.array(names, mask=unknown), pa.array(base + starts), pa.array(ends - starts)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])


def write_token_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                    spaces_matter: bool = True, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write the shards; returns the manifest.

    Manifest: part int, seq int, path string, n_docs long, n_ids long. The order (part, seq) is the order of the
    documents: ascending id, null ids first, equal ids by the hash of their text. Null text counts as empty (only the
    end id), repeated rows are kept, an empty table gives an empty manifest, other columns are ignored. The files are in
    the folder that ``spark.checkpoint.dir`` names.
    """
    folder = f"{work_folder(docs.sparkSession)}/saleloom/token-ids-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_ids(tokenizer, spaces_matter)
        width, end = encoder.dtype.itemsize, np.array([end_id], dtype=encoder.dtype).tobytes()
        system, root = _file_system(folder)
        system.create_dir(root)
        part, seq = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        done: list[bytes] = []
        held = 0

        def close() -> pa.RecordBatch:
            path = f"{folder}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.ids"
            with system.open_output_stream(_file_system(path)[1]) as out:
                out.write(shard_bytes(names, done, width))
            row = [[part], [seq], [path], [len(done)], [held]]
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            arrays = [pa.array(v, k) for v, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "seq", "path", "n_docs", "n_ids"])

        for batch in slices(batches):
            for name, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1).to_pylist()), strict=True):
                names.append(name)
                done.append(ids + end)
                held += len(ids) // width + 1
                if held >= shard_ids:
                    yield close()
                    seq, names, done, held = seq + 1, [], [], 0
        if done:
            yield close()

    name = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(name.alias("doc_id"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    # The partition a row came from splits a hot id over several ranges.
    placed = rows.repartitionByRange(*order, F.spark_partition_id()).sortWithinPartitions(*order)
    return freeze(placed.mapInArrow(write, _MANIFEST), "token-manifest")


def read_token_ids(manifest: DataFrame) -> DataFrame:
    """doc_id long, start long (ids of all documents before it), n_tokens long, ids binary (little-endian 32 bit)."""
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("held"))  # one row per write task
    before = running_offsets(parts, [], "part", "held", "offset").select("part", "offset")
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_ids").over(earlier), F.lit(0).cast("long"))
    shards = manifest.withColumn("within", within).join(before, "part").select(
        "path", (F.col("offset") + F.col("within")).alias("base")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield Shard(path).batch(base)

    # The manifest is tiny, so its size must not decide how many tasks read the shards.
    session = manifest.sparkSession
    tasks = max(1, min(manifest.count(), READ_TASKS * int(session.conf.get("spark.sql.shuffle.partitions"))))
    return shards.repartition(tasks, "path").mapInArrow(read, _DOCUMENTS)
