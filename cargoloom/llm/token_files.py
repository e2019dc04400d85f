"""Token ids of documents in flat binary files that training jobs map into memory.

A folder holds, per part ``p`` (a range of document ids): ``p.tokens`` (all ids, little-endian unsigned
16-bit numbers where the vocabulary fits, else 32-bit), ``p.offsets`` (one 64-bit number per document
and one more: where its ids start *in the whole folder*, then where the part ends) and ``p.documents``
(64-bit document ids). Parts are in document order, so the files laid end to end are one stream.

Tasks write part files with offsets from zero. Each part's base is the sum of the tokens of all parts
before it (one number per part reaches the driver); a second pass adds it to the offsets. Every file
is written under a name of its attempt and then renamed, so a task that runs twice leaves one
whole file. The folder must be one that all executors see, reached by ``pyarrow.fs``.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargoloom.llm.common import identified_texts, in_id_order, numbers_of, saved, sliced
from cargoloom.llm.pieces import encoder

PARTS = "part int, n_documents long, n_tokens long, wide int"
ROWS = "doc_id long, start long, n_tokens long, ids_crc32 long, part int"


def _place(folder: str):
    from pyarrow import fs

    found, path = fs.FileSystem.from_uri(folder if "://" in folder else _as_uri(folder))
    return found, path.rstrip("/")


def _as_uri(folder: str) -> str:
    return folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") else f"file://{folder}"


def _put(folder: str, name: str, chunks: Iterator[bytes]) -> None:
    """Write whole, then rename: readers and repeated attempts see a finished file or none."""
    found, path = _place(folder)
    trial = f"{path}/_{name}.{uuid.uuid4().hex}"
    with found.open_output_stream(trial) as out:
        for chunk in chunks:
            out.write(chunk)
    found.move(trial, f"{path}/{name}")


def mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """A file as an array: mapped into memory where the folder is a file system path, else read."""
    found, path = _place(folder)
    full = f"{path}/{name}"
    if found.type_name == "local":
        return np.memmap(full, kind, "r") if found.get_file_info(full).size else np.zeros(0, kind)
    with found.open_input_file(full) as source:
        return np.frombuffer(source.read(), kind)


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, style: str = "byte", end_id: int | None = 2
) -> DataFrame:
    """Encode every whole text and write the folder; the parts with their bases, as a small frame.

    Null texts are empty: a document of the end id alone. Rows without a ``doc_id`` have no place in the
    order and are left out. Repeated ids are documents of their own, side by side. Extra columns are ignored.
    """
    spark = docs.sparkSession
    found, path = _place(folder)
    found.create_dir(path, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One part is one file, so its ids go to the stream as they come; nothing is held but a batch.
        part, code = TaskContext.get().partitionId(), encoder(tokenizer_path, style)
        kind = code.kind if end_id is None or end_id < 1 << (8 * code.kind.itemsize) else np.dtype("<u4")
        ids_of, lengths, total = [], [], 0

        def chunks() -> Iterator[bytes]:
            nonlocal total
            for batch in sliced(batches):
                ids_of.append(numbers_of(batch, "doc_id").astype("<i8"))
                for ids in code.encode(batch.column(batch.schema.get_field_index("text"))):
                    whole = ids.astype(kind) if end_id is None else np.append(ids.astype(kind), kind.type(end_id))
                    lengths.append(len(whole))
                    total += len(whole)
                    yield whole.tobytes()

        _put(folder, f"{part:08d}.tokens", chunks())
        offsets = np.concatenate(([0], np.cumsum(lengths, dtype="<i8"))).astype("<i8")
        _put(folder, f"{part:08d}.local", iter([offsets.tobytes()]))
        _put(folder, f"{part:08d}.documents", iter([x.tobytes() for x in ids_of]))
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()),
                "n_documents": pa.array([len(lengths)], pa.int64()),
                "n_tokens": pa.array([total], pa.int64()),
                "wide": pa.array([kind.itemsize], pa.int32()),
            }
        )

    parts = saved(in_id_order(identified_texts(docs)).mapInArrow(write, PARTS), "token-parts")
    counts = parts.select("part", "n_documents", "n_tokens", "wide").orderBy("part").collect()
    bases = np.concatenate(([0], np.cumsum([r["n_tokens"] for r in counts], dtype=np.int64)))
    listed = spark.createDataFrame(
        [(r["part"], r["n_documents"], r["n_tokens"], r["wide"], int(bases[i])) for i, r in enumerate(counts)],
        f"{PARTS}, base long",
    )

    def rebase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                local = mapped(folder, f"{row['part']:08d}.local", "<i8")
                _put(folder, f"{row['part']:08d}.offsets", iter([(local + row["base"]).tobytes()]))
            yield batch

    return saved(listed.repartition(max(1, len(counts)), "part").mapInArrow(rebase, listed.schema), "token-bases")


def read_token_files(parts: DataFrame, folder: str) -> DataFrame:
    """Per document, from the mapped files: its id, where its ids start, how many, and their CRC-32 as 32-bit ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{row['part']:08d}"
                tokens = mapped(folder, f"{name}.tokens", f"<u{row['wide']}")
                offsets = mapped(folder, f"{name}.offsets", "<i8")
                documents = mapped(folder, f"{name}.documents", "<i8")
                at = offsets - row["base"]
                for first in range(0, len(documents), 10_000):
                    last = min(first + 10_000, len(documents))
                    checks = [
                        zlib.crc32(tokens[at[i] : at[i + 1]].astype("<u4").tobytes()) for i in range(first, last)
                    ]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(np.array(documents[first:last])),
                            "start": pa.array(np.array(offsets[first:last])),
                            "n_tokens": pa.array(np.diff(offsets[first : last + 1])),
                            "ids_crc32": pa.array(checks, pa.int64()),
                            "part": pa.array([row["part"]] * (last - first), pa.int32()),
                        }
                    )

    return parts.where(F.col("n_documents") > 0).mapInArrow(read, ROWS)


def token_slice(spark: SparkSession, parts: DataFrame, folder: str, start: int, end: int) -> np.ndarray:
    """The ids ``start`` to ``end`` of the stream, by the bases, as a training job would read them."""
    rows = parts.where((F.col("base") < end) & (F.col("base") + F.col("n_tokens") > start)).orderBy("part").collect()
    out = []
    for r in rows:
        tokens = mapped(folder, f"{r['part']:08d}.tokens", f"<u{r['wide']}")
        out.append(tokens[max(0, start - r["base"]) : max(0, end - r["base"])].astype("<u4"))
    return np.concatenate(out) if out else np.zeros(0, "<u4")
