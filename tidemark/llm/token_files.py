"""Token files: flat unsigned integers with 64-bit document offsets, read through a memory map.

A corpus is a folder of shards in ascending document order. ``shard-N.bin`` holds the ids of its
documents one after the other, ``shard-N.idx`` the 64-bit offsets of the documents within the
shard (one more than documents), ``shard-N.doc`` their ids (64-bit; the smallest value stands for
null). ``manifest.json`` lists the shards with the number of ids before each, which is a prefix
sum over the shards' totals, so no task needs to know what another one wrote.
"""

from __future__ import annotations

import json
import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import file_system, qualified, slices, stored, table
from tidemark.llm.tokens import TOKENIZER, crc32_of_ids, encoder
from tidemark.session import new_folder

#: A shard is written for about so many bytes of text.
SHARD_BYTES = 24 << 20
#: Texts are encoded in slices of about so many bytes; the more of them, the fewer of their words differ.
ENCODE_BYTES = 4 << 20
NULL_ID = -(1 << 63)
END_ID = 1


def write_token_files(docs: DataFrame, folder: str, end_id: int = END_ID, tokenizer: str = TOKENIZER) -> dict:
    """Write the ids of all documents and return the manifest.

    Texts are dealt to shards by ranges of ``doc_id`` and encoded where their shard is written;
    documents with the same id follow each other in the order of their texts, null ids come first,
    null texts have the end id alone. A shard is
    written under a name of its own and then renamed, so repeated attempts of a task leave the
    same file. An empty table has no shards.
    """
    width, folder = encoder(tokenizer).width, qualified(docs.sparkSession, folder)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = max(1, math.ceil((source.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / SHARD_BYTES))
    ordered = source.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (files, root) = encoder(tokenizer), file_system(folder)
        end = own.one(end_id)
        name = f"shard-{TaskContext.get().partitionId():06d}"
        at = f"{root}/.{name}-{uuid.uuid4().hex}"
        ends, doc_ids, out = [0], [], None
        for batch in slices(batches, "text", ENCODE_BYTES):
            out = out or files.open_output_stream(f"{at}.bin")
            doc_ids += [NULL_ID if i is None else i for i in batch.column("doc_id").to_pylist()]
            for ids in own.encode(batch.column("text")):
                out.write(ids + end)
                ends.append(ends[-1] + len(ids) // width + 1)
        if out is None:
            return
        out.close()
        for suffix, values in (("idx", ends), ("doc", doc_ids)):
            with files.open_output_stream(f"{at}.{suffix}") as f:
                f.write(np.array(values, "<i8").tobytes())
        for suffix in ("bin", "idx", "doc"):
            files.move(f"{at}.{suffix}", f"{root}/{name}.{suffix}")
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([len(doc_ids)], pa.int64()), pa.array([ends[-1]], pa.int64())],
            ["name", "n_docs", "n_tokens"],
        )

    files, root = file_system(folder)
    files.create_dir(root, recursive=True)
    wrote = ordered.mapInArrow(write, "name string, n_docs long, n_tokens long")
    found = sorted(stored(wrote, "shards").collect())  # one row for each shard
    bases = [0, *accumulate(r.n_tokens for r in found)]
    manifest = {"width": width, "shards": [{**r.asDict(), "base": b} for r, b in zip(found, bases)]}
    with files.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of a folder of token files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before. Files on a local or mounted disk are mapped
    where they are; from other stores a task first copies its shard to its own disk.
    """
    folder = qualified(spark, folder)
    files, root = file_system(folder)
    with files.open_input_stream(f"{root}/manifest.json") as f:
        manifest = json.loads(f.read())
    width = manifest["width"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = file_system(folder)
        for batch in batches:
            for shard in batch.to_pylist():
                with tempfile.TemporaryDirectory() as own:
                    place = root
                    if not isinstance(files, fs.LocalFileSystem):
                        place = own
                        for suffix in ("bin", "idx", "doc"):
                            name = f"{shard['name']}.{suffix}"
                            fs.copy_files(f"{root}/{name}", os.path.join(own, name), source_filesystem=files)
                    at = os.path.join(place, shard["name"])
                    ids = np.memmap(f"{at}.bin", f"<u{width}", mode="r")
                    ends = np.memmap(f"{at}.idx", "<i8", mode="r")
                    docs = np.memmap(f"{at}.doc", "<i8", mode="r")
                    for low in range(0, len(docs), 4096):
                        cut = ends[low : low + 4097]
                        crc = [crc32_of_ids(ids[a:b].tobytes(), width) for a, b in zip(cut[:-1], cut[1:])]
                        own_ids = np.array(docs[low : low + 4096])
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(own_ids, mask=own_ids == NULL_ID),
                                pa.array(shard["base"] + np.array(cut[:-1])),
                                pa.array(np.diff(cut)),
                                pa.array(crc, pa.int64()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    kinds = "name string, n_docs long, n_tokens long, base long"
    rows = [(s["name"], s["n_docs"], s["n_tokens"], s["base"]) for s in manifest["shards"]]
    shards = spark.createDataFrame(rows, kinds).repartition(max(1, len(rows)))
    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, written as token files and read back from them."""
    folder = new_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder)
    return read_token_files(spark, folder)
