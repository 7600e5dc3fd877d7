"""Packing by power-of-two decomposition.

A document's ids, with the end id, are cut into pieces whose lengths are the powers of two of its length in binary,
longest first, at most `longest`. Each piece is a sequence of its own and needs no padding; none crosses documents.
Equal lengths are one bucket: a sequence's id is its bucket (the length's power of two, times 2**48) and its number
there, from 0 without gaps, and rows come by bucket within each partition, so that a reader takes whole batches of one length.

Ids come from the ranks of the same byte-level vocabulary through tiktoken, which gives the ids of the tokenizers file
(tested); special strings inside texts become their id, the tokenizers library's default.

Null texts count as empty and give the end id alone. Numbers follow the tasks that made the pieces, which are written first.
Extra columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.bpe import BYTE_LEVEL, _shared, byte_characters
from helixframe.llm.common import Workspace, arrow_map, texts_of

END = 0
BUCKET = 48
_encodings: dict = {}


def encoding(content: str):
    """The tokenizers file as a tiktoken encoding; one for each Python worker."""
    key = hashlib.md5(content.encode()).hexdigest()
    if key not in _encodings:
        import tiktoken

        spec, byte = json.loads(content), {c: b for b, c in enumerate(byte_characters())}
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        # Bytes first, then each merge's product in the order of the merges: that order is the rank.
        vocab = spec["model"]["vocab"]
        order = [*byte_characters(), *dict.fromkeys("".join(m) if isinstance(m, list) else m.replace(" ", "") for m in spec["model"]["merges"])]
        ranks = {bytes(byte[c] for c in t): k for k, t in enumerate(order)}
        ids = np.array([vocab[t] for t in order], np.uint32)
        if len(ranks) != len(order):
            raise ValueError("two tokens of the vocabulary have the same bytes")
        shift = {s: len(ranks) + k for k, s in enumerate(special)}
        ids = np.concatenate((ids, np.array([*special.values()], np.uint32)))
        _encodings[key] = tiktoken.Encoding("packing", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=shift), ids, set(special)
    return _encodings[key]


def pieces(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids."""
    full = n // longest
    out = [(k * longest, longest) for k in range(full)]
    at, rest = full * longest, n % longest
    while rest:
        size = 1 << (rest.bit_length() - 1)
        out.append((at, size))
        at, rest = at + size, rest - size
    return out


def _pack(content, longest: int, with_ids: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    enc, ids_of, special = encoding(content.value)
    task, made = TaskContext.get().partitionId(), np.zeros(64, np.int64)
    for batch in batches:
        doc, start, length, crc, total, tokens = [], [], [], [], [], []
        for i, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
            ids = ids_of[enc.encode_to_numpy(text, allowed_special=special, disallowed_special=())]
            ids = np.append(ids, np.uint32(END)).astype("<u4", copy=False)
            cut = pieces(len(ids), longest)
            raw = memoryview(ids).cast("B")
            for a, n in cut:
                doc.append(i)
                start.append(a)
                length.append(n)
                crc.append(zlib.crc32(raw[4 * a : 4 * (a + n)]))
                total.append(len(ids))
            tokens.append(ids)
        out = {k: pa.array(v, pa.int64()) for k, v in (("doc_id", doc), ("start", start), ("length", length), ("ids_crc32", crc), ("doc_tokens", total))}
        power = np.array([n.bit_length() - 1 for n in length], np.int64)
        number = np.empty(len(power), np.int64)
        for k in np.unique(power):
            at = np.flatnonzero(power == k)
            number[at] = made[k] + np.arange(len(at))
            made[k] += len(at)
        out["bucket"], out["number"] = pa.array(power), pa.array(number)
        out["task"] = pa.array(np.full(len(power), task, np.int64))
        if with_ids:
            flat = np.concatenate(tokens) if tokens else np.zeros(0, "<u4")
            at = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
            out["ids"] = pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype(np.int32)))
        yield pa.RecordBatch.from_pydict(out)


def pack(docs: DataFrame, tokenizer: str, longest: int = 1024, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest piece must be a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bucket long, number long, task long" + ", ids array<int>" * with_ids
    work = Workspace(docs.sparkSession, "packing")
    made = work.write(arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), _pack, schema, _shared(docs, tokenizer), longest, with_ids), "pieces")
    # A row for each task and bucket: where the task's numbers begin in the bucket.
    sizes = made.groupBy("task", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bucket").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = work.write(sizes.select("task", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "first")
    out = made.join(first, ["task", "bucket"]).sortWithinPartitions("bucket", "task", "number")
    ident = F.shiftleft("bucket", BUCKET) + F.col("first") + F.col("number")
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", ident.alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *["ids"] * with_ids)


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences in one folder for each length; every length's rows stay spread over the tasks that made them."""
    packed.write.partitionBy("length").parquet(path)
