"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is read once on the driver (its size is that of a vocabulary)
and sent to the tasks, which need no local copy.  Each whole text is encoded
in one task; long texts go to the library in pieces that are cut only where
the splitting pattern must end a match, so the ids equal those of one call
over the whole text.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hirelens.llm.common import text_slices

#: Characters after which a long text is cut at the next safe boundary.
PIECE_CHARS = 16_384

#: A match always ends after a word character that white space follows, and
#: between ASCII letters, digits and other ASCII signs (a contraction starts
#: at its apostrophe, so a cut before the apostrophe is safe as well).
SAFE_CUT = re.compile(r"\w(?=[ \t\r\n])|[A-Za-z](?=[0-9!-/:-@\[-`{-~])|[0-9](?=[A-Za-z!-/:-@\[-`{-~])")


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoding(rank_file: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in rank_file.splitlines() if x)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_pieces(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in pieces of about ``most`` characters, cut at safe
    boundaries only; a run without any stays whole."""
    at = 0
    while len(text) - at > most:
        cut = SAFE_CUT.search(text, at + most - 1)
        if cut is None:
            break
        yield text[at:cut.end()]
        at = cut.end()
    if at < len(text) or at == 0:
        yield text[at:]


def encode_text(enc, text: str, most: int = PIECE_CHARS) -> list[int]:
    if len(text) <= most:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    for piece in safe_pieces(text, most):
        ids += enc.encode_ordinary(piece)
    return ids


def encode(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           digests: bool = False) -> DataFrame:
    """Token ids of every whole text: (id, n_tokens, ids array<long>), or with
    ``digests`` (id, n_tokens, ids_sha256, decoded_sha256), where the ids are
    decoded to raw bytes again and neither ids nor bytes leave the task.

    A null text is an empty text (no ids).  Ids of rows may be null or
    repeated; every input row gives one row.  Other columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    rows = df.select(df[id_col].alias(id_col), df[text_col].alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoding(shared.value, pattern)
        for batch in batches:
            for part, _, _ in text_slices(batch):
                counts, ids, left, right = [], [], [], []
                for text in part.column("text").to_pylist():
                    got = encode_text(enc, text or "")
                    counts.append(len(got))
                    if digests:
                        left.append(hashlib.sha256(np.asarray(got, dtype="<u4").tobytes()).hexdigest())
                        right.append(hashlib.sha256(enc.decode_bytes(got)).hexdigest())
                    else:
                        ids.append(got)
                out = [part.column(0), pa.array(counts, pa.int64())]
                if digests:
                    out += [pa.array(left, pa.string()), pa.array(right, pa.string())]
                    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                else:
                    out.append(pa.array(ids, pa.list_(pa.int64())))
                    names = [id_col, "n_tokens", "ids"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    tail = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<bigint>"
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint, {tail}")


def decode(df: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Raw bytes of every id list: (id, bytes).  Null or empty ids: no bytes.
    An id that is no rank raises ``KeyError``; a partial character stays the
    bytes that it is (no replacement signs)."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    rows = df.select(df[id_col].alias(id_col), df[ids_col].alias("ids"))
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoding(shared.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                data = [enc.decode_bytes(ids or []) for ids in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(data, pa.binary())],
                                                 names=[id_col, "bytes"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, bytes binary")
