"""Whole corpora as token ids of a public byte-level BPE vocabulary.

Method: the tiktoken library with a local rank file; long texts are cut at
boundaries where the pre-splitting pattern must cut anyway; ids decode to raw
bytes. One Arrow batch at a time, no shuffle, one encoder per Python worker.

Defined results: null and empty texts have no ids (an empty list); strings that
look like special tokens are ordinary text; every text is encoded whole.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import cache

import pandas as pd
import regex
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirework.session import spread

#: Folder of the public vocabularies; the same on every machine of a cluster.
VOCABULARIES = "/opt/tokenizers"
#: Fixed value: the published pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Code points after which a long text is cut at the next safe boundary.
PIECE = 20_000
#: Where a match of PATTERN always ends and the next starts afresh: from
#: something to white space, and behind a letter or number when the class changes.
#: (Not behind an apostrophe, which may start a contraction.)
SAFE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])")


@cache
def encoder(path: str) -> tiktoken.Encoding:
    """The encoder of a rank file (lines of base64 token and rank), built once per process."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> list[str]:
    """``text`` cut at safe boundaries into pieces of about ``size``; their ids join to the ids of the text."""
    out, start = [], 0
    while len(text) - start > size:
        found = SAFE.search(text, start + size)
        if not found or found.start() >= len(text):
            break
        out.append(text[start : found.start()])
        start = found.start()
    out.append(text[start:])
    return out


def encode(texts: list[str | None], path: str) -> list[list[int]]:
    enc = encoder(path)
    out = []
    for text in texts:
        if not text:
            out.append([])
        elif len(text) <= PIECE:
            out.append(enc.encode_ordinary(text))
        else:
            ids: list[int] = []
            for piece in pieces(text):
                ids += enc.encode_ordinary(piece)
            out.append(ids)
    return out


def vocabulary(name: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> str:
    return os.path.join(folder, f"{name}.tiktoken")


def token_ids(text: Column | str, path: str | None = None) -> Column:
    """array<int>: the ids of a text column."""
    file = path or vocabulary()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(encode(batch.tolist(), file), index=batch.index)

    return F.pandas_udf(run, "array<int>")(text)


def token_count(text: Column | str, path: str | None = None) -> Column:
    """int: how many ids a text has; the ids themselves stay in the worker."""
    file = path or vocabulary()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([len(x) for x in encode(batch.tolist(), file)], index=batch.index, dtype="int32")

    return F.pandas_udf(run, "int")(text)


def decoded(ids: Column | str, path: str | None = None) -> Column:
    """binary: the raw bytes of the ids, whether or not they are whole characters; null for null."""
    file = path or vocabulary()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(file)
        for batch in batches:
            yield pd.Series([None if x is None else enc.decode_bytes([int(i) for i in x]) for x in batch], index=batch.index)

    return F.pandas_udf(run, "binary")(ids)


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) of every document."""
    return spread(docs.select("doc_id", "text")).select("doc_id", token_ids("text", path).alias("ids"))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_ids, n_bytes, same): whether decoding the ids gives back the bytes of the text."""
    ids = spread(docs.select("doc_id", "text")).select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("_bytes"), token_ids("text", path).alias("ids"))
    back = ids.select("doc_id", "_bytes", F.size("ids").alias("n_ids"), decoded("ids", path).alias("_back"))
    return back.select("doc_id", "n_ids", F.octet_length("_bytes").alias("n_bytes"), (F.col("_bytes") == F.col("_back")).alias("same"))
