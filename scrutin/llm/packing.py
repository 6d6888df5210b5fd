"""Operator 13: packing by power-of-two decomposition.

A document's token ids, ended by one end id, are cut into pieces whose lengths
are powers of two: whole pieces of the longest length, then one for each set
bit of what is left, longest first.  Every piece is a sequence of its own, so
no sequence crosses documents and none is padded; pieces of one length make up
one bucket, whose sequences are numbered in a row, in a seeded order, for
batches of one shape.

Ids are those of the tokenizer file.  They are computed from its vocabulary by
the byte-pair library that is five times as fast; ``encoder`` checks that the
file is a plain byte-level vocabulary whose merges are in the order of their
ids, which makes both alike (the tests compare them), and uses the file's own
library for any other file.

Defined cases: a null or empty text is its end id alone, one sequence of one
token.  Texts in which the name of a special token occurs hold it as ordinary
text.  Repeated rows and equal ids are documents of their own; null ids are
kept.  An empty table has no sequences.  Columns beside doc_id and text are
not read.  A text is encoded as a whole, so one text's ids must fit in a task.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrutin.llm import textbytes as B
from scrutin.llm.ranks import positions

LONGEST = 2048
END_ID = 1
SEED = 0

# The vocabulary's fixed pattern of words (byte-level byte pairs, 50,257 ids).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"

_encoders: dict[str, Callable[[list[str]], list[list[int]]]] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_of() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable
    Latin-1 letters for themselves, the letters from U+0100 on for the others."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def byte_pair_ranks(spec: dict) -> dict[bytes, int] | None:
    """The vocabulary as byte strings by id if ids alone give the order of merges, else None."""
    model, pre = spec.get("model", {}), spec.get("pre_tokenizer") or {}
    plain = (model.get("type") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
             and not pre.get("add_prefix_space") and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
    if not plain:
        return None
    letters = byte_of()
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [model["vocab"].get(a + b) for a, b in merges]
    if None in ids or any(x >= y for x, y in zip(ids, ids[1:])):
        return None
    specials = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(letters[c] for c in word): i for word, i in model["vocab"].items() if word not in specials}


def encoder(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Texts to ids, without special tokens; made once in each Python worker."""
    if path not in _encoders:
        with open(path, encoding="utf-8") as f:
            ranks = byte_pair_ranks(json.load(f))
        if ranks is not None:
            import tiktoken
            fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            _encoders[path] = lambda texts: [fast.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer
            own = Tokenizer.from_file(path)
            own.encode_special_tokens = True
            _encoders[path] = lambda texts: [e.ids for e in own.encode_batch(texts, add_special_tokens=False)]
    return _encoders[path]


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """The pieces of n tokens, longest first; ``longest`` is a power of two."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def _cut(batches: Iterator[pa.RecordBatch], path: str, longest: int) -> Iterator[pa.RecordBatch]:
    encode = encoder(path)
    for batch in batches:
        for part, col in B.chunks(batch):
            ids = encode(col.to_pylist())
            cuts = [lengths(len(x) + 1, longest) for x in ids]
            n = np.array([len(c) for c in cuts])
            total = np.array([len(x) + 1 for x in ids], np.int64)
            size = np.fromiter((s for c in cuts for s in c), np.int64, n.sum())
            ends = np.cumsum(size)
            flat = np.fromiter((i for x in ids for i in (*x, END_ID)), "<u4", total.sum()).tobytes()
            offsets = pa.py_buffer(np.concatenate([[0], ends * 4]).astype(np.int64))
            binary = pa.Array.from_buffers(pa.large_binary(), len(size), [None, offsets, pa.py_buffer(flat)])
            yield pa.record_batch([
                part.column(0).take(pa.array(np.repeat(np.arange(len(ids)), n))),
                pa.array(ends - size - np.repeat(np.cumsum(total) - total, n)),
                pa.array(size), pa.array(np.repeat(total, n)), binary.cast(pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "ids"])


def pieces(documents: DataFrame, tokenizer: str | None = None, longest: int = LONGEST) -> DataFrame:
    """Every document's pieces: doc_id, start, length, doc_tokens, and the ids as
    little-endian unsigned 32-bit numbers.  ``tokenizer`` is a path that all
    executors have."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    path = tokenizer or default_tokenizer()
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(lambda batches: _cut(batches, path, longest), PIECES)


def numbered(cut: DataFrame, seed: int = SEED) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``: the buckets from the shortest
    length to the longest, in each the pieces by a seeded hash."""
    content = [c for c in ("ids", "ids_crc32") if c in cut.columns]
    rows = cut.withColumn("turn", F.xxhash64(F.lit(seed), "doc_id", "start", "doc_tokens", *content))
    ranked = positions(rows, [], ["length", "turn", "doc_id", "start"], "packed")
    return ranked.withColumns({"sequence_id": F.col("pos"), "offset": F.lit(0).cast("long")}).drop("turn", "pos", "n")


def packed(documents: DataFrame, tokenizer: str | None = None, longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """One row per sequence, with its ids."""
    return numbered(pieces(documents, tokenizer, longest), seed)


def packed_digest(documents: DataFrame) -> DataFrame:
    """The packing with each piece's checksum in place of its ids, which are
    reduced to it before the pieces are numbered."""
    cut = pieces(documents).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return numbered(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
