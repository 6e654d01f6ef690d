"""Byte-level BPE encoding and decoding.

The tokenizers library runs over Arrow batches. Its vocabulary works on
printable stand-ins for the 256 byte values; the merges are rebuilt from the
rank file (every way to split a token into two tokens, ranked as the joined
token). Decoding reverses the byte table: token bytes are joined first and
decoded as UTF-8 after that, so characters split over several tokens come back
whole, and a piece cut inside a character shows replacement characters.
"""

from __future__ import annotations

import base64
import hashlib
import os
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelmart.llm._common import pieces, text_of

#: Texts are handed to the tokenizer in runs of about this many characters.
RUN_CHARS = 1 << 18
#: Matches of the pattern whose ids a worker keeps, and the longest that it keeps.
SEEN, SEEN_CHARS = 1 << 19, 64


def byte_table() -> dict[int, str]:
    """The printable stand-in of each byte value (byte-level BPE's mapping)."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


class ByteBPE:
    """A tokenizer from a rank file and the pattern that splits text first."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        shown = byte_table()
        show = lambda raw: "".join(shown[b] for b in raw)
        by_rank = sorted(ranks, key=ranks.get)
        merges = [(show(t[:i]), show(t[i:])) for t in by_rank
                  for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.tokenizer = Tokenizer(models.BPE(
            vocab={show(t): r for t, r in ranks.items()}, merges=merges))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # for single matches, which need no splitting
        self.word_tokenizer = Tokenizer(self.tokenizer.model)
        self.word_tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern = regex.compile(pattern)
        self.seen: dict[str, bytes | bool] = {}
        # all tokens' bytes in one array, with where each begins
        self.size = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
        self.size[list(ranks.values())] = [len(t) for t in ranks]
        self.known = np.zeros(len(self.size), bool)
        self.known[list(ranks.values())] = True
        self.start = np.cumsum(self.size) - self.size
        self.table = np.frombuffer(b"".join(by_rank), np.uint8)

    def encode(self, texts: list[str]) -> list:
        """Encodings (``ids`` and character ``offsets``) of the texts."""
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def raw_ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers.

        A text with a character that this Python's Unicode tables leave
        unassigned goes to the tokenizer whole: tables of different age may
        split it differently.
        """
        if len(self.seen) > SEEN:
            self.seen.clear()
        pack = lambda e: np.asarray(e.ids, "<u4").tobytes()
        split = [self.pattern.findall(t) for t in texts]
        known = [list(map(self.seen.get, words)) for words in split]
        new = list({w for words, parts in zip(split, known) if None in parts for w, x in zip(words, parts) if x is None})
        for w, e in zip(new, self.word_tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            odd = not w.isascii() and any(unicodedata.category(c) == "Cn" for c in w)
            self.seen[w] = False if odd else pack(e)
        out = []
        for t, words, parts in zip(texts, split, known):
            if None in parts:
                parts = [self.seen[w] if x is None else x for w, x in zip(words, parts)]
            out.append(pack(self.tokenizer.encode_batch_fast([t], add_special_tokens=False)[0]) if False in parts
                       else b"".join(parts))
        for w in new:
            if len(w) > SEEN_CHARS:
                del self.seen[w]
        return out

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(x, "<u4").tolist() for x in self.raw_ids(texts)]

    def decode_bytes(self, ids) -> bytes:
        """The tokens' bytes, joined; an id that the vocabulary lacks raises KeyError."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        if ids.min() < 0 or ids.max() >= len(self.size) or not self.known[ids].all():
            raise KeyError("an id that the vocabulary lacks")
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.table[np.arange(ends[-1]) + np.repeat(self.start[ids] - (ends - size), size)].tobytes()

    def decode(self, ids) -> str:
        """The text; bytes that are no whole character show as U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> ByteBPE:
    """One tokenizer per worker process."""
    return ByteBPE(read_ranks(path), pattern)


def _runs(texts: list[str]):
    """Slices of about RUN_CHARS characters, so that memory stays bounded."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= RUN_CHARS:
            yield texts[start:i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text", offsets: bool = False) -> DataFrame:
    """``id, ids`` (and ``starts, ends``: code points of each token) per row.

    Every row gives a row, a null text counts as empty and gives no ids. A
    token that holds part of a character spans that character. Special tokens
    are never added, and their strings are ordinary text.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, ids array<int>" + (", starts array<int>, ends array<int>" if offsets else "")

    def lists(rows):
        ends = np.cumsum([0] + [len(r) for r in rows])
        flat = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    def batches(it):
        bpe = load(path, pattern)
        for b in pieces(it):
            at = 0
            for run in _runs(b.column(1).to_pylist()):
                keys = b.column(0).slice(at, len(run))
                at += len(run)
                if offsets:
                    got = bpe.encode(run)
                    spans = [np.array(e.offsets, np.int32).reshape(-1, 2) for e in got]
                    cols = [lists([e.ids for e in got]), lists([s[:, 0] for s in spans]),
                            lists([s[:, 1] for s in spans])]
                else:
                    cols = [lists([np.frombuffer(x, "<u4") for x in bpe.raw_ids(run)])]
                yield pa.RecordBatch.from_arrays(
                    [keys, *cols], ["id", "ids", "starts", "ends"][:1 + len(cols)])

    return (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
            .mapInArrow(batches, schema))


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``id, raw, text`` for rows of ``id, ids``: the bytes, and their text.

    Null ids give null. An id that the vocabulary lacks raises an error.
    """
    kind = tokens.schema["id"].dataType.simpleString()

    def batches(it):
        bpe = load(path, pattern)
        for b in pieces(it):
            raw = [None if x is None else bpe.decode_bytes(x) for x in b.column(1).to_pylist()]
            text = [None if x is None else x.decode("utf-8", "replace") for x in raw]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(raw, pa.binary()), pa.array(text, pa.string())],
                ["id", "raw", "text"])

    return tokens.select("id", "ids").mapInArrow(batches, f"id {kind}, raw binary, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``) per row.

    Encodes each text and decodes its ids again in the same pass, so token
    lists need not be shuffled or stored. ``ids_sha256`` is over the ids as
    little-endian unsigned 32-bit integers. Null texts count as empty.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def batches(it):
        bpe = load(path, pattern)
        sha = lambda raw: hashlib.sha256(raw).hexdigest()
        for b in pieces(it):
            at = 0
            for run in _runs(b.column(1).to_pylist()):
                keys = b.column(0).slice(at, len(run))
                at += len(run)
                raw = bpe.raw_ids(run)
                ids = [np.frombuffer(x, "<u4") for x in raw]
                cols = {"id": keys, "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                        "ids_sha256": pa.array([sha(x) for x in raw]),
                        "decoded_sha256": pa.array([sha(bpe.decode_bytes(x)) for x in ids])}
                if with_ids:
                    cols["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.cumsum([0] + [len(x) for x in ids]), pa.int32()),
                        pa.array(np.concatenate(ids).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return (docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
            .mapInArrow(batches, schema + ", ids array<int>" * with_ids))
