"""Sequence packing along a space-filling curve.

Each document's tokens are hashed into a signed vector, projected to a few dimensions and squashed to a grid cell
whose Hilbert key orders the documents.  The token table is range-sorted by (key, id), and each range is cut into
sequences as one stream: neighbours on the curve share sequences and only cuts at sequence ends split documents.
The rest of a range is cut at powers of two, which need no padding.  The number of ranges follows from the tokens' bytes.

The tokens are written once to the shared folder, since range partitioning samples its input: the sample then reads
the key columns of that table instead of encoding every text twice.

Defined results: a null text is an empty one, and an empty text still has its end token.  Copies and equal keys are
ordered by id, then tokens, so a group of copies of any size spreads over ranges.  Very long texts are tokenized
whole and cut over as many sequences as they need.  Repeated rows are packed once
each.  A null id stays null and sorts first.  An empty table gives no row.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binaries, slabs, utf8, written

TOKENS = "n_tokens long, ids binary, curve_key long"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, curve_key long, ids binary"


@dataclass(frozen=True)
class Settings:
    """``end`` is appended to each document.  The grid has ``2 ** bits`` cells in each of ``dims`` dimensions."""

    tokenizer: str = "byte_bpe_50k.json"
    ranks: str = "byte_bpe_50k.tiktoken"
    size: int = 1024
    end: int = 0
    buckets: int = 256
    dims: int = 3
    bits: int = 12
    seed: int = 11
    range_bytes: int = 8 << 20  # of token ids in a range, as long as there are no more than ``most_ranges``
    most_ranges: int = 20_000


def tokenizer_path(name: str) -> str:
    """The installed file of a public tokenizer; a path is taken as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


#: Bytes that surely end a run of other than white space, and those that surely end one of white space.
_ENDS = np.zeros((2, 256), bool)
_ENDS[0, [9, 10, 11, 12, 13, 32]] = True
_ENDS[1, :128] = ~_ENDS[0, :128]
_ENDS[1, 28:32] = False


def long_runs(flat: np.ndarray, offsets: np.ndarray, size: int = 1000) -> np.ndarray:
    """Which texts may hold an unbroken run of ``2 * size`` bytes; each such run fills an aligned block of ``size``."""
    found = np.zeros(len(offsets) - 1, bool)
    blocks = flat[: len(flat) // size * size].reshape(-1, size)
    for ends in _ENDS:
        for k in np.flatnonzero(~ends[blocks].any(axis=1)).tolist():
            first, last = np.searchsorted(offsets, [k * size, (k + 1) * size - 1], side="right") - 1
            found[first : last + 1] = True
    return found


class Encoder:
    """Ids of the ``tokenizers`` file.  ``tiktoken`` gives the same ids several times faster from the same vocabulary;
    texts that spell a special token or may hold a very long unbroken run go to ``tokenizers`` itself."""

    def __init__(self, cfg: Settings):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.end = np.array([cfg.end], np.uint32)
        self.whole = Tokenizer.from_file(tokenizer_path(cfg.tokenizer))
        self.quick = None
        if cfg.ranks:
            with open(tokenizer_path(cfg.ranks), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.quick = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each followed by the end token, and their offsets."""
        parts, lengths, odd = [], np.empty(len(texts), np.int64), long_runs(*utf8(texts))
        for i, text in enumerate(texts.to_pylist()):
            if not text:
                got = self.end[:0]
            elif self.quick is None or odd[i] or "<|" in text:
                got = np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
            else:
                got = self.quick.encode_to_numpy(text)
            lengths[i] = len(got) + 1
            parts += [got, self.end]
        return np.concatenate(parts) if parts else self.end[:0], np.concatenate([[0], np.cumsum(lengths)])


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of integer coordinates (Skilling, 2004)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def token_table(vocabulary: int, cfg: Settings) -> np.ndarray:
    """Per token its signed bucket's row of the projection: summing rows projects the hashed document vector."""
    rng = np.random.default_rng(cfg.seed)
    project = rng.normal(0, 1 / np.sqrt(cfg.buckets), (cfg.buckets, cfg.dims))
    mixed = (np.arange(vocabulary, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(cfg.seed)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    sign = np.where(mixed >> np.uint64(63), 1.0, -1.0)
    return (project[(mixed % np.uint64(cfg.buckets)).astype(np.intp)] * sign[:, None]).astype(np.float32)


def curve_keys(ids: np.ndarray, offsets: np.ndarray, table: np.ndarray, cfg: Settings) -> np.ndarray:
    """Hilbert keys of the documents between ``offsets``: directions of their projections, squashed to the grid."""
    total = np.add.reduceat(table[ids], offsets[:-1], axis=0) if len(offsets) > 1 else np.zeros((0, cfg.dims), np.float32)
    norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
    unit = total / np.maximum(norm, 1e-12)
    cells = np.clip(((unit + 1) / 2 * (1 << cfg.bits)).astype(np.int64), 0, (1 << cfg.bits) - 1)
    return hilbert_key(cells, cfg.bits)


def tokenize(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """``doc_id, n_tokens, ids, curve_key``; ids are little-endian and unsigned, the end token included, of two bytes each
    where the vocabulary allows, else of four, which halves what is stored and shuffled."""

    @F.arrow_udf(TOKENS)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, table = Encoder(cfg), None
        names, kind = ["n_tokens", "ids", "curve_key"], pa.struct([("n_tokens", pa.int64()), ("ids", pa.binary()), ("curve_key", pa.int64())])
        for texts in batches:
            out = []
            for some in slabs(texts, 4 << 20):
                ids, offsets = encoder(some)
                if table is None:
                    table = token_table(max(encoder.whole.get_vocab_size(), cfg.end + 1), cfg)
                width = 2 if len(table) <= 1 << 16 else 4
                packed = binaries(ids.astype(f"<u{width}").view(np.uint8), offsets * width)
                columns = [pa.array(np.diff(offsets)), packed, pa.array(curve_keys(ids, offsets, table, cfg))]
                out.append(pa.StructArray.from_arrays(columns, names))
            yield pa.concat_arrays(out) if out else pa.array([], kind)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), encode(F.col("text")).alias("t")).select("doc_id", "t.*")


def tail(total: int, size: int) -> list[int]:
    """Sequence lengths that hold ``total`` tokens without padding: full ones, then falling powers of two."""
    rest = total % size
    return [size] * (total // size) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def cut(lengths: np.ndarray, before: int, size: int, last: bool) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Cut documents that follow ``before`` tokens of a stream: (document, start, length, sequence, offset), and the
    tokens so far.  Sequences follow each other in the stream, so ends are multiples of ``size`` until the tail."""
    pieces, at = [], before
    for k, n in enumerate(lengths.tolist()):
        start = 0
        while start < n:
            offset = at % size
            take = min(n - start, size - offset)
            pieces.append((k, start, take, at // size, offset))
            start += take
            at += take
    return pieces, at


def pack(tokens: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Pieces of the documents of ``tokenize`` in sequences along the curve, with their ids as unsigned 32-bit."""
    size = cfg.size

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 36
        at, held = 0, []  # held: pieces of the sequence that is still open

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            types = [pa.int64()] * 7 + [pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "curve_key", "ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            doc, n, key = (batch.column(c).to_pylist() for c in ("doc_id", "n_tokens", "curve_key"))
            ids = batch.column("ids")
            pieces, at = cut(np.array(n, np.int64), at, size, False)
            rows, of, data = held, -1, b""
            for k, start, length, sequence, offset in pieces:
                if k != of:
                    data = ids[k].as_buffer()
                    of, data = k, np.frombuffer(data, f"<u{len(data) // n[k]}")
                part = data[start : start + length].astype("<u4").tobytes()
                rows.append((doc[k], start, length, n[k], base + sequence, offset, key[k], part))
            open_at = base + at // size
            held = [r for r in rows if r[4] == open_at]
            if done := [r for r in rows if r[4] != open_at]:
                yield emit(done)
        if held:
            yield emit(list(split_tail(held, at % size, base + at // size)))

    total = 4 * (tokens.agg(F.sum("n_tokens")).first()[0] or 0)
    ranges = int(min(cfg.most_ranges, max(1, -(-total // cfg.range_bytes))))
    ordered = tokens.repartitionByRange(ranges, "curve_key", "doc_id").sortWithinPartitions("curve_key", "doc_id", "ids")
    return ordered.select("doc_id", "n_tokens", "curve_key", "ids").mapInArrow(stream, PIECES)


def split_tail(held: list[tuple], total: int, sequence: int) -> Iterator[tuple]:
    """Deal the pieces of an unfilled sequence out to sequences of falling powers of two."""
    ends, sequences = np.cumsum(tail(total, 1 << 62)).tolist(), 0
    for doc, start, length, n, _, offset, key, ids in held:
        done = 0
        while done < length:
            while offset + done >= ends[sequences]:
                sequences += 1
            first = ends[sequences - 1] if sequences else 0
            take = min(length - done, ends[sequences] - offset - done)
            yield doc, start + done, take, n, sequence + sequences, offset + done - first, key, ids[4 * done : 4 * (done + take)]
            done += take


def pack_documents(docs: DataFrame, cfg: Settings = Settings()) -> DataFrame:
    """Tokenize, order along the curve and pack whole documents."""
    return pack(written(tokenize(docs, cfg), "tokens"), cfg)


def digests(pieces: DataFrame) -> DataFrame:
    """One row per piece with the CRC-32 of its ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
