import random
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from wafertide.llm import packing

from .helpers import AWKWARD, frame, prose


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_path("byte_bpe_50k.json"))
    return [t.encode(x or "", add_special_tokens=False).ids + [0] for x in texts]


def checked(rows, pieces, size=1024):
    """Every id of every document once, sequences gapless and full but for powers of two at the ends of ranges."""
    want = sorted(((i if i is not None else -1, tuple(ids)) for (i, _), ids in zip(rows, whole([t for _, t in rows]))))
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= size and at & (at - 1) == 0
    spare = defaultdict(list)
    for i, ids in want:
        spare[i].append(ids)
    got = defaultdict(list)
    for p in pieces:
        got[p.doc_id if p.doc_id is not None else -1].append((p.start, p.length, p.ids_crc32, p.doc_tokens))
    for i, lists in spare.items():
        assert sum(n for _, n, _, _ in got[i]) == sum(map(len, lists))
        if len(lists) > 1:
            continue
        at = 0
        for start, length, crc, total in sorted(got[i]):
            assert start == at and total == len(lists[0])
            assert crc == zlib.crc32(np.array(lists[0][start : start + length], "<u4").tobytes())
            at += length


def test_pieces_cover_documents(spark):
    rng = random.Random(3)
    rows = [(100 + i, prose(rng, rng.randrange(1, 1500))) for i in range(60)] + AWKWARD
    rows += [(300, "an <|endoftext|> in a text <|startoftext|>"), (301, "tab\tand  two   spaces \n\n x"), (302, "z " * 3000)]
    docs = frame(spark, rows).withColumn("offset", F.lit("clash")).withColumn("ids", F.lit(1))
    checked(rows, packing.digests(packing.pack_documents(docs)).collect())


def test_empty_and_single(spark):
    assert packing.digests(packing.pack_documents(frame(spark, []))).count() == 0
    (one,) = packing.digests(packing.pack_documents(frame(spark, [(5, None)]))).collect()
    assert (one.doc_id, one.start, one.length, one.doc_tokens, one.offset) == (5, 0, 1, 1, 0)
    assert one.ids_crc32 == zlib.crc32(bytes(4))


def test_hilbert_neighbours_differ_in_one_step():
    bits, dims = 3, 3
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    key = packing.hilbert_key(grid, bits)
    assert sorted(key) == list(range(1 << bits * dims))
    walk = grid[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_encoders_agree():
    import pyarrow as pa

    encoder, rng = packing.Encoder(packing.Settings()), random.Random(4)
    alphabet = "ab cZ'sé漢字𝄞\n\t\r 09_-.,!?<|>ßñ  ́ᄀÅⅧ½٣\x00\x85​"
    more = "aeinst  hrl.,\n\t'ABC012é漢字𝄞<|endoftext|>\x85\u3000\x1c"
    texts = [t for _, t in AWKWARD] + ["".join(rng.choice(x) for _ in range(rng.randrange(0, 80))) for x in (alphabet, alphabet, more) for _ in range(1500)]
    texts += ["<|endoftext|> a", " " * 5000, "\u3000 " * 2500, "ab" * 3000, f"x {'y' * 1999} z", "é" * 2500, f"{prose(rng, 400)}{'q' * 4000}"]
    ids, offsets = encoder(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == whole(texts)
    runs = ["a" * n for n in (1999, 2000, 2500)] + ["b c " * 4000, " " * 2000, "\u3000" * 700, None, "w" * 2000]
    found = packing.long_runs(*packing.utf8(pa.array(runs)))
    assert found[[1, 2, 4, 5, 7]].all() and not found[3]


def test_tail_has_no_padding():
    for total in (0, 1, 5, 1023, 1024, 1025, 5000):
        got = packing.tail(total, 1024)
        assert sum(got) == total and all(n & (n - 1) == 0 and n <= 1024 for n in got)


def test_neighbours_are_alike(spark):
    """Documents of two vocabularies do not interleave along the curve more than a few times."""
    rows = [(i, " ".join(["alpha beta gamma delta", "rouge vert bleu jaune"][i % 2].split() * (5 + i % 7))) for i in range(80)]
    got = packing.pack_documents(frame(spark, rows)).orderBy("sequence_id", "offset").collect()
    kinds = [p.doc_id % 2 for p in got]
    assert sum(a != b for a, b in zip(kinds, kinds[1:])) < 12


def test_many_ranges(spark):
    """Small ranges: sequences end at each range's end, and every id still lies in one piece."""
    rng = random.Random(5)
    rows = [*AWKWARD, *[(100 + i, prose(rng, rng.randrange(1, 400))) for i in range(150)]]
    cfg = packing.Settings(range_bytes=40_000)
    pieces = packing.digests(packing.pack_documents(frame(spark, rows), cfg)).collect()
    assert len({p.sequence_id >> 36 for p in pieces}) > 5
    checked(rows, pieces)
