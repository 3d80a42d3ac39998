import random
import zlib

import numpy as np
import pytest

from wafertide.llm import sentencepiece as own
from wafertide.llm.packing import tokenizer_path

from .helpers import AWKWARD, frame, prose


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=tokenizer_path(own.MODEL))


def ids(pieces, text):
    units = own.split_units(text)
    return np.frombuffer(b"".join(pieces.units(units)), "<u4").tolist()


def test_ids_equal_the_library(library, tiny):
    import duckdb

    pieces, rng = own.Pieces(), random.Random(1)
    texts = [t for (t,) in duckdb.sql(f"select text from '{tiny}/documents.parquet' limit 60").fetchall()]
    alphabet = "aeinst  hrl ▁.,\n\tABC012é漢字𝄞<s>"
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 60))) for _ in range(1500)]
    texts += ["  two  ", "\n\n", "a" * 70, " " * 40, "internationalization of counterrevolutionaries", "<0x41><s></s>"]
    for t in texts:
        got = ids(pieces, t)
        assert got == library.encode(t), t
        assert pieces.decode(np.array(got, np.uint32)) == library.decode(got)


def test_long_units_equal_the_library(library):
    """Runs without spaces: cut at safe borders, and what stays long a position at a time, in linear time."""
    import time

    pieces, rng = own.Pieces(), random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    runs = ["".join(rng.choice(letters) for _ in range(3000)), "".join(rng.choice("etaoin") for _ in range(3000)), "a" * 3001, "ab" * 1500]
    runs += [" " * 5000, "-" * 777, "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(4000)), "国" * 900, "é𝄞" * 400]
    runs += ["".join(rng.choice(letters + "漢字é▁=_-") for _ in range(900)) for _ in range(20)]
    for t in runs:
        assert ids(pieces, t) == library.encode(t), t[:40]
    start = time.time()
    pieces.units(["▁" + "".join(rng.choice(letters) for _ in range(50_000)), "▁" + "汉" * 20_000])
    assert time.time() - start < 5
    some = [i for i in np.flatnonzero(pieces.reached).tolist() if i % 11 == 0]
    a, b = (np.array([rng.choice(some) for _ in range(4000)]) for _ in range(2))
    assert pieces.stay_apart(a, b).tolist() == [pieces.apart(x, y) for x, y in zip(a.tolist(), b.tolist())]


def test_bounds_change_no_result(library):
    """A small memory and few units at a time give the same ids."""
    rng = random.Random(5)
    texts = [prose(rng, 200), None, "", "x" * 500, prose(rng, 2000)] * 2
    small = own.Coder(remembered=2000, together=50)
    assert small(texts) == [np.array(library.encode(t or ""), "<u4").tobytes() for t in texts]


def test_round_trip(spark, library):
    rng = random.Random(2)
    rows = [*AWKWARD, (50, "▁ meta ▁"), (51, prose(rng, 3000)), (52, " lead"), (53, "trail ")]
    got = own.round_trip(frame(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.exact for r in got)
    by = {r.doc_id: r for r in got}
    for i, t in rows:
        if t and "\x00" not in t:
            want = np.array(library.encode(t), "<u4").tobytes()
            assert (by[i].n_ids, by[i].ids_crc32) == (len(want) // 4, zlib.crc32(want))
    assert own.round_trip(frame(spark, [])).count() == 0


def test_neighbours_equal_merging():
    pieces, rng = own.Pieces(), random.Random(3)
    some = [i for i in np.flatnonzero(pieces.reached).tolist() if i % 7 == 0]
    assert all(pieces.merged(pieces.text[i]) == [pieces.text[i]] for i in some)
    assert not any(pieces.merged(t) == [t] for t, i in pieces.id.items() if not pieces.reached[i])
    a, b = (np.array([rng.choice(some) for _ in range(20_000)]) for _ in range(2))
    b[:500] = a[:500]
    for _ in range(2):  # the second time from the table of recent answers, where it holds them
        got = pieces.stay_apart(a, b)
        assert got.tolist() == [pieces.merged(pieces.text[x] + pieces.text[y]) == [pieces.text[x], pieces.text[y]] for x, y in zip(a, b)]
