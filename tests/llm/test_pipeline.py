import random
import re

import pytest

from wafertide.llm import pii

from .helpers import frame, prose
from .test_packing import checked
from .test_pii import plain_spans
from .test_simhash import plain_components

pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_against_plain_python(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(60, 300)), "en", f"s{i % 4}") for i in range(40)]
    rows += [(100 + i, rows[i][1], "en", "s0") for i in range(5)] + [(200, "too short", "en", "s1"), (201, None, None, None)]
    rows += [(202, prose(rng, 70) + " mail me@x.example.org", "en", "s2"), (203, "1 2 3 4 " * 30, "en", "s3")]
    frame(spark, [(*r, 0) for r in rows]).write.parquet(str(tmp_path / "documents.parquet"))
    want = [(i, t) for i, t, *_ in rows if t and len(t.split()) >= 50 and i != 203]
    firsts = {c for _, _, c in plain_components(want)}
    want = [(i, pii.masked(t, [dict(zip(("start", "kind", "end"), s)) for s in plain_spans(t)])) for i, t in want if i in firsts]
    assert not any(re.search("@", t) for _, t in want)
    got = pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in got} == {i for i, _ in want}
    checked(want, got)


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "language_id", "near_dedup", "personal_data", "packing"]
