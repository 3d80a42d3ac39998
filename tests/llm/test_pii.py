import hashlib
import random
import re

from pyspark.sql import functions as F

from wafertide.llm import pii

from .helpers import AWKWARD, frame, prose

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            good = [
                True,
                all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                14 <= len(digits) <= 19 and sum(n - 9 if n > 9 else n for n in twice) % 10 == 0,
                10 <= len(digits) <= 15,
            ][kind]
            if good:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def shown(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for alphabet in ("a.@-1é ", "12.5 ", "0123456789 -", "+(1) 23-.4", "+12 a@b.c-3"):
        for _ in range(4000):
            t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40)))
            assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("x 4111 1111 1111 1111 y")[0][1] == 2
    long = "1" * 200_000 + "a" * 200_000 + "@" * 5_000 + "1.x" * 50_000
    assert pii.base_spans(long) == []


def corpus(rng):
    rows = list(AWKWARD)
    for i in range(12):
        rows.append((100 + i, f"{prose(rng, 30)} contact: user{i}@mail.example.org {prose(rng, 9)}"))
    rows += [(200 + i, f"{prose(rng, 8)} contact: agent-{i}77x {prose(rng, 5)} see also: words here") for i in range(2)]
    rows += [(300 + i, f"{prose(rng, 8)} total: {1000000 + i} {prose(rng, 5)}") for i in range(9)]
    rows += [(400, 'é contact: "tom@x.org" and note: a12345b'), (401, "card 4111-1111-1111-1111, ip 10.0.0.256 or 10.0.0.25")]
    return rows


def test_patterns_find_unseen_identifiers(spark):
    rows = corpus(random.Random(2))
    docs = frame(spark, rows).withColumns({"row": F.lit("clash"), "spans": F.lit(1), "found": F.lit(2)})
    got = {}
    for r in pii.find(docs).collect():
        got.setdefault(r.doc_id, r)
    for i, t in rows:
        base = plain_spans(t)
        r = got[i]
        assert r.base_sha256 == hashlib.sha256(shown(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        if i in (200, 201):
            at = t.index("agent-")
            assert r.spans == f"id:{at}:{at + 10}"
        else:
            assert r.spans == shown(base), t
    assert pii.find(frame(spark, [])).count() == 0


def test_redaction(spark):
    rows = corpus(random.Random(3))
    docs = frame(spark, rows).withColumn("row", F.lit("clash"))
    out = pii.redact(docs)
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows)
    assert "contact: [ID] " in got[200].text and "contact: [EMAIL] " in got[100].text
    assert got[401].text == "card [CARD], ip 10.0.0.256 or [IP]" and got[401].n_chars == len(got[401].text)
    assert got[300].text == dict(rows)[300] and got[1].text is None


def test_masking_overlaps():
    spans = [{"start": 2, "kind": 2, "end": 6}, {"start": 4, "kind": 3, "end": 9}, {"start": 9, "kind": 0, "end": 10}]
    assert pii.masked("ab345678901", spans) == "ab[CARD][EMAIL]1"


def graph(spark, rows):
    return spark.createDataFrame(rows, "pattern string, instance string, n long, level int")


def test_rounds_reach_the_fixpoint(spark):
    rows = [("P1", f"s{i}", 1, pii.SEED) for i in range(85)]
    rows += [(p, f"i{i}", 1, pii.IDENTIFIER) for p in ("P1", "P2") for i in range(15)] + [("P2", "word", 1, pii.PLAIN)]
    assert {r.pattern for r in pii.settled(graph(spark, rows)).collect()} == {"P1", "P2"}
    # each pattern of the chain shares its instances with the next
    chain = [("C0", f"s{i}", 100, pii.SEED) for i in range(5)]
    chain += [(f"C{k}", f"{k + d}-{i}", 1 if d else 1000, pii.IDENTIFIER) for k in range(9) for d in (0, 1) if k + d for i in range(5)]
    got = {r.pattern for r in pii.settled(graph(spark, chain)).collect()}
    assert got == {f"C{k}" for k in range(9)}
    assert pii.settled(graph(spark, [])).count() == 0


def test_identifiers_without_marks(spark):
    rng = random.Random(4)
    forms = {
        "my ssn is {}": "123-45-6789", "passport number {}": "AB123456", "account no. {}": "8837261", "id #{}": "A1234567",
        "password='{}'": "hunter22x", "key:\n  {}": "ab12cd34", "token => {}": "zz91qq", "iban: {}": "DE89 3704 0044 0532 0130 00",
        "pin: {}": "4821", "write {} for details": "x-7711",
    }
    rows, spans = [], {}
    for k, (form, value) in enumerate(forms.items()):
        words = prose(rng, 6)
        for i in range(24):
            rows.append((1000 * k + i, f"{prose(rng, 5)} {form.format(f'user{i}@mail.example.org')} {prose(rng, 3)}"))
        text = f"{words} {form.format(value)} {words}"
        rows.append((1000 * k + 500, text))
        spans[1000 * k + 500] = f"id:{text.index(value)}:{text.index(value) + len(value)}"
        rows += [(1000 * k + 600 + i, f"the year {2000 + i} and plain words number {i}") for i in range(6)]
    got = {r.doc_id: r.spans for r in pii.find(frame(spark, rows)).collect()}
    assert {i: got[i] for i in spans} == spans
    assert not [i for i, s in got.items() if "id:" in s and i not in spans]


def test_plain_words_count_against_a_pattern(spark):
    """Every pattern's total equals a plain count, and a common word before an identifier is no pattern."""
    rng = random.Random(5)
    rows = [(i, f"{prose(rng, 4)} send to user{i}@mail.example.org now") for i in range(9)]
    rows += [(50 + i, f"words go to {w} now and to {w} again") for i, w in enumerate(["home"] * 9)] + [(99, "go to a1234567 now")]
    docs = frame(spark, rows)
    got = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert got[99] == ""
    wanted = spark.createDataFrame([("to _",), ("send to _",), ("_ now",), ("absent _",)], "pattern string")
    assert {r.pattern: r.total for r in pii.totals(docs, wanted).collect()} == {"to _": 28, "send to _": 9, "_ now": 19}


WORD = re.compile(r"""[^ \t\n\x0b\x0c\r:=,;<>"'#$()*`{}\[\]]+[:=]*|[:=]+""")


def plain_words(text, cfg):
    """(start, end, level, form) of all words, one at a time; forms end with their last bytes."""
    out, at = [], 0
    for s, e, level in [*pii.merged(text, pii.base_spans(text)), (len(text), len(text), None)]:
        out += [(at + m.start(), at + m.end(), None, m[0]) for m in WORD.finditer(text[at:s])]
        if s < e:
            out.append((s, e, level, re.sub(r"""[ \t\n\x0b\x0c\r:=,;<>"'#$()*`{}\[\]]""", "_", text[s:e])))
        at = e
    form = lambda w: re.sub("[0-9]", "0", re.sub("[A-Z]", lambda m: m[0].lower(), w)).encode()[-cfg.word_length :].decode("utf-8", "ignore")
    return [(s, e, level, form(w)) for s, e, level, w in out]


def contexts(forms, i, cfg):
    left, right = forms[max(0, i - cfg.words) : i], forms[i + 1 : i + 1 + cfg.words]
    return [" ".join(left[-k:]) + " _" for k in range(1, len(left) + 1)] + ["_ " + " ".join(right[:k]) for k in range(1, len(right) + 1)]


def plain_learn(texts, cfg):
    """Bootstrapping with dictionaries: accepted patterns and the total of each pattern."""
    edges, totals = {}, {}
    for text in texts:
        words = plain_words(text or "", cfg)
        forms = [w[3] for w in words]
        for i, (s, e, level, _) in enumerate(words):
            value = text[s:e]
            if level is None:
                if value.endswith("=") and e < len(text) and text[e] not in " \t\n\x0b\x0c\r":
                    value = value.rstrip(":=")
                value = value.rstrip(".:!?")
                level = pii.SEED if re.fullmatch(cfg.seeds, value) else pii.IDENTIFIER if pii._SHAPE.fullmatch(value) else pii.PLAIN
            for p in contexts(forms, i, cfg):
                totals[p] = totals.get(p, 0) + 1
                if level:
                    old = edges.setdefault(p, {}).get(value.lower(), (0, 0))
                    edges[p][value.lower()] = (old[0] + 1, max(old[1], level))
    trust = {}
    while True:
        score = {p: sum(n * (1.0 if level == pii.SEED else trust.get(v, 0.0)) for v, (n, level) in own.items()) / totals[p] for p, own in edges.items()}
        good = {
            p for p, own in edges.items()
            if score[p] >= cfg.confidence and sum(level == pii.SEED or trust.get(v, 0.0) >= cfg.confidence for v, (_, level) in own.items()) >= cfg.support
        }
        new = {}
        for p in good:
            for v, (_, level) in edges[p].items():
                if level == pii.IDENTIFIER:
                    new[v] = max(new.get(v, 0.0), score[p])
        if all(abs(new.get(v, 0.0) - trust.get(v, 0.0)) < 1e-9 for v in {*new, *trust}):
            return good, totals
        trust = new


def test_words_equal_a_plain_split():
    import pyarrow as pa

    rng, cfg = random.Random(6), pii.Settings()
    pieces = ["ab", "C9", " ", "\n", ":", "==", ",", "é", "漢字", " ", "x" * 40, "é" * 30, "a@b.co", "10.2.3.4", "DE89 3704 0044", "12 345 67", ">", '"', "="]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 30))) for _ in range(600)] + [None, ""]
    _, _, words, flat, offsets = pii.examined(pa.array(texts), cfg)
    got = [[] for _ in texts]
    for i in range(len(words.start)):
        low = offsets[words.row[i]]
        before, inside = flat[low : words.start[i]].tobytes().decode(), flat[words.start[i] : words.end[i]].tobytes().decode()
        got[words.row[i]].append((len(before), len(before) + len(inside), words.form(i)))
    assert got == [[(s, e, f) for s, e, _, f in plain_words(t or "", cfg)] for t in texts]


def test_learning_equals_plain_bootstrapping(spark):
    rng, cfg = random.Random(7), pii.Settings(support=2, confidence=0.6)
    codes = [f"{rng.choice('abcxyz')}{rng.randrange(100, 999)}-{rng.randrange(9)}" for _ in range(30)]
    slots = ["reach {} now", "login: {} ok", "key={}", "the {} thing", "see {}, and", "no {} here", 'say "{}" é']
    values = lambda: rng.choice([f"u{rng.randrange(40)}@mail.org", rng.choice(codes), rng.choice(codes), rng.choice(["word", "home", "été"])])
    rows = [(i, " ".join(rng.choice(slots).format(values()) for _ in range(rng.randrange(0, 7)))) for i in range(150)]
    docs = frame(spark, [*rows, (900, None), (901, "")])
    found = pii.marked(docs, ["doc_id"], "m", cfg).select("m.found")
    want, totals = plain_learn([t for _, t in rows], cfg)
    assert {r.pattern for r in pii.learn(found, docs, cfg).collect()} == want and len(want) > 5
    asked = spark.createDataFrame([(p,) for p in totals], "pattern string")
    assert {r.pattern: r.total for r in pii.totals(docs, asked, cfg).collect()} == totals


def test_long_texts_take_linear_time():
    import time
    import tracemalloc

    import pyarrow as pa

    cfg = pii.Settings()
    for text in ("a=b1c2&" * 75_000, "k1=" * 150_000, "x9" * 500_000, "é: a1234 " * 30_000, "1 " * 150_000):
        tracemalloc.start()
        begin = time.time()
        _, (found,) = pii.instances(pa.array([text]), cfg, re.compile(cfg.seeds))
        assert time.time() - begin < 60 and tracemalloc.get_traced_memory()[1] < 1 << 29
        tracemalloc.stop()
        assert all(len(name) <= cfg.longest for _, _, name, _, _ in found)
    (long,) = pii.instances(pa.array([f"key: {'a1' * 5000} end"]), cfg, re.compile(cfg.seeds))[1]
    assert [(s, e, len(name)) for s, e, name, _, _ in long] == [(5, 10005, 64)]
