"""Vector codes, repeated strings and the source audit against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pointflow.llm import bwt_repeats, queries, term_transducer, value_codebooks

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, id bigint, mark string, base int, key string"


def docs(spark, rows):
    """(doc_id, text, lang, source), next to columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, 1, "m", 2, "k") for r in rows], DOCS)


# --- vector codes ---------------------------------------------------------------------------------


def plain_codes(rows, parts, entries, rounds, scale):
    """Codebooks, codes and errors by the plain definition, in Python's integers."""
    good = [(i, [math.floor(scale * x) for x in v]) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0))
    width = len(good[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v in good[:entries]] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    pick = lambda v, p: min(range(len(books[p])), key=lambda e: (dist(cut(v, p), books[p][e]), e))
    for _ in range(rounds):
        members = [[[] for _ in books[p]] for p in range(parts)]
        for _, v in good:
            for p in range(parts):
                members[p][pick(v, p)].append(cut(v, p))
        books = [[[sum(c) // len(ms) for c in zip(*ms)] if ms else old for ms, old in zip(members[p], books[p])] for p in range(parts)]
    codes = [(i, [pick(v, p) for p in range(parts)], v) for i, v in good]
    return books, [(i, "".join(f"{e:02x}" for e in c), sum(dist(cut(v, p), books[p][c[p]]) for p in range(parts))) for i, c, v in codes]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, k, 1, "x") for i, v, k in rows], "vec_id bigint, embedding array<double>, label int, error int, code string")


@pytest.mark.parametrize("far", [1.0, 3e5, 3e6])
def test_codes_equal_the_plain_definition(spark, far):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1, 1]) * rng.random() * far if far > 1 else round(rng.gauss(0, 0.2), 2) for _ in range(8)], rng.choice([None, 1, 1, 2])) for i in range(150)]
    if far > 1:
        # far apart places, whose squares pass 63 bits, each held by many vectors
        places = [r[1] for r in rows[:3]]
        rows = [(i, places[i % 3], k) for i, _, k in rows]
    rows += [(200, None, 1), (201, [None] * 8, 2), (202, [math.nan] + [0.0] * 7, 2), (203, [math.inf] + [0.0] * 7, None)]
    rng.shuffle(rows)
    coded, books = value_codebooks.compress_vectors(vectors(spark, rows), parts=4, entries=5)
    want_books, want = plain_codes(rows, 4, 5, value_codebooks.ROUNDS, value_codebooks.SCALE)
    got = coded.collect()
    assert books.tolist() == want_books
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == sorted(want)
    label = {i: k for i, _, k in rows}
    sums = Counter()
    for i, _, error in want:
        sums[label[i]] += error
    assert all(r["label_error"] == sums[r["label"]] for r in got)


def test_codes_of_odd_tables(spark):
    few, books = value_codebooks.compress_vectors(vectors(spark, [(2, [0.5] * 8, 1), (2, [0.25] * 8, 1), (None, [1.0] * 8, 3)]))
    assert books.shape == (8, 3, 1) and books[0, :, 0].tolist() == [1024, 2048, 4096]
    assert sorted((r["code"], r["error"]) for r in few.collect()) == [(f"0{i}" * 8, 0) for i in range(3)]
    for rows in ([], [(1, None, 1)]):
        none, books = value_codebooks.compress_vectors(vectors(spark, rows))
        assert none.count() == 0 and books.shape[1] == 0
    for rows in ([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], [(1, [1.0] * 9, 1)], [(1, [1e300] * 8, 1)]):
        with pytest.raises(Exception, match="widths|equal parts|too large"):
            value_codebooks.compress_vectors(vectors(spark, rows))[0].collect()


# --- repeated strings -----------------------------------------------------------------------------


def plain_cut(rows, length):
    """(bytes, removed, spans, what is left) per row, by a table of all strings."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for at in range(len(t) - length + 1):
            w = t[at : at + length]
            first[w] = min(first.get(w, (i, at)), (i, at))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for at in range(len(t) - length + 1):
            if first[t[at : at + length]] < (i, at):
                gone[at : at + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), int((np.diff(gone.astype(int)) == -1).sum()), kept))
    return sorted(out)


def cut_rows(frame):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in frame.collect()), key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("max_kinds", [1, 3, 4096])
def test_cuts_equal_a_table_of_all_strings(spark, max_kinds, monkeypatch):
    rng = random.Random(max_kinds)
    line = "".join(rng.choice("abcé ") for _ in range(60))
    rows = []
    for i in range(80):
        text = "".join(rng.choice("abcé ") for _ in range(rng.randrange(0, 60)))
        if i % 3 == 0:
            text += line[rng.randrange(30) :] + "".join(rng.choice("ab") for _ in range(9))
        if i % 7 == 0:
            text += text
        rows.append((i * 3, text, None, None))
    rows += [(1000 + i, rows[6][1], None, None) for i in range(5)]
    rows += [(2000, None, None, None), (2001, "", None, None), (2002, "a" * 500, None, None), (2003, "a" * 20, None, None)]
    rng.shuffle(rows)
    got = cut_rows(bwt_repeats.cut_repeats(docs(spark, rows), length=20, gram=6, max_kinds=max_kinds))
    assert got == plain_cut([r[:2] for r in rows], 20)


def test_cuts_of_odd_tables(spark):
    passage = "the same forty bytes stand in many texts"
    rows = [(None, passage + "x", None, None), (4, "y" + passage, None, None), (9, passage, None, None), (9, passage, None, None)]
    got = cut_rows(bwt_repeats.cut_repeats(docs(spark, rows), length=40, gram=8))
    assert [r[4] for r in got] == [b"y" + passage.encode(), b"", b"", b"x"]
    alone = cut_rows(bwt_repeats.cut_repeats(docs(spark, rows[2:]), length=40, gram=8))
    assert [r[4] for r in alone] == [passage.encode()] * 2
    assert bwt_repeats.cut_repeats(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        bwt_repeats.cut_repeats(docs(spark, []).drop("text"))


def test_prefixes_by_expansion():
    rng = random.Random(2)
    for _ in range(200):
        length = rng.choice([1, 2, 5, 9, 16])
        pieces = [bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 6))]
        by_class, by_window = defaultdict(set), defaultdict(set)
        for i, at, k in zip(*(x.tolist() for x in bwt_repeats.window_classes(pieces, length))):
            by_class[k].add(pieces[i][at : at + length])
            by_window[pieces[i][at : at + length]].add(k)
        assert all(len(s) == 1 for s in [*by_class.values(), *by_window.values()])


def test_every_window_is_in_one_segment(monkeypatch):
    rng = random.Random(3)
    for _ in range(200):
        monkeypatch.setattr(bwt_repeats, "STRETCH", rng.choice([5, 40, 1000]))
        length = rng.choice([4, 8, 16])
        gram = rng.randrange(1, length + 1)
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 60))) for _ in range(5)]
        seen, grams = Counter(), {}
        for i, start, stop, key in zip(*(x.tolist() for x in bwt_repeats.segments_of(texts, length, gram))):
            for at in range(start, stop - length + 1):
                seen[i, at] += 1
                assert grams.setdefault(texts[i][at : at + length], key) == key
        assert seen == {(i, at): 1 for i, t in enumerate(texts) for at in range(len(t) - length + 1)}


def test_cut_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op12_repeats"](spark, FOLDER).collect())
    assert got == [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in plain_cut(rows, 100)]
    assert sum(r[2] for r in got)


def test_memory_goes_back_once_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(bwt_repeats, "give_back", lambda: calls.append(1), raising=False)
    monkeypatch.setattr("pointflow.llm.tables.give_back", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_pydict({"text": ["a", None, "b" * 9]}) for _ in range(5)]
    assert [t for texts, _ in bwt_repeats._slices(batches, []) for t in texts] == ["a", None, "b" * 9] * 5
    assert len(calls) == 1


@pytest.mark.parametrize("n", [1, 6, 20, 500])
def test_suffix_order_of_deep_repeats(n):
    rng = random.Random(n)
    symbols = np.array([rng.choice((1, 2)) for _ in range(n)] * 3, dtype=np.uint16)
    order = bwt_repeats.suffix_order(symbols, 100)
    front = [tuple(symbols[i : i + 100].tolist()) for i in order.tolist()]
    assert sorted(order.tolist()) == list(range(3 * n)) and front == sorted(front)


# --- source audit ---------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain_audit(rows, min_docs, top):
    terms = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for _, text, lang, source in rows]
    out = []
    for lang in {t[0] for t in terms}:
        own = [t for t in terms if t[0] == lang]
        in_docs = Counter(w for t in own for w in set(t[2]))
        kept = [w for w, n in in_docs.items() if n >= min_docs]
        counts = {s: Counter() for s in {t[1] for t in own}}
        for _, s, words in own:
            counts[s].update(w for w in words if w in set(kept))
        share = lambda tally: {w: 1 + 10**9 * (tally[w] + 2) // (sum(tally.values()) + 2 * len(kept)) for w in kept}
        p, q = {s: share(c) for s, c in counts.items()}, share(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(sum(f(p[s][w], p[o][w]) for w in kept), o) for o in counts if o != s]
            best = [(f(p[s][w], q[w]), w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found, limit in (("pair", pairs, None), ("term", best, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:limit], 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"max_key_bytes": 10}, {"block_sources": 2, "block_terms": 3}])
def test_audit_equals_the_plain_definition(spark, options):
    rng = random.Random(8)
    words = ["Ab", "ab", "é", "É", "x1y", "zz-top", "日本", "a" * 300, "the", "The", "of", "q\x00r", "\U0001f600ok"]
    rows = [
        (i, " ".join(rng.choice(words[: rng.randrange(1, 14)]) for _ in range(rng.randrange(0, 25))), rng.choice(["en", "en", None, "de\0x"]), rng.choice(["s1", "s2", "S", None, "é", "s10", "t"]))
        for i in range(150)
    ]
    rows += [(900, None, "en", "silent"), (901, "", "la", "a"), (902, "one two", "la", "b"), (903, "one two", "la", "b"), (None, "ab", None, None)]
    got = term_transducer.audit_sources(docs(spark, rows), min_docs=3, top=4, **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, 3, 4)


@pytest.mark.parametrize("options", [{}, {"max_key_bytes": 0}])
def test_audit_of_languages_with_zero_bytes(spark, options):
    """Keys of "en\\0b" must not lie between those of "en"."""
    langs = ["en", "en\0b", "en\0", "en\1b", "en\1\1b", "en\1\2b", "\0", ""]
    rows = [(i, "a c d" + " c" * (i % 5) + " b" * (i % 3), langs[i % 8], f"s{i % 5}") for i in range(160)]
    got = term_transducer.audit_sources(docs(spark, rows), min_docs=3, top=4, **options)
    assert sorted(tuple(r) for r in got.collect()) == plain_audit(rows, 3, 4)


def test_audit_of_an_empty_table(spark):
    assert term_transducer.audit_sources(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        term_transducer.audit_sources(docs(spark, []).drop("lang"))


def test_transducer_is_minimal_and_ordered():
    rng = random.Random(4)
    for _ in range(60):
        keys = sorted({bytes(rng.choice(b"ab\xc3") for _ in range(rng.randrange(0, 7))) for _ in range(rng.randrange(0, 60))})
        made = term_transducer.unpack(term_transducer.pack(term_transducer.build_transducer(keys)))
        for i, key in enumerate(keys):
            state, ordinal = made.walk(key)
            assert made.final[state] and ordinal == i
        for probe in (b"zz", b"aab", b"ba\xc3a"):
            found = made.walk(probe)
            assert (found is not None and bool(made.final[found[0]])) == (probe in keys)
        # states are as many as there are different futures
        futures = {frozenset(k[n:] for k in keys if k.startswith(key[:n])) for key in keys for n in range(len(key) + 1)}
        assert len(made.final) == max(1, len(futures))
