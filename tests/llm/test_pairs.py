"""Exact dedup, near-dedup, embedding links and components against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pointflow.llm import heavy_dedup, int8_tiles, minhash_bayes, shingles
from pointflow.llm.components import connected, forest
from pointflow.llm.tables import Scratch

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, id bigint, rank int"


def docs(spark, rows):
    """Documents whose other columns have names that the operators use inside."""
    return spark.createDataFrame([(i, t, None, "s", len(t or ""), "x", 1, 2) for i, t in rows], DOCS)


def roots(n, pairs):
    low = list(range(n))
    while True:
        following = list(low)
        for i, j in pairs:
            following[i] = following[j] = min(following[i], following[j])
        if following == low:
            return low
        low = following


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(30)]
    frame = spark.createDataFrame([*edges, (5, 5), (None, 3)], "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in connected(Scratch(spark, "t"), frame).collect()}
    want = roots(140, edges)
    assert got == {i: want[i] for e in edges if e[0] != e[1] for i in e}
    assert connected(Scratch(spark, "t"), frame.where("false")).count() == 0
    assert forest(5, np.array([0, 3]), np.array([3, 4])).tolist() == [0, 1, 2, 0, 0]


def test_exact_groups_edge_cases(spark):
    rows = [(1, "Ab c"), (2, "aB C"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "z"), (7, "z"), (None, "z")]
    got = heavy_dedup.exact_groups(docs(spark, rows), counters=2).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    assert (by_id[1]["keep_id"], by_id[1]["kept"], by_id[2]["kept"]) == (2, False, True)
    assert (by_id[3]["keep_id"], by_id[4]["group_size"]) == (4, 2)
    assert by_id[5]["kept"] and by_id[6]["kept"]
    assert bytes(by_id[1]["digest"]) == hashlib.sha256(b"ab c").digest()
    sevens = [r for r in got if r["keep_id"] == 7]
    assert sorted(r["kept"] for r in sevens) == [False, False, True] and {r["group_size"] for r in sevens} == {3}
    assert heavy_dedup.exact_groups(docs(spark, []), counters=2).count() == 0
    with pytest.raises(ValueError):
        heavy_dedup.exact_groups(docs(spark, rows).drop("text"))


def test_exact_dedup_with_heavy_and_light_digests(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["hot", "hot", "Hot", "warm", f"t{rng.randrange(300)}"])) for i in range(2000)]
    frame = docs(spark, rows).repartition(7)
    best = {}
    for i, t in rows:
        best[t.lower()] = max(i, best.get(t.lower(), -1))
    assert heavy_dedup.heavy_candidates(frame.select(heavy_dedup.text_digest("text").alias("digest")), 8).count() in (1, 2)
    for counters in (8, 512):
        kept = heavy_dedup.exact_dedup(frame, counters=counters)
        assert kept.columns == frame.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(best.values())
        groups = heavy_dedup.exact_groups(frame, counters=counters).collect()
        assert sorted(r["doc_id"] for r in groups if r["kept"]) == sorted(best.values())
        assert all(r["keep_id"] == best[dict(rows)[r["doc_id"]].lower()] for r in groups)


def test_misra_gries_never_misses():
    rng = random.Random(2)
    values = [b"a"] * 300 + [b"%d" % rng.randrange(400) for _ in range(700)]
    rng.shuffle(values)
    state = {}
    for at in range(0, 1000, 50):
        part = values[at : at + 50]
        names = sorted(set(part))
        heavy_dedup.merge_counts(state, names, [part.count(n) for n in names], 9)
    assert len(state) <= 9 and 300 - 1000 // 10 <= state[b"a"] <= 300


def sets_of(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words)} if 0 < len(words) < width else {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute_near(rows, width):
    sets = [sets_of(t, width) for _, t in rows]
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] & sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    low = roots(len(rows), pairs)
    members = {}
    for i, root in enumerate(low):
        members.setdefault(root, []).append(rows[i][0])
    return [(rows[i][0], len(sets[i]), min(members[low[i]])) for i in range(len(rows))]


def near_rows():
    rng = random.Random(7)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(7)):
            words[rng.randrange(len(words))] = f"x{i}"
        rows.append((100 + i, " ".join(words)))
    rows += [(i, " ".join(f"u{rng.randrange(9000)}" for _ in range(rng.randrange(1, 40)))) for i in range(30)]
    rows += [(300, "A b\tc"), (301, "a B c"), (302, "a b c d"), (303, None), (304, ""), (305, " \n"), (306, "É b c d e")]
    rows += [(307, "é b c d e"), (308, "one"), (309, "ONE")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [4, 5])
def test_near_components_equal_brute_force(spark, width, monkeypatch):
    rows = near_rows()
    # small blocks, so that large buckets fall into several tiles
    monkeypatch.setattr(minhash_bayes, "BLOCK_MEMBERS", 8)
    got = minhash_bayes.near_components(docs(spark, rows), width).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute_near(rows, width))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    left = minhash_bayes.near_dedup(docs(spark, rows), width)
    assert left.columns == docs(spark, []).columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r["doc_id"] for r in got if r["kept"])


def test_near_components_nulls_and_repeats(spark):
    text = "a b c d e f g"
    got = minhash_bayes.near_components(docs(spark, [(None, text), (4, text), (4, text), (9, text)]), 4).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in got) == [
        ("4", "4", True),
        ("4", "4", True),
        ("9", "4", False),
        ("None", "None", True),
    ]
    assert minhash_bayes.near_components(docs(spark, []), 4).count() == 0


def test_near_dedup_of_repeated_rows_and_ids(spark):
    text, other = "a b c d e f g", "h i j k l m n"
    rows = [(4, text), (4, text), (9, text), (9, other), (7, ""), (7, None), (7, ""), (None, text)]
    frame = docs(spark, rows).selectExpr("*", "1 AS lost_id", "2 AS id", "3 AS mark")
    left = minhash_bayes.near_dedup(frame)
    assert left.columns == frame.columns
    want = [(4, text), (7, ""), (7, ""), (7, None), (9, other), (None, text)]
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(want, key=str)


def test_near_dedup_judges_ids_that_repeat_by_their_texts(spark):
    def text(tag, changed=""):
        words = [f"{tag}{i}" for i in range(60)]
        return " ".join(words[:-1] + [changed or words[-1]])

    # one id with two texts, near copies under one id, near copies without an id
    rows = [(3, text("a", "x")), (5, text("a")), (5, text("b")), (8, text("b")), (9, text("b", "y"))]
    rows += [(11, text("c")), (11, text("c", "x")), (11, text("c", "y"))]
    rows += [(None, text("d", f"v{i}")) for i in range(4)] + [(None, text("e")), (None, text("e")), (None, None)]
    frame = docs(spark, rows)
    left = [(r["doc_id"], r["text"]) for r in minhash_bayes.near_dedup(frame).collect()]
    assert sorted((i, t[:1]) for i, t in left if i is not None) == [(3, "a"), (5, "b"), (11, "c")]
    assert sorted((t or "")[:1] for i, t in left if i is None) == ["", "d", "e"]
    got = minhash_bayes.near_components(frame).collect()
    ids = sorted((r["doc_id"], r["component_id"]) for r in got if r["doc_id"] is not None)
    assert ids == [(3, 3), (5, 3), (5, 5), (8, 5), (9, 5), (11, 11), (11, 11), (11, 11)]
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert all(r["component_id"] is None for r in got if r["doc_id"] is None)


def test_common_counts():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 80, rng.integers(0, 60))).astype(np.uint64) for _ in range(40)]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    got = minhash_bayes.common_counts(np.concatenate(sets), offsets)
    for i in range(40):
        for j in range(i + 1, 40):
            assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_signatures_estimate_and_prune():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    agree = []
    for share in (0.85, 0.5, 0.0):
        a = np.sort(pool[:1000])
        b = np.sort(np.concatenate([pool[:1000][: round(2000 * share / (1 + share))], pool[1000 : 2000 - round(2000 * share / (1 + share))]]))
        marks = shingles.signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]))
        agree.append((marks[0] == marks[1]).mean())
        assert minhash_bayes.surviving(marks[:1], marks[1:], 80).tolist() == [share > 0.8]
    assert abs(agree[0] - 0.85) < 0.12 and abs(agree[1] - 0.5) < 0.15 and agree[2] < 0.02
    assert (np.diff(minhash_bayes.least_matches(80)) >= 0).all()


def brute_links(rows, threshold):
    def unit(v):
        ok = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        return np.array(v, dtype=float) / np.linalg.norm(v) if ok else None

    units = [unit(v) if l is not None else None for _, v, l in rows]
    pairs = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
        and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold
    ]
    low = roots(len(rows), pairs)
    least = {}
    for i, root in enumerate(low):
        least[root] = min(rows[i][0], least.get(root, rows[i][0]))
    return [(rows[i][0], sum(i in p for p in pairs), least[low[i]]) for i in range(len(rows))]


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(6, 16))
    rows = []
    for i in range(240):
        v = centers[i % 6] + rng.normal(size=16) * (0.05 if i % 3 else 0.35)
        rows.append((1000 - i, [float(np.float32(x)) for x in v], int(i % 2)))
    rows += [(2000 + i, rows[0][1], 0) for i in range(20)]
    rows += [(1, None, 0), (2, [], 0), (3, [0.0] * 16, 0), (4, [float("nan")] * 16, 0), (5, [None] + [1.0] * 15, 0)]
    rows += [(6, [float("inf")] * 16, 0), (7, rows[0][1], None), (8, rows[0][1][:8], 0), (9, [x * 3 for x in rows[0][1]], 0)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, rep string")
    want = sorted(brute_links([(i, v and [None if x is None else float(np.float32(x)) for x in v], l) for i, v, l in rows], 0.93))
    for block in (1024, 16):
        got = int8_tiles.cosine_links(frame, block=block).collect()
        assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == want
    assert int8_tiles.cosine_links(frame.where("false")).count() == 0


def test_embedding_null_id_and_huge_values(spark):
    rows = [(None, [1.0, 2.0], 0), (3, [1e200, 2e200], 0), (4, [1e-200, 2e-200], 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted((str(r["vec_id"]), r["n_links"], r["kept"]) for r in int8_tiles.cosine_links(frame).collect())
    assert got == [("3", 1, True), ("4", 1, False), ("None", 0, True)]


def test_int8_bound_is_rigorous():
    rng = np.random.default_rng(8)
    a, b = int8_tiles.unit_rows(rng.normal(size=(50, 1500))), int8_tiles.unit_rows(rng.normal(size=(40, 1500)))
    ca, sa, na, ea = int8_tiles.quantise(a)
    cb, sb, nb, eb = int8_tiles.quantise(b)
    products = int8_tiles.code_products(ca, cb)
    assert (products == ca.astype(int) @ cb.astype(int).T).all()
    error = np.abs(products * np.outer(sa, sb) - a @ b.T)
    assert (error <= np.outer(na, eb) + np.outer(ea, nb) + np.outer(ea, eb) + 1e-12).all()
