"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from outagegrid.llm import decontaminate, exact_dedup, near_dedup, substring_dedup, suffix_array as suffixes
from outagegrid.llm.components import components
from outagegrid.llm.suffix_array import permuted_common_prefixes, suffix_array

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingle_sets(rows, width):
    out = {}
    for i, text in rows:
        w = WORDS.findall(lower(text))
        out[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    return out


def brute_components(sets, percent):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_exact_against_groups(make):
    rows = [(i, t) for i, t in enumerate(["a", "A", "b", None, "", "É", "é", "a ", "a"])]
    got = {r.doc_id: r for r in exact_dedup.decide(make(rows)).collect()}
    for i, t in rows:
        same = [j for j, u in rows if lower(u) == lower(t)]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(same), len(same), i == max(same))
        assert bytes(got[i].digest).hex() == hashlib.sha256(lower(t).encode()).hexdigest()


def test_exact_weak_digest_is_split_by_bytes(make):
    rows = [(i, t) for i, t in enumerate(["aa", "bb", "AA", "c", "bb", "cc", ""])]
    weak = lambda c: F.length(c).cast("string").cast("binary")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.decide(make(rows), digest=weak).collect()}
    assert got == {0: (2, 2), 2: (2, 2), 1: (4, 2), 4: (4, 2), 3: (3, 1), 5: (5, 1), 6: (6, 1)}


def test_exact_state_outlives_a_run(spark, make, tmp_path):
    state = str(tmp_path / "state")
    first, second = make([(1, "x"), (2, "y")]), make([(7, "X"), (8, "z")])
    for n, docs in enumerate((first, second)):
        exact_dedup.fingerprints(docs).write.mode("append").parquet(str(tmp_path / "prints"))
        held = exact_dedup.update_state(spark, str(tmp_path / "prints"), state).collect()
    assert sorted((r.keep_id, r.n) for r in held) == [(2, 1), (7, 2), (8, 1)]


def test_exact_hard_rows(make, hard):
    docs = make(hard)
    got = exact_dedup.decide(docs).collect()
    assert len(got) == len(set(hard))  # rows that repeat id and text are one document
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got if r.doc_id in (3, 4, 9)} == {(3, 4, 3), (4, 4, 3), (9, 10, 2)}
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {4, 5, 6, 7, 8, 10, 11}
    assert exact_dedup.decide(docs.where("false")).count() == 0


def near_rows(seed=3):
    """Chains of copies with a few words changed, unequal lengths, and texts of frequent words."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, i = [], 0
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(8, 200))
        for _ in range(rng.randint(1, 12)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(text) // 25))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((i, " ".join(text).upper() if rng.random() < 0.2 else " ".join(text)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_against_all_pairs(make, width, percent):
    rows = near_rows()
    sets = shingle_sets(rows, width)
    want = brute_components(sets, percent)
    got = {r.doc_id: r for r in near_dedup.near_duplicates(make(rows), width, percent).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (i == want[i]) for i, r in got.items())


def test_near_hard_rows(make, hard):
    docs = make(hard)
    got = near_dedup.near_duplicates(docs, 3, 85).collect()
    assert len(got) == len(hard)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].n_shingles == by[2].n_shingles == by[7].n_shingles == 0 and by[1].kept and by[2].kept
    assert (by[3].component_id, by[4].component_id, by[10].component_id) == (3, 3, 9)
    assert near_dedup.keep_one(docs).columns == docs.columns
    assert near_dedup.near_duplicates(docs.where("false"), 3, 85).count() == 0


def test_components_of_a_long_chain(spark):
    chain = list(range(40))
    random.Random(1).shuffle(chain)
    edges = spark.createDataFrame(list(zip(chain, chain[1:])) + [(100, 101)], "a long, b long")
    assert {(r.id, r.label) for r in components(edges).collect()} == {(i, 0) for i in range(40)} | {(100, 100), (101, 100)}


def test_suffix_array_and_prefixes():
    rng = random.Random(2)
    for _ in range(400):
        n, kinds = rng.randint(1, 60), rng.choice([1, 2, 3, 20])
        text = [rng.randint(1, kinds) for _ in range(n)] + [0]
        if rng.random() < 0.3:
            text = (text[: rng.randint(1, 4)] * n)[:n] + [0]
            text = [x or 1 for x in text[:-1]] + [0]
        t = np.array(text, dtype=np.int64)
        want = sorted(range(len(text)), key=lambda i: text[i:])
        sa = suffix_array(t)
        assert sa.tolist() == want
        shared = permuted_common_prefixes(t, sa)
        for x, y in zip(want, want[1:]):
            m = 0
            while max(x, y) + m < len(text) and text[x + m] == text[y + m]:
                m += 1
            assert shared[y] == m


def test_ranks_sort_only_what_is_open(monkeypatch):
    rng, sorted_ = random.Random(9), []
    for _ in range(300):
        names = np.array(rng.choices(range(rng.randint(1, 6)), k=rng.randint(1, 40)) * rng.choice([1, 1, 3]), dtype=np.int64)
        want = sorted(range(len(names)), key=lambda i: names[i:].tolist())
        assert np.argsort(suffixes._ranks(names)).tolist() == want
    argsort, unique = np.argsort, np.unique
    monkeypatch.setattr(np, "argsort", lambda a, **kw: (sorted_.append(len(a)), argsort(a, **kw))[1])
    monkeypatch.setattr(np, "unique", lambda a, **kw: (sorted_.append(len(a)), unique(a, **kw))[1])
    suffixes._ranks(np.array([*range(1000), *[2000] * 64, *range(3000, 4000)]))
    assert sum(sorted_) < 3000


def brute_repeats(rows, least):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - least + 1):
            if data[s : s + least] in seen:
                gone[s : s + least] = True
            seen.add(data[s : s + least])
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        runs = int((np.diff(np.r_[0, gone.astype(int), 0]) == 1).sum())
        out[i] = (len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("settings", [{}, {"most_segments": 1}, {"block_bytes": 500}])
def test_repeats_against_all_windows(make, settings):
    rng = random.Random(5)
    alphabet = ["the ", "of ", "é", "\n", "lorem ", "0", "\x00", "x" * 37]
    passages = ["".join(rng.choices(alphabet, k=60)) for _ in range(6)]
    rows = []
    for i in range(40):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 30)
            text += p[a : a + rng.randint(50, 200)] + rng.choice(alphabet)
        rows.append((i, text))
    rows += [(50, rows[3][1]), (51, "ab" * 400), (52, "a" * 99), (53, "a" * 100), (54, "a" * 101), (55, None), (56, passages[0] * 3)]
    got = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        for r in substring_dedup.remove_repeats(make(rows), **settings).collect()
    }
    assert got == brute_repeats(rows, 100)


def test_segments_with_nul_bytes():
    rng = random.Random(2)
    for _ in range(300):
        texts = ["".join(rng.choices("a\0b", k=rng.randint(4, 9))) for _ in range(rng.randint(2, 6))]
        texts = list(dict.fromkeys(texts))
        rows = [(i, 0, 0, t.encode()) for i, t in enumerate(texts)]
        gone = {i: set() for i in range(len(texts))}
        for i, _, a, b in substring_dedup.repeats_in_block(rows, 4):
            gone[i] |= set(range(a, b))
        for i, (n, removed, _, _) in brute_repeats(list(enumerate(texts)), 4).items():
            assert len(gone[i]) == removed
    rows = [(i, 0, 0, t) for i, t in enumerate([b"abcd", b"efgh", b"ccxx", b"cd\0efgz"])]
    assert substring_dedup.repeats_in_block(rows, 4) == []


def test_rows_that_stay_keep_all_their_columns(spark, make):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text), (2, text), (3, text + " more"), (4, "other words"), (4, "other words"), (4, "OTHER words"), (None, "x y"), (None, "x y")]
    docs = make(rows).selectExpr(
        "*", "concat('u', doc_id) AS _id", "'d' AS _digest", "0.5 AS _toxic_score", "'p' AS `a.b`", "'k' AS keep_id", "'g' AS component_id"
    )
    exact = exact_dedup.keep_one(docs)
    assert exact.columns == docs.columns
    assert sorted((r.doc_id or 0, r._id, r._digest, r["a.b"]) for r in exact.collect()) == [
        (0, None, "d", "p"), (2, "u2", "d", "p"), (3, "u3", "d", "p"), (4, "u4", "d", "p")]
    near = near_dedup.keep_one(docs, width=5, percent=80)
    assert near.columns == docs.columns and {(r.doc_id, r._id) for r in near.collect()} == {(1, "u1"), (4, "u4"), (None, None)}
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    clean = decontaminate.without_leaks(docs, bench)
    assert clean.columns == docs.columns and {(r.doc_id, r._id) for r in clean.collect()} == {(4, "u4"), (None, None)}


def test_rows_follow_from_the_threshold():
    assert [near_dedup.rows_for(p, 2) for p in (85, 80)] == [8, 10]


def test_keys_come_back_in_one_row_a_document(make, spark):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdefgh", k=7)) for _ in range(300)]
    shared = " ".join(rng.choices(vocabulary, k=400))
    rows = [(i, shared[i : i + 1500] + " " + " ".join(rng.choices(vocabulary, k=50))) for i in range(20)] + [(7, "short"), (30, None)]
    rows += [(None, shared), (8, shared), (8, shared)]
    docs = substring_dedup._documents(make(rows))
    got = substring_dedup.repeated_keys(docs.repartition(4), 100, 32).collect()
    assert len(got) == len({(r.doc_id, r.tie) for r in got}) == 22
    seen = {(r.doc_id, r.tie): set(np.frombuffer(r.keys, np.int64).tolist()) for r in got}
    rows = [((r.doc_id, r.tie), substring_dedup.window_keys(bytes(r.text), 100, 32)[1].tolist()) for r in docs.collect()]
    times = {}
    for _, keys in rows:
        for k in keys:
            times[k] = times.get(k, 0) + 1
    want = {i: {k for k in keys if times[k] > 1} for i, keys in rows}
    assert seen == {i: k for i, k in want.items() if k}
    gone = docs.where("doc_id = 8").select("doc_id", "tie").limit(1)
    left = substring_dedup.repeated_keys(docs, 100, 32, docs.where("doc_id < 5").select("doc_id", "tie").unionByName(gone)).collect()
    assert {r.doc_id for r in left} <= {r.doc_id for r in got} and all(r.doc_id >= 5 for r in left)


def test_repeats_hard_rows(make, hard):
    got = substring_dedup.remove_repeats(make(hard)).collect()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    want = brute_repeats([r for r in hard if r[0] is not None], 100)
    assert {i: (r.n_bytes, r.n_removed) for i, r in by.items()} == {i: w[:2] for i, w in want.items()}
    assert substring_dedup.remove_repeats(make(hard).where("false")).count() == 0


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_misses_of_a_large_group_are_not_paired_with_all_its_nodes(make, monkeypatch, width, percent):
    rng = random.Random(11)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]

    def varied(edits):
        text = list(base)
        for at in rng.sample(range(len(base)), edits):
            text[at] = f"v{rng.randrange(60)}"
        return " ".join(text)

    # Some are linked with many, some only with one that shares their changes, most with nothing.
    rows = [(i, varied(rng.randint(1, 7))) for i in range(500)]
    rows += [(500 + i, f"{rows[i][1]} and more") for i in range(0, 500, 25)]
    rows += [(i, rows[i + 1][1]) for i in range(0, 40, 20)]  # ids with two texts
    counts = {}
    stored = near_dedup.stored

    def counted(df, label, codec=None):
        out = stored(df, label, codec)
        counts[label] = out.count()
        return out

    monkeypatch.setattr(near_dedup, "stored", counted)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(make(rows), width, percent).collect()}
    sets = [next(iter(shingle_sets([r], width).values())) for r in rows]
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 100 * len(x & y) >= percent * len(x | y):
                a, b = sorted((top(rows[i][0]), top(rows[j][0])))
                root[b] = a
    assert got == {i: top(i) for i, _ in rows}
    assert len(set(got.values())) > 50 and counts["rest"] < 2 * len(rows)


@pytest.mark.parametrize("dtype,symbols", [(np.int16, 2), (np.int16, 258), (np.int64, 2**40)])
def test_common_prefixes_are_compared_several_symbols_at_once(monkeypatch, dtype, symbols):
    rng = np.random.default_rng(4)
    part = rng.integers(1, symbols, 300)
    t = np.r_[part, symbols - 1, part, 0].astype(dtype)
    sa = np.array(sorted(range(len(t)), key=lambda i: t[i:].tolist()))
    rounds = []
    count = np.bitwise_count
    monkeypatch.setattr(np, "bitwise_count", lambda x: rounds.append(len(x)) or count(x))
    shared = permuted_common_prefixes(t, sa)
    for x, y in zip(sa, sa[1:]):
        m = 0
        while t[x + m] == t[y + m]:
            m += 1
        assert shared[y] == m
    assert 0 < len(rounds) <= len(t) // max(1, 63 // (symbols - 1).bit_length()) + 1
    assert permuted_common_prefixes(np.zeros(1, dtype), np.zeros(1, int)).tolist() == [0]


def test_tables_are_dealt_out_once(make, monkeypatch):
    docs = make([(i, f"{' '.join(f'w{k}' for k in range(30))} {i // 2}") for i in range(40)])
    nodes = near_dedup.sketches(docs, 5, 2, 10).selectExpr("doc_id AS id", "n", "u", "v")
    monkeypatch.setattr(near_dedup, "stored", lambda df, *_: df)
    shared = near_dedup._shared_tables(nodes)
    assert shared.columns == ["key", "id", "n", "centers"]
    rows = shared.collect()
    assert {r.id for r in rows} == set(range(40)) and all(r.centers[0].a <= r.id for r in rows)
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("Initial Plan")[0]
