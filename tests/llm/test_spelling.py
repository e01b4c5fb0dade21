"""Spelling variants against plain dictionaries of all single edits."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from outagegrid.llm import spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, times=10):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            n[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    by_rest = {}
    for w in n:
        for i in range(len(w)):
            by_rest.setdefault(w[:i] + w[i + 1 :], set()).add((i, w))
    near = {w: set() for w in n}
    for rest, some in by_rest.items():
        for i, a in some:
            near[a] |= {b for j, b in some if i == j and a != b}
            if rest in n:
                near[a].add(rest)
                near[rest].add(a)
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= times * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, alphabet="abcdeé", count=60):
    r = random.Random(seed)
    stems = ["".join(r.choice(alphabet) for _ in range(r.randint(6, 10))) for _ in range(12)]

    def word():
        w = r.choice(stems)
        while r.random() < 0.35:
            at = r.randrange(len(w))
            w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice(alphabet) + w[at:], w[:at] + r.choice(alphabet) + w[at + 1 :]]) or w
        return w.upper() if r.random() < 0.05 else w

    return [(i, " ".join(word() for _ in range(r.randint(0, 120)))) for i in range(count)]


@pytest.mark.parametrize("sample", [10, 200, spelling.SAMPLE])
@pytest.mark.parametrize("seed, alphabet", [(1, "abcdeé"), (2, "ab"), (3, "abcdefghijklmnopqrstuvwxyzèÿ")])
def test_variants_equal_all_edits(make, monkeypatch, seed, alphabet, sample):
    monkeypatch.setattr(spelling, "SAMPLE_LEAF", 2)
    monkeypatch.setattr(spelling, "shard_words", lambda length: 24)
    rows = corpus(seed, alphabet)
    assert got(spelling.variants(make(rows), sample=sample)) == plain(rows)


def test_forms_lead_to_a_root(make):
    words = ["banddana"] * 2 + ["bandana"] * 20 + ["bandanas"] * 200 + ["windowed", "windowed"]
    # The id is one whose hashes leave these runs whole.
    whole = next(i for i in range(10_000) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in set(words)))
    found = {r[0]: r for r in got(spelling.variants(make([(whole, " ".join(words))])))}
    assert found["banddana"][1:3] == ("bandana", "bandanas") and found["bandana"][1:3] == ("bandanas", "bandanas")
    assert found["windowed"] == ("windowed", None, "windowed", 2, 0, None)


def test_hard_rows(make, hard):
    rows = hard + [(20, "abcdefg" * 200 + " " + "abcdefg" * 200), (21, "ÀÉÎõ÷×ÿ ÀÉÎõ÷×ÿ ÀÉÎõ÷×z"), (22, "x" * 7 + "🙂" + "x" * 7)]
    assert got(spelling.variants(make(rows))) == plain(rows)
    assert got(spelling.variants(make(rows).where("false"))) == []


def test_tree_search_is_whole():
    r = np.random.default_rng(5)
    vectors = r.integers(0, 4, (400, spelling.CLASSES)).astype(np.uint8)
    vectors[:, 6:] = 0
    tree = spelling.Tree(vectors, 4)
    for radius in (1, 2):
        rows, leaves = tree.search(vectors, radius)
        pairs = {(a, int(m)) for a, leaf in zip(rows.tolist(), leaves.tolist()) for m in tree.members[tree.start[leaf] : tree.start[leaf + 1]]}
        apart = np.abs(vectors[:, None].astype(int) - vectors[None]).sum(2)
        assert {(int(a), int(b)) for a, b in zip(*np.nonzero(apart <= radius))} <= pairs
        assert len(pairs) < 400 * 400 / 2
    assert (tree.home(vectors)[tree.members] == np.repeat(np.arange(tree.leaves), np.diff(tree.start))).all()
