"""Language-model scores, personal data, toxicity and decontamination against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from outagegrid.llm import decontaminate, lm_score, pii, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def rest(i, n=5):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def tokens(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) + ["</s>"]


def model_scores(rows, vocabulary):
    """The documented model, computed in one place; weights come from the operator's own function."""
    train = [(i, tokens(t)) for i, t in rows if rest(i) != 1]
    deleted = {i for i, _ in train if zlib.crc32(str(i).encode()) // 5 % 10 == 0}
    counts = collections.Counter(w for _, t in train for w in t[:-1])
    level = lambda c: math.floor(math.log2(c) * 16)
    kinds, least, total = collections.Counter(level(c) for c in counts.values()), None, 0
    for k in sorted(kinds, reverse=True):
        total += kinds[k]
        if total > vocabulary:
            break
        least = k
    inside = {w for w, c in counts.items() if least is not None and level(c) >= least}
    classed = lambda t: ["<s>"] + [w if w in inside or w == "</s>" else "<o>" for w in t]

    def tables(docs):
        c, bi = collections.Counter(), collections.Counter()
        for _, t in docs:
            m = classed(t)
            c.update(m)
            bi.update(zip(m, m[1:]))
        return c, bi

    c_t, bi_t = tables([d for d in train if d[0] not in deleted])
    held = tables([d for d in train if d[0] in deleted])[1]
    n_t = sum(c_t.values()) - c_t["<s>"]
    bucket = lambda n: min(int(math.log2(n + 1)), lm_score.BUCKETS - 1)
    step = lambda p: max(math.floor(math.log2(p) * lm_score.STEPS + 0.5), lm_score.LOWEST) if p > 0 else lm_score.LOWEST
    cells = collections.Counter()
    for (h, w), n in held.items():
        cells[bucket(c_t[h]), step(bi_t[h, w] / c_t[h] if c_t[h] else 0), step(c_t[w] / max(1, n_t))] += n
    size = len(inside) + 3
    weights = lm_score.weights_by_em(np.array([(*k, n) for k, n in cells.items()]).reshape(-1, 4), 1 / (size - 1))
    c, bi = tables(train)
    n_all = sum(c.values()) - c["<s>"]
    others = [n for w, n in counts.items() if w not in inside]
    out = {}
    for i, text in rows:
        t = tokens(text)
        m, s = classed(t), 0.0
        for h, w in zip(m, m[1:]):
            l2, l1, l0 = weights[bucket(c[h])]
            s += math.log10(l2 * (bi[h, w] / c[h] if c[h] else 0) + l1 * c[w] / n_all + l0 / (size - 1))
        for w in t[:-1]:
            if w not in inside:
                s += math.log10((counts[w] + 0.5) / (sum(others) + 0.5 * (len(others) + 1)))
        base_n, base_v = sum(counts.values()) + len(train), len(counts) + 1
        base = sum(math.log10((counts[w] + 0.5) / (base_n + 0.5 * (base_v + 1))) for w in t[:-1])
        base += math.log10((len(train) + 0.5) / (base_n + 0.5 * (base_v + 1)))
        out[i] = (len(t), sum(counts[w] > 0 for w in t[:-1]) + 1, base_n, base, s)
    return out


@pytest.mark.parametrize("vocabulary,hot", [(10**6, 0.001), (12, 0.5), (30, 0.02)])
def test_scores_equal_the_plain_model(make, vocabulary, hot):
    rng = random.Random(6)
    common = [f"w{k}" for k in range(30)]
    rows = [
        (i, " ".join(rng.choices(common, weights=range(30, 0, -1), k=rng.randint(0, 60)) + [f"rare{rng.randint(0, 99)}"]))
        for i in range(150)
    ]
    want = model_scores(rows, vocabulary)
    for r in lm_score.score(make(rows), vocabulary, hot).collect():
        n, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (rest(r.doc_id) == 1, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_every_word_has_its_own_bigrams(make):
    """No size of the vocabulary at which words lose their own counts; blocks smaller than a document change nothing."""
    rng = random.Random(16)
    rows = [(i, " ".join(f"x{rng.randrange(900_000)} w{rng.randrange(9)}" for _ in range(3500))) for i in range(90)]
    want = model_scores(rows, 10**9)
    assert len({w for _, t in rows for w in t.split()}) > 220_000
    for r in lm_score.score(make(rows), block_events=20_000).collect():
        n, known, total, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_scores_hard_rows(make, hard):
    docs = make(hard)
    got = lm_score.score(docs).collect()
    assert {r.doc_id for r in got} == {i for i, _ in hard} and len(got) == len({i for i, _ in hard})
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) and r.score < 0 for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (1, 2, 7)} == {1}
    assert lm_score.score(docs.where("false")).count() == 0
    assert all(math.isfinite(r.score) for r in lm_score.score(make([(i, "a b") for i in range(99) if rest(i) == 1])).collect())


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    double = lambda d: 2 * d - 9 if d > 4 else 2 * d
    return sum(double(int(c)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def plain_base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


def test_base_spans_equal_the_patterns(make):
    rng = random.Random(8)
    parts = [
        "a.b@c.de", "x@y", "q@-a.b.", "1.2.3.4", "999.1.1.1", "001.2.3.04", "4539 1488 0343 6467", "4539148803436467", "12", " ",
        " ", "-", ".", "..", "+1 (377) 555-0271", "+4", "é", "🙂", "\n", "@", "", "7", "1 - 2", "text", "(", "+", "1234567890123456",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(500)]
    rows = pii.find(make(texts)).select("doc_id", pii.joined(F.col("base")).alias("b")).collect()
    assert {r.doc_id: r.b for r in rows} == {i: plain_base(t) for i, t in enumerate(texts)}


def test_time_follows_the_text(make):
    """A run of a million letters beside an address, and thousands of addresses in one text."""
    texts = ["a" * 1_000_000 + " x@y.de " + "7" * 1_000_000 + " 1.2.3.4", "a@b.de " * 4_000]
    rows = {r.doc_id: r for r in pii.find(make(texts)).select("doc_id", F.size("base").alias("n"), F.element_at("base", -1).alias("last")).collect()}
    assert rows[0].n == 2 and (rows[0].last.start, rows[0].last.end) == (2_000_009, 2_000_016)
    assert rows[1].n == 4_000 and rows[1].last.start == 7 * 3_999


def test_added_spans_keep_the_base(make):
    texts = [f"call me tel 555-{k:03d}-{k * 7 % 10000:04d} or mail a{k}@b.com token = \"{hashlib.sha1(bytes([k])).hexdigest()}\"" for k in range(60)]
    for r in pii.find(make(texts)).collect():
        assert [s.kind for s in r.base] == ["email"]
        assert "secret" in {s.kind for s in r.added}
        assert all(b.end <= s.start or s.end <= b.start for s in r.added for b in r.base)


def test_labeler_reliabilities_are_learned():
    names = pii.LABELERS
    rng = random.Random(1)
    seen = collections.Counter()
    for _ in range(4000):
        truth = rng.random() < 0.4
        seen[tuple((1 if truth else -1) * (1 if rng.random() < q else -1) for q in (0.95, 0.9, 0.85, 0.6, 0.55)) + (truth,)] += 1
    patterns = collections.Counter()
    for k, n in seen.items():
        patterns[k[:5]] += n
    belief, table = pii.estimate([dict(zip(names, p), n=n) for p, n in patterns.items()])
    right = sum(n for k, n in seen.items() if (belief[list(patterns).index(k[:5])] > 0.5) == k[5])
    assert right / 4000 > 0.95
    assert table[0, 1, 2] > table[3, 1, 2] > 0.5


def test_pii_hard_rows(make, hard):
    got = pii.find(make(hard)).collect()
    assert len(got) == len(hard) and pii.find(make(hard).where("false")).count() == 0


INSULTS = ["idiot", "worthless", "moron"]


def toxic_rows():
    rng = random.Random(9)
    clean = ["river", "window", "letter", "summer", "garden", "silver", "market", "people", "morning", "thing"]
    disguise = lambda w: rng.choice([w, w, w.replace("o", "0"), w.replace("i", "1"), w[:2] + w[1] * 4 + w[2:], " ".join(w)])
    rows, truth = [], {}
    for i in range(600):
        words = rng.choices(clean, k=rng.randint(5, 40))
        truth[i] = int(i % 4 == 0)
        if truth[i]:
            word = rng.choice(INSULTS)
            words.insert(rng.randrange(len(words)), word if rest(i) else disguise(word))
        rows.append((i, " ".join(words)))
    return rows, truth


def test_toxicity_on_held_out_disguises(spark, make):
    rows, truth = toxic_rows()
    labels = spark.createDataFrame([(i, 0, t) for i, t in truth.items()], "doc_id long, quality int, toxic int")
    got = toxicity.score(make(rows), labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(rows) and {r.doc_id for r in held} == {i for i in truth if rest(i) == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert not any(r.predicted for r in held if not truth[r.doc_id])
    docs = make(rows)
    left = toxicity.reject(docs, labels)
    assert left.columns == docs.columns and {i for i, t in truth.items() if not t} <= {r.doc_id for r in left.collect()}


def test_held_out_labels_do_not_count(spark, make):
    rows, truth = toxic_rows()
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(i, 0, t) for i, t in truth.items()], schema)
    flipped = spark.createDataFrame([(i, 0, t if rest(i) else 1 - t) for i, t in truth.items()], schema)
    a, b = (sorted((r.doc_id, r.score) for r in toxicity.score(make(rows), x).collect()) for x in (labels, flipped))
    assert a == b


def test_a_rarer_insult_is_weighed_beside_a_common_one(spark, make):
    rng = random.Random(12)
    words = ["river", "window", "letter", "summer", "garden", "silver", "market", "people", "morning", "thing"]
    rows, truth = [], {}
    for i in range(3000):
        truth[i] = int(i % 3 == 0)
        insult = [] if not truth[i] else ["wretch"] if i % 150 == 0 else ["idiot"]
        rows.append((i, " ".join([*rng.choices(words, k=15), *insult, str(i)])))
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, toxic int")
    _, weights, _ = toxicity.fit(make(rows), labels)
    assert {b"idiot", b"wretch"} <= set(weights)


def test_the_fit_reads_all_patterns(spark):
    """Weights equal the optimum over every pattern, however often a pattern is there and whatever its label."""
    rng = random.Random(13)
    rows = collections.Counter()
    for _ in range(400):
        words = tuple(sorted(w for w in range(6) if rng.random() < 0.3))
        rows[words, int(rng.random() < 1 / (1 + math.exp(2 - sum(words))))] += 1
    patterns = spark.createDataFrame(
        [(list(w), rows[w, 1], rows[w, 0] + rows[w, 1]) for w in {w for w, _ in rows}], "words array<int>, k long, n long"
    )
    got, bias = toxicity._ridge_logistic(patterns.repartition(3), 6, -1.0)
    x = np.array([[w in words for w in range(6)] + [True] for words, _ in rows], dtype=float)
    y, n = np.array([t for _, t in rows]), np.array(list(rows.values()))
    p = 1 / (1 + np.exp(-x @ np.r_[got, bias]))
    assert np.abs(x.T @ (n * (p - y)) + 0.05 * np.r_[got, 0.0]).max() < 1e-2


@pytest.fixture(scope="module")
def memo():
    counts = np.zeros(toxicity.SIZE**toxicity.ORDER)
    clean = "river window letter summer garden silver market people morning thing it is in the of a an".split()
    text = " ".join(random.Random(4).choices(clean, k=4000) + ["idiot", "worthless", "stupid", "die", "ass"] * 30)
    s = [0, 0, 0, *text.encode().translate(toxicity.SYMBOL_BYTES), 0]
    for k in range(len(s) - 3):
        counts[((s[k] * 28 + s[k + 1]) * 28 + s[k + 2]) * 28 + s[k + 3]] += 1
    return toxicity.Restored(toxicity.character_model(counts))


@pytest.mark.parametrize("written,word", [
    ("worthle$$", "worthless"), ("an id1o+ it", "idiot"), ("1d107", "idiot"), ("@$$", "ass"), ("st" + "u" * 60 + "pid", "stupid"),
    ("d i e", "die"), ("an id iot is", "idiot"), ("an id.iot", "idiot"), ("wor-thless", "worthless"), ("st*pid", "stupid"),
    ("idiot!", "idiot"),
])
def test_each_disguise_is_restored(memo, written, word):
    assert word.encode() in toxicity.restored_words(written.encode(), memo)


def test_plain_words_stay(memo):
    assert toxicity.restored_words(b"The river, in summer. It is 100", memo) >= {b"the", b"river", b"in", b"summer", b"it", b"is", b"100"}
    assert toxicity.restored_words(b"a1" * 20_000, memo)


def test_parts_are_decoded_as_by_the_lattice(memo):
    rng = random.Random(6)
    parts = ["a", "i", "it", "of", "in", "the", "ass", "aa", "all", "will", "id", "iot", "aaa", "d", "e", "stu", "pid", "river"]
    for _ in range(3000):
        span = " ".join(rng.choices(parts, k=rng.randint(2, 9))).encode()
        assert toxicity.decode_parts(span, memo.model, memo.symbols).strip() == toxicity.decode(span, memo.model)
        assert toxicity.decode(span, np.array(memo.model, dtype=np.float32)) == toxicity.decode(span, memo.model)
    assert toxicity.restored_words(b"die  die d  i e", memo) >= {b"die", b"d", b"i", b"e"}


def test_toxicity_hard_rows(make, hard, labels):
    for docs in (make(hard), make(hard).where("false")):
        got = toxicity.score(docs, labels).collect()
        assert len(got) == docs.count() and all(0 < r.score < 1 for r in got)
    assert all(0 < r.score < 0.5 for r in toxicity.score(make(hard), labels.where("false")).collect())


def plain_tiles(a, b, least):
    """Greedy string tiling by its definition."""
    used_a, used_b, out = set(), set(), []
    while True:
        best = (0,)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and i + n not in used_a and j + n not in used_b:
                    n += 1
                best = max(best, (n, -i, -j))
        if best[0] < least:
            return out
        n, i, j = best[0], -best[1], -best[2]
        used_a |= set(range(i, i + n))
        used_b |= set(range(j, j + n))
        out.append(n)


def test_tiles_equal_the_definition():
    rng = random.Random(3)
    for _ in range(300):
        kinds = rng.choice([2, 4, 30])
        a = np.array([rng.randrange(kinds) for _ in range(rng.randint(0, 25))], dtype=np.uint64)
        b = np.array([rng.randrange(kinds) for _ in range(rng.randint(0, 40))], dtype=np.uint64)
        if len(a) > 8 and rng.random() < 0.7:
            b = np.r_[b[:5], a[len(a) // 2 :], b[5:9], a[: len(a) // 2]]
        got = decontaminate.tiles(a, b, 3)
        for i, j, n in got:
            assert (a[i : i + n] == b[j : j + n]).all()
        for part in (0, 1):
            spans = sorted((t[part], t[part] + t[2]) for t in got)
            assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        want = plain_tiles(a.tolist(), b.tolist(), 3)
        assert max((t[2] for t in got), default=0) == max(want, default=0)
        if kinds == 30:
            assert sum(t[2] for t in got) == sum(want)


def test_leaks(spark, make):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(500)]
    items = [rng.choices(words, k=30) for _ in range(6)]
    bench = spark.createDataFrame(
        [(k, " ".join(t)) for k, t in enumerate(items)] + [(None, None), (9, "too short"), (2, " ".join(items[2]))], "item_id long, text string"
    )
    noise = lambda n: rng.choices(words, k=n)
    rows = [
        (0, " ".join(noise(40) + items[0] + noise(40))),
        (1, " ".join(noise(9) + items[1][15:] + noise(9) + items[1][:15])),  # reordered
        (2, " ".join(noise(9) + items[2][:9] + noise(9))),  # too little of it
        (3, " ".join(noise(200))), (4, None), (5, (" ".join(items[3]) + ", ").upper() * 3), (None, " ".join(items[4])),
    ]
    docs = make(rows)
    got = {r.doc_id: r for r in decontaminate.leaks(docs, bench).collect()}
    assert {i: (r.contaminated, r.item_id) for i, r in got.items()} == {
        0: (True, 0), 1: (True, 1), 2: (False, None), 3: (False, None), 4: (False, None), 5: (True, 3), None: (True, 4)
    }
    assert got[1].tiles >= 2 and got[0].covered == 30
    left = decontaminate.without_leaks(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {2, 3, 4}
    assert decontaminate.leaks(docs, bench.where("false")).where("contaminated").count() == 0
    assert decontaminate.leaks(docs.where("false"), bench).count() == 0


def test_leaks_hard_rows(spark, make, hard):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (2, "a a a a a a")], "item_id long, text string")
    got = {r.doc_id: r.contaminated for r in decontaminate.leaks(make(hard), bench).collect()}
    assert set(got) == {i for i, _ in hard} and got[5] and not got[6]


def test_plain_spans_are_decoded_only_where_a_weighed_word_may_be(monkeypatch):
    rng = random.Random(3)
    known = {b"idiot", b"moron", b"mon", b"hello", b"stoop", b"zq" * 1500, "caf\u00e9".encode(), b"1d107"}
    texts = [
        " ".join("".join(rng.choice("idotsmrnhelpa") for _ in range(rng.randint(1, 5))) for _ in range(12)).encode()
        + rng.choice([b"", b" i d i o t", b" hel lo mo r on", b" st.oo.p", b" m o n", b" a  a a", b" 1 d 1 0 7", b" 1d107"])
        for _ in range(600)
    ]
    counts = np.zeros(toxicity.SIZE**toxicity.ORDER)
    seen = [0, 0, 0, *b" idiot moron mon hello stoop caf the ".translate(toxicity.SYMBOL_BYTES)]
    for window in zip(seen, seen[1:], seen[2:], seen[3:], strict=False):
        counts[int(np.polyval(window, toxicity.SIZE))] += 50
    model = toxicity.character_model(counts)
    every, some, none = toxicity.Restored(model), toxicity.Restored(model, known), toxicity.Restored(model, ())
    found = [toxicity.restored_words(t, every) & known for t in texts]
    assert sum(map(len, found)) > 200 and [toxicity.restored_words(t, some) & known for t in texts] == found
    decoded = []
    plain = toxicity.decode_parts
    monkeypatch.setattr(toxicity, "decode_parts", lambda *a: decoded.append(a[0]) or plain(*a))
    spans = []
    for memo in (every, some, none):
        decoded.clear()
        for t in texts:
            toxicity.restored_words(t, memo)
        spans.append(len(decoded))
    assert spans[0] > 2 * spans[1] > spans[2] == 0
