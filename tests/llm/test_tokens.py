"""Encoding, token files and token counts against the public libraries."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from outagegrid.llm import bpe, token_counts, token_files, token_ids
from outagegrid.llm.units import units

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
PIECES = [
    "a", "th", "the", " ", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "é", "ü", "'s", "'ll", "'",
    "1", "23", "½", "٣", ".", ",", "日本", "🙂", "​", "ſ", "İ", "<|endoftext|>", "\x00", "﻿", "\r\n", "running", "Zw",
]


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 20))) for _ in range(400)]


def test_units_never_cut_a_match(reference, texts):
    for t in texts:
        first, rest = units(t)
        parts = ([] if first is None else [first]) + [" " + u for u in rest]
        assert [i for p in parts for i in reference.encode_ordinary(p)] == reference.encode_ordinary(t)


def test_encode_equals_the_library(make, reference, texts):
    for chunk in (1, 500, 10**7):
        rows = bpe.encode(make(texts), RANKS, P.PATTERN, chunk_bytes=chunk).collect()
        assert len(rows) == len(texts)
        for r in rows:
            assert np.frombuffer(r.tokens, "<u4").tolist() == reference.encode_ordinary(texts[r.doc_id])
            assert bytes(r.decoded) == texts[r.doc_id].encode()


def test_fold_by_higher_order_functions(spark, reference):
    words = ["the", " running", "unbelievable", "xzqj", "é", "日本", "🙂🙂", "aaaaaaaa", " antidisestablishmentarianism", "a"]
    df = spark.createDataFrame([(bytearray(w.encode()),) for w in words], "word binary")
    got = {bytes(r.word).decode(): (list(r.tokens), bytes(r.decoded)) for r in bpe.fold_words(df, RANKS).collect()}
    assert got == {w: (reference.encode_ordinary(w), w.encode()) for w in words}


def test_encode_hard_rows(make, hard, reference):
    rows = bpe.encode(make(hard), RANKS, P.PATTERN).collect()
    got = sorted((r.doc_id or -1, bytes(r.decoded), len(r.tokens) // 4) for r in rows)
    assert got == sorted((i or -1, (t or "").encode(), len(reference.encode_ordinary(t or ""))) for i, t in hard)
    assert bpe.encode(make(hard).where("false"), RANKS, P.PATTERN).count() == 0


def test_known_words_are_not_asked_for_again(monkeypatch):
    """Not from text to text, not before another mark, and not when there is no room to remember them for good."""
    monkeypatch.setattr(token_ids, "MOST_UNITS", 2)
    definition = token_ids.read_definition(P.path("byte_bpe_50k.json"))
    encoder, library, asked = token_ids.TextEncoder(definition), Tokenizer.from_str(definition), []
    tokenize = encoder.tokenizer.model.tokenize
    monkeypatch.setattr(encoder, "tokenize", lambda w: asked.append(w) or tokenize(w), raising=False)
    texts = ["The wide river, the river. A river; rivières 12", "rivières. The wide the river\n river's  12, 12", "", " wide"]
    for text in texts * 2:
        ids = np.frombuffer(encoder.encode([text])[0], "<u2")
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert "\u0120river" in asked and len(asked) == len(set(asked))


def test_a_space_that_touches_is_found():
    for white in (" ", "\t", "\r", "\x85", "\xa0", "\u2003", "\u3000"):
        assert units(f"a b {white}c") == (f"a b {white}c", []) and units(f"a{white} b") == (f"a{white} b", [])
    assert units("a\u2003b c\n") == ("a\u2003b", ["c\n"])


def test_token_files_round_trip(spark, make, tokenizer, texts, tmp_path):
    path = str(tmp_path / "files")
    docs = make([((i * 37) % 401, t) for i, t in enumerate(texts)])
    token_files.write(docs, path, JSON, end_id=2, shard_bytes=300)
    got = {r.doc_id: r for r in token_files.read(spark, path).collect()}
    at = 0
    for i, t in sorted(((i * 37) % 401, t) for i, t in enumerate(texts)):
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens) == (at, len(ids))
        assert zlib.crc32(got[i].ids) == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
        if i % 100 == 0:
            assert token_files.read_document(spark, path, i) == [ids]
    shards = spark.read.parquet(f"{path}/shards")
    name = spark.read.parquet(f"{path}/dictionary").first()["hash"]
    assert {r.dictionary for r in shards.collect()} == {name} and shards.count() > 4


def test_token_files_hard_rows(spark, make, hard, tmp_path):
    for n, docs in enumerate((make(hard), make(hard).where("false"))):
        path = str(tmp_path / f"files{n}")
        token_files.write(docs, path, JSON, end_id=2)
        rows = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
        assert len(rows) == (0 if n else len(hard))
        assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
        assert [r.doc_id for r in rows] == sorted((r.doc_id for r in rows), key=lambda i: -1 if i is None else i)


def brute_counts(tokenizer, document, ends):
    counts = [0] * len(ends)
    for a, b in tokenizer.encode(document, add_special_tokens=False).offsets:
        shares = [min(b, e) - max(a, s) for s, e in zip([0, *ends[:-1]], ends)]
        counts[max(range(len(ends)), key=lambda k: (shares[k], -k))] += 1
    return counts


@pytest.mark.parametrize("separator", ["\n", " ", " -- "])
def test_counts_follow_the_rule(make, tokenizer, texts, separator):
    rows = token_counts.attribute(make(texts), JSON, ["source", "lang", "text"], separator=separator).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    crossing = 0
    for i, t in enumerate(texts):
        mine = sorted(by[i], key=lambda r: (["source", "lang", "text"].index(r.field), r.section))
        document = separator.join(["src", "en", t])
        assert [r.end for r in mine][-1] == len(document) and [r.start for r in mine][1:] == [r.end for r in mine][:-1]
        assert [r.n_tokens for r in mine] == brute_counts(tokenizer, document, [r.end for r in mine])
        crossing += sum(r.n_crossing for r in mine)
    assert crossing > 0


def test_counts_hard_rows(make, hard, tokenizer):
    rows = token_counts.attribute(make(hard), JSON, ["text"]).collect()
    want = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t in hard)
    assert sum(r.n_tokens for r in rows) == want
    assert token_counts.attribute(make(hard).where("false"), JSON, ["text"]).count() == 0
