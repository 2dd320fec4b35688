from __future__ import annotations

import base64
import hashlib
import random
import time
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from heliovane.llm import bpe
from heliovane.llm.bpe import blocks, byte_bpe, read_ranks, token_digest

PATHS = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


def reference(name):
    with open(public_tokenizers.path(name), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def texts():
    rng = random.Random(11)
    letters = "abcdefghij ABC 012 .,!'\n\téü漢\U0001f600​ \x1c\x85 "
    yield from (None, "", " ", "\n\n  \n", "don't we'll 'S", "<|endoftext|>", "a" * 3000, "ab" * 2000)
    yield "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(2500))
    yield "word " * 20_000
    for _ in range(150):
        yield "".join(rng.choice(letters) for _ in range(rng.randrange(200)))


@pytest.mark.parametrize("name", PATHS)
def test_equals_the_library(spark, documents, name):
    given = dict(enumerate(texts()))
    docs = documents(*given.items(), (3, "\n\n  \n"), (None, "no id"))
    out = byte_bpe(docs, public_tokenizers.path(name), public_tokenizers.PATTERN)
    encoding = reference(name)
    rows = out.select("*", token_digest(out["ids"]).alias("digest")).collect()
    assert len(rows) == len(given) + 2
    for row in rows:
        text = given.get(row["doc_id"], "no id") or ""
        assert row["ids"] == encoding.encode_ordinary(text)
        assert bytes(row["decoded"]) == text.encode()
        assert row["digest"] == hashlib.sha256(" ".join(map(str, row["ids"])).encode()).hexdigest()


def test_blocks_keep_words():
    import regex

    rng = random.Random(2)
    find = regex.compile(public_tokenizers.PATTERN).findall
    for _ in range(300):
        text = "".join(rng.choice("ab '.  \n1é") for _ in range(300))
        cut = list(blocks(text, 20))
        assert "".join(cut) == text
        assert [w for piece in cut for w in find(piece)] == find(text)


def test_small_blocks_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "WORD_BLOCK", 100)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    monkeypatch.setattr(bpe, "TEXT_BLOCK", 500)
    given = [t or "" for t in texts()]
    batches = [pa.record_batch({"doc_id": range(len(given)), "text": given})]
    with open(public_tokenizers.path(PATHS[0]), "rb") as file:
        out = list(bpe._encode_batches(batches, file.read(), public_tokenizers.PATTERN, 500))
    ids = [x for batch in out for x in batch.column(1).to_pylist()]
    assert len(out) > 5 and ids == [reference(PATHS[0]).encode_ordinary(t) for t in given]


def test_a_task_holds_little():
    """Two tasks of an executor, each with the words of 4 million characters and arrays for each of them, took too much memory."""
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshr", k=rng.randrange(2, 9))) for _ in range(40_000)]
    given = [" ".join(rng.choices(words, k=2_000)) for _ in range(400)]
    with open(public_tokenizers.path(PATHS[0]), "rb") as file:
        ranks = file.read()
    bpe._encoder(ranks).learn({" " + word for word in words})
    batches = [pa.record_batch({"doc_id": range(len(given)), "text": given})]
    tracemalloc.start()
    sizes = [len(batch) for batch in bpe._encode_batches(batches, ranks, public_tokenizers.PATTERN)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == len(given) and len(sizes) > 3
    assert peak < 30 << 20


def test_every_token_of_the_vocabulary_survives():
    with open(public_tokenizers.path(PATHS[0]), "rb") as file:
        encoder = bpe.Encoder(file.read())
    # Tokens that are valid text come back as themselves, whatever the merges of their bytes would give.
    words = {}
    for token, rank in encoder.ranks.items():
        try:
            words[token.decode()] = rank
        except UnicodeDecodeError:
            pass
    encoder.learn(set(words))
    for word, rank in words.items():
        assert encoder.recent[word] == (rank.to_bytes(4, "little"), word.encode())


def long_words():
    rng = random.Random(13)
    yield "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=100_000))
    yield "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(30_000))
    yield "".join(rng.choices(["the", "漢字", "ing", "q", "é", "かな"], k=5_000))
    yield "".join(rng.choices("etaoin", k=2_000))


@pytest.mark.parametrize("name", PATHS)
def test_long_words_come_apart(name):
    """Letters without a break by the hundred thousand once took hours."""
    with open(public_tokenizers.path(name), "rb") as file:
        encoder = bpe.Encoder(file.read())
    encoding, given = reference(name), list(long_words())
    start = time.perf_counter()
    encoder.learn(set(given))
    assert time.perf_counter() - start < 60
    for word in given:
        ids, decoded = encoder.recent[word]
        assert np.frombuffer(ids, "<i4").tolist() == encoding._encode_single_piece(word)
        assert decoded == word.encode()
    assert len(encoder._apart(given[0].encode())) > 10_000


def test_no_token_lies_across_a_cut():
    with open(public_tokenizers.path(PATHS[0]), "rb") as file:
        encoder = bpe.Encoder(file.read())
    rng = random.Random(17)
    for _ in range(50):
        piece = "".join(rng.choices("abcxyzqjé漢1", k=rng.randrange(2, 80))).encode()
        parts = encoder._apart(piece)
        assert b"".join(parts) == piece and all(parts)
        cuts = {sum(map(len, parts[:k])) for k in range(1, len(parts))}
        free = {
            p for p in range(1, len(piece))
            if not any(piece[a:b] in encoder.ranks for a in range(p) for b in range(p + 1, len(piece) + 1))
        }
        assert cuts == free


def test_columns_of_any_name(documents):
    docs = documents((1, "two words")).withColumns({n: F.lit("clash") for n in ("ids", "decoded", "a.b")})
    (row,) = byte_bpe(docs, public_tokenizers.path(PATHS[0]), public_tokenizers.PATTERN).collect()
    assert row["ids"] == reference(PATHS[0]).encode_ordinary("two words") and bytes(row["decoded"]) == b"two words"


def test_no_vocabulary_without_all_bytes():
    with pytest.raises(ValueError):
        bpe.Encoder(b"YQ== 0\n")
    assert read_ranks(b"YQ== 0\nYg== 1\n") == {b"a": 0, b"b": 1}


def test_empty_table(documents):
    out = byte_bpe(documents(), public_tokenizers.path(PATHS[0]), public_tokenizers.PATTERN)
    assert out.collect() == []
