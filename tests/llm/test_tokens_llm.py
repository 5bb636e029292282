"""Splits, token counts and byte-level BPE against the libraries."""

import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
import regex
import sentencepiece
import tiktoken

from parley.llm import bpe, pretoken, tokens

RANKS, MODEL = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", None, " ", "  two  spaces ", "it's we'll 'street ''s 's's", "line one.\nline two\t\ttabs \n", "naïve café 中文 😀😀 ²½ ٣",
         "the the the the", "<s> </s> <0x0A> <|endoftext|>", "▁under ▁▁score", "x" * 700, "word " * 3000, "a b\x00c", "the the the the"]


def random_texts(n, seed):
    rng = random.Random(seed)
    signs = list("ab '\"stredmvl1 2\n\t   é中!?.😀²▁") + ["'s", "'re", "'ll", "the ", " the", "<s>"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def docs_of(spark, texts):
    rows = [(k if k != 3 else None, t, "clash", 7) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids long")


@pytest.fixture(scope="module")
def library():
    pieces = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={p: k for k, p in enumerate(pieces)}, special_tokens={})


def test_split_is_the_pattern():
    pattern, classes, texts = regex.compile(public_tokenizers.PATTERN), pretoken.char_classes(), random_texts(5000, 1)
    at = 0
    for first, words, codes, bounds in pretoken.slices(texts, "gpt", classes):
        words = words.to_pylist()
        for k in range(len(bounds) - 1):
            assert [words[c] for c in codes[bounds[k]:bounds[k + 1]]] == pattern.findall(texts[first + k])
            at += 1
    assert at == len(texts)


@pytest.mark.parametrize("hot", [0, 40, 100_000])
def test_bpe_is_the_library(spark, library, hot):
    texts = TEXTS + random_texts(150, 2)
    docs = docs_of(spark, texts)
    rows = bpe.decode(bpe.encode(docs, RANKS, hot_words=hot), RANKS).collect()
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], hashlib.sha256(r["ids"]).hexdigest(), bytes(r["data"])) for r in rows)
    want = []
    for k, t in enumerate(texts):
        ids = np.array(library.encode_ordinary(t or ""), "<u4")
        want.append((k if k != 3 else -1, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), (t or "").encode()))
    assert got == sorted(want)
    once = bpe.encode(docs, RANKS, hot_words=hot, decoded=True).collect()
    assert sorted((r["n_tokens"], bytes(r["ids"]), bytes(r["data"])) for r in once) == sorted((r["n_tokens"], bytes(r["ids"]), bytes(r["data"])) for r in rows)
    assert bpe.encode(docs.limit(0), RANKS).count() == 0


def test_token_counts_are_the_library(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = TEXTS + random_texts(300, 3)
    for hot in (0, 1 << 18):
        rows = tokens.token_counts(docs_of(spark, texts), MODEL, hot_words=hot).collect()
        got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"]) for r in rows)
        assert got == sorted((k if k != 3 else -1, len((t or "").encode()), len(model.encode(t or ""))) for k, t in enumerate(texts))
    assert tokens.token_counts(docs_of(spark, texts).limit(0), MODEL).count() == 0


def test_long_words():
    pieces = bpe.read_ranks(RANKS)
    ranks = {p: i for i, p in enumerate(pieces)}
    byte_id = [ranks[bytes([b])] for b in range(256)]
    merges = {int.from_bytes(k[:bpe.WIDTH], "big") << 24 | int.from_bytes(k[bpe.WIDTH:], "big"): int.from_bytes(v, "big") for k, v in bpe.pair_ranks(pieces).items()}
    known = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(4)
    for word in ["a" * 501, "ab" * 300, "".join(rng.choice("etaoinshrdlu") for _ in range(3000)), "日本語" * 200, "".join(rng.choice("aé ") for _ in range(999))]:
        data = word.encode()
        assert list(memoryview(bpe.fold_long(data, byte_id, merges)).cast("I")) == known.encode(word)
        assert bpe.fold_long(data[:150], byte_id, merges) == bpe.fold_word(data[:150], byte_id, merges)
    start = time.time()
    bpe.fold_word(("".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))).encode(), byte_id, merges)
    assert time.time() - start < 30
