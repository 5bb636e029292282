"""Byte-level BPE encoding and decoding over ranked merges.

The words (pre-tokens) of all documents are counted, and Spark higher-order functions
fold the ranked merges over the byte array of each distinct frequent word, with the
rank of every mergeable pair in a literal. The result, at most ``hot_words`` words of
at most ``hot_bytes`` bytes, is a table of bounded size that goes to all tasks; it
covers nearly all word occurrences. A word outside it is folded where it stands, once
per Arrow batch, by the same merges in Python: interpreted higher-order functions take
about 0.2 ms a word, too long for the millions of rare words. No word occurrence is
shuffled, only distinct words with their counts. Decoding concatenates the binary
pieces of the ids.

A null text counts as empty; an empty text has no ids. Repeated rows are encoded alike,
columns other than the key and the text are not read, an empty table gives no rows. A
word of n bytes takes up to n - 1 folding steps.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm import pretoken
from parley.llm.common import hot_threshold, stage, strings, text_or_empty

RARE_WORDS = 100_000
LONG_WORD = 200  # bytes; longer words are folded by a heap
WIDTH = 3
ENTRY = 3 * WIDTH
HALVES = (140_009, 140_057)  # together over twice the pairs of a 50k vocabulary


def read_ranks(path: str) -> list[bytes]:
    """The pieces of a rank file by id (base64 piece, blank, rank)."""
    with open(path, "rb") as f:
        rows = [line.split() for line in f if line.strip()]
    out = [b""] * (max(int(r) for _, r in rows) + 1)
    for piece, rank in rows:
        out[int(rank)] = base64.b64decode(piece)
    return out


def pair_ranks(pieces: list[bytes]) -> dict[bytes, bytes]:
    """Ids of two pieces -> id of the joined piece, for every pair that merges. Ids are
    WIDTH bytes, high byte first, so that they sort as ranks."""
    ids = {p: i.to_bytes(WIDTH, "big") for i, p in enumerate(pieces) if p}
    return {ids[p[:k]] + ids[p[k:]]: i for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}


def rank_map(pieces: list[bytes]) -> Column:
    """The literal rank map: one binary literal that holds a hash table. Spark searches a
    map literal from its start and ships an array literal as one object per element;
    ``substring`` of a binary is direct. An entry (pair, rank) lies at its place in the
    one half or in the other (cuckoo hashing), so a look-up reads two places."""
    slots: list[bytes] = [b"\xff" * ENTRY] * sum(HALVES)
    for pair, rank in pair_ranks(pieces).items():
        entry, half = pair + rank, 0
        for _ in range(500):
            place = zlib.crc32(entry[:2 * WIDTH]) % HALVES[half] + half * HALVES[0]
            slots[place], entry = entry, slots[place]
            if entry == b"\xff" * ENTRY:
                break
            half = int(place < HALVES[0])
        else:
            raise ValueError("the rank map needs larger HALVES")
    return F.lit(bytearray(b"".join(slots)))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def byte_ids(word: Column, pieces: list[bytes]) -> Column:
    """A word's bytes as ids of one-byte pieces, taken from a literal of 256 ids."""
    ids = {p: i.to_bytes(WIDTH, "big") for i, p in enumerate(pieces)}
    of_byte = F.lit(bytearray(b"".join(ids[bytes([b])] for b in range(256))))
    data = F.encode(word, "utf-8")
    at = lambda i: F.conv(F.hex(F.substring(data, i, F.lit(1))), 16, 10).cast("int") * WIDTH + 1
    each = F.transform(F.sequence(F.lit(1), F.octet_length(word)), lambda i: F.substring(of_byte, at(i), F.lit(WIDTH)))
    return F.when(F.octet_length(word) > 0, each).otherwise(F.array().cast("array<binary>"))


def merge_fold(start: Column, ranks: Column) -> Column:
    """Fold the ranked merges over an array of ids: each step joins the leftmost pair of
    the least rank, until no pair has one. The state holds ids and the pairs' ranks, so
    a step looks up only the two pairs that it changes."""
    def rank(a: Column, b: Column) -> Column:
        return let(F.concat(a, b), lambda pair: let(F.crc32(pair), lambda h: let(
            F.substring(ranks, (h % HALVES[0]).cast("int") * ENTRY + 1, F.lit(ENTRY)), lambda one: F.when(
                F.substring(one, 1, 2 * WIDTH) == pair, F.substring(one, 2 * WIDTH + 1, WIDTH)).otherwise(let(
                    F.substring(ranks, (h % HALVES[1] + HALVES[0]).cast("int") * ENTRY + 1, F.lit(ENTRY)), lambda two: F.when(
                        F.substring(two, 1, 2 * WIDTH) == pair, F.substring(two, 2 * WIDTH + 1, WIDTH)).otherwise(never))))))

    def step(state: Column, _: Column) -> Column:
        return let(F.coalesce(F.array_min(state["r"]), never), lambda least: F.when(least == never, state).otherwise(
            let(F.array_position(state["r"], least).cast("int"), lambda i: merged(state, least, i))))

    def merged(state: Column, least: Column, i: Column) -> Column:
        p, r = state["p"], state["r"]
        n = F.size(p)
        left = F.when(i > 1, F.concat(F.slice(r, F.lit(1), i - 2), F.array(rank(F.get(p, i - 2), least)))).otherwise(none)
        right = F.when(i + 1 < n, F.concat(F.array(rank(least, F.get(p, i + 1))), F.slice(r, i + 2, n))).otherwise(none)
        return F.struct(F.concat(F.slice(p, F.lit(1), i - 1), F.array(least), F.slice(p, i + 2, n)).alias("p"),
                        F.concat(left, right).alias("r"))

    never = F.lit(bytearray(b"\xff" * WIDTH))
    none = F.array().cast("array<binary>")
    first = F.struct(start.alias("p"), F.when(F.size(start) > 1, F.transform(
        F.sequence(F.lit(0), F.size(start) - 2), lambda k: rank(F.get(start, k), F.get(start, k + 1)))).otherwise(none).alias("r"))
    steps = F.when(F.size(start) > 1, F.sequence(F.lit(2), F.size(start))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, first, step, lambda s: s["p"])


def encode_word(word: Column, pieces: list[bytes], ranks: Column) -> Column:
    """Ids of one pre-token: WIDTH bytes each, high byte first, joined."""
    # the literal stands once in the plan, whose text Spark keeps on the driver
    return let(ranks, lambda held: let(byte_ids(word, pieces), lambda b: F.aggregate(
        merge_fold(b, held), F.lit(bytearray()), lambda a, x: F.concat(a, x))))


def fold_word(word: bytes, byte_id: list[int], ranks: dict[int, int]) -> bytes:
    """The same fold in Python, for words that are not in the table: ids as unsigned
    32-bit integers, low byte first."""
    if len(word) > LONG_WORD:
        return fold_long(word, byte_id, ranks)
    ids = [byte_id[b] for b in word]
    never, rank = 1 << 40, ranks.get
    row = [rank(a << 24 | b, never) for a, b in zip(ids, ids[1:], strict=False)]
    while row:
        least = min(row)
        if least == never:
            break
        at = row.index(least)
        ids[at:at + 2] = [least]
        del row[at]
        if at:
            row[at - 1] = rank(ids[at - 1] << 24 | least, never)
        if at < len(row):
            row[at] = rank(least << 24 | ids[at + 1], never)
    return array("I", ids).tobytes()


def fold_long(word: bytes, byte_id: list[int], ranks: dict[int, int]) -> bytes:
    """``fold_word`` with a heap of (rank, place) over a linked list: n log n steps for n bytes."""
    ids, n = [byte_id[b] for b in word], len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    rank = ranks.get
    heap = [(r, k) for k in range(n - 1) if (r := rank(ids[k] << 24 | ids[k + 1])) is not None]
    heapify(heap)
    while heap:
        r, k = heappop(heap)
        right = after[k]
        # the pair is stale if one of its ends has been merged since
        if ids[k] < 0 or right >= n or rank(ids[k] << 24 | ids[right]) != r:
            continue
        ids[k], ids[right] = r, -1
        after[k] = nxt = after[right]
        if nxt < n:
            before[nxt] = k
            if (new := rank(r << 24 | ids[nxt])) is not None:
                heappush(heap, (new, k))
        if (prev := before[k]) >= 0 and (new := rank(ids[prev] << 24 | r)) is not None:
            heappush(heap, (new, prev))
    return array("I", [x for x in ids if x >= 0]).tobytes()


def _widened(ids: bytes) -> bytes:
    """Ids of WIDTH bytes, high byte first, as unsigned 32-bit integers, low byte first."""
    return array("I", [int.from_bytes(ids[k:k + WIDTH], "big") for k in range(0, len(ids), WIDTH)]).tobytes()


def word_counts(docs: DataFrame, kind: str, text_col: str = "text") -> DataFrame:
    """(word, n) over all documents: counted per batch, then summed per word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = pretoken.char_classes() if kind == "gpt" else None
        for batch in batches:
            for _, words, codes, _ in pretoken.slices(strings(batch.column(0)), kind, classes):
                yield pa.RecordBatch.from_arrays([words, pa.array(np.bincount(codes, minlength=len(words)))], ["word", "n"])

    return (docs.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def frequent(counts: DataFrame, hot_words: int, hot_bytes: int) -> DataFrame:
    """The most frequent words: at most ``hot_words``, of at most ``hot_bytes`` bytes."""
    short = counts.filter(F.octet_length("word") <= hot_bytes)
    return short.filter(F.col("n") >= hot_threshold(short, "n", hot_words))


def encode(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text",
           hot_words: int = 100_000, hot_bytes: int = 48, decoded: bool = False) -> DataFrame:
    """(id_col, n_tokens long, ids binary) for every row of ``docs``; ids are unsigned
    32-bit integers, low byte first. ``decoded`` adds ``data``, what ``decode`` makes of
    the ids, in the same pass: half as many Python workers as two passes."""
    pieces = read_ranks(ranks_path)
    counts = stage(word_counts(docs, "gpt", text_col), "bpe-words")
    ranks = rank_map(pieces)
    known = frequent(counts, hot_words, hot_bytes).select("word", encode_word(F.col("word"), pieces, ranks).alias("ids")).collect()
    table = docs.sparkSession.sparkContext.broadcast({r["word"]: _widened(bytes(r["ids"])) for r in known})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, hot = pretoken.char_classes(), table.value
        of_byte = {p: i for i, p in enumerate(pieces) if len(p) == 1}
        byte_id = [of_byte[bytes([b])] for b in range(256)]
        merges = {int.from_bytes(k[:WIDTH], "big") << 24 | int.from_bytes(k[WIDTH:], "big"): int.from_bytes(v, "big")
                  for k, v in pair_ranks(pieces).items()}
        rare: dict[str, bytes] = {}
        of = np.array(pieces, object)
        for batch in batches:
            keys = batch.column(0)
            for first, words, codes, bounds in pretoken.slices(strings(batch.column(1)), "gpt", classes):
                found = []
                for word in words.to_pylist():
                    got = hot.get(word) or rare.get(word)
                    if got is None:
                        got = rare[word] = fold_word(word.encode(), byte_id, merges)
                    found.append(got)
                if len(rare) > RARE_WORDS:  # a memory of words, not a limit on them
                    rare.clear()
                flat, sizes = np.frombuffer(b"".join(found), "<u4"), np.array([len(x) // 4 for x in found], np.int64)
                begins = np.cumsum(sizes) - sizes
                n = sizes[codes]
                ends = np.concatenate([[0], np.cumsum(n)])
                out = flat[np.repeat(begins[codes] - ends[:-1], n) + np.arange(ends[-1])] if len(flat) else flat
                at = ends[bounds]
                ids = [out[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                data = [pa.array([joined(x, of) for x in ids], pa.binary())] if decoded else []
                yield pa.RecordBatch.from_arrays([keys.slice(first, len(at) - 1), pa.array(np.diff(at)), pa.array(ids, pa.binary()), *data],
                                                 [id_col, "n_tokens", "ids", "data"][:3 + decoded])

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(
        run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens long, ids binary" + ", data binary" * decoded)


def joined(ids: bytes, pieces: np.ndarray) -> bytes:
    """Decoding: the binary pieces of the ids, one after the other."""
    return b"".join(pieces[np.frombuffer(ids, "<u4")].tolist())


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``encoded`` with a column ``data``: the bytes of the ids' pieces, joined. Null ids
    give null, no ids give empty bytes; a column named ``data`` is replaced."""
    pieces = read_ranks(ranks_path)
    kept = encoded.drop("data")
    names, place = kept.columns, kept.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = np.array(pieces, object)
        for batch in batches:
            data = [None if x is None else joined(x, of) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(data, pa.binary())], [*names, "data"])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("data", T.BinaryType())]))
