"""Removal of repeated passages: runs of two lines or more, and long single lines.

A text's lines are hashed; a rolling hash over the hashes of ``window`` lines ends a
chunk where it is divisible by ``divisor`` (once the chunk has ``min_lines`` lines). As
such boundaries depend on the line before a passage, every run of ``min_lines``
successive lines that are not blank (with the blank lines between them) is a chunk as
well: a repeated passage is a chain of repeated runs, so it goes whole, wherever its
neighbours make the boundaries fall and however far it reaches. Lines of over
``line_words`` words are chunks by themselves. Chunks that are not blank and occur in
several places are repeats: the first (smallest id, then place) stays, every other one is
removed, after its bytes have been compared with the first one's. The earliest
occurrence of a line is in no repeat, so no line is lost from all texts.

Hashes are grouped in a narrow table of chunks; texts are moved, compressed, only for two
joins on a document key (to fetch the first occurrences, and to compare and cut). A chunk in very
many documents is a hot key of plain joins and of partially aggregated groups only.

A null text stays null and has no chunks; lines are split at line feeds alone, so
joining the kept lines restores an untouched text exactly. Rows that agree in id and
text count as one occurrence and are cut alike. A null id sorts first. Extra columns pass through (``removed_lines``, which
is added, replaces a column of that name); an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.llm.common import stage

PRIME = 0x9E3779B97F4A7C15
WORD = (1 << 64) - 1


def chunk_spans(lines: list[str], window: int = 2, divisor: int = 2, min_lines: int = 2) -> list[tuple[int, int]]:
    """(first line, number of lines) of the chunks of a text: all runs of ``min_lines``
    successive lines that are not blank, and the rolling hash's chunks that reach
    further (their first or last line is blank)."""
    import xxhash

    hashes = [xxhash.xxh64_intdigest(line.encode()) for line in lines]
    drop = pow(PRIME, window, 1 << 64)
    full = [k for k, line in enumerate(lines) if line.strip()]
    spans = [(a, b + 1 - a) for a, b in zip(full, full[min_lines - 1:], strict=False)]
    seen, start, rolling = set(full), 0, 0

    def add(stop: int) -> None:
        if start not in seen or stop - 1 not in seen or stop - start < min_lines:
            spans.append((start, stop - start))

    for i, h in enumerate(hashes):
        rolling = (rolling * PRIME + h - (hashes[i - window] * drop if i >= window else 0)) & WORD
        if i + 1 - start >= min_lines and (rolling >> 20) % divisor == 0:
            add(i + 1)
            start = i + 1
    if start < len(lines):
        add(len(lines))
    return spans


def packed(text: str | None) -> bytes | None:
    """A text as its length and Zstandard bytes (less to shuffle than rows of plain text)."""
    data = text.encode() if text is not None else None
    return None if data is None else len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpacked(data: bytes | None) -> str | None:
    return None if data is None else pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True).decode()


def pack_text(rows: DataFrame, text_col: str) -> DataFrame:
    place = rows.columns.index(text_col)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = pa.array([packed(x) for x in batch.column(place).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([data if k == place else c for k, c in enumerate(batch.columns)], batch.schema.names)

    return rows.mapInArrow(pack, T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == text_col else f for f in rows.schema.fields]))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   window: int = 2, divisor: int = 2, min_lines: int = 2, line_words: int = 50) -> DataFrame:
    """``docs`` with repeated chunks cut from the text and ``removed_lines`` int."""
    def spans_of(text: str) -> tuple[list[str], list[tuple[int, int]]]:
        lines = text.split("\n")
        long = [(k, 1) for k, line in enumerate(lines) if len(line) > 2 * line_words and len(line.split()) > line_words]
        if len(lines) < min_lines:
            return lines, long
        return lines, long + [(a, n) for a, n in chunk_spans(lines, window, divisor, min_lines)
                              if n >= max(min_lines, 2) and any(x.strip() for x in lines[a:a + n])]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            at, start, n, h = [], [], [], []
            for k, text in enumerate(batch.column(2).to_pylist()):
                lines, spans = spans_of(text or "")
                for a, m in spans:
                    at.append(k)
                    start.append(a)
                    n.append(m)
                    h.append(xxhash.xxh3_128_digest("\n".join(lines[a:a + m]).encode()))
            pick = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pick), batch.column(1).take(pick), pa.array(start, pa.int32()),
                                              pa.array(n, pa.int32()), pa.array(h, pa.binary())], ["id", "key", "start", "n", "hash"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, start, h, body = [], [], [], []
            for k, (text, wanted) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                lines = unpacked(text).split("\n")
                for w in wanted:
                    at.append(k)
                    start.append(w["start"])
                    h.append(w["hash"])
                    body.append("\n".join(lines[w["start"]:w["start"] + w["n"]]))
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.binary()), pa.array(body, pa.string()), batch.column(0).take(pa.array(at, pa.int64())),
                                              pa.array(start, pa.int32())], ["hash", "body", "first_key", "first_start"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed = [], []
            for data, marks in zip(batch.column(place).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                gone: set[int] = set()
                text = unpacked(data)
                if marks:
                    lines = text.split("\n")
                    for m in marks:
                        span = range(m["start"], m["start"] + m["n"])
                        if "\n".join(lines[span.start:span.stop]).encode() == m["body"].encode():
                            gone.update(span)
                    text = "\n".join(x for k, x in enumerate(lines) if k not in gone) if gone else text
                texts.append(text)
                removed.append(len(gone))
            columns = [pa.array(texts, pa.string()) if k == place else batch.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int32())], [*names, "removed_lines"])

    base = docs.drop("removed_lines")
    names, place = base.columns, base.columns.index(text_col)
    # positions, so that no name of an extra column can clash with the working columns
    work = base.toDF(*[f"c{k}" for k in range(len(names))])
    own_id, own_text = f"c{names.index(id_col)}", f"c{place}"
    work = work.withColumn(own_text, F.col(own_text).cast("string")).withColumn("key", F.xxhash64(own_id, own_text))
    id_kind = base.schema[id_col].dataType.simpleString()
    found = stage(work.select(F.col(own_id).alias("id"), "key", own_text).mapInArrow(
        chunks, f"id {id_kind}, key long, start int, n int, hash binary"), "chunks")
    once = stage(found.distinct(), "chunk-places")
    repeats = once.groupBy("hash").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("id", "key", "start", "n")).alias("first")).filter("times > 1")
    firsts = repeats.groupBy(F.col("first.key").alias("key")).agg(F.collect_list(
        F.struct(F.col("first.start").alias("start"), F.col("first.n").alias("n"), "hash")).alias("wanted"))
    # one row per repeated chunk (rows that agree in id and text count once); the places
    # then meet it in a single join, whose hot hashes Spark splits
    bodies = pack_text(work.select("key", own_text), own_text).join(firsts, "key").dropDuplicates(["key"]).select("key", own_text, "wanted").mapInArrow(
        fetch, "hash binary, body string, first_key long, first_start int")
    others = once.join(bodies, "hash").filter(~((F.col("key") == F.col("first_key")) & (F.col("start") == F.col("first_start"))))
    marks = others.groupBy("key").agg(F.collect_list(F.struct("start", "n", "body")).alias("marks"))
    joined = pack_text(work, own_text).join(marks, "key", "left").select(*[f"c{k}" for k in range(len(names))], "marks")
    fields = [T.StructField(f.name, T.StringType()) if f.name == text_col else f for f in base.schema.fields]
    return joined.mapInArrow(cut, T.StructType([*fields, T.StructField("removed_lines", T.IntegerType())]))
