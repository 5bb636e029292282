"""SimHash near-duplicates: fingerprints of word shingles, pigeonhole blocks, Hamming check.

A fingerprint bit is set if it is set in over half of the 64-bit XXH64 values (seed 42)
of the text's word shingles, repeats included. Fingerprints link at ``max_bits`` or
fewer differing bits; components follow the links.

Everything after the fingerprints works on distinct fingerprints (one class of equal
fingerprints is one row, however many documents share it). Two fingerprints that
differ in k bits agree on at least one of k + 1 blocks, so distinct fingerprints join
on their blocks and each pair's distance is then verified. A block value shared by more than
``crowd`` distinct fingerprints is not paired out: there, two fingerprints are at most
2 * r bits apart exactly if some centre lies within r bits of both (r = max_bits / 2
rounded up), so each member is joined to the centres within r bits of it over the bits
outside the block, and every member of a centre is verified against the centre's
smallest member; for max_bits = 2 any two members of one centre are linked. That work
grows in proportion to the rows.

A null text counts as empty. A text without words has fingerprint zero and links like
any other. A null id is returned with its fingerprint but never names a component:
it takes the smallest id that it reaches, null if there is none. Repeated rows are all returned;
columns other than the key and the text are not read; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import stage, strings, text_or_empty
from parley.llm.components import connected_components

CHUNK = 1 << 16  # shingles whose bits are counted at a time


def fingerprint(text: str, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text."""
    import xxhash

    words = text.encode().lower().split()  # bytes: only A-Z are lowered, only \\x20 and \\x09-\\x0D split
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - shingle + 1, 1)
    begins, ends = starts[:n].tolist(), ends[-n:].tolist()
    counts = np.zeros(64, np.int64)
    for k in range(0, n, CHUNK):
        part = [xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(begins[k:k + CHUNK], ends[k:k + CHUNK], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id_col, fp long) per row of ``docs``; fp holds the 64 bits, signed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, shingle) for t in strings(batch.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], [id_col, "fp"])

    return docs.select(id_col, text_or_empty(text_col).alias("text")).mapInArrow(
        run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, fp long")


def _blocks(n: int) -> list[tuple[int, int]]:
    """n adjoining (first bit, width) blocks of the 64 bits."""
    edges = [64 * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _bits(first: int, width: int) -> int:
    """The mask of a block, as a signed long."""
    mask = ((1 << width) - 1) << first
    return mask - (1 << 64) if mask >> 63 else mask


def links(fps: DataFrame, max_bits: int = 2, crowd: int = 64) -> DataFrame:
    """(a, b) pairs of the distinct fingerprints ``fps`` (fp long) that suffice for the
    components of the relation "at most ``max_bits`` bits apart"; all verified. Outside
    crowded blocks they are all such pairs."""
    if not 1 <= max_bits <= 2:
        raise ValueError("max_bits: 1 or 2")
    blocks = _blocks(max_bits + 1)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_bits(*b))) for b in blocks])).alias("block", "part"))
    sizes = keyed.groupBy("block", "part").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    keyed = stage(keyed.join(sizes, ["block", "part"]), "blocks")
    few = keyed.filter(F.col("size") <= crowd).select("block", "part", "fp")
    near: Column = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = (few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), ["block", "part"])
             .filter("a < b").filter(near).select("a", "b"))
    # crowded: centres are the fingerprint itself and those one bit off, outside the block
    outside = F.when(F.lit(False), F.array().cast("array<bigint>"))
    for k, b in enumerate(blocks):
        flips = [1 << i for i in range(64) if not b[0] <= i < b[0] + b[1]]
        outside = outside.when(F.col("block") == k, F.array(*[F.lit(x - (1 << 64) if x >> 63 else x) for x in [0, *flips]]))
    centres = keyed.filter(F.col("size") > crowd).select("block", "fp", F.explode(outside).alias("flip")).select(
        "block", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    least = centres.groupBy("block", "centre").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).filter("a < z")
    stars = (centres.withColumnRenamed("fp", "b").join(least, ["block", "centre"]).filter("a < b").filter(near)
             if max_bits == 2 else centres.filter("fp != centre").select(F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b"))
             .join(fps.withColumnRenamed("fp", "a"), "a", "semi").join(fps.withColumnRenamed("fp", "b"), "b", "semi"))
    return pairs.unionAll(stars.select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(id_col, fp long, component_id) for every row of ``docs``: the fingerprint and the
    smallest id that is reachable over links, the own one included."""
    rows = stage(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "classes")
    roots = connected_components(links(classes.select("fp"), max_bits))
    # components by the smallest fingerprint; named by the smallest document of all their classes
    member = classes.join(roots.select(F.col("id").alias("fp"), "component"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))
    names = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(member.join(names, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(id_col, "fp", "component_id")
