"""Exact nearest-neighbour search and intent-first rerank.

* Sparse (TF-IDF cosine): blocks of queries meet blocks of the KB in cogroups; each is
  an inverted index whose posting blocks carry their largest weights, so that
  queries skip blocks below their k-th score; then a per-query top-k.
* Dense (inner product on unit vectors): blocks of queries meet blocks of the KB
  in cogroups; each is one matrix product that keeps a top-k per query, so only
  k rows per query and block leave a group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.operators.sampling import bounded_rows
from parley.operators.util import checked_broadcast, discard, range_count, staged

OTHER = "other_support"


# What a group of ``sparse_search`` holds at most, on average: rows and their term weights.
QUERY_ROWS, QUERY_TERMS = 20_000, 1_500_000
CASE_ROWS, CASE_TERMS = 50_000, 3_500_000
# Term weights that a round of ``search_vectors`` shuffles (at least every case once).
ROUND_TERMS = 20_000_000


def sparse_search(kb_weights: DataFrame, q_weights: DataFrame, k: int = 3, digits: int | None = None,
                  kb_blocks: int | None = None, query_blocks: int = 1, postings: int = 512, then=None) -> DataFrame:
    """Top-k cases per query by cosine of L2-normalised TF-IDF vectors (weights above zero).

    kb_weights(id, term, weight), q_weights(qid, term, weight) ->
    (qid, id, similarity, rank). ``digits`` rounds scores before ranking so exact
    duplicates tie regardless of summation order; cases that share no term are not found.

    Both sides are staged as one row per vector, the cases' without terms that no query has: see ``search_vectors``."""
    queries = staged(_vectors(q_weights, "qid"), "search-queries")
    asked = queries.select(F.explode("terms").alias("term")).distinct()
    few = asked.count()
    cases = staged(_vectors(kb_weights.join(checked_broadcast(asked, few), "term", "left_semi"), "id"), "search-cases")
    found = search_vectors(cases, queries, k, digits, kb_blocks, query_blocks, postings, then)
    discard(queries, cases)
    return found


def search_vectors(cases: DataFrame, queries: DataFrame, k: int = 3, digits: int | None = None,
                   kb_blocks: int | None = None, query_blocks: int = 1, postings: int = 512, then=None) -> DataFrame:
    """``sparse_search`` of stored vectors: cases(id, terms, weights), queries(qid, terms, weights).

    Cases are dealt by hash into ``kb_blocks`` and queries into at least ``query_blocks`` blocks, as many as keep a
    block within the bounds above; every pair of blocks is a group, a task's memory the same
    at every size. A hot term's postings are thereby split by case. A group is an inverted
    index of its cases: see ``_best_cases``; k rows per query leave it.

    A case goes to every block of queries and a query to every block of cases. This is done in rounds of a
    few blocks of queries against all cases, and the shuffle files of a round are removed at
    its end: disk grows with the cases, not with their product with the queries. The best are staged, or
    what ``then`` makes of the best of a round's queries."""
    then = then or (lambda found: found)
    n_q, n_d = _sizes(queries), _sizes(cases)
    query_blocks, kb_blocks, rounds = _blocks(n_q, n_d, k, range_count(cases), query_blocks, kb_blocks)
    each = -(-query_blocks // rounds)
    found = [staged(then(_search_round(cases, queries, k, digits, kb_blocks, query_blocks, lo, min(lo + each, query_blocks), postings)), "search-found")
             for lo in range(0, query_blocks, each)]
    # every query is in one round
    out = cases.sparkSession.read.schema(found[0].schema).parquet(*[x.staged_at for x in found])
    out.parts = found
    return out


def _search_round(cases: DataFrame, queries: DataFrame, k: int, digits: int | None, kb_blocks: int, query_blocks: int, lo: int, hi: int, postings: int) -> DataFrame:
    """The best cases of the queries in the blocks from ``lo`` to before ``hi``."""
    kinds = queries.schema["qid"].dataType.simpleString(), cases.schema["id"].dataType.simpleString()
    groups = 2 * (hi - lo) * kb_blocks  # a number given here is not coalesced: few groups share a task
    left = (queries.withColumn("b", F.pmod(F.xxhash64("qid"), F.lit(query_blocks)).cast("int")).filter(F.col("b").between(lo, hi - 1))
            .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(kb_blocks - 1)))).repartition(groups, "b", "c"))
    right = (cases.withColumn("c", F.pmod(F.xxhash64("id"), F.lit(kb_blocks)).cast("int"))
             .withColumn("b", F.explode(F.sequence(F.lit(lo), F.lit(hi - 1)))).repartition(groups, "b", "c"))

    def best(q: pa.Table, d: pa.Table) -> pa.Table:
        i, j, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if q.num_rows and d.num_rows:
            qt, dt = _term_codes(_flat(q, "terms"), _flat(d, "terms"))
            i, j, score = _best_cases(_owners(q), qt, _flat(q, "weights").to_numpy(), q.num_rows,
                                      _owners(d), dt, _flat(d, "weights").to_numpy(), _places(d.column("id")), k, digits, postings)
        return pa.table({"qid": q.column("qid").take(pa.array(i)), "id": d.column("id").take(pa.array(j)), "similarity": pa.array(score)})

    found = left.groupBy("b", "c").cogroup(right.groupBy("b", "c")).applyInArrow(best, f"qid {kinds[0]}, id {kinds[1]}, similarity double")
    return top_k(found, "qid", "similarity", "id", k)


def _vectors(weights: DataFrame, key: str) -> DataFrame:
    """(key, terms, weights): a row per vector (lists as long as its distinct terms)."""
    ws = weights.groupBy(key).agg(F.collect_list(F.struct("term", F.col("weight").cast("double").alias("weight"))).alias("ws"))
    return ws.select(key, F.col("ws.term").alias("terms"), F.col("ws.weight").alias("weights"))


def _sizes(vectors: DataFrame) -> tuple[int, int]:
    """Rows and terms of vectors (two figures come to the driver)."""
    n = vectors.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    return n["rows"], n["terms"]


def _least(n: tuple[int, int], rows: int, terms: int) -> int:
    return max(1, -(-n[0] // rows), -(-n[1] // terms))


def _block_count(vectors: DataFrame, rows: int, terms: int) -> int:
    """Into how many blocks to deal the vectors at least."""
    return _least(_sizes(vectors), rows, terms)


def _blocks(queries: tuple[int, int], cases: tuple[int, int], k: int, spread: int, query_blocks: int = 1, kb_blocks: int | None = None) -> tuple[int, int, int]:
    """(blocks of queries, blocks of cases, rounds) of a search. Blocks are as few as their bounds allow; a search of
    fewer than ``spread`` groups gets more, of the side whose copies cost less, until they hold a
    25th of their bound. Rounds are as many as keep the copies of a round within ``ROUND_TERMS``."""
    least = max(query_blocks, _least(queries, QUERY_ROWS, QUERY_TERMS))
    fixed, kb_blocks = kb_blocks, kb_blocks or _least(cases, CASE_ROWS, CASE_TERMS)
    most = max(least, -(-25 * queries[0] // QUERY_ROWS)), kb_blocks if fixed else max(kb_blocks, -(-25 * cases[0] // CASE_ROWS))
    copied = queries[1] + 2 * k * queries[0]  # a block of cases costs a copy of the queries and k rows for each
    tried = [(cases[1] * q + copied * c, q, c) for q in range(least, max(least, min(most[0], spread)) + 1)
             for c in [min(most[1], max(kb_blocks, -(-spread // q)))] if q * c >= min(spread, most[0] * most[1])]
    cost, query_blocks, kb_blocks = min(tried, default=(cases[1] * least + copied * kb_blocks, least, kb_blocks))
    return query_blocks, kb_blocks, min(query_blocks, -(-cost // ROUND_TERMS) or 1)


def _flat(t: pa.Table, column: str) -> pa.ChunkedArray:
    return pc.list_flatten(t.column(column))


def _owners(t: pa.Table) -> np.ndarray:
    """The number of its row for every entry of a table's lists."""
    return np.repeat(np.arange(t.num_rows), pc.list_value_length(t.column("terms")).to_numpy())


def _term_codes(q: pa.ChunkedArray, d: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    terms = pa.chunked_array([*q.chunks, *d.chunks], q.type).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return terms[:len(q)], terms[len(q):]


def _places(ids: pa.ChunkedArray) -> np.ndarray:
    """Of every id, its place among the sorted ones: ties go to the smaller id."""
    place = np.empty(len(ids), np.int64)
    place[np.argsort(ids.to_numpy(), kind="stable")] = np.arange(len(ids))
    return place


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row's value by first appearance, a row of each value)."""
    coded = column.combine_chunks().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    return codes, np.unique(codes, return_index=True)[1]


def _search_block(q: pa.Table, d: pa.Table, k: int, digits: int | None, postings: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``q``, row of ``d``, score) of the best ``k`` cases for the queries of tables
    of single weights: q(qid, term, wq), d(id, term, weight)."""
    if not q.num_rows or not d.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    qt, dt = _term_codes(q.column("term"), d.column("term"))
    (qi, q_row), (di, d_row) = _codes(q.column("qid")), _codes(d.column("id"))
    i, j, score = _best_cases(qi, qt, q.column("wq").to_numpy(), len(q_row), di, dt, d.column("weight").to_numpy(),
                              _places(d.column("id").take(pa.array(d_row))), k, digits, postings)
    return q_row[i], d_row[j], score


def _best_cases(qi: np.ndarray, qt: np.ndarray, wq: np.ndarray, n_q: int, di: np.ndarray, dt: np.ndarray, wd: np.ndarray, place: np.ndarray,
                k: int, digits: int | None, postings: int, dense: int = 1024, rows: int = 1024, entries: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, case, score) of the best ``k`` cases for every query; entry x of a side belongs to
    query ``qi[x]`` or case ``di[x]``; ``place`` of a case: its order among equal scores.

    Cases are ordered by their heaviest term and cut into posting blocks of ``postings`` cases;
    each term's largest weight in a block bounds what the block's cases can score. Blocks are
    visited in the order of their bounds, for the queries alone that they may still improve:
    a block below a query's k-th score is skipped (one that equals it is not: ties). Terms that many
    queries and cases share (at most ``dense`` of them) are multiplied as matrices, the others by their
    postings, for at most ``rows`` queries and about ``entries`` matching postings at a time."""
    n_d, width = len(place), int(max(qt.max(), dt.max())) + 1
    order = np.argsort(qi, kind="stable")
    qi, qt, wq = qi[order], qt[order].astype(np.int64), wq[order]
    starts = np.searchsorted(qi, np.arange(n_q + 1))
    heaviest = np.lexsort((wd, di))[np.searchsorted(np.sort(di, kind="stable"), np.arange(n_d), side="right") - 1]
    block = np.empty(n_d, np.int64)
    block[np.lexsort((place, dt[heaviest]))] = np.arange(n_d) // postings
    order = np.lexsort((place[di], dt, block[di]))
    di, dt, wd = di[order], dt[order].astype(np.int64), wd[order]
    key = block[di] * width + dt  # postings in the order of (block, term)
    heads = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
    del key, order, heaviest
    top = np.maximum.reduceat(wd, heads[:-1])
    head_term, n_blocks = dt[heads[:-1]], int(block.max()) + 1
    span = np.searchsorted(block[di[heads[:-1]]], np.arange(n_blocks + 1))

    # terms whose postings meet more often than a matrix product costs
    meets = np.bincount(qt, minlength=width).astype(float) * np.bincount(dt, minlength=width)
    heavy = np.flatnonzero(meets * 256 >= n_q * n_d)
    heavy = heavy[np.argsort(-meets[heavy], kind="stable")][:dense]
    column = np.full(width, -1, np.int64)
    column[heavy] = np.arange(len(heavy))
    q_column = column[qt]

    where = np.full(width, -1, np.int64)  # of a term: its head in the block at hand

    def heads_of(b: int) -> np.ndarray:
        own = slice(span[b], span[b + 1])
        where[head_term[own]] = np.arange(span[b], span[b + 1])
        at = where[qt]
        where[head_term[own]] = -1
        return at

    bound = np.zeros((n_q, n_blocks))
    for b in range(n_blocks):
        at = heads_of(b)
        met = at >= 0
        bound[:, b] = np.bincount(qi[met], wq[met] * top[at[met]], n_q)
    slack = 1e-9 + (0.5 * 10.0 ** -digits if digits is not None else 0)
    best_score, best_case = np.full((n_q, k), -np.inf), np.full((n_q, k), -1, np.int64)
    local = np.zeros(n_d, np.int64)
    for b in np.argsort(-bound.max(axis=0), kind="stable"):
        live = (bound[:, b] > 0) & (bound[:, b] * (1 + 1e-12) + slack >= best_score[:, -1])
        asked = np.flatnonzero(live)
        if not len(asked):
            continue
        cases = np.flatnonzero(block == b)
        cases = cases[np.argsort(place[cases])]
        local[cases] = np.arange(len(cases))
        own = slice(heads[span[b]], heads[span[b + 1]])
        into, of = column[dt[own]], local[di[own]]
        matrix = np.zeros((len(cases), len(heavy)))
        np.add.at(matrix, (of[into >= 0], into[into >= 0]), wd[own][into >= 0])
        at = heads_of(b)
        at[q_column >= 0] = -1
        count = np.where(at >= 0, heads[at + 1] - heads[at], 0)
        met = np.cumsum(np.add.reduceat(np.append(count, 0), starts[:-1])[asked] * (starts[1:] > starts[:-1])[asked])
        lo = 0
        while lo < len(asked):
            hi = min(lo + rows, max(lo + 1, int(np.searchsorted(met, (met[lo - 1] if lo else 0) + entries, side="right"))))
            some = asked[lo:hi]
            lo = hi
            n = starts[some + 1] - starts[some]
            x = np.repeat(starts[some] - np.cumsum(n) + n, n) + np.arange(n.sum())  # the queries' entries
            slot = np.repeat(np.arange(len(some)), n)
            plain = q_column[x] < 0
            asking = np.zeros((len(some), len(heavy)))
            np.add.at(asking, (slot[~plain], q_column[x[~plain]]), wq[x[~plain]])
            score = asking @ matrix.T
            x, slot = x[plain & (at[x] >= 0)], slot[plain & (at[x] >= 0)]
            n = count[x]
            p = np.repeat(heads[at[x]] - np.cumsum(n) + n, n) + np.arange(n.sum())  # their postings
            if len(p):
                score += np.bincount(np.repeat(slot * len(cases), n) + local[di[p]], np.repeat(wq[x], n) * wd[p], score.size).reshape(score.shape)
            if digits is not None:
                score = np.round(score, digits)
            low = best_score[some, -1]
            if len(cases) > k:
                low = np.maximum(low, np.partition(score, -k, axis=1)[:, -k])
            i, j = np.nonzero((score > 0) & (score >= low[:, None]))
            if not len(i):
                continue
            # the new ones among those known so far, for the queries that have any
            rows_new = np.unique(i)
            old_i, old_j = np.nonzero(best_case[some[rows_new]] >= 0)
            old_q = some[rows_new[old_i]]
            ii, jj = np.concatenate([some[i], old_q]), np.concatenate([cases[j], best_case[old_q, old_j]])
            ss = np.concatenate([score[i, j], best_score[old_q, old_j]])
            order = np.lexsort((place[jj], -ss, ii))
            ii, jj, ss = ii[order], jj[order], ss[order]
            rank = np.arange(len(ii)) - np.searchsorted(ii, ii, side="left")
            keep = rank < k
            best_score[ii[keep], rank[keep]], best_case[ii[keep], rank[keep]] = ss[keep], jj[keep]
    i, rank = np.nonzero(best_case >= 0)
    return i, best_case[i, rank], best_score[i, rank]


def top_k(scores: DataFrame, qid: str, score: str, key: str, k: int, rank_col: str = "rank") -> DataFrame:
    """``row_number() <= k`` per query (planned as WindowGroupLimit: per-task
    top-k before the shuffle), ties broken by ``key``."""
    w = Window.partitionBy(qid).orderBy(F.desc(score), F.asc(key))
    return scores.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def intent_rerank(cands: DataFrame, q_intent: str, kb_intent: str, k: int = 3,
                  qid: str = "qid", score: str = "similarity", key: str = "id", other: str = OTHER) -> DataFrame:
    """Inside the candidate list, cases whose intent equals the query's
    (unless the query intent is ``other``) come first, each group by similarity."""
    match = ((F.col(kb_intent) == F.col(q_intent)) & (F.col(q_intent) != other)).cast("int")
    w = Window.partitionBy(qid).orderBy(match.desc(), F.desc(score), F.asc(key))
    return cands.withColumn("final_rank", F.row_number().over(w)).filter(F.col("final_rank") <= k)


def dense_search(kb: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
                 vec_col: str = "embedding", qid_col: str = "qid", qvec_col: str = "qvec",
                 chunk: int = 8192) -> DataFrame:
    """M7a exact top-k by inner product -> (qid, id, similarity, rank).

    Both sides are dealt by a hash of their id into blocks of about ``chunk`` rows (the
    two row counts are the only figures the driver sees); every pair of blocks is one
    group, a matrix product that keeps k candidates per query (ties at the boundary
    kept), and the per-query top-k follows. Same plan at every size."""
    n_kb, n_q = (max(1, -(-df.count() // chunk)) for df in (kb, queries))
    left = (queries.select(F.col(qid_col).cast("long").alias("qid"), F.col(qvec_col).cast("array<double>").alias("qvec"))
            .withColumn("b", F.pmod(F.xxhash64("qid"), F.lit(n_q))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_kb - 1)))))
    right = (kb.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
             .withColumn("c", F.pmod(F.xxhash64("id"), F.lit(n_kb)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1)))))
    left, right = left.withColumn("b", F.col("b").cast("int")), right

    def best(_, q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(d):
            ids, mat = d["id"].to_numpy(), np.vstack(d["vec"].to_numpy())
            for at in range(0, len(q), 512):
                part = q.iloc[at:at + 512]
                sims = np.round(np.vstack(part["qvec"].to_numpy()) @ mat.T, 9)
                low = np.partition(sims, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(part), -np.inf)
                i, j = np.nonzero(sims >= low[:, None])
                f = pd.DataFrame({"qid": part["qid"].to_numpy()[i], "id": ids[j], "similarity": sims[i, j]})
                out.append(f.sort_values(["qid", "similarity", "id"], ascending=[True, False, True]).groupby("qid", sort=False).head(k))
        return pd.concat(out) if out else pd.DataFrame({"qid": [], "id": [], "similarity": []})

    part = left.groupBy("b", "c").cogroup(right.groupBy("b", "c")).applyInPandas(best, "qid long, id long, similarity double")
    return top_k(part.withColumn("similarity", F.round("similarity", 9)), "qid", "similarity", "id", k)


def embed(df: DataFrame, text_col: str, load, dim: int, out: str = "embedding", batch: int = 128) -> DataFrame:
    """M6: ``df`` with a column ``out`` array<float>, the unit-length vector of every text (null as
    empty) by the caller's model. ``load()`` is called once in every Python worker that gets rows and returns
    a function from a list of at most ``batch`` texts to an array of one row of ``dim``
    figures each; anything else raises. A zero vector stays zero."""
    kept = df.drop(out)
    names, place = kept.columns, kept.columns.index(text_col)

    def run(batches):
        model = None
        for rows in batches:
            texts = [x or "" for x in rows.column(place).to_pylist()]
            model = model or load()
            found = [np.zeros((0, dim), np.float32)]
            for at in range(0, len(texts), batch):
                some = texts[at:at + batch]
                x = np.asarray(model(some), np.float64)
                if x.shape != (len(some), dim):
                    raise ValueError(f"the model gave {x.shape} for {len(some)} texts, not {(len(some), dim)}")
                length = np.linalg.norm(x, axis=1, keepdims=True)
                found.append((x / np.where(length > 0, length, 1)).astype(np.float32))
            flat = np.concatenate(found)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * dim, pa.int32()), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([*rows.columns, vectors], [*names, out])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(out, T.ArrayType(T.FloatType()))]))


def dense_index(kb: DataFrame, load, dim: int, id_col: str = "case_id", text_col: str = "customer_message",
                max_cases: int | None = 15_000, seed: int = 42) -> DataFrame:
    """M6: the knowledge base with ``embedding``; of a larger one the ``max_cases`` cases of least
    hash (None: all). Cases without an intent get ``other_support``."""
    if max_cases is not None:
        kb = bounded_rows(kb, id_col, max_cases, seed)
    kb = kb.withColumn("intent", F.coalesce("intent", F.lit(OTHER))) if "intent" in kb.columns else kb.withColumn("intent", F.lit(OTHER))
    return embed(kb, text_col, load, dim)


def label_centroids(df: DataFrame, label_col: str = "label", vec_col: str = "embedding") -> DataFrame:
    """Unit-length mean vector per label (partial/final aggregation, no explode):
    element-wise sums via ``Summarizer``, then L2 normalisation."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    m = (df.select(label_col, array_to_vector(F.col(vec_col)).alias("v"))
           .groupBy(label_col).agg(Summarizer.mean(F.col("v")).alias("mean")))
    arr = vector_to_array("mean")
    norm = F.sqrt(F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x * x))
    return m.select(label_col, F.transform(arr, lambda x: x / norm).alias("centroid"))


def nearest_label(df: DataFrame, centroids: DataFrame, label_col: str = "label", vec_col: str = "embedding",
                  id_col: str = "vec_id") -> DataFrame:
    """kNN-style vote by centroid: every row gets the label of the closest centroid
    (ties to the smaller label): a search of the rows among the centroids."""
    found = dense_search(centroids, df, 1, label_col, "centroid", id_col, vec_col)
    return found.select(F.col("qid").alias(id_col), F.col("id").alias("predicted"), F.col("similarity").alias("score"))
