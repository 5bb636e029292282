"""Disk of the scoring flow: copies of a search stay within a round, staged tables and shuffle files go when they are read."""

import os
import time

import pytest

from parley.operators import retrieval as RT
from parley.operators.util import discard, staged
from parley.plans import jobs as J
from parley.session import ensure_checkpoint_dir


def vectors(spark, key, n, shift):
    rows = [(f"{key}{i}", [f"t{(i * k + shift) % 23}" for k in range(1, 5)], [0.1 + (i * k % 7) / 8 for k in range(1, 5)]) for i in range(n)]
    return spark.createDataFrame([(i, list({*t}), w[:len({*t})]) for i, t, w in rows], f"{key} string, terms array<string>, weights array<double>")


def test_rounds_of_queries_give_the_same(spark, monkeypatch):
    cases, queries = vectors(spark, "id", 90, 3), vectors(spark, "qid", 40, 5)
    found = lambda **x: sorted(map(tuple, RT.search_vectors(cases, queries, 4, 9, **x).select("qid", "id", "similarity", "rank").collect()))
    one = found(kb_blocks=1)
    assert len({r[0] for r in one}) == 40 and len(one) == 160
    monkeypatch.setattr(RT, "ROUND_TERMS", 500)
    ran = []
    whole = RT._search_round
    monkeypatch.setattr(RT, "_search_round", lambda *a: ran.append(a[6:8]) or whole(*a))
    assert found(kb_blocks=2, query_blocks=7) == one and len(ran) > 3
    assert sorted(b for lo, hi in ran for b in range(lo, hi)) == list(range(7))


@pytest.mark.parametrize("spread", [12, 54, 600])
def test_copies_of_a_round_do_not_grow_with_the_queries(spread):
    k, cases = 50, (550_000, 13_000_000)
    for times in (1, 6, 60):
        queries = (140_000 * times, 5_000_000 * times)
        q, c, rounds = RT._blocks(queries, cases, k, spread)
        assert queries[0] / q <= RT.QUERY_ROWS and queries[1] / q <= RT.QUERY_TERMS and cases[0] / c <= RT.CASE_ROWS and cases[1] / c <= RT.CASE_TERMS
        each = -(-q // rounds)
        copied = cases[1] * each + (queries[1] + 2 * k * queries[0]) * c * each / q
        assert copied <= 3 * RT.ROUND_TERMS + cases[1]
    assert RT._blocks((20_000, 700_000), (40_000, 1_000_000), k, 1) == (1, 1, 1)
    assert RT._blocks((0, 0), (0, 0), k, spread)[0] == 1


def test_shuffle_files_end_with_the_write(spark):
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return sum(x.getName().startswith("shuffle_") for x in map(tracker.getAllFiles().apply, range(tracker.getAllFiles().size())))

    before = shuffled()
    out = staged(spark.range(2000).repartition(5, "id"), "trial")
    until = time.time() + 20  # files are removed beside the job
    while shuffled() > before and time.time() < until:
        time.sleep(0.2)
    assert shuffled() <= before and out.count() == 2000
    discard(out)
    assert not os.path.exists(out.staged_at.removeprefix("file:"))


def test_score_keeps_what_is_read_again_alone(spark, monkeypatch):
    monkeypatch.setattr(J, "HIT_ROWS", 10)  # several slices
    kb = spark.createDataFrame([(f"c{i}", f"the song {i % 5} stops playing {i}", f"answer {i} of many", "audio_playback_issue" if i % 2 else "other_support") for i in range(30)]
                               + [("c3", "the song 3 stops at once", "another answer", "audio_playback_issue")],  # one id, two cases
                               "case_id string, customer_message string, support_response string, intent string")
    asked = spark.createDataFrame([(f"m{i}", f"my song {i} stops playing") for i in range(7)] + [("none", "xyz")], "msg_id string, message string")
    folder = ensure_checkpoint_dir(spark).removeprefix("file:") + "/staged"
    before = set(os.listdir(folder)) if os.path.exists(folder) else set()
    got = {r["msg_id"]: r for r in J.score(asked, kb).collect()}
    assert {x.split("-")[0] for x in set(os.listdir(folder)) - before} == {"evidence"}
    assert len(got) == 8 and got["none"]["evidence"] == [] and all(len(r["evidence"]) == 3 for k, r in got.items() if k != "none")
    texts = {(r["case_id"], r["customer_message"], r["support_response"], r["intent"]) for r in kb.collect()}
    assert {(e["case_id"], e["customer"], e["agent"], e["intent"]) for r in got.values() for e in r["evidence"]} <= texts
    # a stored index of all terms gives the same
    again = {r["msg_id"]: r for r in J.score(asked, kb, J.build_index(kb)).collect()}
    ids = lambda rows: {k: [(e["case_id"], e["similarity"]) for e in r["evidence"]] for k, r in rows.items()}
    assert ids(again) == ids(got)
