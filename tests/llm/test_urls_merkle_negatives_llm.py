"""URL rules, Merkle manifest and hard negatives against plain versions and DuckDB."""

import hashlib
import math
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import components, merkle, negatives, queries, urlrules

RULES = queries.URL_RULES


def canonical(href):
    return f'<html><head><link rel="canonical" href="{href}"></head><body>x</body></html>'


PAGES = [
    (1, "https://a.example.net/en/1", None),
    (2, "http://b.example.com/en/2?x=1#top", "<p>x</p>"),  # blocked by example.com/en/
    (3, "https://www.example.com/en/3", ""),  # www.example.com/en/ allows
    (4, "https://mirror.org/p", canonical("http://B.example.com/en/2?x=1")),  # alias of 2
    (5, "https://other.org/q", "<META content='0; URL=https://mirror.org/p#frag' HTTP-EQUIV=Refresh>"),  # alias of 4
    (6, "https://shop.com/q", canonical("https://mirror.org/p")),  # alias, but com/ allows
    (7, "https://third.org/z", canonical("/y")),
    (8, "https://third.org/y", canonical("//x.net/fr/1")),  # target is not a page, and blocked
    (9, "https://fourth.org/z", "<!-- " + canonical("http://b.example.com/en/2?x=1") + " --><script>'" + canonical("https://x.net/es/") + "</script>"),
    (10, "https://fifth.org", canonical("https://b.example.com/en/2?x=1")),  # another scheme: another URL, blocked by its rule all the same
    (11, "https://sixth.org/a/b?q", '<link href="c.html" rel="alternate canonical"><link rel=stylesheet href=http://x.net/es/1>'),
    (12, "https://sixth.org/a/c.html", "<link rel=canonical href=https://free.org/?a=1&amp;b=2>"),
    (13, "https://free.org/?a=1&b=2", canonical("")),
    (14, None, canonical("https://x.net/es/")), (15, "no address", canonical("https://x.net/es/")), (16, "", None), (17, "://", None),
    (18, "HTTPS://X.Net/ES/", None), (19, "https://x.net/es/", None), (20, "https://x.net/es", None), (21, "https://xnet/es/", None),
    (22, "https://net/fr/\nx", None), (23, "a://b://example.com/en/", None), (4, "https://mirror.org/p", canonical("http://B.example.com/en/2?x=1")),
    (24, "https://Äx.example.com?x=/en/", "<link " * 3000), (None, "https://other.org/q", None),
]
WANT = {1: "allow", 2: "block", 3: "allow", 4: "block", 5: "block", 6: "allow", 7: "block", 8: "block", 9: "allow", 10: "block", 11: "allow", 12: "allow", 13: "allow",
        14: "allow", 15: "allow", 16: "allow", 17: "allow", 18: "allow", 19: "block", 20: "allow", 21: "allow", 22: "block", 23: "allow", 24: "allow", None: "block"}


def test_url_rules(spark):
    pages = spark.createDataFrame([(*p, "r", "k") for p in PAGES], "page_id long, url string, html string, rule string, id string")
    out = urlrules.judge(pages, RULES)
    assert out.columns == ["page_id", "url", "id", "host", "path", "rule", "verdict"]
    got = out.collect()
    assert len(got) == len(PAGES)
    assert {r["page_id"]: r["verdict"] for r in got} == WANT
    by_id = {r["page_id"]: r for r in got}
    assert (by_id[2]["host"], by_id[2]["path"], by_id[2]["rule"]) == ("b.example.com", "/en/2", "example.com/en/")
    assert (by_id[18]["host"], by_id[18]["path"], by_id[18]["rule"]) == ("x.net", "/ES/", None)
    assert (by_id[15]["host"], by_id[15]["path"]) == ("", "") and by_id[24]["host"] == "Äx.example.com"
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    names = "page_id, host, path, rule, verdict"
    key = lambda r: tuple((x is None, str(x)) for x in r)
    want = con.execute(f"SELECT {names} FROM ({urlrules.oracle_sql(RULES)})").fetchall()
    assert sorted([tuple(r) for r in out.select(*names.split(", ")).collect()], key=key) == sorted(want, key=key)
    assert urlrules.judge(pages.limit(0), RULES).count() == 0
    assert {r["verdict"] for r in urlrules.judge(pages, []).collect()} == {"allow"}


def test_redirect_table_and_allow_ties(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", None), (2, "http://b.org/", None), (3, "http://c.org/x", None)], "page_id long, url string, html string")
    log = spark.createDataFrame([("http://a.org/", "http://z.org/"), ("http://z.org/", "http://bad.org/"), (None, "http://bad.org/")], "source string, target string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urlrules.judge(pages, [("block", "bad.org", ""), ("block", "c.org", "/"), ("allow", "org", "/x12"), ("allow", "org", "/x")], log).collect()}
    assert got == {1: (None, "block"), 2: (None, "allow"), 3: ("c.org/", "block")}
    tie = urlrules.judge(pages.filter("page_id = 3"), [("block", "c.org", "/"), ("allow", "org", "/x")]).first()
    assert tie["verdict"] == "block"  # the longer one
    tie = urlrules.judge(pages.filter("page_id = 3"), [("block", "c.org", ""), ("allow", "org", "/x")]).first()
    assert (tie["rule"], tie["verdict"]) == ("org/x", "allow")


def test_components_with_hubs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    edges = [(0, k) for k in range(1, 300)] + [(1000 + k, 1001 + k) for k in range(40)] + [(int(a), int(b)) for a, b in rng.integers(2000, 2400, (200, 2))] + [(7, 7), (9000, 9000)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    for hubs in (4096, 3):
        monkeypatch.setattr(components, "HUBS", hubs)
        out = components.connected_components(spark.createDataFrame(edges, "a long, b long"))
        assert {r["id"]: r["component"] for r in out.collect()} == {x: find(x) for x in root}
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("gathered", [1 << 18, 0])
def test_components_load_on_the_driver(spark, monkeypatch, gathered):
    """Edges are computed once, and a round of a small table is a few jobs (before: twice, 130 jobs)."""
    monkeypatch.setattr(components, "GATHERED", gathered, raising=False)
    monkeypatch.setattr(components, "HUBS", 8)
    sc, seen = spark.sparkContext, spark.sparkContext.accumulator(0)
    rows = [(0, k) for k in range(1, 60)] + [(101 + k, 100 + k) for k in range(30)] + [(7, 7), (900, 900), (901, None), (0, 1), (1, 0)]

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    edges = spark.createDataFrame(rows, "a long, b long").mapInArrow(counted, "a long, b long")
    sc.setJobGroup(f"components-{gathered}", "")
    try:
        got = {r["id"]: r["component"] for r in components.connected_components(edges).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == {k: 0 for k in range(60)} | {100 + k: 100 for k in range(31)} | {900: 900, 901: 901}
    assert seen.value == len(rows)
    if gathered:
        assert len(sc.statusTracker().getJobIdsForGroup(f"components-{gathered}")) <= 60


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][k:k + 16])) for k in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, at):
    out = []
    for level in levels[:-1]:
        first = at // 16 * 16
        out.append(("".join(level[first:at]), "".join(level[at + 1:first + 16])))
        at //= 16
    return out


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) rows by the contract."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [levels_of([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names]
    top = levels_of([t[-1][0] for t in trees])
    out = []
    for g, (name, tree) in enumerate(zip(names, trees, strict=True)):
        for at, (_, _, leaf, r) in enumerate(sorted(groups[name], key=lambda x: x[:3])):
            path = siblings(tree, at) + siblings(top, g)
            folded = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = r[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                folded = leaf_of((*r[:4], text))
            for before, after in path:
                folded = h(before + folded + after)
            out.append((r[0], leaf, tree[-1][0], top[-1][0], h("".join(b + a for b, a in path)), folded, folded == top[-1][0]))
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def documents(n):
    rng = np.random.default_rng(n)
    rows = [(k, f"s{int(rng.integers(0, 4))}", "en", k * 3, f"Text {k} Äb") for k in range(n)]
    rows += [(n + k, "hot", None, None, ("Same TEXT " if k % 3 else None)) for k in range(n)]
    return rows + [(None, None, None, None, None), (7, None, "en", -4, ""), (7, None, "en", -4, ""), (90_001, "Ä", "en", 1, "X" * 100_000), (90_002, "", "en", 1, "ß"), (5, "s1", "en", 15, "other")]


@pytest.mark.parametrize("rows", [documents(300), documents(20), [(0, "a", "en", 1, "Aa")], [(k, "a", "en", 1, "Aa") for k in range(17)], [(k, f"g{k}", "en", 1, "Aa") for k in range(40)]])
def test_manifest(spark, tmp_path, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, root string, tree int")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    want = in_order(plain_manifest(rows))
    out = queries.op12_merkle(spark, str(tmp_path))
    assert in_order([tuple(r) for r in out.collect()]) == want
    assert any(not r[-1] for r in want) or len(rows) < 50
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert in_order(con.execute(merkle.oracle_sql(4)).fetchall()) == want


def test_manifest_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, source string")
    assert merkle.manifest(empty, "source", "doc_id", merkle.row_hash([F.col("doc_id")])).count() == 0


def plain_negatives(rows, anchors):
    good = [(i, lab, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, lab, v in rows
            if i is not None and lab is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for i, lab, x in {(a, b, c.tobytes()): (a, b, c) for a, b, c in good if anchors(a)}.values():
        s = sorted((-int(x @ v), j, other == lab) for j, other, v in good if j != i and len(v) == len(x))
        for ps, p, _ in [r for r in s if r[2]][:5]:
            found = [r for r in s if not r[2] and 50 * -ps <= 100 * -r[0] <= 95 * -ps][:3]
            out += [(i, p, k + 1, j, -ps, -ns) for k, (ns, j, _) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("chunk,cells,seed,block", [(4096, 32, 4000, 4096), (40, 5, 30, 7)])
def test_hard_negatives(spark, chunk, cells, seed, block):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(6, 10))
    rows = []
    for k in range(500):
        v = centres[k % 6] + rng.normal(size=10) * 0.6
        rows.append((k, int(rng.integers(0, 3)) if k % 2 else k % 6, [float(np.float32(c)) for c in v]))
    rows += [(600 + k, k % 3, rows[10][2]) for k in range(150)]  # many ties
    rows += [(800, None, rows[0][2]), (None, 1, rows[0][2]), (810, 1, None), (820, 1, [None] + [0.1] * 9), (830, 1, [float("nan")] * 10), (840, 1, [float("inf")] * 10),
             (850, 1, []), (860, 1, [0.0] * 10), (870, 1, [0.5, 0.5]), (880, 2, [0.4, 0.45]), (890, 1, [0.3, 0.4]), (10, rows[10][1], rows[10][2]), (20, 77, rows[20][2])]
    frame = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, label int, embedding array<float>, mark string, dim double")
    out = negatives.mine(frame, F.col("vec_id") % 10 == 0, chunk=chunk, cells=cells, seed=seed, block=block, sample=200)
    got = sorted(tuple(r) for r in out.collect())
    assert got == plain_negatives(rows, lambda i: i % 10 == 0)
    assert len(got) > 300
    assert negatives.mine(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_cover_tree_bounds():
    rng = np.random.default_rng(8)
    x = np.floor(rng.normal(size=(700, 12)) * 50)
    x[100:400] = x[5]
    most = float((x * x).sum(axis=1).max())
    up = negatives.lifted(x, most)
    q = np.floor(rng.normal(size=(9, 12)) * 50)
    flat = np.column_stack([q, np.zeros(len(q))])

    def walk(node):
        assert negatives.distances(up[node.at], node.centre[None, :]).max() <= node.radius + 1e-9
        d = negatives.distances(flat, node.centre[None, :])
        low, high = negatives.bounds((q * q).sum(axis=1), d, np.array([[node.radius]]), most)
        s = q @ x[node.at].T
        assert (s >= low).all() and (s <= high).all()
        if node.children:
            assert sorted(np.concatenate([c.at for c in node.children])) == sorted(node.at)
        for c in node.children:
            walk(c)

    root = negatives.Node(up, np.arange(len(x)), up.mean(axis=0))
    walk(root)
    assert root.children
    seen = set()
    best = negatives.Best(len(q), 1, 3, np.full((len(q), 1), -np.inf))

    def verify(who, at):
        seen.update(at.tolist())
        best.add(who, q[who] @ x[at].T, at, np.ones((len(who), len(at)), bool), lo, hi)

    top = np.sort(q @ x.T, axis=1)
    lo, hi = np.full((len(q), 1), -np.inf), np.full((len(q), 1), np.inf)
    negatives.descend(root, most, q, lo, hi, best, verify)
    assert (best.score[:, 0, :] == top[:, :-4:-1]).all()
