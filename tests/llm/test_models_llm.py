"""Top-k search, classifier, page extraction, mixing and licence scan."""

import html
import math
import re
import textwrap

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from parley.llm import htmlmain, licenses, mixing, quality, queries, topk


@pytest.mark.parametrize("chunk,seed", [(8192, 2000), (16, 10)])
def test_top_k(spark, chunk, seed):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 12)) * rng.uniform(0.2, 2, (200, 1))
    x[50:90] = x[7]  # many ties
    rows = [(k, [float(np.float32(v)) for v in x[k]]) for k in range(200)]
    rows += [(300, None), (320, [None] + [0.5] * 11), (340, [float("nan")] * 12), (360, [float("inf")] * 12), (None, rows[0][1]), (380, [0.1, 0.2]),
             (400, []), (420, [0.0] * 12), (440, [-0.3, 0.4])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, rank string")
    got = sorted(tuple(r) for r in topk.top_k(frame, F.col("vec_id") % 20 == 0, pivots=6, annuli=3, seed=seed, chunk=chunk).collect())
    good = {i: np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows
            if i is not None and v and all(c is not None and math.isfinite(c) for c in v)}
    want = []
    for q in good:
        if q % 20 == 0:
            best = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:20]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(want)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_quality_learns_and_is_whole(spark):
    rng = np.random.default_rng(2)
    words = [f"w{k}" for k in range(300)]
    say = lambda k: " ".join(rng.choice(words, k))
    rows = [(k, say(60) + "." if k % 3 else " ".join(w.upper() + "!!" for w in rng.choice(words, 60)), k) for k in range(600)]
    docs = spark.createDataFrame(rows + [(700, None, 0), (701, "", 0), (702, "x " * 50_000, 0), (None, say(5), 0), (1, rows[1][1], 0)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(0, 600, 2)] + [(None, 1, 0), (3, None, 0), (5, 7, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, "quality", per_class=80)
    out = quality.score(docs, model)
    assert out.columns == ["doc_id", "text", "score"]
    got = out.collect()
    assert len(got) == 605 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 600 and r["doc_id"] % 2]
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 3 > 0) for r in held]) > 0.97
    again = quality.score(docs, quality.fit(docs, labels, "quality", per_class=80))
    assert sorted(r["score"] for r in again.collect()) == pytest.approx(sorted(r["score"] for r in got))
    none = quality.fit(docs, labels.limit(0), "quality")
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), model).count() == 0


def test_temperature_and_gradient():
    rng = np.random.default_rng(3)
    z = rng.normal(size=4000) * 2
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(int)
    assert quality.temperature(3 * z, y, np.ones(4000)) == pytest.approx(3, rel=0.15)
    x = rng.normal(size=(500, 5))
    layers = quality.train(x, (x[:, 0] * x[:, 1] > 0).astype(int), np.ones(500), 16, 150)
    assert ((quality._forward(x, layers)[1] > 0) == (x[:, 0] * x[:, 1] > 0)).mean() > 0.9


def test_quality_held_out(spark):
    got = queries.op1_quality(spark, SF.replace("0.001", "0.01")).join(
        spark.read.parquet(SF.replace("0.001", "0.01") + "/labels.parquet"), "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.9


@pytest.fixture(scope="module")
def trees():
    rows = duckdb.sql(f"SELECT html FROM '{SF}/pages.parquet'").fetchall()
    paragraphs = sorted({" ".join(x.split())[:800] for (h,) in rows for x in re.findall(r"<p>([^<]{60,})", h)})
    return paragraphs, htmlmain.train(paragraphs, 300)


def read(model, page):
    tree = htmlmain.parse(page)
    x, chars = htmlmain.features(tree)
    return htmlmain.main_text(tree, htmlmain.decode(tree, htmlmain.log_probabilities(model, x), chars))


def test_layouts_held_out(trees):
    paragraphs, model = trees
    rng, hit, found, wanted = np.random.default_rng(99), 0, 0, 0
    for _ in range(80):
        page = htmlmain.layout(rng, paragraphs)
        tree = htmlmain.parse(page)
        truth = " ".join("".join(" " if n < 0 else t if htmlmain.MARK in t else "" for n, t in tree.parts).replace(htmlmain.MARK, "").split()).split()
        got = read(model, page.replace(htmlmain.MARK, "")).split()
        hit += sum(min(truth.count(w), got.count(w)) for w in set(truth))
        found += len(got)
        wanted += len(truth)
    assert hit / found > 0.97 and hit / wanted > 0.97


def test_decoding_is_consistent(trees):
    paragraphs, model = trees
    tree = htmlmain.parse(htmlmain.layout(np.random.default_rng(5), paragraphs).replace(htmlmain.MARK, ""))
    x, chars = htmlmain.features(tree)
    logs = htmlmain.log_probabilities(model, x)
    n = len(tree.tag)
    # brute force on small trees: every assignment that respects the order of states
    small = htmlmain.parse("<div><p>aaa aaa</p><ul><li>b</li><li>c</li></ul></div>")
    chars_small = htmlmain.features(small)[1]
    rng = np.random.default_rng(1)
    for _ in range(50):
        z = np.log(rng.dirichlet([1, 1, 1], len(small.tag)))
        best, at = -np.inf, None
        for code in range(3 ** len(small.tag)):
            s = [code // 3 ** k % 3 for k in range(len(small.tag))]
            ok = all(s[small.parent[k]] in (htmlmain.MIXED, s[k]) for k in range(1, len(s))) and s[0] == htmlmain.MIXED
            if ok and (v := sum(z[k, s[k]] for k in range(1, len(s)) if chars_small[k] > 0)) > best and all(
                    s[k] != htmlmain.MIXED or small.children[k] for k in range(1, len(s))):
                best, at = v, s
        got = htmlmain.decode(small, np.vstack([[[-50, -50, 0]], z[1:]]), chars_small)
        assert [bool(g) for g, s, c in zip(got, at, small.children) if not c] == [s == htmlmain.MAIN for s, c in zip(at, small.children) if not c]
    assert len(htmlmain.decode(tree, logs, chars)) == n


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    odd = [(10_001, "u", None), (10_002, None, ""), (10_003, "u", "<p>"), (10_004, "u", "a < b & c &amp; d"), (None, "u", "<div>" * 3000 + "deep"),
           (10_005, "u", "<script>x</script><style>y</style>"), (10_006, "u", "<![CDATA[x]]><!-- c --><br/></p></div>")]
    odd = spark.createDataFrame(odd, "page_id long, url string, html string")
    out = htmlmain.extract(pages.unionByName(odd).withColumn("text", F.lit(3)), sample=50, layouts=500)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = {r["page_id"]: r for r in out.collect()}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert got[10_001]["text"] == got[10_002]["text"] == got[10_003]["text"] == got[10_005]["text"] == ""
    exact = 0
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        exact += got[r["page_id"]]["text"] == " ".join(html.unescape(re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br)>", " ", body))).split())
    assert exact >= 0.95 * pages.count()
    assert htmlmain.extract(pages.limit(0), layouts=20).count() == 0


def test_mixing_meets_targets(spark):
    rng = np.random.default_rng(4)
    kinds = {"clean": ["river", "stone"], "toxic": ["trash", "scum"], "junk": ["###", "&&&"]}
    rows, truth = [], {}
    for k in range(900):
        truth[k] = rng.choice(["clean", "toxic", "junk"], p=[0.6, 0.25, 0.15])
        rows.append((k, " ".join(rng.choice(["a", "of", "then", *kinds[truth[k]]], 30)) + " " + kinds[truth[k]][0], "en", "r"))
    rows += [(5000, None, None, "r"), (5001, "", "en", "r"), (None, "river a", "en", "r"), (1, rows[1][1], "en", "r"), (5002, "river " * 30_000, "en", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, rate string")
    domains = spark.createDataFrame([(k, str(truth[k])) for k in range(0, 900, 3)] + [(None, "clean"), (2, None)], "doc_id long, domain string")
    out = mixing.mix(docs, domains, {"clean": 0.8, "toxic": 0.15, "junk": 0.05}, "clean")
    assert out.columns == ["doc_id", "text", "lang", "rate", "copies"] and out.count() == len(rows)
    got = out.collect()
    assert all(r["rate"] >= 0 and abs(r["copies"] - r["rate"]) < 1 for r in got)
    tokens = {d: 0.0 for d in kinds}
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 900:
            tokens[truth[r["doc_id"]]] += r["rate"] * len(r["text"].split())
    tokens["clean"] += sum(r["rate"] * 30_000 for r in got if r["doc_id"] == 5002)
    total = sum(tokens.values())
    for d, share in {"clean": 0.8, "toxic": 0.15, "junk": 0.05}.items():
        assert tokens[d] / total == pytest.approx(share, abs=0.02)
    assert {(r["rate"], r["copies"]) for r in mixing.mix(docs, domains.limit(0), {"clean": 1.0}, "clean").collect()} == {(1.0, 1)}
    assert mixing.mix(docs.limit(0), domains, {"clean": 1.0}, "clean").count() == 0


def test_rates_are_the_least_squares(spark):
    classes = [([16, 0], 1000.0), ([8, 8], 400.0), ([0, 16], 600.0), ([12, 4], 100.0)]
    frame = spark.createDataFrame(classes, "class_ array<int>, tokens double")
    rates, wanted = mixing.fit_rates(frame, 2, 16, [0.9, 0.1], 0, 0.002, 2000)
    got = {tuple(r["class_"]): r["rate"] for r in rates.collect()}
    p, t = np.array([c for c, _ in classes]) / 16, np.array([x for _, x in classes])
    w = np.array(wanted)

    def cost(r):
        e = (p * (t * r)[:, None]).sum(0)
        return ((e - w) ** 2 / w).sum() / 2 + 0.002 / 2 * (t * (r - 1) ** 2).sum()

    r = np.ones(4)
    for _ in range(20_000):  # plain projected descent
        e = (p * (t * r)[:, None]).sum(0)
        r = np.maximum(0, r - 0.1 * ((p * ((e - w) / w)).sum(1) + 0.002 * (r - 1)))
    mine = np.array([got[tuple(c)] for c, _ in classes])
    assert (mine >= 0).all() and cost(mine) <= cost(r) * 1.02 + 1e-6


def test_mixing_meets_targets_by_unrounded_posteriors(spark):
    """Words shared by the domains: most documents have small posteriors of other domains."""
    rng = np.random.default_rng(14)
    words = ["river", "stone", "cloud", "grass", "brick", "plant"]
    weights = {"clean": [8, 6, 5, 4, 3, 2], "toxic": [4, 4, 4, 5, 5, 5], "junk": [2, 3, 4, 5, 6, 8]}
    rows, truth = [], {}
    for k in range(1500):
        truth[k] = str(rng.choice(["clean", "toxic", "junk"], p=[0.8, 0.12, 0.08]))
        p = np.array(weights[truth[k]], float) * 0.07
        rows.append((k, " ".join(["a", "of", *[w for w, x in zip(words, p) if rng.random() < x]] * int(rng.integers(1, 9))), "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    domains = spark.createDataFrame(list(truth.items()), "doc_id long, domain string")
    targets = {"clean": 0.93, "toxic": 0.05, "junk": 0.02}
    model = mixing.fit(docs, domains)
    own = {r["doc_id"]: list(r["posteriors_"]) for r in mixing.with_classes(docs, model, "text", "lang", 16).collect()}
    got = {r["doc_id"]: r["rate"] for r in mixing.mix(docs, domains, targets, "clean", rounds=3000).collect()}
    mass = sum(np.array(own[k]) * len(t.split()) * got[k] for k, t, _ in rows)
    share = dict(zip(model.domains, mass / mass.sum()))
    before = sum(np.array(own[k]) * len(t.split()) for k, t, _ in rows)
    print(share, dict(zip(model.domains, before / before.sum())))
    assert all(share[d] == pytest.approx(x, abs=0.003) for d, x in targets.items())


def test_licenses(spark):
    texts = ["Licensed under the Apache License, Version 2.0. Then more.", "x. RELEASED under the MIT  License", None, "", "mit license",
             "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "This work is licensed under the GNU General Public License, version 3.",
             "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
             "You may obtain a copy of the License at", "word " * 20_000 + "\nReleased under the MIT License.\n" * 50]
    docs = spark.createDataFrame([(k, t, "q") for k, t in enumerate(texts)] + [(None, texts[0], "q"), (0, texts[0], "q")], "doc_id long, text string, rules string")
    got = licenses.scan(docs).toPandas()
    assert list(got.columns) == ["doc_id", "n_sentences", "sentences", "rules", "licenses"] and len(got) == 11
    first = got.set_index("doc_id")
    assert first.loc[7, "rules"] == "apache-2-full" and first.loc[5, "licenses"] == "MIT,CC-BY-NC-4.0" and first.loc[4, "licenses"] == "" and first.loc[2, "n_sentences"] == 0
    assert first.loc[8, "n_sentences"] == 50
    with duckdb.connect() as c:
        c.register("documents", docs.toPandas())
        want = c.execute(licenses.oracle_sql()).df()
    rows = lambda f: sorted(map(repr, f[sorted(f.columns)].fillna(-1).itertuples(index=False, name=None)))
    assert rows(got.astype({"doc_id": float})) == rows(want.astype({"doc_id": float}))
    assert all(any(c in s for c in licenses.cues(licenses.SENTENCES)) for s in licenses.SENTENCES.values())
    assert licenses.scan(docs.limit(0)).count() == 0


WRAPPED = {
    "mit-full": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "mit-mention": "This tool is great. Released under the MIT License.",
    "mit-mention-2": "Licensed under the MIT License.",
    "apache-2-full": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0""",
    "apache-2-mention": "Licensed under the Apache License, Version 2.0.",
    "apache-2-mention-2": 'Licensed under the Apache License, Version 2.0 (the "License").',
    "gpl-3-full": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "gpl-3-mention": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3-mention-2": "This program is licensed under the GNU General Public License, version 3.",
    "bsd-full": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.""",
    "mpl-2-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "cc-by-mention": "Licensed under CC BY 4.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-mention": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-mention": "Licensed under CC BY-NC 4.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}
for _rule in ("mit", "gpl-3", "bsd"):
    WRAPPED[{"bsd": "bsd-mention"}.get(_rule, _rule + "-grant")] = WRAPPED[_rule + "-full"].split("\n\n")[0]

PUBLISHED = "under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
HOPE = "This {} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {}General Public License for more details."
RECEIVED = "You should have received a copy of the GNU {}General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
FREE = "This {} is free software; you can redistribute it and/or modify it "
BINARY = "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
WRAPPED |= {
    "apache-2-body": WRAPPED["apache-2-full"] + """

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "gpl-2-full": "\n\n".join([FREE.format("program") + PUBLISHED.format("", "2"), HOPE.format("program", ""), RECEIVED.format("")]),
    "gpl-2-grant": FREE.format("program") + PUBLISHED.format("", "2"),
    "gpl-2-only-grant": FREE.format("program") + "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl-2-mention": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-2-1-full": "\n\n".join([FREE.format("library") + PUBLISHED.format("Lesser ", "2.1"), HOPE.format("library", "Lesser ")]),
    "lgpl-2-1-grant": FREE.format("library") + PUBLISHED.format("Lesser ", "2.1"),
    "lgpl-3-full": "\n\n".join([FREE.format("library") + PUBLISHED.format("Lesser ", "3"), HOPE.format("library", "Lesser ")]),
    "lgpl-3-grant": FREE.format("library") + PUBLISHED.format("Lesser ", "3"),
    "agpl-3-full": "\n\n".join([FREE.format("program").replace(";", ":") + PUBLISHED.format("Affero ", "3"), HOPE.format("program", "Affero "), RECEIVED.format("Affero ")]),
    "agpl-3-grant": FREE.format("program").replace(";", ":") + PUBLISHED.format("Affero ", "3"),
    "isc-full": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "bsd-2-full": WRAPPED["bsd-full"] + "\n\n" + BINARY,
    "bsd-3-full": WRAPPED["bsd-full"] + "\n\n" + BINARY + "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-3-mention": "Licensed under the BSD 3-Clause License.", "bsd-2-mention": "Licensed under the BSD 2-Clause License.",
    "epl-2-notice": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl-1-notice": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "cc0-waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", "cc0-mention": "Licensed under CC0 1.0.",
    **{rule: f"SPDX-License-Identifier: {name}" for rule, name in (("mit-spdx", "MIT"), ("apache-2-spdx", "Apache-2.0"), ("gpl-2-spdx", "GPL-2.0-only"), ("gpl-3-spdx", "GPL-3.0-or-later"), ("isc-spdx", "ISC"),
                                                                  ("bsd-3-spdx", "BSD-3-Clause"), ("bsd-2-spdx", "BSD-2-Clause"), ("mpl-2-spdx", "MPL-2.0"), ("epl-2-spdx", "EPL-2.0"), ("cc0-spdx", "CC0-1.0"))},
}


@pytest.mark.parametrize("width", [12, 40, 72, 10_000])
def test_licenses_in_wrapped_text(spark, width):
    assert set(WRAPPED) == {r for r, _, _ in licenses.RULES}
    texts = {}
    for rule, text in WRAPPED.items():
        for sign in ("", " * ", "# "):
            for end in ("\n", "\r\n"):
                lines = [x for part in text.split("\n\n") for x in [*textwrap.wrap(part, width, break_long_words=False, break_on_hyphens=False), ""]]
                texts[rule, sign, end] = end.join(f"{sign}{x}" for x in ["Copyright 2020 Somebody", "", *lines, "more words"])
    docs = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    got = {r["doc_id"]: r["rules"] for r in licenses.scan(docs).collect()}
    assert [(k, got[n]) for n, k in enumerate(texts) if got[n] != k[0]] == []
    with duckdb.connect() as c:
        c.register("documents", docs.toPandas())
        want = c.execute(licenses.oracle_sql()).fetchall()
    names = ["doc_id", "n_sentences", "sentences", "rules", "licenses"]
    assert sorted(want) == sorted(tuple(r[n] for n in names) for r in licenses.scan(docs).collect())
    apart = spark.createDataFrame([(0, "Released under\n\nthe MIT License."), (1, "Released under. the MIT License."), (2, "not released\nunder the MIT License")], "doc_id long, text string")
    assert {r["rules"] for r in licenses.scan(apart).collect()} == {""}
