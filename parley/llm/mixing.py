"""Soft-membership mixing of a corpus to target domain weights, in DataFrame functions only.

1. A multinomial logistic regression learns domains from labelled rows: from at most
   ``per_domain`` documents of each domain (least hash of the id), weighted to the sizes
   of the domains in all labels. Its features are the ``words`` words that tell most about
   the domain, the shares of signs, of capital letters and of words said twice in a
   row, and the language; it is applied as a column expression.
2. Every document gets posteriors. Documents whose posteriors agree when rounded to
   multiples of 1 / ``steps`` form a class, of which there are at most
   C(steps + D - 1, D - 1) for D domains, whatever the input. Rounding decides the class
   alone: tokens, and tokens times each unrounded posterior, are summed over all documents
   of a class (posteriors as multiples of 2^-30 in exact sums, so that no order matters).
3. Projected-gradient least squares fits one rate >= 0 per class, so that the expected
   tokens of each domain (sum of rate * tokens * unrounded posterior) match the targets; a small
   weight ``ridge`` pulls rates to 1 and makes them unique. The sums over documents are distributed (step
   2); the steps fold over the class table in one expression. The total is such that the ``anchor`` domain keeps its tokens.
4. A document of rate r is repeated floor(r + u) times, u in [0, 1) from a hash of its id
   and text: whole copies by the whole part, one more by the fraction.

A null text counts as empty (no tokens; it follows its class). Null ids are not learned
from. Rows that agree in id and text get the same rate and the same number of copies. Labels of an id
that is there several times: the least domain name counts. Extra columns pass through
(``rate`` and ``copies`` replace columns of that name); an empty table gives no rows.
Without labels every document has posterior 1 for the anchor and rate 1."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.bpe import let
from parley.llm.common import bounded_sample, stage, text_or_empty

SIGNS = r"[#$%&*|!@^~<>{}\[\]=+_]"
CAPITALS = "[A-Z]"
CLASSES = 200_000  # rows of the table that the gradient steps fold over
UNIT = 1 << 30  # posteriors are summed as multiples of 1 / UNIT


@dataclass
class Classifier:
    domains: list[str]
    words: list[str] = field(default_factory=list)
    buckets: list[tuple[str, str]] = field(default_factory=list)  # (feature, value)
    bias: list[float] = field(default_factory=list)  # per domain
    weights: list[list[float]] = field(default_factory=list)  # per domain: words, then buckets


def features(text: Column, lang: Column | None) -> dict[str, Column]:
    """Small categorical features of a document."""
    def share(signs: str) -> Column:
        part = F.regexp_count(text, F.lit(signs)) / F.greatest(F.length(text), F.lit(1))
        return F.when(part == 0, "0").when(part < 0.01, "1").when(part < 0.05, "2").when(part < 0.2, "3").otherwise("4")

    again = F.regexp_count(text, F.lit(r"(?<!\S)(\S++) \1(?!\S)")) * 40 / F.greatest(F.length(text), F.lit(40))
    echo = F.when(again == 0, "0").when(again < 0.02, "1").when(again < 0.1, "2").otherwise("3")
    out = {"signs": share(SIGNS), "capitals": share(CAPITALS), "echo": echo}
    return out | ({"lang": F.coalesce(lang.cast("string"), F.lit(""))} if lang is not None else {})


def has_word(text: Column, word: str) -> Column:
    return F.contains(F.lower(text), F.lit(word))


def fit(docs: DataFrame, domains: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
        per_domain: int = 1500, words: int = 24, least: int = 20) -> Classifier:
    """``domains``: (id_col, domain string)."""
    own = domains.filter(F.col(id_col).isNotNull() & F.col("domain").isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min("domain").alias("domain"))
    totals = {r["domain"]: r["count"] for r in own.groupBy("domain").count().collect()}
    names = sorted(totals)
    if not names:
        return Classifier([])
    chosen = own.limit(0)
    for d in names:
        chosen = chosen.unionAll(bounded_sample(own.filter(F.col("domain") == d), F.xxhash64("id"), per_domain, totals[d]))
    text = text_or_empty(text_col)
    picked = docs.select(F.col(id_col).alias("id"), text.alias("text"), *[c.alias(f"f_{k}") for k, c in features(
        text, F.col(lang_col) if lang_col and lang_col in docs.columns else None).items()])
    sample = stage(picked.join(F.broadcast(chosen), "id"), "mixing-sample")  # at most per_domain ids of each domain
    sizes = {r["domain"]: r["count"] for r in sample.groupBy("domain").count().collect()}
    rows = sample.repartition(64, "id").select("domain", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")) \
        .filter((F.length("word") >= 3) & (F.octet_length("word") <= 40))
    per_word = rows.groupBy("word").agg(*[F.sum((F.col("domain") == d).cast("long")).alias(f"n{k}") for k, d in enumerate(names)])
    # information of presence about the domain, priors counted alike
    shares = [(F.col(f"n{k}") + 0.5) / (sizes.get(d, 0) + 1.0) for k, d in enumerate(names)]
    mean = sum(shares[1:], shares[0]) / len(names)
    gain = sum(((p * F.log(p / mean) + (1 - p) * F.log((1 - p) / (1 - mean))) for p in shares[1:]),
               shares[0] * F.log(shares[0] / mean) + (1 - shares[0]) * F.log((1 - shares[0]) / (1 - mean)))
    total = sum((F.col(f"n{k}") for k in range(1, len(names))), F.col("n0"))
    best = [r["word"] for r in per_word.filter(total >= least).orderBy(F.desc(gain), "word").limit(words).collect()]
    kinds = [c[2:] for c in sample.columns if c.startswith("f_")]
    values = [(k, r[0]) for k in kinds for r in sorted(sample.select(f"f_{k}").distinct().collect())]
    rows = sample.select(F.col("domain"), *[has_word(F.col("text"), w).cast("double").alias(f"x{k}") for k, w in enumerate(best)],
                         *[(F.col(f"f_{k}") == v).cast("double").alias(f"x{len(best) + j}") for j, (k, v) in enumerate(values)])
    label, weight = F, F
    for k, d in enumerate(names):
        label = label.when(F.col("domain") == d, float(k))
        weight = weight.when(F.col("domain") == d, totals[d] / max(sizes.get(d, 0), 1))
    rows = stage(rows.withColumns({"label": label, "weight": weight}), "mixing-features")
    if len(sizes) < 2 or not best + values:
        return Classifier(names, bias=[math.log(totals[d] / sum(totals.values())) for d in names], weights=[[] for _ in names])
    size = len(best) + len(values)
    fitted = LogisticRegression(family="multinomial", weightCol="weight", regParam=1e-3, maxIter=50).fit(
        VectorAssembler(inputCols=[f"x{k}" for k in range(size)], outputCol="features").transform(rows))
    matrix, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    seen = len(bias)  # domains after the last one that has a sampled text are never predicted
    return Classifier(names, best, values, [float(bias[k]) if k < seen else -1e3 for k in range(len(names))],
                      [[float(x) for x in matrix[k]] if k < seen else [0.0] * size for k in range(len(names))])


def with_classes(docs: DataFrame, model: Classifier, text_col: str, lang_col: str | None, steps: int) -> DataFrame:
    """``docs`` with ``class_``: the rounded posteriors as array<int>, in domain order, and
    ``posteriors_``: array<double>. In the class the likeliest domain takes what rounding
    leaves. Every feature is a column of its
    own before the sums, so that it is computed once for all domains."""
    text = text_or_empty(text_col)
    lang = F.col(lang_col) if lang_col and lang_col in docs.columns else None
    rows = docs.withColumn("low_", F.lower(text))
    rows = rows.withColumns({f"f_{k}": c for k, c in features(text, lang).items()}
                            | {f"w_{k}": F.contains("low_", F.lit(w)) for k, w in enumerate(model.words)})
    logs = []
    for k in range(len(model.domains)):
        log, own = F.lit(model.bias[k]), model.weights[k]
        for j, x in enumerate(own[:len(model.words)]):
            log = log + F.when(F.col(f"w_{j}"), F.lit(x)).otherwise(F.lit(0.0))
        for (name, value), x in zip(model.buckets, own[len(model.words):], strict=False):
            if f"f_{name}" in rows.columns:
                log = log + F.when(F.col(f"f_{name}") == value, F.lit(x)).otherwise(F.lit(0.0))
        logs.append(log)
    rows = rows.select(*docs.columns, F.array(*logs).alias("logs_"))
    rows = rows.withColumn("weights_", F.transform("logs_", lambda x: F.exp(x - F.array_max("logs_"))))
    rows = rows.withColumn("posteriors_", F.transform("weights_", lambda x: x / F.aggregate("weights_", F.lit(0.0), lambda a, y: a + y)))
    rows = rows.withColumn("parts_", F.transform("posteriors_", lambda x: F.floor(x * steps).cast("int")))
    spare = F.lit(steps) - F.aggregate("parts_", F.lit(0), lambda a, y: a + y)
    top = F.array_position("weights_", F.array_max("weights_")).cast("int") - 1
    rows = rows.withColumn("class_", F.transform("parts_", lambda x, k: x + F.when(k == top, spare).otherwise(F.lit(0))))
    return rows.drop("logs_", "weights_", "parts_")


def fit_rates(classes: DataFrame, n: int, steps: int, targets: list[float], anchor: int, ridge: float, rounds: int) -> tuple[DataFrame, list[float]]:
    """(class_, rate) for ``classes`` (class_ array<int>, tokens, and shares_ array<double>:
    the mean posteriors of the tokens, class_ / steps if it is missing), and the targets
    in tokens. Minimises, relative to all tokens, the squared misses over the targets and
    ``ridge`` times the token-weighted squares of rate - 1, by projected gradient steps
    scaled per class by its tokens. The sums over documents lie in ``classes``; the
    steps are one fold of higher-order functions over that bounded table."""
    if "shares_" not in classes.columns:
        classes = classes.withColumn("shares_", F.transform("class_", lambda x: x / F.lit(float(steps))))
    row = classes.agg(*[F.sum(F.col("tokens") * F.col("shares_")[k]).alias(f"d{k}") for k in range(n)]).first()
    now = [float(x or 0.0) for x in row]
    share = sum(targets)
    scale = now[anchor] / targets[anchor] * share if targets[anchor] > 0 and now[anchor] > 0 else sum(now)
    wanted = [t / share * scale for t in targets]
    size = [max(w, 1e-9 * max(scale, 1.0)) for w in wanted]
    live = [k for k in range(n) if now[k] > 0]  # domains without tokens cannot be reached by any rate
    step = 1.0 / (max((now[k] / size[k] for k in live), default=1.0) + ridge)
    table = F.col("table")

    def total(parts: Column) -> Column:
        return F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)

    def tokens_of(k: int):
        return lambda c, r: c["tokens"] * r * c["shares_"][k]

    def descend(rates: Column, _: Column) -> Column:
        misses = F.array(*[(total(F.zip_with(table, rates, tokens_of(k))) - wanted[k]) / size[k]
                           if k in live else F.lit(0.0) for k in range(n)])
        return let(misses, lambda miss: F.zip_with(table, rates, lambda c, r: F.greatest(F.lit(0.0), r - step * (
            total(F.zip_with(c["shares_"], miss, lambda share, m: share * m)) + ridge * (r - 1)))))

    folded = classes.agg(F.collect_list(F.struct("class_", F.col("tokens").cast("double").alias("tokens"), "shares_")).alias("table")).select(
        "table", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.transform("table", lambda c: F.lit(1.0)), descend).alias("rates"))
    return folded.select(F.explode(F.zip_with(table, F.col("rates"), lambda c, r: F.struct(c["class_"].alias("class_"), r.alias("rate")))).alias("x")).select("x.*"), wanted


def mix(docs: DataFrame, domains: DataFrame, targets: dict[str, float], anchor: str, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str | None = "lang", steps: int = 16, ridge: float = 0.002, rounds: int = 400) -> DataFrame:
    """``docs`` with ``rate`` double and ``copies`` int. ``targets``: weight per domain
    (domains of ``domains`` that it leaves out have target 0). ``steps``: the finest
    rounding; with many domains it is as coarse as keeps the classes at ``CLASSES`` or fewer."""
    base = docs.drop("rate", "copies")
    names = base.columns
    model = fit(base, domains, id_col, text_col, lang_col)
    others = max(len(model.domains), 1) - 1
    while steps > 1 and math.comb(steps + others, others) > CLASSES:  # ways to deal the steps out
        steps -= 1
    if not model.domains or anchor not in model.domains:
        return base.withColumns({"rate": F.lit(1.0), "copies": F.lit(1)})
    work = base.toDF(*[f"c{k}" for k in range(len(names))])  # no clash with working columns
    own = {x: f"c{names.index(x)}" for x in (id_col, text_col, *([lang_col] if lang_col in names else []))}
    text = text_or_empty(own[text_col])
    marked = with_classes(work, model, own[text_col], own.get(lang_col), steps)
    # features are computed once: the classes read narrow columns of this table, the result the rest
    marked = stage(marked.withColumn("tokens_", F.regexp_count(text, F.lit(r"\S+")).cast("long")), "mixing-documents")
    n = len(model.domains)
    masses = [F.sum((F.col("tokens_") * F.round(F.col("posteriors_")[k] * UNIT).cast("long")).cast("decimal(20,0)")) for k in range(n)]
    classes = marked.groupBy("class_").agg(F.sum("tokens_").alias("tokens"), *[x.alias(f"m{k}") for k, x in enumerate(masses)])
    shares = [F.coalesce(F.try_divide(F.col(f"m{k}").cast("double"), F.col("tokens") * F.lit(float(UNIT))), F.lit(0.0)) for k in range(n)]
    classes = stage(classes.select("class_", "tokens", F.array(*shares).alias("shares_")), "mixing-classes")
    rates, _ = fit_rates(classes, n, steps, [float(targets.get(d, 0.0)) for d in model.domains], model.domains.index(anchor), ridge, rounds)
    side = F.broadcast(stage(rates, "mixing-rates"))  # as many rows as classes
    u = F.pmod(F.xxhash64(own[id_col], own[text_col]), F.lit(1 << 24)) / float(1 << 24)
    out = marked.join(side, "class_", "left").withColumn("rate", F.coalesce("rate", F.lit(1.0)))
    return out.select(*[F.col(f"c{k}").alias(x) for k, x in enumerate(names)], "rate", F.floor(F.col("rate") + u).cast("int").alias("copies"))


def label_domains(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The three domains of the label table: junk (quality 0), toxic, clean."""
    return labels.select(id_col, F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic")
                         .when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean").alias("domain"))
