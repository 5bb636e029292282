"""Queries of input shapes and small helpers: JSON files of three shapes, optional columns,
coded values, last rows, labelled rows, evaluation of the first rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from parley.functions import text as tx
from parley.operators import classify as C
from parley.operators import sampling as SM
from parley.plans import jobs as J
from parley.plans.families.cascade_q import LOG_CTE, judged_run
from parley.plans.registry import query
from parley.sources.tables import read_query_file, table, with_default
from parley.streaming.streams import stream_root

FILES = 8


@query("query_files", sql=f"""
SELECT shape, item_id % {FILES} AS file, text FROM benchmark, (VALUES ('objects'), ('wrapped'), ('strings')) s(shape)""")
def q_query_files(spark, d):
    """Benchmark items written as JSON files of every shape that sample queries come in (list of
    objects, object around the list, list of strings) to the shared folder, and read back."""
    items = table(spark, d, "benchmark").select((F.col("item_id") % FILES).alias("file"), "text")
    root, out = stream_root(spark, "query-files"), None
    body = F.collect_list(F.struct("file", "text"))
    shapes = {"objects": F.to_json(body), "wrapped": F.concat(F.lit('{"queries": '), F.to_json(body), F.lit("}")), "strings": F.to_json(F.collect_list("text"))}
    for shape, made in shapes.items():
        # a file per list
        items.groupBy("file").agg(made.alias("value")).write.partitionBy("file").option("maxRecordsPerFile", 1).text(f"{root}/{shape}")
        for k in range(FILES):
            back = read_query_file(spark, f"{root}/{shape}/file={k}")
            rows = back.select(F.lit(shape).alias("shape"), F.lit(k).cast("long").alias("file"), "text")
            out = rows if out is None else out.unionByName(rows)
    return out


LANGUAGES = {"en": "English", "fr": "French", "de": "German"}


@query("coded_values", sql="""
SELECT doc_id, left(text, 120) AS start, CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' ELSE 'another language' END AS language,
       lang, 'other_support' AS intent FROM documents""")
def q_coded_values(spark, d):
    """First characters, values looked up with a default, and columns that are
    there or are given a default."""
    docs = with_default(with_default(table(spark, d, "documents"), "lang", "none"), "intent", "other_support")
    return docs.select("doc_id", tx.truncate("text", 120).alias("start"), tx.choice("lang", LANGUAGES, "another language").alias("language"), "lang", "intent")


@query("last_events", sql="SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")
def q_last_events(spark, d):
    """The last 50 events by time and id (the limit is the feature)."""
    return SM.tail(table(spark, d, "events"), ["ts", "event_id"], 50).select("event_id", "event_type", "value")


@query("labelled_rows", sql="""
SELECT count(l.quality) AS n_labelled, count(l.quality) > 50 AS enough FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def q_labelled_rows(spark, d):
    """Documents with a label, and whether they are enough to train on."""
    docs = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left")
    return C.labelled_rows(docs, "quality")


@query("evaluation_first", sql=f"""WITH {LOG_CTE},
x AS (SELECT s.trigger <> 'none' AS p, t.expected_decision = 'escalate' AS t FROM scored2 s JOIN (SELECT * FROM t ORDER BY msg_id LIMIT 20) t ON t.msg_id = s.msg_id)
SELECT count(*) FILTER (WHERE t AND p) AS tp, count(*) FILTER (WHERE NOT t AND p) AS fp, count(*) FILTER (WHERE t AND NOT p) AS fn, count(*) FILTER (WHERE NOT t AND NOT p) AS tn FROM x""")
def q_evaluation_first(spark, d):
    """The decisions of an evaluation of the first 20 messages by id (the limit is the feature)."""
    judged, truth = judged_run(spark, d)
    return J.evaluate(judged, truth.drop("difficulty"), first=20)["decisions"].select("tp", "fp", "fn", "tn")
