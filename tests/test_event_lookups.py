"""Event words are looked up by set; only words that can matter are compared with the lists."""

import reference_rules as rules
from pyspark.sql import functions as F

from pressroom import fixed_values as fv
from pressroom.functions import events as ev, text as tx

CLASSES = [("b", ["onti", "a"], ["de"]), ("a", ["on"], ["deal", "atto"]), ("b", [], ["x"])]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_events_by_set(spark):
    titles = ["ontic on de deal atto x", "", "  d o dea xx", "Délayed film: retraso, ROBO lanzamiento", "null nothing"]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    words = tx.words(tx.ascii_words(F.col("t")))
    for classes in (CLASSES, fv.EVENT_CLASSES):
        rows = df.select(words.alias("w"), ev.event_set(words, classes).alias("e"), ev.with_events_named(words, classes).alias("n")).collect()
        for r in rows:
            found = [rules.event_of(w, classes) for w in r.w]
            assert r.e == sorted({e for e in found if e})
            assert r.n == [e or w for e, w in zip(found, r.w)]
    # most words go after one look at a set, and the normalisation is under no lambda
    plan = optimized(df.select(ev.event_set(words)))
    assert "substring(" in plan and "filter(split(" not in plan
