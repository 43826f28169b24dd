"""Word boundaries in rule patterns are those of the SQL: ASCII word characters, whatever the Java version."""

import duckdb
import pytest
from pyspark.sql import functions as F

from pressroom import fixed_values as fv
from pressroom.operators import scoring
from pressroom.plans import oracles
from pressroom.plans.catalog import QUERIES

TITLES = [
    "4977698924732615 bestüng die", "12 bestß", "12 besten", "12 best", "ä12 best", "Die 7 best", "the 12 bestä", "ñthe 12 best",
    "étop 5 x", "top 5é", "top 5º", "atop 5", "best of appsé", "ébest of all apps", "best of all apps", "best apps", "½12 bestö", "_12 best", "",
]


@pytest.mark.parametrize("name", ["lexicon_score", "branch_assign"])
def test_query_and_sql_agree_beside_accents(spark, tmp_path, name):
    docs = spark.createDataFrame([(i + 1, t, "de", "src1", len(t)) for i, t in enumerate(TITLES)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    with duckdb.connect() as con:
        con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
        result = con.execute(oracles.ORACLES[name])
        columns = [d[0] for d in result.description]
        wanted = sorted(result.fetchall())
    assert sorted(map(tuple, QUERIES[name](spark, str(tmp_path)).select(*columns).collect())) == wanted
    assert any("listicle" in r[-1] or "cifra" in r[-1] for r in wanted)


def test_bounds_are_ascii(spark):
    rule = scoring.Rule("listicle", -42, tuple(fv.LISTICLE_PATTERNS), "regex")
    df = spark.createDataFrame([("12 best",), ("12 bestü",), ("ä12 best",), ("12 besten",), ("a12 best",)], "t string")
    got = [r[0] for r in df.select(scoring._rule_points(rule, F.split("t", " "), F.col("t"))).collect()]
    assert got == [-42, -42, -42, 0, 0]


@pytest.mark.parametrize("pattern, wanted", [
    (r"t\B", [True, False, False, False]), (r"(?!\ba)a", [True, False, False, False]), (r"t(?:\ba)*+a", [True, False, False, False]),
    (r"\\\\b\.", [False, False, False, True]), (r"\b(?:t|u)\b", [False, True, True, False]),
])
def test_other_patterns(spark, pattern, wanted):
    df = spark.createDataFrame([("ta",), ("té",), ("t",), (r"\\b.",)], "t string")
    assert [r[0] for r in df.select(scoring.pattern_found(F.col("t"), [pattern])).collect()] == wanted
