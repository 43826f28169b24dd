"""The registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressroom.llm import bpe, centroids, exact_dedup, hard_negatives, html_text, language, licenses, minhash, mixing, packing, quality, suffix_dedup, url_filter

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_exact_dedup(spark, sf_dir) -> DataFrame:
    """Groups of equal texts, white space folded; the smallest doc_id stays."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256",
    )


ORACLES["op3_exact_dedup"] = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as body from documents)
select doc_id, min(doc_id) over (partition by body) as keep_id, count(*) over (partition by body) as group_size,
       doc_id = min(doc_id) over (partition by body) as kept, sha256(body) as text_sha256
from d
"""


@query
def op4_language_id(spark, sf_dir) -> DataFrame:
    """Language of every whole text, learned from documents whose hash is not held out."""
    docs = table(spark, sf_dir, "documents")
    out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.train(docs, learn=~out)
    held = F.crc32(F.col("_id").cast("string")) % 3 == 1
    return language.predict(docs, model).select(F.col("_id").alias("doc_id"), held.alias("held_out"), "lang_pred", "score", "accepted")


@query
def op6_quality_rules(spark, sf_dir) -> DataFrame:
    """Base numbers of every whole text and the verdict of risk-controlled cutoffs per language."""
    found = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(F.col("_id").alias("doc_id"), *quality.FEATURES, "base_failed", "kept", F.array_join("rejected_by", " ").alias("rejected_by"))


@query
def op8_url_filter(spark, sf_dir) -> DataFrame:
    """Rules by host and path, else the weighted vocabulary, for every page URL."""
    found = url_filter.judge_urls(table(spark, sf_dir, "pages"), rules=url_filter.RULES)
    return found.select(
        "page_id", "host", "path", "rule", "verdict", F.array_join("strict_terms", " ").alias("strict_terms"), F.array_join("soft_terms", " ").alias("soft_terms"),
    )


def _listed(terms: list[str]) -> str:
    each = ", ".join(f"case when regexp_matches(t, '{url_filter.term_pattern([x])}') then '{x}' end" for x in sorted(terms))
    return f"concat_ws(' ', {each})"


def _rule_sql(want: str) -> str:
    fits = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    value = {"rule": lambda r: r[1] + r[2], "verdict": lambda r: r[0]}[want]
    return "case " + " ".join(f"when (host = '{r[1]}' or ends_with(host, '.{r[1]}')) and starts_with(path, '{r[2]}') then '{value(r)}'" for r in fits) + " end"


ORACLES["op8_url_filter"] = f"""
with a as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r from pages),
b as (select page_id, regexp_extract(r, '^[^?#]*') as r from a),
c as (select page_id, translate(regexp_extract(r, '^[^/]*'), '{url_filter.UPPER}', '{url_filter.LOWER}') as host,
             case when strpos(r, '/') > 0 then substr(r, strpos(r, '/')) else '' end as path from b),
d as (select c.*, translate(coalesce(url, ''), '{url_filter.UPPER}', '{url_filter.LOWER}') as t from c join pages using (page_id)),
e as (select *, {_listed(url_filter.STRICT)} as st, {_listed(url_filter.SOFT)} as so from d)
select page_id, host, path, {_rule_sql("rule")} as rule,
       coalesce({_rule_sql("verdict")}, case when st <> '' or (so <> '' and length(so) - length(replace(so, ' ', '')) + 1 >= {url_filter.SOFT_HITS}) then 'block' else 'allow' end) as verdict,
       st as strict_terms, so as soft_terms
from e
"""


@query
def op9_source_mix(spark, sf_dir) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(F.col("_id").alias("doc_id"), "size", "source", "source_size", "target", "taken")


@query
def op2_minhash_dedup(spark, sf_dir) -> DataFrame:
    """Components of documents with similar shingle sets; the smallest doc_id stays."""
    return minhash.near_groups(table(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"), "n_shingles", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept"), "class_id",
    )


@query
def op5_packing(spark, sf_dir) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens, with a checksum of their ids."""
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).select(
        F.col("_id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"), "sequence_id", "offset",
    )


@query
def op1_suffix_dedup(spark, sf_dir) -> DataFrame:
    """Spans of 50 words or more that another document has too."""
    return suffix_dedup.spans(table(spark, sf_dir, "documents")).select(F.col("_id").alias("doc_id"), "start_word", "n_words", "other_id")


@query
def op10_license_scan(spark, sf_dir) -> DataFrame:
    """License notices of every whole text, with the share of the notice that is there."""
    return licenses.scan(table(spark, sf_dir, "documents")).select(F.col("_id").alias("doc_id"), "license", "containment", "start_word", "n_words")


@query
def op7_html_text(spark, sf_dir) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages")).select(F.col("_id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query
def op11_hard_negatives(spark, sf_dir) -> DataFrame:
    """Hard negatives inside a window of each positive's score, for every fiftieth vector."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", moved), anchors=F.col("vec_id") % 50 == 0)


_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

ORACLES["op11_hard_negatives"] = f"""
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
           from embeddings where label is not null and {_FINITE}),
s as (select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
             list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2]))::bigint as score
      from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
p as (select anchor_id, id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select anchor_id, positive_id, row_number() over w as rank, s.id as negative_id, positive_score, s.score as negative_score
from p join s using (anchor_id)
where not s.same and 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
window w as (partition by anchor_id, positive_id order by s.score desc, s.id)
qualify row_number() over w <= 3
"""


@query
def op12_centroids(spark, sf_dir) -> DataFrame:
    """Exact clusters of all vectors around sixteen centroids after three rounds."""
    found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    sha = F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256)
    return found.select(F.col("_id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", sha.alias("centroid_sha256"))


def _round_sql(i: int) -> str:
    return f"""
a{i} as (select vec_id, cluster, d from (select x.vec_id, c.cluster, sum((x.v - c.v) * (x.v - c.v)) as d from x join c{i} c using (dim) group by all)
         qualify row_number() over (partition by vec_id order by d, cluster) = 1),
m{i} as (select cluster, dim, sum(x.v) as s, count(*) as n from a{i} join x using (vec_id) group by all),
c{i + 1} as (select c.cluster, c.dim, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, c.v) as v from c{i} c left join m{i} m using (cluster, dim))"""


ORACLES["op12_centroids"] = f"""
with k as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as e from embeddings where len(embedding) = 64 and {_FINITE}),
f as (select row_number() over (order by sha256('1:' || vec_id)) - 1 as cluster, e from k qualify cluster < 16),
x as (select vec_id, unnest(e) as v, unnest(range(64)) as dim from k),
c0 as (select cluster, unnest(e) as v, unnest(range(64)) as dim from f),
{",".join(_round_sql(i) for i in range(4))},
h as (select cluster, sha256(string_agg(v::bigint::varchar, ',' order by dim)) as centroid_sha256 from c3 group by cluster)
select vec_id, cluster, d::bigint as distance, (sum(d) over (partition by cluster))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia, centroid_sha256
from a3 join h using (cluster)
"""


@query
def op13_byte_bpe(spark, sf_dir) -> DataFrame:
    """Ids of every whole text and the bytes they decode to, as checksums."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    made = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return made.select(F.col("_id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
