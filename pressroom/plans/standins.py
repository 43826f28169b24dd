"""The driver tables seen as feed, history, asset and ledger tables.

Every row of a table takes part. Headlines are all sentences of a document's whole text. Stories that are told apart
by their titles are the pages: the title is the whole heading, the link the page's URL. Dates are arithmetic on ids, so that SQL agrees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressroom.functions import text as tx, urls

AS_OF = "2024-01-31 00:00:00"
BRANCH_OF_LANG = {"en": "gaming", "es": "tecnologia", "fr": "cultura_pop", "de": "cultura_pop"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; one stored as a single split is spread over the cores."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _branch():
    out = None
    for lang, branch in BRANCH_OF_LANG.items():
        cond = F.col("lang") == lang
        out = F.when(cond, branch) if out is None else out.when(cond, branch)
    return out


def _feed_columns(df: DataFrame, link: Column | None = None) -> DataFrame:
    hours = F.col("doc_id") % 240
    known = F.timestamp_micros(F.unix_micros(F.lit(AS_OF).cast("timestamp")) - hours * 3_600_000_000)
    branch = _branch()
    return df.select(
        "doc_id", "seq", "title", "source",
        branch.alias("branch"),
        F.array(branch).alias("categories_seen"),
        F.when(F.col("doc_id") % 17 == 0, None).otherwise(known).alias("published"),
        (F.lit("") if link is None else link).alias("link"),
        tx.merge_key(F.lit(""), F.col("title"), F.col("source")).alias("key"),
    )


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of every document as a feed row; seq is document, then place."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", "lang", "source", F.posexplode(F.split("text", "[.\n]+")).alias("pos", "title"))
    rows = rows.withColumn("title", F.trim("title")).filter(F.col("title") != "")
    return _feed_columns(rows.withColumn("seq", F.col("doc_id") * 1_000_000 + F.col("pos")))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed row per document, with its whole text for a title."""
    docs = table(spark, sf_dir, "documents")
    return _feed_columns(docs.select("doc_id", "lang", "source", F.trim("text").alias("title"), F.col("doc_id").alias("seq")))


HEADING = r"<h1[^>]*>(.*?)</h1>"
PAGE_HOST = r"^https?://([^/?#]+)"
PAGE_LANGUAGE = r"^https?://[^/?#]+/([a-z]+)/"


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed row per page: the whole heading as title, the host as source, the path's language as branch."""
    return page_feed(table(spark, sf_dir, "pages"))


def page_feed(pages: DataFrame) -> DataFrame:
    rows = pages.select(
        F.col("page_id").alias("doc_id"), F.col("page_id").alias("seq"), F.trim(F.regexp_extract("html", HEADING, 1)).alias("title"),
        F.regexp_extract("url", PAGE_HOST, 1).alias("source"), F.regexp_extract("url", PAGE_LANGUAGE, 1).alias("lang"), "url",
    )
    fed = _feed_columns(rows, F.coalesce("url", F.lit("")))
    return fed.withColumn("key", tx.merge_key(urls.canonical_url(F.col("link")), F.col("title"), F.col("source")))


def _decorated():
    """Whether a link has a query or a fragment: such pages came through a feed, the others are the site's own."""
    return F.col("link").rlike("[?#]")


def published_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under plain links, as stories published up to 40 days ago."""
    rows = page_articles(spark, sf_dir).filter(~_decorated())
    day = F.date_format(F.date_sub(F.lit("2024-01-31").cast("date"), (F.col("doc_id") % 40).cast("int")), "yyyy-MM-dd")
    return rows.select(
        F.col("doc_id").alias("hist_seq"), day.alias("date"), "branch", "title", "source", F.col("link").alias("url"),
        tx.slug(F.col("title")).alias("story_key"),
    )


# every third open story brings a word of an event that the published ones seldom have
NEWS_WORD = "ontilayed"


def open_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under links with a query or a fragment; every third heading carries its story on."""
    rows = page_articles(spark, sf_dir).filter(_decorated())
    return rows.withColumn("title", F.when(F.col("doc_id") % 3 == 1, F.concat_ws(" ", "title", F.lit(NEWS_WORD))).otherwise(F.col("title")))


def page_batches(rows: DataFrame) -> DataFrame:
    """Page stories in batches of 24 ids; those of mobile and blog hosts are reserves."""
    return rows.withColumns({
        "batch": F.floor(F.col("doc_id") / 24).cast("bigint"), "editorial_branch": F.col("branch"), "reserve": F.col("source").rlike(r"^(m|blog)\."),
    })


def fixture_rules():
    """A rule table drawn from words of the driver tables; the editorial lists match almost none."""
    from pressroom.operators.scoring import BranchRules, Rule

    shared = (Rule("ruido", -9, ("re", "ble", "que la"), "count", 18), Rule("cifra", -7, (r"\b\d+\b",), "regex"))

    def rules(impact, brands, minor):
        return BranchRules(
            ("src1",), ("src2", "src3"), ("src4",),
            (Rule("impacto", 8, impact, "count", 24), Rule("marca", 5, brands, "count", 15),
             Rule("menor", -12, minor, also=("the", "la", "der")), Rule("menor solo", -22, minor, unless=("the", "la", "der")))
            + shared,
        )

    return {
        "gaming": rules(("anea", "attion", "reedes", "to the", "and the"), ("is", "of", "thble"), ("thor", "ing")),
        "tecnologia": rules(("ciue", "asboque", "de la", "el"), ("osgata", "que", "jaqueue"), ("arez", "ga")),
        "cultura_pop": rules(("éeuxier", "sch", "und der", "et"), ("le", "die", "zu"), ("pour", "nicht")),
    }


# event words, drawn from the driver tables, in the shape of fixed_values.EVENT_CLASSES
EVENT_CLASSES = [
    ("delay", ["attion", "onti"], []), ("cancel", ["sch"], ["reedes"]), ("launch", [], ["anea", "aux", "und"]),
    ("release", ["thble", "queeau"], ["de"]), ("announce", ["reing", "eux"], ["the", "la"]),
    ("sales", ["ciue", "thor"], ["los"]), ("beta", [], ["is", "die"]),
]
EVENT_FAMILIES = {
    "release": ["attion", "to the", "de la"], "delay": ["anea", "und"], "update": ["is the", "la", "the and"],
    "lawsuit": ["thble", "der"],
}


def scored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as candidates of batches of 24 documents, with an arithmetic score."""
    rows = articles(spark, sf_dir)
    return rows.select(
        "*", F.col("doc_id").alias("candidate_id"), F.col("branch").alias("editorial_branch"),
        F.floor(F.col("doc_id") / 24).cast("bigint").alias("batch"), ((F.col("doc_id") * 37) % 101).alias("editorial_score"),
    )


def chosen_and_proposed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidates, chosen, proposed reserves) from the labels: good and clean documents are chosen;

    poor ones are proposed; toxic ones propose their successor under their own branch.
    """
    cands = scored_articles(spark, sf_dir).select("batch", "candidate_id", "editorial_branch", "editorial_score", "seq")
    labels = table(spark, sf_dir, "labels")
    labelled = cands.join(labels, F.col("candidate_id") == F.col("doc_id"))
    chosen = labelled.filter("quality = 1 and toxic = 0").select("batch", "candidate_id", "editorial_branch")
    proposed = labelled.filter("quality = 0 or toxic = 1").select(
        "batch", F.when(F.col("toxic") == 1, F.col("candidate_id") + 1).otherwise(F.col("candidate_id")).alias("candidate_id"),
        "editorial_branch", F.col("doc_id").alias("ordinal"),
    )
    return cands, chosen, proposed


def stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as finished stories in batches of six, with the faults their ids call for."""
    docs = table(spark, sf_dir, "documents")
    sentence = F.filter(F.transform(F.split("text", "[.\n]+"), lambda s: F.trim(s)), lambda s: s != "")
    rows = docs.select("doc_id", "lang", "source", "text", sentence.alias("s"))
    title, rest = F.element_at("s", 1), F.array_join(F.slice("s", 2, 2147483647), ". ")
    place = F.col("doc_id") % 6 + 1
    lead = F.array_join(F.slice(F.split(title, " "), 1, 3), " ")
    return rows.select(
        "doc_id", F.floor(F.col("doc_id") / 6).cast("bigint").alias("batch"), place.alias("place"),
        F.when(F.col("doc_id") % 29 == 0, "09").otherwise(F.lpad(place.cast("string"), 2, "0")).alias("numero"),
        F.upper("lang").alias("categoria"), F.when(F.col("doc_id") % 31 == 0, "deportes").otherwise(_branch()).alias("rama"),
        F.lit("31 ENE 2024").alias("fecha"), title.alias("titulo"),
        F.when(F.col("lang") == "de", F.array(F.concat(F.lit("¡"), lead))).otherwise(F.array(lead)).alias("tituloDestacado"),
        rest.alias("resumen"), F.array(F.substring_index(rest, " ", 2), F.lit("zzz")).alias("resumenDestacado"),
        F.lit("").alias("imagen"), F.col("source").alias("fuente"),
        F.when(F.col("doc_id") % 37 == 0, "").otherwise(F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))).alias("url"),
        F.lit("").alias("fecha_original"), F.lit("").alias("por_que_importa"), F.lit("").alias("anguloShort"),
        F.lit("").alias("imagenFuente"), F.lit("").alias("imagenFuenteUrl"), F.lit("").alias("imagenTipo"),
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as calls: two models, tokens from the event value."""
    ev = table(spark, sf_dir, "events")
    model = F.when(F.col("user_id") % 2 == 0, "gpt-5.6-terra").otherwise("gpt-5.6-luna")
    return ev.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), model.alias("model"),
        F.floor(F.col("value") * 40).cast("bigint").alias("input_tokens"), F.floor(F.col("value") * 8).cast("bigint").alias("output_tokens"),
        F.floor(F.col("value") * 10).cast("bigint").alias("cached_tokens"),
    )


def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as delivered pieces: eight a run, an hour is a run, errors were not delivered."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.date_format("ts", "yyyy-MM-dd HH").alias("run"), F.lpad((F.col("event_id") % 9).cast("string"), 2, "0").alias("key"),
        (F.col("event_type") != "error").alias("delivered"), "event_type",
    )


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as images of a manifest."""
    part = table(spark, sf_dir, "part")
    kinds = F.array(F.lit("article"), F.lit("jsonld"), F.lit("og"), F.lit("twitter"))
    return part.select(
        F.col("p_partkey").alias("asset_id"), F.floor(F.col("p_partkey") / 40).cast("bigint").alias("story"),
        F.concat(F.lit("https://cdn.example.com/"), F.regexp_replace("p_name", " ", "-"), F.lit("-"), F.col("p_partkey").cast("string"), F.lit(".jpg")).alias("url"),
        F.lower(F.concat_ws(" ", "p_type", "p_name", "p_brand")).alias("text"),
        F.element_at(kinds, (F.col("p_partkey") % 4 + 1).cast("int")).alias("kind"),
        (F.col("p_size") * 40 + 300).alias("width"), (F.col("p_size") * 22 + 170).alias("height"),
        F.floor(F.col("p_retailprice") * 21).cast("bigint").alias("n_bytes"),
    )


# source tiers of the driver tables' source names
TIERS = {"official": ["x.example.org"], "premium": ["src1"], "good": ["src2", "src3"], "low": ["src4", "src5"]}


def assets_with_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest images of a story (40 parts) with the story's topic words: those of its first part."""
    from pressroom.operators import images

    a = assets(spark, sf_dir)
    lead = a.filter(F.col("asset_id") == F.col("story") * 40).select("story", F.col("text").alias("headline"))
    topic = images.topic_words(F.col("headline"), F.lit(""), F.lit("https://example.org/gear/official-hot"))
    return a.join(lead, "story").withColumns({
        "topic": topic, "seq": F.col("asset_id"), "source": F.concat(F.lit("src"), (F.col("story") % 7).cast("string")),
        "original": F.col("asset_id") % 3 == 0,
    })


def coverage_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as entries of coverage searches: 200 documents a story, a language is a query."""
    docs = table(spark, sf_dir, "documents")
    number = F.element_at(F.create_map(*[F.lit(x) for p in (("de", 1), ("en", 2), ("es", 3), ("fr", 4)) for x in p]), F.col("lang"))
    return docs.select(
        F.floor(F.col("doc_id") / 200).cast("bigint").alias("story"), F.col("lang").alias("query"), number.alias("query_no"),
        F.col("doc_id").alias("pos"), F.concat(F.lit("https://h"), (F.col("doc_id") % 13).cast("string"), F.lit(".example.org/"), F.floor(F.col("doc_id") / 3).cast("string")).alias("url"),
        "source",
    )


def asset_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest written as pages: each image is named in one of six ways, those in the text twice."""
    a = assets(spark, sf_dir)
    url, number = F.concat(F.col("url"), F.lit("?w=1")), F.col("asset_id").cast("string")

    def made(*parts):
        return F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])

    ways = [
        made('<figure><img class="x" data-src="', url, '" alt="', F.col("kind"), '"><figcaption> ', F.col("text"), ' <b>now</b></figcaption></figure><article><img src="', url, '"></article>'),
        made('<meta property="og:image" content="', url, '">'),
        made("<meta name='twitter:image' content='//cdn.example.com/tw-", number, ".jpg'>"),
        made('<script type="application/ld+json">{"@graph":[{"name":"image","image":{"url":"', url, '","thumbnailUrl":["', url, '&amp;t=1"]}},{"a":{"b":[{"image":["//cdn.example.com/deep-', number, '.jpg","no address"]}]}}]}</script>'),
        made('<img srcset="/s-', number, '-300.jpg 300w, /s-', number, '-900.jpg 900w" src="/s-', number, '.jpg" title="wide">'),
        made("<img data-lazy-src=../img/", number, ".png src='/blank.gif' alt='lazy'><img src='/logo-", number, ".svg'>"),
    ]
    way = F.element_at(F.array(*ways), (F.col("asset_id") % 6 + 1).cast("int"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("asset_id", way.alias("f")))), lambda x: x["f"]), " ")
    html = F.concat(F.lit('<html><meta property="og:image:alt" content="A &amp; B"><article>'), body, F.lit("<script type='application/ld+json'>{broken</script></article><img src='/outside.jpg'></html>"))
    return a.groupBy(F.col("story").alias("page_id")).agg(html.alias("html")).withColumn("url", F.lit("https://example.org/a/b"))


# what the rules for information modules look for; the driver tables hold none of it, so each document gets one of them by its id
PHRASES = [
    "", "La inversion es de 30 millones de dólares", "Se retrasa a mayo de 2026", "Llega a Nintendo Switch 2", "La pelicula llega el 3 de junio de 2025",
    "Un ciberataque a gran escala", "Habrá uno cada semana", "Con NVLink Fusion", "En PlayStation y Xbox", "En 2027 para PC y Xbox", "A corto plazo, en Netflix",
]


def json_text(value):
    """A column as JSON; null is null."""
    return F.coalesce(F.nullif(F.regexp_extract(F.to_json(F.struct(value.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1), F.lit("")), F.lit("null"))


def landed_lists(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Documents written as indented JSON lists of up to 500 records; some records have a mistyped field, some are broken."""
    docs = table(spark, sf_dir, "documents")
    name = F.when(F.col("doc_id") % 50 == 9, "doc_id").otherwise('"doc_id"')
    size = F.when(F.col("doc_id") % 50 == 7, '"many"').otherwise(F.col("n_chars").cast("string"))
    record = F.concat(
        F.lit("  {\n    "), name, F.lit(": "), F.col("doc_id").cast("string"), F.lit(',\n    "n_chars": '), size, F.lit(',\n    "more": {\n      "source": '),
        json_text(F.col("source")), F.lit('\n    },\n    "text": '), json_text(F.col("text")), F.lit("\n  }"),
    )
    lists = docs.select(F.floor(F.col("doc_id") / 500).alias("part"), F.struct("doc_id", record.alias("r")).alias("r")).groupBy("part").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    whole = F.concat(F.lit("[\n"), F.array_join(F.transform("rs", lambda x: x["r"]), ",\n"), F.lit("\n]"))
    lists.select("part", whole.alias("value")).write.partitionBy("part").text(path)


def xml_text(value):
    """A column as the text of an XML element."""
    for plain, written in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        value = F.replace(value, F.lit(plain), F.lit(written))
    return value


def landed_feed(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Pages written as RSS files of up to 500 entries; a heading's &amp; is a plain & there, and what is markup in XML is escaped."""
    rows = page_articles(spark, sf_dir)
    title = xml_text(F.replace(F.col("title"), F.lit("&amp;"), F.lit("&")))
    date = F.coalesce(F.concat(F.lit("<pubDate>"), F.date_format("published", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate>")), F.lit(""))
    item = F.concat(
        F.lit("<item><title>"), title, F.lit(" - "), xml_text(F.upper("source")), F.lit("</title><link>"), xml_text(F.col("link")), F.lit("</link>"), date, F.lit('<source url="https://x">'), xml_text(F.col("source")), F.lit("</source></item>"),
    )
    files = rows.groupBy(F.floor(F.col("doc_id") / 500).alias("part")).agg(F.array_join(F.collect_list(item), "\n").alias("items"))
    files.select("part", F.concat(F.lit("<rss><channel>\n"), "items", F.lit("\n</channel></rss>")).alias("value")).write.partitionBy("part").text(path)


def image_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """An image header per supplier, with a size from its key: PNG files, and JPEG files with segments before the size."""
    import struct

    import pyarrow as pa

    from pressroom.sources.landed import arrow_file

    def write(batches):
        for batch in batches:
            place, folder = arrow_file(path)
            place.create_dir(folder, recursive=True)
            for key in batch.column(0).to_pylist():
                width, height = 300 + key * 37 % 1700, 200 + key * 53 % 900
                data = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sII", 13, b"IHDR", width, height)
                if key % 2:
                    data = b"\xff\xd8\xff\xe0" + struct.pack(">H", 16) + b"JFIF" + b"\0" * 10 + b"\xff\xe1" + struct.pack(">H", 2 + key % 60_000) + b"\xff" * (key % 60_000)
                    data += b"\xff\xff" * (key % 3) + b"\xff\xc2" + struct.pack(">HBHH", 17, 8, height, width) if key % 5 else b"\xff\xda\0\0"
                with place.open_output_stream(f"{folder}/{key}") as f:
                    f.write(data + b"\0" * (10 * key % 50_000))
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["key"])

    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("bigint").alias("key")).mapInArrow(write, "key bigint").count()
