"""Image references, landed files, outputs."""

import struct

import pytest
from pyspark.sql import functions as F

from pressroom.operators import images, pages
from pressroom.session import scratch_path
from pressroom.sources import landed, outputs, versions

PAGE = """<html><head>
<meta property="og:image" content="//cdn.x/og.jpg"><meta property="og:image:alt" content="Alt og">
<meta name="twitter:image" content="/tw.png">
<script type="application/ld+json">{"@graph":[{"image":{"url":"https://x/ld.jpg","thumbnailUrl":["https://x/t.jpg"]}},{"a":{"image":"https://cdn.x/og.jpg"}}]}</script>
<script type="application/ld+json">broken{</script></head>
<body><img src="/outside.jpg"><article>
<figure><img srcset="/a-300.jpg 300w, /a-900.jpg 900w" src="/a.jpg" alt="Big"><figcaption>The <i>caption</i></figcaption></figure>
<img data-src="/b.jpg?x=1" src="/ph.gif" title="B"><img src="/logo.svg"><img src="https://cdn.x/og.jpg" alt="a much longer text than before">
</article></body></html>"""


def test_image_references(spark):
    df = spark.createDataFrame([(1, "https://site.org/news/p", PAGE)], "page_id int, url string, html string")
    got = {(r.kind, r.url): r.text.strip() for r in pages.image_references(df).collect()}
    assert got == {
        ("og", "https://cdn.x/og.jpg"): "a much longer text than before", ("twitter", "https://site.org/tw.png"): "",
        ("jsonld", "https://x/ld.jpg"): "", ("jsonld", "https://x/t.jpg"): "",
        ("article", "https://site.org/a-900.jpg"): "Big  The caption", ("article", "https://site.org/b.jpg?x=1"): "B",
    }


def test_page_profiles(spark):
    long = "word " * 20
    html = f"<h1>Head</h1><main><p>short</p><p>{long}</p><p>{long.upper()}</p><p>{long}x</p></main>"
    df = spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string")
    meta = pages.page_metadata(df).first()
    assert meta.page_title == "Head" and meta.extract == f"{long.strip()} {long.upper().strip()}"
    text = pages.article_text(df).first()
    assert text.parrafos == [long.strip(), f"{long}x"] and text.useful


def test_search_queries(spark):
    df = spark.createDataFrame([("Wingfeather Saga season two trailer - Variety", "variety", "https://v.com/2024/wingfeather-saga-new-look/")], "t string, s string, u string")
    got = df.select(images.search_queries(F.col("t"), F.col("s"), F.col("u")).alias("q")).first().q
    assert got == ["Wingfeather Saga season two trailer", "2024 wingfeather saga", "wingfeather saga", "wingfeather saga two"]


@pytest.mark.parametrize("total,url_hits,text_hits,original,bonus,width,height,ok", [
    (105, 1, 0, False, 0, 600, 338, True), (104, 1, 0, False, 0, 2000, 2000, False), (90, 0, 2, True, 0, 1000, 560, True),
    (90, 0, 2, True, 0, 999, 560, False), (95, 0, 2, False, 30, 1000, 400, True), (94, 0, 2, False, 30, 1000, 400, False),
    (110, 0, 2, False, 15, 600, 338, True), (110, 0, 1, False, 15, 600, 338, False),
])
def test_acceptance(spark, total, url_hits, text_hits, original, bonus, width, height, ok):
    df = spark.createDataFrame([(total - bonus, ["x"] * url_hits, ["a", "b"][:text_hits], [], width, height)],
                               "score int, matched_url_specific array<string>, matched_text_specific array<string>, bad_url_terms array<string>, width int, height int")
    assert df.select(images.acceptable(F.lit(bonus), F.lit(original)).alias("v")).first().v is ok


def test_cascade_prefers_the_first_tier_that_has_something(spark):
    rows = [(1, 0, 5, "a", "og", 90), (1, 1, 1, "b", "og", 300), (2, 1, 2, "c", "article", 80), (2, 1, 1, "d", "og", 80), (2, 2, 0, "e", "og", 500)]
    df = spark.createDataFrame(rows, "story int, tier int, seq int, url string, kind string, score_with_source int")
    got = {r.story: (r.image_candidate_url, r.source_type, r.alternatives) for r in images.choose_image(df, "story").collect()}
    assert got == {1: ("a", "og", ["a"]), 2: ("d", "alternative_og", ["d", "c"])}


def test_rss(spark, tmp_path):
    (tmp_path / "f.xml").write_text("""<rss><channel>
<item><title>Fresh story - The Paper</title><link>https://n/1</link><pubDate>Tue, 30 Jan 2024 10:00:00 GMT</pubDate><source url="https://p">The Paper</source></item>
<item><title>Old story - X</title><link>https://n/2</link><pubDate>Tue, 02 Jan 2024 10:00:00 GMT</pubDate></item>
<item><title>Undated - Side - Blog</title><link>https://n/3</link></item><item><title> </title></item></channel></rss>""")
    rows = landed.rss_items(spark, str(tmp_path), "2024-01-31 00:00:00", "gaming", "q", 3).orderBy("link").collect()
    assert [(r.title, r.source) for r in rows] == [("Fresh story", "The Paper"), ("Undated - Side", "Blog")]
    assert rows[1].published is None and rows[0].categories_seen == ["gaming"]


def test_json_lists(spark, tmp_path):
    schema = "title string, n int"
    assert landed.json_list(spark, str(tmp_path / "missing.json"), schema).count() == 0
    (tmp_path / "a.json").write_text('[{"title":"x","n":1},{"title":"y","n":2}]')
    assert landed.json_list(spark, str(tmp_path / "a.json"), schema).count() == 2
    assert landed.json_list_strict(spark, str(tmp_path / "a.json"), schema, "a").count() == 2
    (tmp_path / "bad.json").write_text("{not json")
    assert landed.json_list(spark, str(tmp_path / "bad.json"), schema).count() == 0
    with pytest.raises(Exception):
        landed.json_list_strict(spark, str(tmp_path / "bad.json"), schema, "bad")
    with pytest.raises(Exception):
        landed.json_list_strict(spark, str(tmp_path / "missing.json"), schema, "missing")


def test_manifest(spark, tmp_path):
    head = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", 1080, 1350)
    (tmp_path / "00_cover.png").write_bytes(head + b"\0" * 12000)
    (tmp_path / "x.jpg").write_bytes(b"\xff\xd8\xff\xe0" + b"\0" * 50)
    rows = {r.path.rsplit("/", 1)[1]: r for r in landed.image_manifest(spark, str(tmp_path)).collect()}
    png = rows["00_cover.png"]
    assert (png.format, png.width, png.height, png.n_bytes) == ("PNG", 1080, 1350, 24 + 12000)
    assert rows["x.jpg"].format == "JPEG" and rows["x.jpg"].width is None and rows["x.jpg"].n_bytes == 54


def test_outputs(spark, tmp_path):
    path = str(tmp_path / "t")
    assert outputs.stage_table(spark, path, "id long").count() == 0
    outputs.overwrite(spark.range(3), path, "run1")
    outputs.overwrite(outputs.stage_table(spark, path, "id long").filter("id > 0"), path, "run2")  # reads what it replaces
    assert outputs.stage_table(spark, path, "id long").count() == 2
    assert outputs.stage_table(spark, path, "id long", "run1").count() == 3  # the snapshot of a run
    outputs.overwrite(spark.range(0), path, "run3")
    assert outputs.stage_table(spark, path, "id long").count() == 0
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_failed_write_leaves_the_old_version(spark, tmp_path):
    path = str(tmp_path / "t")
    outputs.overwrite(spark.range(100), path, "run1")
    broken = spark.range(100).withColumn("id", F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")))
    with pytest.raises(Exception, match="broken"):
        outputs.overwrite(broken, path, "run2")
    assert outputs.stage_table(spark, path, "id long").count() == 100
    assert outputs.stage_table(spark, path, "id long", "run2").count() == 0
    outputs.overwrite(spark.range(7), path, "run2")
    assert outputs.stage_table(spark, path, "id long").count() == 7


def test_old_versions_go_with_what_only_they_name(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(5):
        outputs.overwrite(spark.range(n + 1), path, f"run{n}")
    assert len(versions.forget(spark, path, keep=2)) == 3
    assert [outputs.stage_table(spark, path, "id long", f"run{n}").count() for n in range(5)] == [0, 0, 0, 4, 5]
    assert versions.forget(spark, path, keep=2) == [] and versions.forget(spark, str(tmp_path / "none")) == []


def test_mistyped_record_loses_its_field_only(spark, tmp_path):
    (tmp_path / "mixed.json").write_text('[{"n": 1, "t": "a"}, {"n": "x", "t": "b"}, {"n": 3, "t": "c"}]')
    rows = landed.json_list(spark, str(tmp_path / "mixed.json"), "n int, t string").collect()
    assert [(r.n, r.t) for r in rows] == [(1, "a"), (None, "b"), (3, "c")]


def test_dot_segments_at_any_depth(spark):
    from urllib.parse import urljoin

    from pyspark.sql import functions as F

    from pressroom.functions import urls

    base = "https://a.b/1/2/3/4/5/6/7/p.html"
    refs = ["../../../../../x.jpg", "../" * 9 + "x.jpg", "./x.jpg", "y/./../x.jpg?q=../z", "..", "../.", "a/b/", "x.jpg#../q"]
    df = spark.createDataFrame([(base, r) for r in refs], "base string, ref string")
    got = [r[0] for r in df.select(urls.absolute_url(F.col("base"), F.col("ref"))).collect()]
    assert got == [urljoin(base, r) for r in refs]


def test_no_paragraph_is_left_out(spark):
    texts = [f"Paragraph number {i} " + "with enough words to count as a good one " * 3 for i in range(60)]
    html = "<article>" + "".join(f"<p>{t}</p>" for t in texts) + "</article>"
    df = spark.createDataFrame([(1, "https://a.example/x", html)], "page_id int, url string, html string")
    assert len(pages.article_text(df).first().parrafos) == 60
    assert len(pages.article_text(df, looked_at=35, most=8, shown=5).first().parrafos) == 5


def test_stories_without_a_url_find_no_text(spark):
    texts = pages.article_text(spark.createDataFrame([(1, "", "<h1>Lost page</h1>"), (2, "https://a.example/x", "<h1>Found page</h1>")], "page_id int, url string, html string"))
    stories = spark.createDataFrame([(1, "one", "s", ""), (2, "two", "s", None), (3, "three", "s", "https://a.example/x")], "numero int, titulo string, fuente string, url string")
    got = {r.numero: (r.titulo_original, r.estado) for r in pages.article_context(stories, texts).collect()}
    assert got == {1: ("one", "PARCIAL"), 2: ("two", "PARCIAL"), 3: ("Found page", "OK")}


def test_addresses_in_linked_data(spark):
    deep = '"https://a/5"'
    for _ in range(40):
        deep = f"[{deep}]"
    texts = [
        '{"@graph": [{"image": {"url": ["https://a/1", {"contentUrl": "//a/2", "caption": "https://a/no"}]}, "url": "https://a/no"}, {"author": {"image": "https://a/3", "logo": {"image": ["https://a/4", "data:x", 7, null]}}}]}',
        f'{{"image": {deep}}}', "null", "{broken", '"https://a/no"', '{"image": "{\\"url\\": \\"https://a/no\\"}"}', '[{"z": 1, "image": "https://z", "a": {"image": "https://y"}}, []]', None,
    ]
    df = spark.createDataFrame([(i, [0], t) for i, t in enumerate(texts)], "page int, at array<int>, json string")
    got = {}
    for r in pages.linked_data_images(df, "page").orderBy("page", "at").collect():
        got.setdefault(r.page, []).append(r.url)
    assert got == {0: ["https://a/1", "//a/2", "https://a/3", "https://a/4"], 1: ["https://a/5"], 6: ["https://z", "https://y"]}
    assert pages.linked_data_images(df.limit(0), "page").count() == 0


def test_nested_elements_stay_whole(spark):
    from pressroom.functions import html as hx

    cases = {
        "a<article class='x'>one <article>two</article> <ARTICLE>three</ARTICLE > four</article>five": "one <article>two</article> <ARTICLE>three</article> four",
        "<article>open <article>inner</article> rest": "open <article>inner</article> rest", "<p>none</p>": "", "<article></article><article>second</article>": "",
    }
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    assert [r.e for r in df.select(hx.whole_element(F.col("h"), "article").alias("e")).collect()] == list(cases.values())


def test_attributes_are_read_once(spark):
    from pressroom.functions import html as hx

    tag = """<img SRC='/a b.jpg' alt="x > 'y' &amp; z" data-src=lazy.png title = "T" srcset="" alt="second">"""
    df = spark.createDataFrame([(tag,)], "t string").select(hx.attributes(F.col("t")).alias("r"))
    row = df.select(*[hx.value_of(F.col("r"), n).alias(n.replace("-", "_")) for n in ("src", "alt", "data-src", "title", "srcset", "none")]).first()
    assert tuple(row) == ("/a b.jpg", "x > 'y' & z", "lazy.png", "T", "", "")


def test_list_records_are_split_over_tasks(spark, tmp_path):
    import json

    records = [{"n": i, "t": f'a "quoted"\n  }} text {i}', "more": {"x": [1, {"y": 2}]}} for i in range(5000)]
    (tmp_path / "list.json").write_text(json.dumps(records, indent=2))
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "odd.json").write_text('[\n  {\n    "n": "x",\n    "t": "mistyped"\n  },\n  {\n    n: 1\n  },\n  {\n    "n": 7\n  }\n]')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
        rows, rejected = landed.json_records(spark, str(tmp_path), "n int, t string")
        assert rows.rdd.getNumPartitions() >= 4
        got = {(r.n, r.t) for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {(r["n"], r["t"]) for r in records} | {(None, "mistyped"), (7, None)}
    assert sorted((r.file.rsplit("/", 1)[1], "mistyped" in r.record) for r in rejected.collect()) == [("odd.json", False), ("odd.json", True)]
    assert [x.count() for x in landed.json_records(spark, str(tmp_path / "missing"), "n int")] == [0, 0]


def test_image_sizes_read_headers_only():
    import io

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            Counted.taken += len(out)
            return out

    def jpeg(*parts):
        return b"\xff\xd8" + b"".join(parts)

    app = b"\xff\xe1" + struct.pack(">H", 60_000) + b"\xff" * 59_998
    size = b"\xff\xc2" + struct.pack(">HBHH", 17, 8, 480, 640) + b"\0" * 12
    cases = {
        jpeg(app, app, b"\xff", size): ("JPEG", 640, 480), jpeg(app, b"\xff\xda\0\0"): ("JPEG", None, None), jpeg(b"\xff\xc4\0\x04ab", size): ("JPEG", 640, 480),
        jpeg(app, size[:6]): ("JPEG", None, None), jpeg(b"\xff\xd0" * 3000, size): ("JPEG", None, None), b"\x89PNG\r\n\x1a\n": ("PNG", None, None), b"": (None, None, None), b"GIF89a": (None, None, None),
    }
    for data, want in cases.items():
        Counted.taken = 0
        assert landed.image_size(Counted(data + b"\0" * 500_000 if want[1] else data)) == want
        assert Counted.taken <= 24 + 9 * landed.MOST_SEGMENTS


def test_second_pool(spark):
    rows = [(1, f"q{q}", q, p, "" if p == 0 else f"https://h{q}/{p}", 10 * q) for q in range(1, 6) for p in range(8)]
    df = spark.createDataFrame(rows, "story int, query string, query_no int, pos int, url string, quality_bonus int")
    got = images.second_pool(df, "story", "query").orderBy("place").collect()
    assert [(r.query_no, r.pos) for r in got] == [(q, p) for q in (3, 2, 1) for p in range(1, 5)]
