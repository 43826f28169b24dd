"""Headings that are no XML."""

from pressroom.plans.catalog import QUERIES


def test_feed_keeps_headings_that_are_no_xml(spark, tmp_path):
    heads = ["Law &amp; order", "A &quot;b&quot; c", "Cut &am", "Cut &amp", "R&D &&&", "x < y > z", "a ]]> b", "plain <b>bold</b>"]
    rows = [(i * 17, f"https://www.x.example.org/en/{i}?a=1&b=2", f"<h1>{h}</h1>") for i, h in enumerate(heads)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.link: r.title for r in QUERIES["landed_rss"](spark, str(tmp_path)).collect()}
    assert got == {url: h.replace("&amp;", "&") for (_, url, _), h in zip(rows, heads)}
