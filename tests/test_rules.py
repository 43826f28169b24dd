"""Boundaries of the scalar rules."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import reference_rules as rules
from pressroom import fixed_values as fv
from pressroom.functions import dates, events as ev, html as hx, similarity as sim, text as tx, urls
from pressroom.operators import images, ledger, modules, scoring

AS_OF = "2024-01-31 00:00:00"


def value(spark, col, **row):
    df = spark.createDataFrame([tuple(row.values())], list(row)) if row else spark.range(1)
    return df.select(col.alias("v")).first().v


def values(spark, texts, fn):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in df.select("i", fn(F.col("t")).alias("v")).orderBy("i").collect()]


def test_text_forms(spark):
    texts = ["  Ünïcode_Ñandú — ½ ﬁne!  ", "Visit https://x.y/z?a=1 now", "ĲSSEL №5 ②", "", "日本 game"]
    assert values(spark, texts, tx.ascii_words) == [rules.plain(t) for t in texts]
    assert values(spark, texts, tx.word_normal) == [rules.normal(t) for t in texts]
    assert values(spark, ["a b", "one two three four"], lambda c: tx.cut_at_word(c, 9)) == ["a b", "one two…"]
    assert values(spark, ["one, two three"], lambda c: tx.shorten(c, 6)) == ["one."]
    assert values(spark, ["T - Src", "T — Src", "T"], lambda c: tx.strip_source(c, F.lit("src"), images.DASHES)) == ["T", "T", "T"]
    assert values(spark, ["A - B - C", "plain"], lambda c: tx.source_of(F.lit(None).cast("string"), c)) == ["C", fv.NO_SOURCE]
    assert values(spark, ["a.b A.B axb"], lambda c: tx.highlight(c, F.lit("a.b"), "<", ">")) == ["<a.b> <A.B> axb"]


def test_dates(spark):
    got = values(spark, ["Mon, 29 Jan 2024 10:00:00 GMT", "29 Jan 2024 10:00:00 +0200", "29 Jan 2024 10:00:00", "nonsense", None],
                 lambda c: F.date_format(dates.feed_date(c), "dd HH:mm"))
    assert got == ["29 10:00", "29 08:00", "29 10:00", None, None]
    now = datetime(2024, 1, 31, tzinfo=timezone.utc)
    ages = [(12, 16), (12.01, 12), (24, 12), (48, 7), (72, 3), (72.01, -20), (-5, 16)]
    df = spark.createDataFrame([(now - timedelta(hours=h), p) for h, p in ages] + [(None, 0)], "t timestamp, p int")
    assert all(r.a == r.p for r in df.select("p", dates.age_points(F.col("t"), AS_OF).alias("a")).collect())
    days = values(spark, ["2024-01-21", "2024-01-20T10:00", "20 ENE 2024"], lambda c: dates.since_day(dates.day_of(c), "2024-01-31 00:00:00", 10))
    assert days == [True, False, False]
    assert values(spark, ["2024-01-21"], lambda c: dates.since_day(dates.day_of(c), "2024-01-31 00:00:01", 10)) == [False]
    assert value(spark, dates.card_date(dates.clock("2024-08-05 02:00:00"))) == "04 AGO 2024"


def test_urls(spark):
    got = values(spark, ["HTTPS://A.B:80/P/?q#f", "https://a.b", "x/y/", ""], urls.canonical_url)
    assert got == ["https://a.b:80/P", "https://a.b", "x/y", ""]
    assert values(spark, ["a.jpg 1x, b.jpg 2x", "a 300w, b 1200w, c", ""], urls.best_of_srcset) == ["b.jpg", "b", ""]
    refs = {"//c/i.png": "https://c/i.png", "/i.png": "https://h/i.png", "i.png": "https://h/d/i.png", "../i.png": "https://h/i.png",
            "https://o/i": "https://o/i"}
    assert values(spark, list(refs), lambda c: urls.absolute_url(F.lit("https://h/d/p?x"), c)) == list(refs.values())
    assert values(spark, ["https://a/b.svg?x", "data:x", "https://a/icons/b.png", "https://a/b.png"], urls.usable_image_url) == [False, False, False, True]


def test_events(spark):
    ws = ["delayed", "robot", "soldier", "investigation", "launch", "launches", "betas", "2026"]
    df = spark.createDataFrame([(w,) for w in ws], "w string")
    got = {r.w: r.e for r in df.select("w", ev.event_of(F.col("w")).alias("e")).collect()}
    assert got == {w: rules.event_of(w, fv.EVENT_CLASSES) for w in ws}


@pytest.mark.parametrize("a,b", [
    ("alpha beta", "alpha beta gamma"), ("game pad", "gamepad"), ("", "x"), ("google pixel phones", "google pixel phone"),
    ("one two three", "four five six"), ("nintendo direct date", "nintendo date delayed direct soon"),
])
def test_ratio(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    parts = sim.set_parts(tx.word_set(F.col("a")), tx.word_set(F.col("b")))
    got = sim.with_ratio(df.withColumn("p", parts), "p", "r").first().r
    assert got == pytest.approx(rules.ratio(a, b))
    assert rules.ratio(a, b) == pytest.approx(rules.ratio(b, a))


def test_scoring_rules(spark):
    rows = [
        ("Sony announces PlayStation game pass price increase and layoffs", "IGN", 12),
        ("Official trailer: new game delayed", "Blog", 12), ("Official trailer for new game", "Blog", 12),
        ("Top 10 best games deal rumor leak might be", "Screenrant", 12),
    ]
    now = datetime(2024, 1, 31, tzinfo=timezone.utc)
    df = spark.createDataFrame([(t, s, now - timedelta(hours=h)) for t, s, h in rows], "title string, source string, published timestamp")
    got = [r for r in scoring.with_scores(df, AS_OF).collect()]
    gaming = [{s.branch: s for s in r.scores}["gaming"] for r in got]
    assert gaming[0].reasons == ["fuente +30", "actualidad +16", "impacto +24", "anuncio +6", "marca +10"]
    assert gaming[0].score == 86
    assert "video/tráiler -12" in gaming[1].reasons and "video/tráiler menor -22" in gaming[2].reasons
    assert {"oferta -35", "listicle -42", "especulación fuerte -30", "fuente -12"} <= set(gaming[3].reasons)
    pop = {s.branch: s for s in got[0].scores}["cultura_pop"]
    assert pop.score == sum(int(r.rsplit(" ", 1)[1]) for r in pop.reasons)


def test_branch_ties_go_to_the_first_named(spark):
    df = spark.createDataFrame([("x", "s", None, ["tecnologia", "gaming"]), ("x", "s", None, ["none"])],
                               "title string, source string, published timestamp, allowed array<string>")
    rows = scoring.assign_branch(df, AS_OF).collect()
    assert [r.editorial_branch for r in rows] == ["tecnologia"]


def test_budget(spark):
    levels = [(2.99, "NORMAL"), (3.0, "ADVERTENCIA"), (4.0, "CRITICO"), (4.5, "STOP")]
    df = spark.createDataFrame(levels, "s double, want string")
    assert all(r.l == r.want for r in df.select("want", ledger.budget_level(F.col("s")).alias("l")).collect())
    cost = ledger.call_cost(F.lit("gpt-5.6-terra"), F.lit(15000), F.lit(3000), F.lit(5000))
    assert value(spark, cost) == pytest.approx(10000 * 2e-6 + 5000 * 0.2e-6 + 3000 * 12e-6)
    with pytest.raises(Exception, match="Modelo sin precio"):
        value(spark, ledger.call_cost(F.lit("other"), F.lit(1), F.lit(1)))


def test_facts_and_modules(spark):
    texts = ["El 3 de Mayo de 2027 llega", "marzo de 2026.", "en 2025 o 2030", "x20255"]
    assert values(spark, texts, modules.date_in) == ["3 de Mayo de 2027", "marzo de 2026", "2025", ""]
    assert values(spark, ["invierte 3,5 mil millones de dólares hoy", "5 euros"], modules.amount_in) == ["3,5 mil millones de dólares", ""]
    assert values(spark, ["PC", "para Xbox y Disney+"], modules.platforms_in) == [["PC"], ["Xbox", "Disney+"]]
    base = {"titulo": "Una empresa inviert en chips", "resumen": "Resumen largo de la noticia", "anguloShort": "", "por_que_importa": "Cambia el mercado de chips para todos", "categoria": "TEC 5 millones de dolares"}
    df = spark.createDataFrame([tuple(base.values())], list(base))
    row = modules.pick_two(modules.with_modules(df)).first()
    assert [m.titulo for m in row.modules] == ["INVERSIÓN", "POR QUÉ IMPORTA", "DATO CLAVE"]
    assert [m.titulo for m in row.picked] == ["POR QUÉ IMPORTA", "INVERSIÓN"]


def test_pick_two_drops_weak_and_repeated(spark):
    one = [("POR QUE IMPORTA", "uno dos tres cuatro cinco seis"), ("DATO CLAVE", "uno dos tres cuatro cinco siete"), ("FECHA", "2027")]
    two = [("CONTEXTO", "uno dos tres cuatro cinco"), ("IMPACTO", "cinco cuatro tres dos uno"), ("PRECIO", "cuesta 500 dolares")]
    df = spark.createDataFrame([(one,), (two,)], f"modules array<{modules.MODULE}>")
    got = [[m.titulo for m in r.picked] for r in modules.pick_two(df).collect()]
    # row one: the date is weak; the two others say nearly the same, so both stay
    assert got == [["POR QUE IMPORTA", "DATO CLAVE"], ["CONTEXTO", "PRECIO"]]


def test_html(spark):
    page = ("<html><head><title>T</title><meta content='Desc &amp; more' name=\"description\"><meta property='og:title' content='OG \"t\"'></head>"
            "<body><p>outside</p><article><p>first <b>bold</b>&nbsp;text</p><!-- <p>no</p> --><script>var x='<p>no</p>'</script><p>second</p></article></body></html>")
    assert values(spark, [page], lambda c: hx.meta(c, "property", "og:title")) == ['OG "t"']
    assert values(spark, [page], lambda c: hx.meta(c, "name", "description")) == ["Desc & more"]
    assert values(spark, [page], lambda c: hx.paragraphs(hx.section(hx.visible(c)), 5)) == [["first bold text", "second"]]
