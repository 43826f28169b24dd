"""The training-data operators on small and odd inputs, against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressroom.llm import exact_dedup, html_text, language, licenses, minhash, mixing, packing, quality, suffix_dedup, url_filter, words
from pressroom.llm.queries import QUERIES
from pressroom.session import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans(url_filter.UPPER, url_filter.LOWER)
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row long, tokens string"
FISH = " ".join(f"word{i}" for i in range(120))


def rows(texts, first=0):
    return [(first + i, t, "en", f"s{i % 3}", len(t or ""), 7, "x") for i, t in enumerate(texts)]


ODD = rows([None, "", " \n", "one", "one", "A b c d e", "a B c d e", FISH, FISH, FISH.replace("word60", "fish"), "x " * 30_000, "\x00 nul é 漢字 🎣", "a\tb", "a b", "a  b"]) + [
    (None, "one", None, None, 3, 7, "x"), (4, "one", "en", "s1", 3, 7, "x"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return materialize(spark.createDataFrame(ODD, SCHEMA).coalesce(3), "odd")


@pytest.fixture(scope="module")
def empty(spark):
    return materialize(spark.createDataFrame([], SCHEMA), "empty")


@pytest.fixture(scope="module")
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


def sets_of(texts):
    out = {}
    for k, t in texts.items():
        w = WORD.findall((t or "").translate(FOLD))
        out[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def components_of(sets):
    label = {k: k for k in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    label[max(x, y)] = min(x, y)
    return {k: root(k) for k in sets}


def test_words_and_hashes():
    import pyarrow as pa

    texts = ["a b  c", None, "", "é b\nA", " ", "b"]
    got = list(words.text_words(pa.array(texts), lower=True))
    assert [len(x) for x in got] == [3, 0, 0, 3, 0, 1]
    assert got[0][1] == got[3][1] == got[5][0] and got[0][0] == got[3][2]


def test_exact_groups(spark, odd, empty):
    got = exact_dedup.exact_groups(odd).collect()
    assert len(got) == len(ODD) and exact_dedup.exact_groups(empty).count() == 0
    groups = defaultdict(list)
    for r in ODD:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")].append(r[0])
    want = sorted((str(i), str(min(x for x in ids if x is not None)), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for i in ids)
    assert sorted((str(r._id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.drop_copies(odd).columns == odd.columns and exact_dedup.drop_copies(odd).count() == len(groups)


def test_directory_doubles(spark):
    rows_ = spark.range(4000).select(F.xxhash64("id").alias("_hash"), F.lit(10).cast("long").alias("_size")).unionByName(spark.range(500).select(F.lit(5).cast("long").alias("_hash"), F.lit(10).cast("long").alias("_size")))
    stored = materialize(rows_, "hashes")
    cells = exact_dedup.directory(stored, bucket_rows=100, bucket_bytes=10**9, first_depth=2).collect()
    assert sum(c.rows for c in cells) == 4500 and max(c._depth for c in cells) > 5
    assert sorted(c.rows for c in cells)[-2] <= 100  # only the chain of one hash may be longer
    got = exact_dedup.exact_groups(materialize(spark.range(300).select(F.col("id").alias("doc_id"), (F.col("id") % 150).cast("string").alias("text")), "many"), bucket_rows=7, first_depth=1)
    assert got.filter("group_size <> 2 or keep_id <> _id % 150").count() == 0


def test_near_groups(spark, odd, empty, docs):
    assert minhash.near_groups(empty).count() == 0
    got = minhash.near_groups(odd).collect()
    assert len(got) == len(ODD)
    fish = {r._id: r for r in got if r._id in (7, 8, 9)}
    assert all(r.component_id == 7 for r in fish.values()) and [fish[i].kept for i in (7, 8, 9)] == [True, False, False]
    ones = [r for r in got if r.n_shingles == 1 and r.component_id == 3]
    assert len(ones) == 4 and sum(r.kept for r in ones) == 1
    assert all(r.kept for r in got if r.n_shingles == 0)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want, sets = components_of(sets_of(texts)), sets_of(texts)
    for r in QUERIES["op2_minhash_dedup"](spark, "/root/testdata/sf0.001").collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_groups_of_edited_copies(spark, monkeypatch):
    """Many copies of one text with few to many edits: open members meet whole blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(base)}
    for i in range(1, 120):
        own = list(base)
        for at in rng.choice(150, int(rng.integers(1, 14)), replace=False):
            own[at] = f"v{rng.integers(0, 4)}"
        texts[i] = " ".join(own)
    df = materialize(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "edited")
    want = components_of(sets_of(texts))
    assert {r._id: r.component_id for r in minhash.near_groups(df).collect()} == want and len(set(want.values())) > 3


def test_components(spark):
    edges = [(i, i + 1) for i in range(30) if i % 7] + [(100, 3), (200, 201)]
    got = {r.node: r.label for r in minhash.components(materialize(spark.createDataFrame(edges, "a long, b long"), "path")).collect()}
    assert got[100] == got[7] == 1 and got[201] == 200 and got[14] == 8


def test_repeated_spans(spark, odd, empty):
    assert suffix_dedup.spans(empty).count() == 0
    shared = [f"p{i}" for i in range(60)]
    texts = {i: " ".join([f"a{i}x{j}" for j in range(i * 13 % 70)] + shared[: 60 if i % 2 else 45] + [f"b{i}x{j}" for j in range(90)]) for i in range(30)}
    texts |= {100: " ".join(f"q{i}" for i in range(200)), 101: " ".join(f"q{i}" for i in range(150)) + " end", 102: None, 103: ""}
    df = materialize(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3), "spans")
    got = defaultdict(set)
    for r in suffix_dedup.spans(df).collect():
        got[r._id].update(range(r.start_word, r.start_word + r.n_words))
        assert r.other_id != r._id
    seen, want = defaultdict(set), defaultdict(set)
    split = {i: WORD.findall(t or "") for i, t in texts.items()}
    for i, w in split.items():
        for k in range(len(w) - 49):
            seen[tuple(w[k:k + 50])].add(i)
    for i, w in split.items():
        for k in range(len(w) - 49):
            if len(seen[tuple(w[k:k + 50])]) > 1:
                want[i].update(range(k, k + 50))
    assert got == want and len(want) == 17
    assert suffix_dedup.cut_spans(b"a b c d", [(1, 2)]).split() == [b"a", b"d"]


def test_language(spark, small, odd, empty):
    got = QUERIES["op4_language_id"](spark, small).toPandas()
    truth = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "lang").toPandas()
    held = got.merge(truth, on="doc_id").query("held_out")
    assert len(got) == len(truth) and (held.lang == held.lang_pred).mean() > 0.9
    assert set(got.held_out[got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)]) == {True}
    model = language.train(odd)
    by = {(r._id, r._row): r for r in language.predict(odd, model).collect()}
    assert all((r.lang_pred == "und") == (r._id in (0, 1, 2)) and 0 <= r.score <= 1 for r in by.values())
    assert language.train(empty) is None and {r.lang_pred for r in language.predict(odd, None).collect()} == {"und"}


def test_language_scores_equal_brute_force(spark, docs):
    """Each score from a plain walk over the subwords of the whole text, texts beyond a run's length included."""
    model = language.train(docs, learn=F.col("doc_id") % 2 == 0)
    long = " ".join(r.text or "" for r in docs.orderBy("doc_id").collect())
    long *= 1 + (language.RUN_CHARS * 5 // 2) // len(long)
    texts = {r.doc_id: r.text for r in docs.collect()} | {-1: long, -2: "", -3: None, -4: "12 34 ..."}
    df = materialize(spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id long, text string"), "spoken")

    def hashed(word):  # the subwords of one word, as the module hashes them
        return language.subwords([word])[0].tolist()

    seen = {}
    for r in language.predict(df, model).collect():
        tally = Counter("".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in texts[r._id] or "").split())
        total, n = np.zeros(len(model.languages)), 0
        for word, times in tally.items():
            buckets = seen.setdefault(word, hashed(word))
            n += times * len(buckets)
            for b in buckets:
                total += times * model.logits[b].astype(float)
        if not n:
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
            continue
        z = (total / n + model.bias) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert abs(r.score - p.max()) < 1e-4 and (p.max() - np.sort(p)[-2] < 1e-3 or r.lang_pred == model.languages[int(p.argmax())]) and r.accepted == (r.score >= model.least)


def check_pieces(pieces, ids, window=1024):
    cover, sequences = defaultdict(list), defaultdict(list)
    for r in pieces:
        cover[r._row].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.ids == np.array(ids[r._row][r.start:r.start + r.length], "<u4").tobytes() and r.tokens == len(ids[r._row])
    assert set(cover) == set(ids)
    for k, spans in cover.items():
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
        assert at == len(ids[k])
    for spans in sequences.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= window
    assert len(sequences) == -(-sum(map(len, ids.values())) // window)


def test_packing(spark, docs, odd, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    assert packing.pack(empty, path).count() == 0
    for df in (docs, odd):
        texts = {r._row: r.text for r in words.numbered(df.select("text")).collect()}
        ids = {k: made.encode(t or "", add_special_tokens=False).ids + [0] for k, t in texts.items()}
        check_pieces(packing.pack(df, path).collect(), ids)


@pytest.mark.parametrize("text", ["a  b", "a   b", " a", "a ", "a\n b", "a \n b", "\n \n x", "a\n\n b  ", "it's a 'test' 12 3", "", " ", "  ", "x  y", "<|endoftext|> z"])
def test_encode_equals_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True
    assert packing.encode([text, text], path) == [np.array(made.encode(text, add_special_tokens=False).ids, "<u4").tobytes()] * 2


@pytest.mark.parametrize("counts", [{700: 1000}, {1: 5}, {1023: 3, 1: 3}, {x: x % 7 for x in range(1, 1024)}, {}])
def test_plan_fills_windows(counts):
    placed = packing.plan(dict(counts))
    tokens, sequences = Counter(), Counter()
    for kind, first, end, start, length, at, offset in placed:
        for k in range(first, end):
            tokens[kind, k] += length
            sequences[at + k - first] += length
    assert tokens == Counter({(x, k): x for x, n in counts.items() for k in range(n)})
    assert all(n == 1024 for n in sorted(sequences.values())[1:])


def brute_quality(text):
    w = WORD.findall(text or "")
    seen3 = Counter(zip(w, w[1:], w[2:]))
    marked = {j for i in range(len(w) - 2) if seen3[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked)


def test_quality(spark, small, odd, empty):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in QUERIES["op6_quality_rules"](spark, small).collect():
        want = brute_quality(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.kept and r.base_failed)
    labels = spark.createDataFrame([(7, 1), (8, 0), (8, 1), (None, 1), (9, None)], "doc_id long, quality int")
    got = quality.judge(odd, labels).collect()
    assert len(got) == len(ODD) and all(r.kept != r.base_failed for r in got)
    assert quality.judge(empty, labels).count() == 0 and quality.drop_bad(odd, labels).columns == odd.columns


def test_binomial_and_cutoffs():
    from math import comb

    for n, x, p in ((10, 3, 0.2), (50, 0, 0.05), (200, 9, 0.05), (7, 7, 0.5), (30, -1, 0.1)):
        want = sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(x + 1))
        assert abs(quality.binomial_cdf(x, n, p) - want) < 1e-9
    good, bad = np.zeros(1001, np.int64), np.zeros(1001, np.int64)
    good[0], bad[200] = 400, 50
    cells = {"fit_good": good, "test_good": good, "fit_bad": bad, "test_bad": bad}
    assert 0 < quality.select_cutoffs({("en", "symbols"): cells})["en"]["symbols"] <= 200
    few = {**cells, "test_good": good // 40}
    assert quality.select_cutoffs({("en", "symbols"): few}) == {}
    assert quality.select_cutoffs({("en", "symbols"): {**cells, "fit_bad": bad * 0}}) == {}


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Menu</ul></nav>
<div class="ad">Buy</div><article><h1>Head &amp; tail</h1><p><b>One<br>two<p>th<i>re</i>e&nbsp;four <div class="post-share">Share</div>
<div class="note">%s</div><p>%s</article><section id="comments"><article>me too</article></section><footer>&copy;</footer></body></html>"""


def test_html(spark):
    pages = [(i, f"http://h{i % 2}.org/{i}", PAGE % ("Follow us", f"own text {i} of this page")) for i in range(40)]
    pages += [(100, None, None), (101, "x", ""), (102, "http://h9.org/", "<p>plain <script>var t='</p>';</script>text"), (103, "http://h9.org", "<main>a<aside>b</aside></main>")]
    pages += [(i, "http://copies.org/", PAGE % ("Same", "same text")) for i in range(200, 230)]
    df = materialize(spark.createDataFrame(pages, "page_id long, url string, html string"), "pages")
    got = {r._id: r.text for r in html_text.extract(df).collect()}
    assert got[3] == "own text 3 of this page"  # the other blocks stand on all pages of the host
    assert got[100] == got[101] == "" and got[102] == "plain text" and got[103] == "a"
    assert got[200] == "Head & tail One two three four Same same text"
    assert html_text.extract(df.limit(0)).count() == 0


def test_url_rules(spark):
    urls = [None, "no scheme", "http://A.Net/x", "http://example.net/en/casino", "http://www.example.net/enx", "http://example.com/de/", "http://q.org/fr/casino", "http://casino.org?x=/y", "http://free-bets.org/", "http://freebets.org/", "http://x.org/FREE/free", "http://net"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = [(r.rule, r.verdict) for r in url_filter.judge_urls(df, rules=url_filter.RULES).orderBy("page_id").collect()]
    assert got == [
        (None, "allow"), (None, "allow"), ("net/", "block"), ("example.net/en/", "allow"), ("net/", "block"), ("example.com/de/", "block"),
        ("org/fr/", "allow"), (None, "block"), (None, "block"), (None, "allow"), (None, "allow"), (None, "allow"),
    ]


def test_url_sql_reads_the_whole_url(spark, tmp_path):
    """The query and its SQL on URLs whose terms stand in the query, the fragment, or where no host is."""
    import duckdb

    from pressroom.llm.queries import ORACLES

    urls = ["http://x.org/go?to=casino", "http://x.org/#porn", "casino.org/x", "http://x.org/free?bet=1", "http://example.net/en/?q=casino", "http://ok.org/", "HTTP://X.ORG/?A=CASINO", None, ""]
    spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    result = con.execute(ORACLES["op8_url_filter"])
    names = [d[0] for d in result.description]
    want = sorted(map(repr, (dict(sorted(zip(names, r, strict=True))) for r in result.fetchall())))
    rows_ = QUERIES["op8_url_filter"](spark, str(tmp_path)).collect()
    assert sorted(map(repr, (dict(sorted(r.asDict().items())) for r in rows_))) == want
    assert [r.verdict for r in sorted(rows_, key=lambda r: r.page_id)][:3] == ["block"] * 3


def water_fill(sizes, share=1.5, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = share * sum(sizes.values()), set()
    while True:
        left = sum(weight[s] for s in order if s not in full)
        level = (total - sum(2 * sizes[s] for s in full)) / left if left else 0
        more = {s for s in order if s not in full and weight[s] * level > 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in full else weight[s] * level for s in order}
        full |= more


def test_mixing(spark, small, odd, empty):
    for df in (spark.read.parquet(f"{small}/documents.parquet"), odd):
        got = mixing.mix(df).toPandas()
        sizes = {r.source: 0 for r in df.select("source").distinct().collect()}
        for r in df.collect():
            sizes[r.source] += len(WORD.findall(r.text or ""))
        want = water_fill(sizes)
        assert (got.taken <= 2 * got["size"]).all() and len(got) == df.count()
        for s, own in got.groupby([x if isinstance(x, str) else "none" for x in got.source]):
            name = None if s == "none" else s
            assert abs(own.target.iloc[0] - want[name]) < 1e-6 * max(1, want[name]) and own.source_size.iloc[0] == sizes[name]
            assert abs(own.taken.sum() - want[name]) <= 8 * len(sizes) + 8
        again = mixing.mix(df).toPandas()
        assert got.sort_values("_row").taken.tolist() == again.sort_values("_row").taken.tolist()
        assert mixing.mixed_documents(df).columns == df.columns
    assert mixing.mix(empty).count() == 0


def test_apportion(spark):
    shares = {"a": 7.0, "b": 3.2, "c": 0.1, "d": 0.0, "e": 22.4}
    df = materialize(spark.createDataFrame(list(shares.items()), "name string, w double"), "shares")
    for seats in (0, 1, 5, 17, 100):
        want = Counter()
        for _ in range(seats):
            best = max((s / (2 * want[k] + 1), -ord(k)) for k, s in shares.items() if s)
            want[chr(-best[1])] += 1
        got = {r.name: r._seats for r in mixing.apportion(df, F.col("w"), seats, F.col("name")).collect()}
        assert {k: n for k, n in got.items() if n} == dict(want)


def test_licenses(spark, odd, empty):
    index = licenses.Index(dict(licenses.TEMPLATES))
    grant = licenses.TEMPLATES["MIT-grant"]
    cut = grant.split()
    noise = " ".join(f"z{i}" for i in range(40))
    texts = {
        0: noise + " Released under the\nMIT license " + noise, 1: noise + " " + grant + " " + noise, 2: " ".join(cut[:85]) + " " + noise,
        3: " ".join(cut[:40]) + " " + noise, 4: None, 5: "", 6: "Licensed under CC BY 4.0.",
    }
    df = materialize(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "licensed")
    got = {(r._id, r.license): r.containment for r in licenses.scan(df).collect()}
    want = {}
    import pyarrow as pa

    for k, items in zip(texts, licenses.text_shingles(pa.array(list(texts.values()), pa.string())), strict=True):
        for i, name in enumerate(index.names):
            width, own = 2 * index.sizes[i], set(index.sets[i].tolist())
            share = max((len(own & set(items[a:a + width].tolist())) / len(own) for a in range(max(1, len(items)))), default=0)
            if share >= 0.75:
                want[k, name] = share
    assert got == want and (0, "MIT") in got and (1, "MIT-grant") in got and (2, "MIT-grant") in got and not any(k in (3, 4, 5) for k, _ in got)
    assert licenses.scan(empty).count() == 0 and licenses.scan(odd).count() == 0


def test_license_query_equals_brute_force(spark, small, docs):
    """Every template in every document, by plain sets of shingles over all runs of twice its size."""


    def words_of(text):
        return [w for w in re.split(r"[^0-9A-Za-z\u0080-\U0010ffff]+|[\u00a0\u00ab\u00bb\u2000-\u206f]+", (text or "").translate(FOLD)) if w]


    texts = {r.doc_id: words_of(r.text) for r in docs.collect()}
    want = set()
    for name, template in licenses.TEMPLATES.items():
        own = words_of(template)
        n = min(5, len(own))
        shingles = [tuple(own[i:i + n]) for i in range(len(own) - n + 1)]
        kinds, width = set(shingles), 2 * len(shingles)
        for doc, w in texts.items():
            hits = [(i, s) for i in range(len(w) - n + 1) if (s := tuple(w[i:i + n])) in kinds]
            share = max((len({s for i, s in hits if a <= i < a + (width if n == 5 else 1)}) / len(kinds) for a, _ in hits), default=0)
            if share >= 0.75:
                want.add((doc, name, round(share, 9)))
    got = {(r.doc_id, r.license, round(r.containment, 9)) for r in QUERIES["op10_license_scan"](spark, small).collect()}
    assert got == want and len({n for _, n, _ in want}) > 2


def test_license_marks_and_short_notices(spark):
    quoted = licenses.TEMPLATES["Apache-2.0-definitions"].replace('"', "\u201c").replace(" ", "\u00a0")
    texts = {1: quoted, 2: "Copyright X. All rights\nreserved \u2014 by us", 3: "all of the rights are reserved", 4: "ALL\u2003RIGHTS\u2026RESERVED", 5: "\u00e2\u20ac all rights reserved\u00e9"}
    df = materialize(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "marks")
    assert {(r._id, r.license) for r in licenses.scan(df).collect()} == {(1, "Apache-2.0-definitions"), (2, "All-rights-reserved"), (4, "All-rights-reserved")}


def test_pipeline(spark, small):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    for name, stage in p.STAGES[:-1]:
        docs = materialize(stage(spark, docs, small), name)
        assert docs.columns == columns
        texts = [r.text for r in docs.collect()]
        if name == "exact_copies":
            assert len({" ".join(t.split()) for t in texts}) >= len(texts) - 1
    ids = [r.doc_id for r in docs.collect()]
    assert max(Counter(ids).values()) <= 2
    pieces = p.STAGES[-1][1](spark, docs, small).collect()
    assert {r.doc_id for r in pieces} == set(ids)


def test_row_numbers_do_not_follow_splits(spark, docs):
    texts = docs.select("doc_id", "text")
    stored = materialize(texts.repartition(5), "layout")
    assert words.reads_files(stored.filter("doc_id >= 0").select("text")) and not words.reads_files(texts.repartition(2))

    def numbers(df):
        return {r.doc_id: r._row for r in words.numbered(df.select("doc_id")).collect()}

    first = numbers(stored)
    assert len(set(first.values())) == docs.count()
    had = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert stored.rdd.getNumPartitions() != 5 and numbers(stored) == first
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", had)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    shuffled = texts.repartition(3)
    assert exact_dedup.drop_copies(shuffled).count() == exact_dedup.drop_copies(stored).count()


def test_mix_is_the_same_for_every_layout(spark, docs, odd):
    for df in (docs, odd):
        def taken(n):
            got = mixing.mix(materialize(df.repartition(n), "layout")).collect()
            return Counter((r._id, r.source, r.size, r.taken) for r in got)

        assert taken(1) == taken(7)


@pytest.mark.parametrize("text", [
    "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> z ", " x  <|endoftext|>\n\n y", "<|endoftext|", "a <|ENDOFTEXT|> b",
    " " * 2_000_000 + "x y", "a" + "\n" * 300_000 + "b", "\n " * 200_000 + "<|endoftext|>" + "\t" * 300_000, "é\u00a0" + "\u00a0" * 20_000 + "w",
])
def test_documents_have_the_ids_of_the_library(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    want = np.array(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert packing.encode_documents([text, "", text], path) == [want, b"", want]


def test_packing_of_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    df = materialize(spark.createDataFrame([(1, "a <|endoftext|> b"), (2, " " * 400_000 + "end")], "doc_id long, text string"), "added")
    texts = {r._row: r.text for r in words.numbered(df.select("text")).collect()}
    check_pieces(packing.pack(df, path).collect(), {k: Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids + [0] for k, t in texts.items()})


def test_html_copies_lose_templates_and_make_none(spark):
    def page(notice, text):
        return f"<article><div>{notice}</div><p>{text}</p><p>more {text}</p></article>"

    pages = [(i, f"http://twice.org/{i // 2}?utm={i % 2}", page("Follow us", f"own {i // 2}")) for i in range(40)]
    pages += [(100 + i, f"http://one.org/?utm={i}", page("Note", "told once")) for i in range(30)]
    pages += [(200 + i, f"http://one.org/{i}", page(f"Own note {i}", f"other {i}")) for i in range(5)]
    df = materialize(spark.createDataFrame(pages, "page_id long, url string, html string"), "pages")
    got = {r._id: r.text for r in html_text.extract(df).collect()}
    assert all(got[i] == f"own {i // 2} more own {i // 2}" for i in range(40))
    assert all(got[100 + i] == "Note told once more told once" for i in range(30))
    assert all(got[200 + i] == f"Own note {i} other {i} more other {i}" for i in range(5))


@pytest.mark.parametrize("html, want", [
    ("<article>one two</article><div><article>three</article></div><p>outside</p>", "one two three"),
    ("<main><p>a long body of the page, longer than the teaser</p><article>teaser</article></main>", "a long body of the page, longer than the teaser teaser"),
    ("<article>teaser</article><div class='entry-content'>a long body of the page</div>", "a long body of the page"),
    ("<main>intro <article>a long text of the article</article></main>", "a long text of the article"),
    ("<div class='content'>a<div class='content'>b</div></div><div class='story-body'>c</div>", "a b c"),
    ("<article>a<article>b</article>c</article><nav><article>d</article></nav>", "a b c"),
])
def test_html_takes_all_main_parts(html, want):
    main = html_text.main_part(html_text.read_tree(f"<html><body>{html}</body></html>"))
    assert html_text.main_text(main, {}, frozenset()) == want


def test_url_terms_of_the_whole_url(spark):
    urls = ["http://x.org/go?to=casino", "http://x.org/#Porn", "casino.org/x", "http://x.org/free?a=bonus", "http://x.org/free?a=freedom", "http://x.org/fr/?q=casino", None]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.verdict, r.strict_terms, r.soft_terms) for r in url_filter.judge_urls(df, rules=url_filter.RULES).collect()}
    assert got == {
        0: ("x.org", "/go", "block", ["casino"], []), 1: ("x.org", "/", "block", ["porn"], []), 2: ("", "", "block", ["casino"], []),
        3: ("x.org", "/free", "block", [], ["bonus", "free"]), 4: ("x.org", "/free", "allow", [], ["free"]),
        5: ("x.org", "/fr/", "allow", ["casino"], []), 6: ("", "", "allow", [], []),
    }


@pytest.mark.parametrize("html", [
    '<article class="post no-comments"><p>Text of it.</p></article>', '<div class="has-sidebar"><main><p>Text of it.</p></main></div>',
    '<form id="aspnetForm"><input><article><p>Text of it.</p></article><button>Go</button></form>', '<div class="category-social"><p>Text of it.</p></div>',
    '<div class="sidebar-layout"><article><p>Text of it.</p></article><div class="sidebar">Links</div></div>', '<article class="sponsored"><p>Text of it.</p></article>',
    '<form><label>Find</label><input><div><p>Text of it.</p></div></form>', '<article><p>Text of it.</p></article><div class="comments-area"><article><p>me too, and much longer than the text</p></article></div>',
    '<article><p>Text of it.</p></article><div class="related"><article class="teaser"><p>More</p></article></div>', '<div id="cookieBanner">We use</div><div><p>Text of it.</p></div>',
])
def test_html_names_do_not_lose_the_text(html):
    main = html_text.main_part(html_text.read_tree(f"<html><body>{html}</body></html>"))
    assert html_text.main_text(main, {}, frozenset()) == "Text of it."


def test_html_reader_is_linear():
    import time

    for html in ("<div>" * 20_000 + "</section>" * 20_000, "<p><table>" + "<b>" * 20_000 + "<li>" * 20_000, "<p><div>" + "<b>" * 20_000 + "<li></p>" * 20_000, "<b></i>" * 20_000):
        start = time.perf_counter()
        html_text.read_tree(html + "text")
        assert time.perf_counter() - start < 2


@pytest.mark.parametrize("most", [500_000, 0])
def test_html_shared_paragraphs_stay_and_notices_go(spark, monkeypatch, most):
    """Planted templates on hosts of 200 pages; a long passage on twelve pages, and edited copies of an article."""
    monkeypatch.setattr(html_text, "MOST_BROADCAST", most)
    notice, passage = "<p>Subscribe to our letter today.</p>", "<p>" + "a passage that twelve pages of this host have in common " * 3 + "</p>"
    body = lambda i: "".join(f"<p>{' '.join(f'w{i}x{k}x{j}' for j in range(12))}</p>" for k in range(3))
    made, want = [], {}
    for i in range(200):
        planted = {"site": notice if i % 5 < 3 else "", "news": passage if i % 17 == 0 else ""}
        for host, extra in planted.items():
            made.append((len(made), f"http://{host}.org/{i}", f"<article><h1>Head {i}</h1>{body(i)}{extra}</article>"))
            want[len(made) - 1] = (bool(extra), host)
    copies = [(1000 + i, f"http://copies.org/{i}", f"<article>{body(7)}{passage}<p>own {i}</p></article>") for i in range(12)]
    df = materialize(spark.createDataFrame(made + copies, "page_id long, url string, html string"), "planted")
    got = {r._id: r.text for r in html_text.extract(df).collect()}
    notices = [i for i, (there, host) in want.items() if there and host == "site"]
    assert len(notices) == 120 and not any("Subscribe" in got[i] for i in notices)
    assert all("a passage" in got[i] for i, (there, host) in want.items() if there and host == "news")
    assert all("a passage" in got[1000 + i] and f"own {i}" in got[1000 + i] and "w7x0x0" in got[1000 + i] for i in range(12))
    assert all(len(got[i].split()) >= 38 for i in want)  # no article loses a paragraph


@pytest.mark.parametrize("parts", [1, 2, 8, 50])
def test_repeats_do_not_depend_on_partitions(spark, parts):
    passage = " ".join(f"p{i}" for i in range(60))
    many = " ".join(f"{passage} a{i}" for i in range(200))
    df = materialize(spark.createDataFrame([(1, many), (2, f"x y {passage} z")], "doc_id long, text string"), "two")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = suffix_dedup.spans(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(r.n_words for r in got if r._id == 1) == 12_000 and len([r for r in got if r._id == 1]) == 200
    assert [(r.start_word, r.n_words) for r in got if r._id == 2] == [(2, 60)]


def repeated_words(texts, least):
    """Numbers of the words inside a run of `least` words that another text has too, by text."""
    where = defaultdict(set)
    for k, t in texts.items():
        w = WORD.findall(t or "")
        for i in range(len(w) - least + 1):
            where[tuple(w[i:i + least])].add((k, i))
    out = defaultdict(set)
    for own in where.values():
        if len({k for k, _ in own}) > 1:
            for k, i in own:
                out[k].update(range(i, i + least))
    return out


@pytest.mark.parametrize("parts", [3, 40])
def test_repeats_equal_brute_force(spark, docs, parts):
    """The query on all documents, whatever the number of partitions; every repeated word is found and none else."""
    texts = {r.doc_id: r.text for r in docs.collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        got = QUERIES["op1_suffix_dedup"](spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    found = defaultdict(set)
    for r in got:
        found[r.doc_id].update(range(r.start_word, r.start_word + r.n_words))
    assert dict(found) == dict(repeated_words(texts, suffix_dedup.LEAST))


def test_cut_repeats_keeps_the_first(spark, odd, empty):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {1: f"a b {passage} c", 2: f"{passage}", 3: f"d {passage} e {passage} f", 4: "none", 5: "", 6: None}
    rows_ = [(k, t, "path", 9, "file", 1.5) for k, t in texts.items()] + [(None, f"late {passage}", "path", 9, "file", 1.5)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, _path_of_row string, _row long, _cuts string, _id double").coalesce(2)
    out = suffix_dedup.cut_repeats(df)
    assert out.columns == df.columns
    got = {r.doc_id: r for r in out.collect()}
    assert {k: " ".join((r.text or "").split()) for k, r in got.items()} == {1: f"a b {passage} c", 2: "", 3: "d e f", 4: "none", 5: "", 6: "", None: "late"}
    assert got[6].text is None and all((r._path_of_row, r._row, r._cuts, r._id) == ("path", 9, "file", 1.5) for r in got.values())
    assert suffix_dedup.cut_repeats(odd).columns == odd.columns and suffix_dedup.cut_repeats(empty).count() == 0
    cut = {(r.doc_id, r.text) for r in suffix_dedup.cut_repeats(odd).filter("doc_id in (7, 8)").collect()}
    assert cut == {(7, FISH), (8, "")} or {t.strip() for k, t in cut if k == 8} == {""}


CLASHES = "_path_of_row string, _file_of_row string, _row string, _row_of_near string, _row_of_mix string, _copies string, _metadata string, p string, `a.b` string"


@pytest.mark.parametrize("stage", ["quality_rules", "exact_copies", "near_copies", "source_mix", "packed"])
def test_stages_take_any_columns(spark, small, stage):
    """Nulls, repeated rows and clashing names come back unchanged; an empty table gives no rows."""
    import corpus_pipeline

    names = [c.strip().split(" ")[0].strip("`") for c in CLASHES.split(",")]
    rows_ = [(*r[:5], *names) for r in ODD]
    df = materialize(spark.createDataFrame(rows_, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}"), "clash")
    call = dict(corpus_pipeline.STAGES)[stage]
    out = call(spark, df, small)
    if stage != "packed":
        assert out.columns == df.columns
        got = [tuple(r) for r in out.collect()]
        assert all(r[5:] == tuple(names) for r in got) and {r[:5] for r in got} <= {r[:5] for r in rows_}
        assert got or stage == "quality_rules"
    assert call(spark, df.limit(0), small).count() == 0


def test_quality_copies_stand_in_one_half(spark):
    """Equal texts count once, whatever their ids and white space, with the worse label."""
    import pyarrow as pa

    keys = quality.measured_texts(pa.array(["a b c", " a\nb  c ", "a c b", "", None, "a b c d"]), keys=True)["_body"].tolist()
    assert keys[0] == keys[1] and keys[3] == keys[4] and len(set(keys)) == 4
    body = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{body} copy" if i < 300 else f"{body} {i}", "en") for i in range(400)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i != 7)) for i in range(400)], "doc_id long, quality int")
    seen = []
    original = quality.select_cutoffs
    try:
        quality.select_cutoffs = lambda counts, risk, delta: seen.append(counts) or {}
        quality.calibrate(materialize(quality.features(docs, stratum=F.col("lang")), "measured"), labels)
    finally:
        quality.select_cutoffs = original
    own = seen[0]["en", "symbols"]
    assert own["fit_good"].sum() + own["test_good"].sum() == 100 and own["fit_bad"].sum() + own["test_bad"].sum() == 1


def test_quality_bound_holds_over_many_draws():
    """The share of draws in which a stratum loses more than `risk` of its good documents stays under `delta`."""
    rng = np.random.default_rng(12)
    steps = np.arange(quality.MOST_BIN + 1)
    weight = np.exp(-steps / 60.0)
    good, bad = weight / weight.sum(), np.roll(weight, 150) / weight.sum()
    worse, found = 0, 0
    for _ in range(400):
        draw = {f"{h}_{k}": rng.multinomial(300, p / p.sum()) for h in ("fit", "test") for k, p in (("good", good), ("bad", bad))}
        cutoffs = quality.select_cutoffs({("en", "symbols"): draw})
        if cutoffs:
            found += 1
            worse += good[cutoffs["en"]["symbols"]:].sum() > quality.RISK
    assert found > 100 and worse <= quality.DELTA * 400
