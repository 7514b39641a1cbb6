"""Nulls, empty and very long texts, repeats, ties, empty tables and clashing columns."""

from collections import Counter

import brute
import numpy as np
import public_tokenizers as P
import pytest
from conftest import EDGES
from pyspark.sql import functions as F

from parcelwing.llm import (arrow_tokens, byte_bpe, jaccard_join, license_scan, line_rules, packing, quality_model,
                            sharding, topk, wrappers)

IDS = Counter(i for i, _, _ in EDGES)


def test_line_rules(edges, nothing):
    got = line_rules.line_rules(edges).collect()
    assert Counter(r.doc_id for r in got) == IDS and all(r.lang == "en" for r in got)
    for r in got:
        want = brute.figures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
    assert line_rules.line_rules(nothing).count() == 0


def test_license_scan(edges, nothing):
    got = license_scan.license_scan(edges).collect()
    assert Counter(r.doc_id for r in got) == IDS
    for r in got:
        assert [r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels] == list(brute.licenses(r.text)[:5])
    assert license_scan.license_scan(nothing).count() == 0


@pytest.mark.parametrize("operator", [line_rules.line_rules, license_scan.license_scan])
def test_columns_named_like_helpers(edges, operator):
    """Extra columns of any name keep their values and change no result."""
    names = ["_text", "_key", "_host", "_words", "_cut", "_lost", "_n0", "_starts", "_base", "passed0", "_a`b"]
    clashing = edges.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in names})
    got, want = operator(clashing), operator(edges)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    for name in names:
        held = "`" + name.replace("`", "``") + "`"
        assert {r[0] for r in got.select(held).collect()} == {r[0] for r in clashing.select(held).collect()}


def test_jaccard(edges, nothing):
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(edges, 3, 90).collect()}
    assert got[2] == 1 and got[3] == 3 and got[5] == 5 and got[7] == 7 and got[None] is None
    assert jaccard_join.jaccard_components(nothing, 3, 90).count() == 0
    kept = jaccard_join.one_per_group(edges)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(set(IDS) - {None, 2})


def test_jaccard_repeated_rows(spark):
    """Groups of near copies in which every row stands twice, also as another text with the same set."""
    from itertools import chain

    body = [" ".join(f"{group}{k}" for k in range(60)) for group in ("first", "second", "third")]
    texts = list(chain.from_iterable((b, b + " more") for b in body))
    once = list(enumerate(texts, 1))
    docs = spark.createDataFrame(once + [(i, t) for i, t in once[:4]] + [(i, t.upper()) for i, t in once[4:]],
                                 "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(docs, 3, 90).collect())
    assert got == [(i, i - 1 + i % 2) for i in range(1, 7) for _ in range(2)]


@pytest.mark.parametrize("seed", range(3))
def test_bitmap_bounds(seed):
    """No bitmap may rule out a link: equal and unequal widths, also where tokens crowd into few buckets."""
    random = np.random.default_rng(seed)
    for crowded in (False, True) * 150:
        n = int(random.integers(1, 400))
        tokens = random.integers(0, 2**63, 3 * n, dtype=np.uint64)
        if crowded:
            tokens = tokens & np.uint64(0xF80) | tokens << np.uint64(20)
        start = int(random.integers(0, n + 1))
        a, b = np.unique(tokens[:n]), np.unique(tokens[start:start + int(random.integers(1, 2 * n + 1))])
        x, y = jaccard_join.opened([jaccard_join.bitmap(a), jaccard_join.bitmap(b)])
        both = len(np.intersect1d(a, b))
        assert jaccard_join._bound(x, len(a), y, len(b)) >= both
        percent = 100 * both // (len(a) + len(b) - both)
        tree = jaccard_join.Tree(np.array([len(a), len(b)]), np.array([1, 2]), [x, y])
        assert tree.may_link(0, np.array([0]), np.array([1]), percent)[0]


def test_tokens(edges, nothing):
    texts = Counter((i, t) for i, t, _ in EDGES)
    got = byte_bpe.encode_and_decode(edges, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    want = Counter((i, *brute.coded(t)) for i, t in texts.elements())
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    files = arrow_tokens.token_files(edges, P.path("word_bpe_49k.json"), 2, length=16).collect()
    want = Counter((i, brute.crc(brute.ids("word_bpe_49k.json", t, 2))) for i, t in texts.elements())
    assert Counter((r.doc_id, r.ids_crc32) for r in files) == want
    assert len(packing.pack(edges, P.path("byte_bpe_50k.json")).collect()) >= len(EDGES)
    for frame in (byte_bpe.encode_and_decode(nothing, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN),
                  arrow_tokens.token_files(nothing, P.path("word_bpe_49k.json"), 2),
                  packing.pack(nothing, P.path("byte_bpe_50k.json"))):
        assert frame.count() == 0


def test_quality(spark, edges, nothing):
    labels = spark.createDataFrame([(1, 1), (9, 0), (12, 0), (None, 1), (10, None), (7, 1), (7, 0)], "doc_id long, quality int")
    model = quality_model.train(edges, labels)
    got = quality_model.score_documents(edges, model).collect()
    assert Counter(r.doc_id for r in got) == IDS and all(0 <= r.score <= 1 for r in got)
    assert quality_model.keep_good(edges, labels, threshold=0.0).count() == len(EDGES)
    assert quality_model.score_documents(nothing, quality_model.train(nothing, labels)).count() == 0


def test_topk(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (5, [1.0, 2.0]), (3, [1.0, 2.0]), (4, [nan, 1.0]), (6, None), (None, [9.0, 9.0]), (7, [-1.0, -1.0]),
            (8, [1.0, None])]
    vectors = topk.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"), 2).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 3), (0, 2, 5)]
    assert topk.top_k(vectors, vectors.filter("vec_id % 100 = 0"), 10).count() == 3
    assert topk.top_k(vectors.limit(0), vectors.limit(0), 10).count() == 0


def test_pages(spark):
    page = ("<html><body><header>Top</header><nav>Menu</nav><div class='cookie-notice'>We use</div><article><h1>A &amp; B</h1>"
            "<p>one<br>two<p>three <b>bold</b></p><aside>side</aside><form>f</form><script>x<y</script></article>"
            "<section id=comments><p>nice</p></section><footer>end</footer>")
    rows = [(1, "http://a.b/c", page, "u"), (2, None, None, "u"), (3, "http://a.b/d", "", "u"), (3, "http://a.b/d", "", "u"),
            (None, "x", "plain a < b", "u")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = wrappers.extract_pages(df).collect()
    assert Counter((r.page_id, r.text) for r in got) == Counter([
        (1, "A & B\none two\nthree bold"), (2, ""), (3, ""), (3, ""), (None, "plain a < b")])
    assert wrappers.extract_pages(df.limit(0)).count() == 0
    same = "<body><div><p>Welcome to our site</p></div><div class=post><p>{}</p></div>"
    many = spark.createDataFrame([(k, f"http://h/{k}", same.format(f"story {k}")) for k in range(12)],
                                 "page_id long, url string, html string")
    assert {r.text for r in wrappers.extract_pages(many).collect()} == {f"story {k}" for k in range(12)}


def test_shards(edges, nothing):
    got = sharding.stratified_shards(edges, 4).collect()
    assert Counter(r.doc_id for r in got) == IDS
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert sharding.stratified_shards(nothing).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_packing_plan(seed):
    import random

    draw = random.Random(seed)
    histogram = Counter(draw.choice((7, 300, 900, 1100, 2048, draw.randint(1, 2048))) for _ in range(3000))
    configs = packing.plan(dict(histogram))
    held = Counter()
    for config, times in configs:
        assert sum(n * c for n, c in config) <= 2048
        for n, c in config:
            held[n] += c * times
    assert held == histogram


@pytest.mark.parametrize("pieces", [3000, 300_000, 30_000_000])
@pytest.mark.parametrize("kind", ["even", "short"])
def test_the_program_places_the_pieces_however_many_they_are(kind, pieces):
    import numpy as np

    rng = np.random.default_rng(1)
    some = min(pieces, 300_000)
    drawn = rng.integers(1, 2048, some) if kind == "even" else np.clip(rng.lognormal(6, 1, some).astype(int), 1, 2047)
    histogram = {n: c * (pieces // some) for n, c in Counter(drawn.tolist()).items()}
    configs = packing.cover(histogram, 2048)
    held = Counter()
    for config, times in configs.items():
        assert sum(n * c for n, c in config) <= 2048
        held.update({n: c * times for n, c in config})
    assert held == histogram
    sequences = sum(times for _, times in packing.plan(histogram))
    alone = sum(times for _, times in packing.best_fit(histogram, 2048))
    assert sequences <= alone + max(1, alone // 2000)


def test_lines_travel_once_per_distinct_text(spark, edges):
    """Hashes of a text's lines are stored once; no later step splits a text again to count them."""
    from parcelwing.llm.common import text_key

    prepared = edges.select(F.col("text").alias("_text"), text_key().alias("_key"), F.lit("0").alias("_host"))
    plan = line_rules.frequent_lines(prepared)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan


def test_first_round_tries_few_leaders_and_links_all(spark):
    """Near copies of one text, each with changes that some others share: one component, few first links each."""
    import random

    draw = random.Random(1)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for k in range(80):
        words = list(base)
        for place in draw.sample(range(300), 6):
            words[place] = f"x{place}_{draw.randint(0, 3)}"
        texts.append((k, " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = jaccard_join.jaccard_components(docs, size=2, percent=80).collect()
    assert {r.component_id for r in got} == {0}
    led = spark.createDataFrame([(t, 1000 + t % 40, s) for s in range(50) for t in range(60)], "token long, lead long, set_id long")
    per_set = jaccard_join._likely_leaders(led).groupBy("b").count().collect()
    assert len(per_set) == 50 and max(r["count"] for r in per_set) <= jaccard_join.LEADERS


def test_links_follow_the_sets_of_a_group_and_not_their_pairs(spark, monkeypatch):
    """Near copies of which a third are within the limit of each other: few links reach the components, none is lost."""
    import random

    draw = random.Random(5)
    texts = []
    for k in range(300):
        words = [f"w{place}" for place in range(300)]
        for place in draw.sample(range(300), draw.choice((3, 4, 4, 5, 9))):
            words[place] = f"x{place}_{draw.randint(0, 999)}"
        texts.append(words)
    sets = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in texts]
    want = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and want[a] != want[b]:
                old, new = max(want[a], want[b]), min(want[a], want[b])
                want = [new if c == old else c for c in want]
    fed = []

    def counted(edges, connected=jaccard_join.connected):
        fed.append(edges.count())
        return connected(edges)

    monkeypatch.setattr(jaccard_join, "connected", counted)
    monkeypatch.setattr(jaccard_join, "BLOCK", 64)
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs, size=5, percent=80).collect()}
    assert [got[k] for k in range(len(texts))] == want and 1 < len(set(want)) < 100
    assert max(fed) <= 4 * len(texts)
