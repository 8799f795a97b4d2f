"""Operators on corpora against plain versions, with nulls, empties, ties, repeats and odd columns."""

import hashlib
import re

import numpy as np
import pytest
from brute import cut_repeats
from pyspark.sql import functions as F

from paywatch.llm import curves, masked_lm, mixing, quality, slots, suffixes, superminhash, token_files, url_filter, winnowing
from paywatch.llm.flat import BLANKS, words
from paywatch.llm.queries import URL_RULES

PROSE = [f"word{i} and the {i * 7 % 13} other thing{i % 5}" for i in range(60)]
LONG = " ".join(PROSE)
DOCS = [
    (1, LONG, "en", "src1"),
    (2, LONG + " end", "en", "src1"),
    (3, LONG, "de", "src2"),
    (3, LONG, "de", "src2"),
    (4, None, None, None),
    (5, "", "en", "src1"),
    (6, "one two", "fr", "src0"),
    (7, "ONE Two", "fr", "src0"),
    (8, "été " * 4000, "fr", "src3"),
    (None, "no id at all here but six words", "en", "src1"),
    (9, "ab" * 30 + " tail " + " ".join(PROSE[10:20]), "en", "x"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).withColumns({"n": F.lit(1), "part": F.lit("x"), "score": F.lit(0)})


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_url_filter_judges_hosts_paths_and_odd_urls(spark):
    urls = ["http://a.net/x", "http://net/", "http://bnet/x", "http://EXAMPLE.net/en/1?q#f", "http://a.example.com/de/", "http://example.com/DE/",
            "http://u.org/fr/", "http://a.net", None, "", "a.net/x", "://a.net/", "http://" + "a." * 3000 + "net/", "http://a.net/x"]
    got = [tuple(r) for r in url_filter.filter_urls(
        spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").withColumn("rule", F.lit("old")), URL_RULES
    ).orderBy("page_id").select("host", "rule", "verdict").collect()]
    assert [g[1] for g in got] == ["net/", "net/", None, "example.net/en/", "example.com/de/", None, "org/fr/", None, None, None, None, "net/", "net/", "net/"]
    assert [g[2] for g in got] == ["block" if r in ("net/", "example.com/de/") else "allow" for r in (g[1] for g in got)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    joined = url_filter.filter_urls(pages, URL_RULES, most_bytes=0).orderBy("page_id").select("rule").collect()
    assert [r[0] for r in joined] == [g[1] for g in got]


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(3000).select(*url_filter.key_hashes(F.col("id").cast("string")))
    listed = spark.range(0, 3000, 7).select(*url_filter.key_hashes(F.col("id").cast("string")))
    cascade = url_filter.build_cascade(listed, keys)
    rows = spark.range(3000).select("id", *url_filter.key_hashes(F.col("id").cast("string"))).orderBy("id").toArrow()
    answer = cascade.lists(rows["h1"].to_numpy(), rows["h2"].to_numpy())
    assert answer.tolist() == [i % 7 == 0 for i in range(3000)]


def test_groups_of_near_duplicates(docs, empty):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in superminhash.groups(docs).collect()}
    named = {k[0]: v for k, v in got.items()}
    assert named[2] == named[3] == (1, False) and named[1] == (1, True)
    assert named[7] == (6, False) and named[4] == (4, True) and named[5] == (5, True)
    assert superminhash.groups(docs).count() == len(DOCS) and superminhash.groups(empty).count() == 0
    kept = superminhash.dedupe(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 4, 5, 6, 8, 9, None}


def test_shards_are_even_and_gapless(docs, empty, spark):
    many = spark.range(2000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    rows = slots.shard(many, 8).toPandas()
    sizes = rows.groupby("shard")["size"].sum()
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= rows["size"].max()
    assert all(sorted(g) == list(range(len(g))) for _, g in rows.groupby("shard")["slot"])
    assert slots.shard(docs, 3).count() == len(DOCS) and slots.shard(empty, 3).count() == 0


def test_rebalancing_moves_few_slots():
    sizes = {slot: 100 for slot in range(64)}
    old = slots.first_map(4, 64)
    new = slots.edit_map(old, sizes, 5)
    moved = [s for s in old if old[s] != new[s]]
    assert len(moved) == 12 and {new[s] for s in moved} == {4}


def test_quality_of_every_row(docs, empty, spark):
    texts = [(i, "!!! ### " * 30 if i % 2 else f"some plain words about {i} and more of them. " * 5) for i in range(200)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i, _ in texts], "doc_id long, quality int")
    rows = quality.classify(frame, labels).toPandas()
    assert ((rows.score > 0.5) == (rows.doc_id % 2 == 0)).all()
    none = labels.limit(0)
    assert {r.score for r in quality.classify(docs, none).collect()} == {0.5}
    assert quality.classify(empty, labels).count() == 0


def test_winnowing_finds_every_window(docs, empty, spark):
    items = [(1, " ".join(PROSE[10:16])), (2, "one two"), (3, None), (4, ""), (None, "ab " * 30)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    cut = lambda t: word.findall((t or "").encode().lower())
    windows = {}
    for i, text in items:
        w = cut(text)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add("" if i is None else str(i))
    for r in winnowing.digest(winnowing.mark(docs, benchmark)).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        w, hit, met = cut(r.text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    met |= windows[tuple(w[k : k + n])]
        assert (r.n_words, r.n_hit, r.n_items) == (len(w), len(hit), len(met))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
    assert winnowing.mark(empty, benchmark).count() == 0
    assert winnowing.clean(docs, benchmark.limit(0)).count() == len(DOCS)


def test_mixture_is_the_same_when_leaves_are_not_broadcast(docs, monkeypatch):
    def drawn():
        rows = mixing.mix(docs, F.col("source"), {"lang": {"en": 3}}, percent=70, epochs=2)
        return sorted(map(repr, rows.select("doc_id", "mix_epoch", "mix_tokens", "mix_taken").collect()))

    whole = drawn()
    monkeypatch.setattr(mixing, "MOST_SENT", 0)
    assert drawn() == whole


def test_mixture_meets_its_budget(docs, empty):
    drawn = mixing.mix(docs, F.col("source"), {"lang": {"en": 3}}, percent=50, epochs=2).select("mix_taken").toPandas()
    tokens = sum(len((t or "").split()) for _, t, _, _ in DOCS)
    assert drawn.mix_taken.sum() == tokens // 2
    assert mixing.mix(empty, F.col("source"), {}).count() == 0


def test_repeats_are_cut_as_by_brute_force(docs, empty):
    want = cut_repeats([(i, t) for i, t, _, _ in DOCS if i is not None])
    rows = suffixes.digest(suffixes.cut(docs)).collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        if r.doc_id is not None:
            assert tuple(r)[1:] == want[r.doc_id]
    assert suffixes.cut(empty).count() == 0


def test_token_counts_over_block_edges(docs, empty, spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(docs, path)
    encode = token_files.encoder(token_files.VOCABULARY).encode_ordinary
    want = sorted(len(encode(t or "")) for _, t, _, _ in DOCS)
    for block in (2, 14, 1 << 20):
        rows = token_files.count_tokens(token_files.scan(token_files.read_blocks(spark, path, block))).collect()
        assert sorted(r.n_tokens for r in rows) == want and all(r.terminated for r in rows)
    token_files.write_token_files(empty, path + "-empty")
    assert token_files.count_tokens(token_files.scan(token_files.read_blocks(spark, path + "-empty"))).count() == 0


def test_token_files_are_bounded_and_counted_as_one(docs, spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_token_files(docs.coalesce(1), path, file_bytes=300)
    encode = token_files.encoder(token_files.VOCABULARY).encode_ordinary
    want = [len(encode(r.text or "")) for r in docs.coalesce(1).collect()]
    sizes = sorted(f.stat().st_size for f in (tmp_path / "tokens").glob("part-*"))
    longest = [2 * n + 2 for n in want if 2 * n + 2 > 300]
    assert len(sizes) > len(longest) > 1 and sizes[-len(longest):] == sorted(longest) and sizes[-len(longest) - 1] <= 300
    for block in (14, 1 << 20):
        found = token_files.count_tokens(token_files.joined(token_files.scan(token_files.read_blocks(spark, path, block))))
        assert [tuple(r) for r in found.orderBy("position").collect()] == [(0, i, n, True) for i, n in enumerate(want)]


def test_pseudo_likelihood_gradient_and_odd_rows(docs, empty):
    p = {k: v.astype(np.float64) for k, v in masked_lm.first_parameters().items()}
    near, target = np.array([[1, 2, 3, 4096], [5, 5, 7, 9]]), np.array([77, 4000])
    before = masked_lm.log_probability(p, near, target).mean()
    for _ in range(20):
        masked_lm.train_step(p, near, target, 0.1)
    assert masked_lm.log_probability(p, near, target).mean() > before + 1
    rows = {r.doc_id: r for r in masked_lm.score(docs, *masked_lm.train(docs)).collect()}
    assert rows[4].n_words == rows[5].n_words == 0 and rows[4].mean_log_likelihood is None
    assert rows[1].log_likelihood < 0
    assert masked_lm.score(empty, *masked_lm.train(empty)).count() == 0


def test_masked_step_follows_the_gradient():
    """Each kind of parameter against finite differences, in double precision."""
    start = {k: v.astype(np.float64) for k, v in masked_lm.first_parameters().items()}
    near, target = np.array([[1, 2, 3, 4096], [5, 5, 7, 9], [1, 5, 3, 8]]), np.array([77, 4000, 80])
    moved = {k: v.copy() for k, v in start.items()}
    masked_lm.train_step(moved, near, target, 1e-6)
    places = {"words": (5, 3), "sides": (1, 4), "bias": (2,), "group": (6, 1), "group_bias": (1,), "given": (1, 7), "place": (3, 13), "place_bias": (13,), "given_bias": (1, 16)}
    for name, at in places.items():
        values = []
        for step in (1e-5, -1e-5):
            p = {k: v.copy() for k, v in start.items()}
            p[name][at] += step
            values.append(masked_lm.log_probability(p, near, target).mean())
        longer = 16 if name in ("words", "given", "given_bias") else 1
        slope = (moved[name][at] - start[name][at]) / 1e-6 / longer
        # The scale of a step is kept in single precision.
        assert slope == pytest.approx((values[0] - values[1]) / 2e-5, rel=1e-4, abs=1e-9), name


def test_scores_against_a_loop_over_words(docs):
    common, p, rare = masked_lm.train(docs)
    counts = {r.word: r.n for r in rare.collect()}
    sums = {}
    for r in rare.collect():
        sums[r.bucket] = sums.get(r.bucket, 0) + r.n + 1
    got = sorted((r.doc_id or 0, r.n_words, r.log_likelihood) for r in masked_lm.score(docs, common, p, rare).collect())
    soft = lambda x: x - np.log(np.exp(x - x.max()).sum()) - x.max()
    for (doc_id, n_words, total), (_, text) in zip(got, sorted((d or 0, t or "") for d, t, _, _ in DOCS), strict=True):
        flat = np.frombuffer(text.encode(), np.uint8)
        hashes = words(flat, np.array([0, len(flat)]), BLANKS)[0]
        codes, plain = masked_lm.codes_of(hashes, common).tolist(), 0.0
        for i, code in enumerate(codes):
            hidden = p["bias"].astype(float)
            for k, j in enumerate((i - 2, i - 1, i + 1, i + 2)):
                hidden = hidden + p["words"][codes[j] if 0 <= j < len(codes) else masked_lm.CODES] * p["sides"][k]
            hidden, group, place = np.tanh(hidden), *divmod(code, masked_lm.PLACES)
            plain += soft(hidden @ p["group"] + p["group_bias"])[group]
            plain += soft((hidden + p["given"][group]) @ p["place"] + p["place_bias"] + p["given_bias"][group])[place]
            if code >= masked_lm.COMMON:
                bucket = code - masked_lm.COMMON
                plain += np.log((counts.get(int(hashes[i].view(np.int64)), 0) + 1) / (sums[bucket] + 1))
        assert n_words == len(codes) and total == pytest.approx(plain, rel=1e-4, abs=1e-6), doc_id


def test_every_position_is_a_target(docs, spark):
    coded = masked_lm.encode(docs, masked_lm.counted(docs)[0])
    sent = spark.sparkContext.broadcast(masked_lm.first_parameters())
    turns = [masked_lm._trained(coded, sent, turn).where("piece = 0") for turn in range(masked_lm.ROUNDS)]
    trained = sum(r.weight for turn in turns for r in turn.collect())
    assert trained == sum(len((t or "").split()) for _, t, _, _ in DOCS)


def test_rare_words_share_their_bucket_by_counts(spark):
    often = {f"w{i}": 9 if i < masked_lm.COMMON else 1 + i % 3 for i in range(masked_lm.COMMON + 3000)}
    docs = spark.createDataFrame([(i, f"{w} " * n) for i, (w, n) in enumerate(often.items())], "doc_id long, text string")
    common, p, rare = masked_lm.train(docs)

    def code(word):
        flat = np.frombuffer(word.encode(), np.uint8)
        return int(masked_lm.codes_of(words(flat, np.array([0, len(flat)]), BLANKS)[0], common)[0])

    bucket = code(f"w{masked_lm.COMMON}")
    met = {w: n for w, n in often.items() if code(w) == bucket}
    junk = next(w for w in (f"junk{i}" for i in range(100000)) if code(w) == bucket)
    asked = [*met, junk, "w0", f"{junk} w0 {junk} w{masked_lm.COMMON}"]
    got = masked_lm.score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), common, p, rare)
    got = {r.doc_id: r.log_likelihood for r in got.collect()}
    near, whole = np.full((1, 2 * masked_lm.REACH), masked_lm.CODES), sum(n + 1 for n in met.values()) + 1
    for i, word in enumerate(asked[:-2]):
        share = np.log((met.get(word, 0) + 1) / whole)
        assert got[i] == pytest.approx(masked_lm.log_probability(p, near, np.array([bucket]))[0] + share)
    assert sum(np.exp(got[i] - got[0]) for i in range(len(met) + 1)) == pytest.approx(whole / (met[asked[0]] + 1))
    assert got[len(met) + 1] == pytest.approx(masked_lm.log_probability(p, near, np.array([code("w0")]))[0])
    codes = np.array([code(w) for w in asked[-1].split()])
    plain = masked_lm.log_probability(p, masked_lm.contexts(codes, np.zeros(4, int), np.arange(4)), codes).sum()
    shares = 2 * np.log(1 / whole) + np.log((met[asked[0]] + 1) / whole)
    assert got[len(asked) - 1] == pytest.approx(plain + shares)


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 16)).astype(np.float32)
    x[50:90] = x[40]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (920, [0.0] * 16), (940, [float("nan")] * 16), (960, [1.0])]
    got = curves.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=20, k=20).toPandas()
    hits = 0
    for q in range(0, 300, 20):
        s = x.astype(float) @ x[q].astype(float)
        order = [i for i in np.lexsort((np.arange(300), -s)) if i != q][:20]
        mine = got[got.query_id == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 21)) and np.allclose(mine.score, s[mine.vec_id])
        hits += len(set(order) & set(mine.vec_id))
    assert hits >= 0.9 * 15 * 20 and set(got.query_id) == set(range(0, 300, 20))
    assert curves.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), every=20).count() == 0


def test_few_rows_see_all_others(spark):
    rows = spark.createDataFrame([(i, [float(i + 1)]) for i in range(21)], "vec_id long, embedding array<double>")
    got = curves.nearest(rows, every=1, k=20).toPandas()
    assert len(got) == 21 * 20 and not got.duplicated(["query_id", "vec_id"]).any()


def test_neighbours_within_each_length(spark):
    rng = np.random.default_rng(4)
    lengths = [4] * 30 + [9] + [2] * 5
    x = [rng.standard_normal(n) for n in lengths]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = curves.nearest(rows, every=1, k=20).toPandas()
    assert got.groupby("query_id").size().to_dict() == {i: 20 if n == 4 else 4 for i, n in enumerate(lengths) if n != 9}
    for r in got.itertuples():
        assert r.score == pytest.approx(x[r.query_id] @ x[r.vec_id])
