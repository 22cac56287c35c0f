"""Parts of the operators against plain versions."""

import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from docflow.llm import ann, common, fingerprints, line_dedup, mixing, ngram_join, packing, quality, token_files, url_filter
from docflow.llm.tokens import Encoder
from tests.llm import brute

DRAW = np.random.default_rng(5)


def random_text(n, vocabulary=200):
    return " ".join(f"w{i}" for i in DRAW.integers(0, vocabulary, n))


@pytest.mark.parametrize("text", ["", " \t\n", "one", "One TWO one two", "É é a b c d e f", random_text(2000), "x" * 700_000 + " y " * 5])
def test_shingles_are_the_distinct_ones(text):
    assert len(common.shingle_hashes(text.encode())) == len(brute.shingles(text))
    assert np.array_equal(common.shingle_hashes(text.encode()), common.shingle_hashes(text.lower().encode())) or "É" in text


def test_long_texts_are_cut_between_words():
    text = (random_text(150_000) + "\n").encode()
    assert len(text) > 2 * (1 << 18)
    parts = [common.word_hashes(w) for w in text.split()[:1000]]
    assert np.array_equal(common.word_hashes(text)[:1000], np.concatenate(parts))


def test_alike_sets_share_a_segment():
    bands = ngram_join.Bands(75)
    for size in [1, 2, 3, 4, 7, 8, 15, 16, 31, 33, 64, 100, 127, 128, 300, 1000]:
        for _ in range(20):
            a = np.unique(DRAW.integers(0, 2**63, size).astype(np.uint64))
            b = a.copy()
            while True:  # as unlike as the threshold allows
                c = np.unique(np.concatenate([b[1:], DRAW.integers(0, 2**63, DRAW.integers(0, 2)).astype(np.uint64)]))
                both = len(np.intersect1d(a, c))
                if not len(c) or 100 * both < 75 * (len(a) + len(c) - both):
                    break
                b = c
            assert np.intersect1d(ngram_join.sketch_segments(a, bands), ngram_join.sketch_segments(b, bands)).size
            assert ngram_join.folded_distance(ngram_join.folded(a), ngram_join.folded(b)) <= len(np.setxor1d(a, b))


def test_classes_of_families(spark):
    """A large family of near copies, a passage that all texts share, chains of links, and texts of few words."""
    base, passage = random_text(300, 5000).split(), random_text(60, 5000)
    texts = []
    for i in range(60):
        copy = list(base)
        for j in DRAW.integers(0, 300, 4):
            copy[j] = f"n{i}"
        texts.append(" ".join(copy))
    texts += [passage + " " + random_text(40, 10**6) for _ in range(70)]
    chain = random_text(200, 10**6).split()
    texts += [" ".join(chain[i * 12 : i * 12 + 100]) for i in range(8)]
    texts += ["a b c", "A b C", "a b", "", None, "   "]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.similarity_classes(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute.classes(texts)


def test_all_links_are_counted(spark):
    """Near copies, a passage that all texts share, equal texts, texts of few words: every link, within components, too."""
    base, passage = random_text(300, 5000).split(), random_text(60, 5000)
    texts = []
    for i in range(60):
        copy = list(base)
        for j in DRAW.integers(0, 300, 4):
            copy[j] = f"n{i}"
        texts.append(" ".join(copy))
    texts += [passage + " " + random_text(40, 10**6) for _ in range(70)]
    texts += ["a b c", "A b C", texts[0], texts[0].upper(), "a b", "", None, "   "]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: (r.component_id, r.n_links) for r in ngram_join.similarity_links(docs).collect()}
    sets = [brute.shingles(t) for t in texts]
    alike = lambda a, b: len(a) > 0 and 100 * len(a & b) >= 75 * len(a | b)
    links = [sum(alike(a, b) for b in sets) - (len(a) > 0) for a in sets]
    assert max(links) > 20 and [found[i] for i in range(len(texts))] == list(zip(brute.classes(texts), links))


def test_size_classes(spark):
    """The least size of a class is the least number of that class."""
    sizes = [*range(1, 3000), *(1 << k for k in range(12, 40)), *((1 << k) - 1 for k in range(12, 40))]
    rows = spark.createDataFrame([(n, ngram_join.size_class(n)) for n in sizes], "n long, size long")
    for n, size, least in rows.withColumn("least", ngram_join.least_size(F.col("size"))).collect():
        assert least <= n and ngram_join.size_class(least) == size
        assert least == 1 or ngram_join.size_class(least - 1) < size


def test_pairs_of_two_families(spark, monkeypatch):
    """Families with three quarters of their shingles in common: the pairs compared do not grow with the square of the members."""
    looked_at = []

    class Counting(ngram_join.Verifier):
        def links(self, pairs):
            looked_at.append(pairs.count())
            return super().links(pairs)

    monkeypatch.setattr(ngram_join, "Verifier", Counting)
    common, own = random_text(79, 10**6).split(), [random_text(25, 10**6).split() for _ in range(2)]
    found = {}
    for members in (100, 400):
        texts = []
        for i in range(2 * members):
            words = common + own[i % 2]
            words[int(DRAW.integers(0, len(words)))] = f"m{i}"
            texts.append(" ".join(words))
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        looked_at.clear()
        classes = {r.doc_id: r.component_id for r in ngram_join.similarity_classes(docs).collect()}
        found[members] = sum(looked_at)
        assert [classes[i] for i in range(len(texts))] == brute.classes(texts)
    assert found[400] < 6 * found[100] and found[400] < 400 * 400 / 4, found


def test_pairs_of_one_family(spark):
    """Members near a family's text and some that are too far from most: a few pairs a member hold each component together."""
    base, members = np.unique(DRAW.integers(0, 2**62, 150)), 300
    sets = {}
    for i in range(members):
        held = DRAW.permutation(base)[(3, 12, 30)[i % 3] :]
        sets[i] = np.unique(np.r_[held, DRAW.integers(0, 2**62, len(base) - len(held))])
    rows = [(1, i, i, 7, 1, True, 0, 0) for i in sets]
    rows = spark.createDataFrame(rows, "key long, node long, label long, band int, weight long, crowded boolean, first_label long, first_head long")
    tokens = spark.createDataFrame([(i, x.tolist()) for i, x in sets.items()], "node long, tokens array<long>")
    pairs = [(r.a, r.b) for r in ngram_join.open_pairs(rows, tokens, 75).collect()]

    def components(pairs):
        root = list(range(members))
        for a, b in pairs:
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
                root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
        return root

    assert components(pairs) == components([(a, b) for a in range(members) for b in range(a + 1, members)])
    assert len(pairs) < 20 * members, len(pairs)


def test_equal_keys_of_salted_segments(spark):
    """Sets of other salts, unlike both centers, still share what they shared before the merge of equal segments."""
    band, salts = 5, {0: [1], 1: [10, 11], 2: [20, 21]}
    common = {0: (0, 2), 1: (0, 1), 2: (0, 1, 2)}  # the salts that have sets in each common segment
    rows, sets = [], {}
    for which, own in common.items():
        for salt in own:
            segment = ((which * ngram_join.SALTS + salt) << 6) | band << 1 | 1
            rows += [(segment, node, salts[salt][0]) for node in salts[salt]]
            sets.setdefault(("common", which), set()).update(salts[salt])
    for which, own in enumerate([(30, 31, 32), (30, 31, 32), (30, 31), (11, 21)]):
        rows += [(((100 + which) << 6) | band << 1, node, own[0]) for node in own[1:]]
        sets["plain", which] = set(own)
    found = ngram_join.joined_salts(spark.createDataFrame(rows, "segment long, node long, center long"))
    held = {}
    for r in ngram_join.one_of_equal_keys(found).collect():
        held.setdefault(r.node, {})[r.key] = r.weight
    for a in held:
        for b in held:
            together = sum(weight for key, weight in held[a].items() if key in held[b])
            assert together == sum({a, b} <= own for own in sets.values()), (a, b)
    assert len({key for own in held.values() for key in own}) == 6


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (300, 300)]
    found = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


def test_line_runs(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=3)
    for batch in ([(9, 1), (9, 2), (8, 1)], [(7, 1), (7, 3)], [(6, 3), (6, 4)], [(5, 1), (5, 4)], [(4, 5)]):
        runs.add(spark.createDataFrame([(d, k, k) for d, k in batch], "doc long, h1 long, h2 long"))
    found = {r.h1: (r.keeper, r.docs) for r in runs.lines().collect()}
    assert found == {1: (9, 4), 2: (9, 1), 3: (7, 2), 4: (6, 2), 5: (4, 1)}
    assert [len(level) for level in runs.levels] == [1, 0, 1]


def test_water_filling(spark):
    sizes, weights = [10, 1000, 50, 0, 700], [3, 1, 2, 1, 2]
    sources = spark.createDataFrame([(str(i), s, w) for i, (s, w) in enumerate(zip(sizes, weights))], "source string, source_size long, weight long")
    found = {int(r.source): r.target for r in mixing.targets(sources, sum(sizes), 3).collect()}
    target, left = {}, set(range(5))
    while True:
        rest = sum(sizes) - sum(target.values())
        over = {i for i in left if rest * weights[i] / sum(weights[j] for j in left) > 3 * sizes[i]}
        if not over:
            break
        target |= {i: 3.0 * sizes[i] for i in over}
        left -= over
    target |= {i: rest * weights[i] / sum(weights[j] for j in left) for i in left}
    assert found == pytest.approx(target)


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        (F.col("id") * 37 % 101).alias("size"),
    )
    rows = mixing.mix(docs, mixing.cycled_weights(docs)).toPandas()
    sums = rows.groupby("source").agg({"taken": "sum", "target": "first", "size": "max"})
    assert ((sums.taken - sums.target).abs() <= sums["size"]).all() and (rows.taken <= 3 * rows["size"]).all()


def test_packing_bounds_and_fits():
    for _ in range(30):
        capacity = int(DRAW.integers(5, 60))
        lengths = DRAW.integers(1, capacity + 1, DRAW.integers(1, 60))
        bins, offsets = packing.best_fit(lengths, capacity)
        used = np.bincount(bins, weights=lengths)
        assert used.max() <= capacity and packing.least_bins(lengths, capacity) <= len(used)
        for b in range(len(used)):
            own = np.argsort(offsets[bins == b])
            assert np.array_equal(np.cumsum(lengths[bins == b][own]) - lengths[bins == b][own], offsets[bins == b][own])
    assert packing.least_bins(np.array([6, 6, 6]), 10) == 3 and packing.least_bins(np.array([4, 4, 4]), 10) == 2


def test_partitions_exchange(spark):
    import public_tokenizers

    docs = spark.createDataFrame([(i, "w " * int(n)) for i, n in enumerate(DRAW.integers(1, 60, 400))], "doc_id long, text string")
    path = public_tokenizers.path("word_bpe_49k.json")
    one = packing.pack(docs, path, 64).toPandas()
    many = packing.pack(docs, path, 64, pieces_per_partition=80).toPandas()
    assert sorted(many.doc_id) == sorted(one.doc_id) and (many.groupby("sequence_id").length.sum() <= 64).all()
    assert many.sequence_id.nunique() <= one.sequence_id.nunique() * 1.04 + 1


def test_every_partition_has_a_bound(spark):
    """At op2's own defaults: one partition, and more than one."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    for n, turns in ((50, [1]), (60_000, [2, 1])):
        docs = spark.range(n).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', int(id % 97))").alias("text"))
        rows, bounds = packing.pack_with_bounds(docs, path)
        found = bounds.toPandas()
        assert found.groupby("turn").size().tolist() == turns and (found.bound >= 1).all() and (found.bound <= found.bins).all()
        assert (found.bins - found.given).sum() == rows.select("sequence_id").distinct().count() and rows.count() == n
        assert found.given[found.turn == found.turn.max()].sum() == 0


@pytest.mark.parametrize("name, parts", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_chunks_give_the_ids_of_the_text(name, parts):
    import public_tokenizers
    from tokenizers import Tokenizer

    definition = open(public_tokenizers.path(name)).read()
    plain, own = Tokenizer.from_str(definition), Encoder(definition, parts)
    signs = ["a", "Bé", " ", " ", "\n", "\t", "\u00a0", "'s", "12", "!!", ".", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "\u2028", "ǅ", "İ", "ŉx", "ª", "Ω", "étÉ", "漢", "\x1c", "e\u0301", "\x00"]
    for n in range(400):
        text = "".join(DRAW.choice(signs if n % 2 else signs[:5] + signs[7:11], 30))
        ids = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.ids(text.encode()), dtype=np.uint32).tolist() == ids, text


def test_token_file_reads_single_documents():
    held = io.BytesIO()
    writer = token_files.FileWriter(held)
    docs = [(i, DRAW.integers(0, 2**31, n).astype("<u4").tobytes()) for i, n in enumerate([5, 0, 200_000, 3, 70_000, 1])]
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()

    class File(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    reader = token_files.FileReader(File(held.getvalue()))
    assert [reader.ids(i) for i in (4, 0, 2, 1, 5, 3)] == [docs[i][1] for i in (4, 0, 2, 1, 5, 3)]
    broken = bytearray(held.getvalue())
    broken[len(broken) // 3] ^= 1
    with pytest.raises(Exception):
        bad = token_files.FileReader(File(bytes(broken)))
        [bad.ids(i) for i in range(6)]


def test_selected_documents(spark):
    import public_tokenizers

    docs = spark.createDataFrame([(i, f"text {i} " * (i % 40)) for i in range(500)], "doc_id long, text string")
    manifest = token_files.write_tokens(docs, token_files.tokenizer_definition(public_tokenizers.path("byte_bpe_50k.json")), 0)
    every = {r.doc_id: (r.start, r.ids) for r in token_files.read_tokens(manifest).collect()}
    wanted = spark.createDataFrame([(3,), (77,), (499,), (9999,)], "doc_id long")
    some = {r.doc_id: (r.start, r.ids) for r in token_files.read_tokens(manifest, wanted).collect()}
    assert some == {i: every[i] for i in (3, 77, 499)}


def test_sketches():
    texts = [random_text(900, 300_000), random_text(900, 300_000)]
    both = texts[0] + "\n" + texts[1]
    a, b, ab = (fingerprints.Sketch.of(t) for t in (*texts, both))
    assert np.array_equal(fingerprints.Sketch.parse(str(a)).hashes, a.hashes)
    whole = len(brute.shingles(both))
    assert abs(a.merge(b).count() - whole) < 0.3 * whole
    assert abs(a.resemblance(ab) - brute.likeness(brute.shingles(texts[0]), brute.shingles(both))) < 0.15
    assert a.containment(ab) > 0.75 and a.containment(b) < 0.05


def test_attention_gradients():
    network = quality.Network()
    bags = [DRAW.standard_normal((n, quality.WIDTH)) for n in (1, 3, 2)]
    rows, starts, labels = np.concatenate(bags), np.array([0, 1, 4]), np.array([1.0, 0.0, 1.0])

    def loss():
        logits = network.forward(rows, starts)[0]
        return np.mean(np.log1p(np.exp(logits)) - labels * logits)

    for name, grad in network.gradients(rows, starts, labels).items():
        place = tuple(DRAW.integers(0, n) for n in grad.shape)
        values = []
        for step in (1e-5, -2e-5):
            network.weights[name][place] += step
            values.append(loss())
        network.weights[name][place] += 1e-5
        assert (values[0] - values[1]) / 2e-5 == pytest.approx(grad[place], abs=1e-6)


def test_codes_bound_inner_products():
    x = DRAW.standard_normal((3000, 64))
    center, turn = x.mean(axis=0), ann.rotation(64)
    codes = ann.Codes(*ann.encode(x, center, turn), center, turn)
    near, upper = codes.estimate(x[:50])
    true = x[:50] @ x.T
    assert np.mean(upper >= true) > 0.98 and abs(np.mean(near - true)) < 0.05


def test_queries_of_one_id_are_ranked_each(spark):
    """Two equal rows of an id, and two rows of an id that differ: each has all its neighbours."""
    rows = [(i, DRAW.standard_normal(16).tolist()) for i in range(1, 100)]
    rows += [(20, rows[19][1]), (40, DRAW.standard_normal(16).tolist())]
    found = {}
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    assert set(found) == {20, 40, 60, 80}
    for i, got in found.items():
        expected = []
        for query in (v for j, v in rows if j == i):
            near = sorted((-float(np.dot(v, query)), j) for j, v in rows if j != i)[:20]
            expected += [(rank, j, round(-score, 9)) for rank, (score, j) in enumerate(near, 1)]
        same = len(set(got) & set(expected))
        assert len(got) == len(expected) and sorted(r for r, _, _ in got) == sorted(r for r, _, _ in expected) and same >= 0.95 * len(set(expected))


def test_rules_choose_the_longest(spark):
    rules = [url_filter.Rule("com", "/", "allow"), url_filter.Rule("b.com", "/x", "block"), url_filter.Rule("a.b.com", "/x/y", "allow")]
    urls = ["http://a.b.com/x/y/z", "http://a.b.com/x/z", "http://ab.com/x", "http://b.org/x", None]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    found = {r.url: (r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    assert found["http://a.b.com/x/y/z"] == ("a.b.com/x/y", "allow") and found["http://a.b.com/x/z"] == ("b.com/x", "block")
    assert found["http://ab.com/x"] == ("com/", "allow") and found["http://b.org/x"][0] is None and found[None][0] is None
