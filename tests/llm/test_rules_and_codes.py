"""Quality divergence, bisector clusters and norm-of-sum codes against brute force, and odd rows."""

import hashlib
import math
import random
import time
import tracemalloc
import weakref
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stagewise.llm import base
from stagewise.llm import integers as ints
from stagewise.llm import op1_toxicity as op1
from stagewise.llm import op5_jaccard_join as op5
from stagewise.llm import op7_html_extraction as op7
from stagewise.llm import op10_sharding as op10
from stagewise.llm import op11_quality_divergence as op11
from stagewise.llm import op12_bisector_clusters as op12
from stagewise.llm import op13_norm_of_sum_codes as op13

DOCS = "doc_id long, text string, lang string"
VECTORS = "vec_id long, embedding array<double>, label int"
BLANKS = " \t\n\x0b\x0c\r"


def words_of(text):
    for blank in BLANKS:
        text = text.replace(blank, " ")
    return [w for w in text.split(" ") if w]


def measures(text):
    words = words_of(text or "")
    lines = [line for line in (text or "").split("\n") if words_of(line)]
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    again = {i + j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again))


def prose(rnd, vocabulary, n):
    return " ".join(rnd.choices(vocabulary, [1 / (i + 1) for i in range(len(vocabulary))], k=n))


@pytest.fixture(scope="module")
def judged(spark):
    rnd = random.Random(1)
    one, two = ([f"{a}{b}{c}{tail}" for a in "bdfgkl" for b in "aeiou" for c in "mnprt"] for tail in ("i", "ß"))
    rows = [(i, prose(rnd, one, 400), "aa") for i in range(40)] + [(50 + i, prose(rnd, two, 400), "bb") for i in range(40)]
    rows += [(100, " ".join(w + "$$" for w in prose(rnd, one, 400).split()), "aa"), (101, prose(rnd, one, 400).upper(), "aa"),
             (102, " ".join(f"zz{rnd.random()}" for _ in range(200)), "bb"), (103, prose(rnd, one, 400), None), (104, prose(rnd, two, 400), "rare"),
             (105, "same line here\n" * 60, "aa"), (106, None, "aa"), (107, "", "aa"), (107, " \t\n", None), (None, "one\x0btwo three", "aa"),
             (108, "x" * 300_000 + " # \U0001F600 \x00 €", "aa"), (109, prose(rnd, one, 60_000), "aa")] + [(110, rows[3][1], "aa")] * 30
    wide = spark.createDataFrame([(*r, True, "s", 5) for r in rows], DOCS + ", kept boolean, th string, n_words int").repartition(3)
    return rows, op11.judge_quality(wide).collect()


def test_quality_measures(judged):
    rows, got = judged
    found = Counter((None if r.did == -(2**63) else r.did, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert found == Counter((i, *measures(t)) for i, t, _ in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)


def test_quality_verdicts(judged):
    _, got = judged
    of = {r.did: r for r in got}
    assert all(of[i].kept and of[i].nearest == "aa" for i in range(40)) and all(of[50 + i].kept and of[50 + i].nearest == "bb" for i in range(40))
    assert [of[i].kept for i in (100, 101, 102, 105, 106, 107, 108)] == [False] * 7
    assert not of[100].base_failed and not of[102].base_failed and of[105].base_failed
    # A document of no or a rare language is judged by the references of the others.
    assert of[103].kept and of[103].nearest == "aa" and of[104].kept and of[104].nearest == "bb"
    assert of[107].class_distance is None and of[107].word_distance is None and of[108].word_distance is None


def test_quality_without_references(spark):
    rows = [(1, " ".join(f"w{i}" for i in range(60)), None), (2, "short", None)]
    assert {r.did: (r.kept, r.nearest) for r in op11.judge_quality(spark.createDataFrame(rows, DOCS)).collect()} == {1: (True, None), 2: (False, None)}
    assert op11.judge_quality(spark.createDataFrame([], DOCS)).collect() == []


def test_divergence_by_hand():
    p, q = np.array([[0.5, 0.5, 0.0], [0, 0, 1], [0.2, 0.3, 0.5]]), np.array([0.2, 0.3, 0.5])
    slow = []
    for row in p:
        middle = [(a + b) / 2 for a, b in zip(row, q)]
        kl = lambda x: sum(a * math.log2(a / m) for a, m in zip(x, middle) if a)
        slow.append(math.sqrt((kl(row) + kl(q)) / 2))
    assert np.allclose(op11.divergence(p, q), slow) and op11.divergence(p, q)[2] == 0


def floors(vector, scale=256):
    return [math.floor(x) * scale if abs(x) > 2.0**60 else math.floor(x * scale) for x in vector]


def lloyd(points, centroids, rounds):
    """Integer k-means over lists; assignments and centroids."""
    near = lambda v: min(range(len(centroids)), key=lambda c: (sum((a - b) ** 2 for a, b in zip(v, centroids[c])), c))
    for _ in range(rounds):
        at = [near(v) for v in points]
        for c in range(len(centroids)):
            own = [v for v, a in zip(points, at) if a == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    return [near(v) for v in points], centroids


def odd_vectors(dims, big=False):
    rnd = random.Random(dims)
    rows = [(i, [round(rnd.gauss(0, 1) * 4) / 8 for _ in range(dims)], rnd.choice([None, 1, 2])) for i in range(70)]
    rows += [(70, rows[3][1], 1), (71, rows[3][1], 1), (71, rows[4][1], 1), (71, rows[4][1], 1), (None, rows[5][1], None), (72, [0.0] * dims, 2)]
    bad = [(80, None, 1), (81, [], 1), (82, [1.0] * (dims - 1), 1), (83, [float("nan")] * dims, 1), (84, [float("inf")] + [0.0] * (dims - 1), None),
           (85, [None] + [0.0] * (dims - 1), 2)]
    if big:
        rows += [(90, [1e30] + [0.5] * (dims - 1), 1), (91, [-1e30] + [0.25] * (dims - 1), 2), (92, [3e8] * dims, 2)]
    return rows, bad


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("k", [1, 7, 500])
def test_clusters_brute_force(spark, k, big):
    rows, bad = odd_vectors(8, big)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + bad], VECTORS + ", cluster string, id int").repartition(3)
    got = op12.bisector_clusters(df, k=k, rounds=3, dims=8)
    points = [floors(v) for _, v, _ in rows]
    order = sorted(range(len(rows)), key=lambda i: ("g" if rows[i][0] is None else hashlib.sha256(f"2:{rows[i][0]}".encode()).hexdigest(), rows[i][1]))
    at, centroids = lloyd(points, [points[i] for i in order[:k]], 3)
    far = [sum((a - b) ** 2 for a, b in zip(v, centroids[c])) for v, c in zip(points, at)]
    fits = lambda x: x if x < 2**63 else None
    want = Counter((rows[i][0], c, fits(far[i]), fits(sum(f for f, d in zip(far, at) if d == c)), fits(sum(far)),
                    hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c in enumerate(at))
    assert Counter(map(tuple, got.collect())) == want
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_tournament_ties_favour_the_smaller_number():
    centroids = np.array([[0, 0], [4, 0], [0, 0], [2, 2]])
    points = np.array([[2, 0], [0, 0], [4, 0], [1, 1], [2, 1]])
    far = ((points[:, None] - centroids[None]) ** 2).sum(-1)
    assert op12.tournament(points, *op12.bisectors(centroids)).tolist() == far.argmin(1).tolist()


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("entries", [1, 5, 200])
def test_codes_brute_force(spark, entries, big):
    rows, bad = odd_vectors(8, big)
    kept = rows + [r for r in bad if r[0] in (81, 82)]
    df = spark.createDataFrame([(*r, "x", b"s") for r in rows + bad], VECTORS + ", code string, state binary").repartition(3)
    got = op13.code_vectors(df, parts=2, entries=entries, rounds=3)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0], rows[i][1]))
    codes, far, books = [""] * len(rows), [0] * len(rows), []
    for p in range(2):
        part = [floors(v)[4 * p:4 * p + 4] for _, v, _ in rows]
        at, book = lloyd(part, [part[i] for i in order[:entries]], 3)
        books += [x for entry in book for x in entry]
        for i, c in enumerate(at):
            codes[i] += f"{c:02x}"
            far[i] += sum((a - b) ** 2 for a, b in zip(part[i], book[c]))
    fits = lambda x: x if x < 2**63 else None
    digest = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    error = lambda i: far[i] if i < len(rows) else 0
    want = []
    for i, (number, _, label) in enumerate(kept):
        total = sum(error(j) for j, r in enumerate(kept) if r[2] == label)
        alone = all(fits(error(j)) is not None for j, r in enumerate(kept) if r[2] == label)
        want.append((number, codes[i] if i < len(rows) else None, fits(far[i]) if i < len(rows) else None, fits(total) if alone else None, digest))
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_bounds_spare_scans_and_change_nothing():
    rnd = np.random.default_rng(2)
    centres = rnd.integers(-4000, 4000, (3, 20, 4))
    vectors = (centres[np.arange(3)[None], rnd.integers(0, 20, (3000, 3))] + rnd.integers(-60, 60, (3000, 3, 4)))
    history, state, scans = [vectors[:20].transpose(1, 0, 2)], None, []
    for _ in range(6):
        state, n = op13.recode(vectors, state, history)
        scans.append(n)
        books = history[-1].copy()
        for p in range(3):
            far = ((vectors[:, p, None] - books[p][None]) ** 2).sum(-1)
            assert (far.argmin(1) == state["code"][:, p]).all()
            for c in np.unique(state["code"][:, p]):
                own = vectors[state["code"][:, p] == c, p]
                books[p, c] = own.sum(0) // len(own)
        history.append(books)
    assert scans[0] == 9000 and scans[-1] < 1000 and len(set(state["lower_round"].ravel().tolist())) > 1
    # The net displacement is at most the sum of the moves.
    steps = [np.sqrt(((b - a) ** 2).sum(-1)) for a, b in zip(history, history[1:])]
    assert (op13.displacements(history)[0] <= sum(steps) + 1e-9).all() and (op13.displacements(history)[0] < sum(steps) - 1).any()


def test_no_usable_vectors(spark):
    for rows in ([], [(1, None, 1), (2, [float("nan")] * 64, 1)]):
        df = spark.createDataFrame(rows, VECTORS)
        assert op12.bisector_clusters(df).collect() == [] and op13.code_vectors(df).collect() == []
    odd = op13.code_vectors(spark.createDataFrame([(1, [1.0] * 7, 3)], VECTORS)).collect()
    assert [tuple(r) for r in odd] == [(1, None, None, None, None)]


def test_sums_of_any_size():
    for x in (0, 1, -1, 2**62, -(2**62), 2**200 + 5, -(2**200) - 7, 2**61 - 1):
        got = sum(n * 2**(62 * d) for batch in ints.digit_rows({3: x}) for d, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
        assert got == x


def near_copies(n, words=80, seed=9):
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    texts = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rnd.randrange(1, 5)):
            copy[rnd.randrange(words)] = f"e{rnd.randrange(10**6)}"
        texts.append(" ".join(copy))
    return texts


def shingle_sets(texts, k=3):
    return [{tuple(t.split()[i:i + k]) for i in range(len(t.split()) - k + 1)} for t in texts]


def test_block_edges_join_what_links():
    """A block's links connect exactly what links across it connect, and are no more than it needs."""
    texts = near_copies(60) + near_copies(40, seed=10)
    shingles = op5.Shingles(3)
    items = list(shingles.of(pa.array([t.encode() for t in texts])))
    node, n = np.arange(len(texts)), np.array([len(x) for x in items])
    few = np.arange(len(texts)) % 2 == 0
    root = np.where(node < 6, 0, node)
    columns = {"few": few, "node": node, "root": root, "n": n, "bits": [op5.bitmap(x) for x in items]}
    sets = [set(x.tolist()) for x in items]
    links = [(i, j) for i in node for j in node if few[i] and not few[j] and root[i] != root[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]

    def joined(edges):
        label = root.copy()
        for a, b in edges:
            label[label == max(label[a], label[b])] = min(label[a], label[b])
        return label.tolist()
    a, b = op5.block_edges(pa.table({**columns, "items": [x.tobytes() for x in items]}), 75)
    assert set(zip(a.tolist(), b.tolist())) <= set(links) and joined(zip(a, b)) == joined(links)
    assert len(a) < len(texts) and len(links) > 2 * len(a)
    likely, other = op5.block_edges(pa.table(columns), 75)
    assert len(likely) < len(texts) and len(set(joined(zip(likely, other)))) <= len(set(joined(links)))


def test_jaccard_sends_edges_in_proportion(spark, monkeypatch):
    made, undecided = [], op5._undecided

    def counted(*args):
        found = undecided(*args).cache()
        made[-1] += found.count()
        return found
    monkeypatch.setattr(op5, "_undecided", counted)
    for n in (100, 200, 400):
        texts, sets = near_copies(n), None
        made.append(0)
        df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS)
        got = {r.did: r.component_id for r in op5.jaccard_components(df).collect()}
        sets, root = shingle_sets(texts), list(range(n))
        for i in range(n):
            for j in range(i):
                if root[i] != root[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                    root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
        assert got == dict(enumerate(root))
    assert made[2] <= 6 * max(made[0], 50), made


def test_places_send_a_pair_once():
    """Sets that share many places are sent as few pairs, which join what the pairs of all places would."""
    rnd, texts = random.Random(4), near_copies(70) + near_copies(50, seed=10)
    items = list(op5.Shingles(3).of(pa.array([t.encode() for t in texts])))
    bits, node, root = [op5.bitmap(x) for x in items], np.arange(len(texts)) * 7, np.where(np.arange(len(texts)) < 6, 0, np.arange(len(texts)) * 7)
    places = sorted(rnd.randrange(-(2**62), 2**62) for _ in range(12))
    own = [sorted(rnd.sample(places, rnd.randrange(1, 9))) for _ in texts]
    sent, alone, every = [], [], []
    for place in places:
        at = [i for i, p in enumerate(own) if place in p]
        table = pa.table({"place": [place] * len(at), "few": root[at] != 0, "before": pa.array([[q >> 32 for q in own[i] if q < place] for i in at], pa.list_(pa.int32())),
                          "node": node[at], "root": root[at], "n": [len(items[i]) for i in at], "bits": [bits[i] for i in at]})
        sent += list(zip(*(x.tolist() for x in op5.place_edges(table, 75))))
        nothing = pa.array([[]] * len(at), pa.list_(pa.int32()))
        alone += list(zip(*(x.tolist() for x in op5.place_edges(table.set_column(2, "before", nothing), 75))))
        x, y, _ = op5.candidates(table, 75, place=True)
        every += list(zip(node[at][x].tolist(), node[at][y].tolist()))

    def joined(edges):
        label = dict(zip(node.tolist(), root.tolist()))
        for a, b in edges:
            x, y = label[a], label[b]
            label = {k: min(x, y) if v in (x, y) else v for k, v in label.items()}
        return label
    assert joined(sent) == joined(every) and len(set(joined(sent).values())) < len(texts) - 40
    pairs = {frozenset(p) for p in sent}
    assert len(pairs) == len(sent) and 2 * len(sent) < len(alone) < len(every)


def test_jaccard_places_send_less_than_their_members(spark, monkeypatch):
    """Near copies that share many keys were sent under each, and in each block of a large key."""
    sent, rows, tiles = [], [], op5.sorted_tiles

    def counted(df, keys, one, schema):
        found = tiles(df, keys, one, schema).cache()
        if schema == op5._PAIRS and "items" not in df.columns:
            rows.append(df.count())
            sent.append(found.count())
        return found
    monkeypatch.setattr(op5, "sorted_tiles", counted)
    for name, size in {"PLACE": 24, "FEW": 6, "MANY": 48}.items():
        monkeypatch.setattr(op5, name, size, raising=False)
    for n in (100, 400):
        texts = near_copies(n)
        got = {r.did: r.component_id for r in op5.jaccard_components(spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], DOCS)).collect()}
        sets, root = shingle_sets(texts), list(range(n))
        for i in range(n):
            for j in range(i):
                if root[i] != root[j] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                    root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
        assert got == dict(enumerate(root)) and len(set(root)) < n
    assert sent[0] < 100 and sent[1] < 400 and rows[1] <= 6 * rows[0], (sent, rows)


def test_near_duplicate_plans_stay_small(spark, monkeypatch):
    """The driver plans anew after each shuffle of a plan and keeps the figures of each time: with plans of
    twenty shuffles and more, of which most came twice, the pipeline's driver grew over its memory."""
    import corpus_pipeline

    shuffles, save = {}, op5.saved

    def counted(df, label):
        shuffles[label] = max(shuffles.get(label, 0), df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return save(df, label)
    for module in ("components", "op5_jaccard_join"):
        monkeypatch.setattr(f"stagewise.llm.{module}.saved", counted)
    texts = near_copies(60) + ["", " ", "one"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counted(corpus_pipeline.near_duplicates(spark, docs, ""), "result")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {"jaccard-groups", "jaccard-components", "result"} <= set(shuffles) and max(shuffles.values()) <= 16, shuffles


@pytest.mark.parametrize("html", [
    "<a " * 350_000, "<div>" * 200_000 + "x", "<span hidden>" * 80_000, "<span hidden><div>x" * 50_000 + "</span>", "<script " * 120_000,
    "<! " * 300_000, "<a \"" * 250_000, "<a<a" * 250_000, "<a " + "x" * 1_000_000 + ">", "<div>" * 100_000 + "</p>" * 100_000, "<nav>" + "<article>" * 30_000,
], ids=["tags", "nested", "hidden", "reopened", "scripts", "declarations", "quotes", "names", "attribute", "ends", "articles"])
def test_broken_pages_take_no_longer(html):
    """A megabyte of anything is read in seconds; a second look at each rest of the page would take hours."""
    start = time.process_time()
    op7.page_blocks(html)
    assert time.process_time() - start < 10


def test_html_columns_of_any_name(spark):
    page = "<nav>menu</nav><article><p>Body</p></article>"
    df = spark.createDataFrame([(1, "http://a.b/c", page, "h", "u", "p", "r", 7, "old")],
                               "page_id long, url string, html string, _host string, _url string, path string, _row string, `host` int, text string")
    got = op7.extract_pages(df.withColumnRenamed("path", "a.path"))
    assert got.columns == ["page_id", "url", "html", "_host", "_url", "a.path", "_row", "host", "text"]
    assert tuple(got.first()) == (1, "http://a.b/c", page, "h", "u", "p", "r", 7, "Body")


def test_slots_beyond_exact_doubles(spark):
    """Whole division of long row numbers, where doubles would round."""
    n, shards = 2**60 + 2, 39
    rows = [0, 1, 2**60 + 1, 2**59 + 12345]
    got = {r.row_number: (r.shard, r.slot) for r in op10.shard_rows(spark.createDataFrame([(x,) for x in rows], "row_number long"), shards, total=n).collect()}
    assert got == {x: (int(p) % shards, int(p) // shards) for x, p in zip(rows, op10.permute(np.array(rows), n).tolist())}


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    """A labelled id of very many rows counts once, ids without a document not at all, and bytes are bounded."""
    rows = [(1, f"good words here {i % 3}") for i in range(300)] + [(i, "bad insult" if i % 2 else "kind words") for i in range(2, 60)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, features string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2 if i < 60 else 1) for i in range(1, 2000)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    seen, fit = [], op1.fit
    monkeypatch.setattr(op1, "fit", lambda features, y, seed=7: fit(features, y, seed))
    model = op1.train(docs, labels, sample=40)
    again = op1.train(docs.repartition(7), labels, sample=40)
    assert model[0] == again[0] and (model[1] == again[1]).all() and (model[1] != 0).any()
    monkeypatch.setattr(op1, "SAMPLE_BYTES", 0)
    none = op1.train(docs, labels)
    assert not none[1].any() and not seen


def test_scores_equal_a_double_loop():
    rnd = np.random.default_rng(3)
    weights, vectors = rnd.standard_normal(50).astype(np.float32), rnd.standard_normal((50, 4)).astype(np.float32)
    docs = [np.unique(rnd.integers(0, 50, n)) for n in (0, 1, 2, 9, 30, 0)]
    sizes = np.array([len(d) for d in docs])
    raw, _ = op1._scores(weights, vectors, 0.25, np.concatenate(docs), np.cumsum(sizes) - sizes)
    slow = [0.25 + sum(float(weights[i]) for i in d) + sum(float(vectors[i].astype(float) @ vectors[j].astype(float)) for k, i in enumerate(d) for j in d[k + 1:]) for d in docs]
    assert np.allclose(raw, slow)


def test_workers_let_go_of_kept_tables():
    """A task of another kind frees what an earlier stage kept in its worker; one of the same kind finds it."""
    class Kept:
        pass

    class InThisProcess:
        def mapInArrow(self, run, schema):
            return list(run(iter([pa.RecordBatch.from_pydict({"x": [1]})])))

    made, seen = [], []

    def table():
        kept = base.kept_in_process("table", Kept)
        made.append(weakref.ref(kept))
        return lambda batch: [batch]

    def other():
        seen.append(made[0]() is None)
        return lambda batch: [batch]

    for _ in range(2):
        base.map_batches(InThisProcess(), table, "x long", keeps=True)
    assert made[0]() is made[1]() is not None
    base.map_batches(InThisProcess(), other, "x long")
    assert seen == [True]


def test_fit_counts_in_bounded_memory():
    """Features are counted some documents at a time: the fit needs less than the sample's own size beside it."""
    rnd = np.random.default_rng(1)
    features = [rnd.integers(0, op1.FEATURES, 5000).astype(np.int32) for _ in range(6000)]
    labels = (rnd.random(6000) < 0.3).astype(np.float64)
    tracemalloc.start()
    try:
        op1.fit(features, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < sum(x.nbytes for x in features)


def test_style_tree_by_brute_force(spark):
    """Both entropies of each style node, over the distinct pages of a host with and without articles."""
    def page(items, text, tag):
        return f"<body><{tag} class='c'>" + "".join(f"<p>{text} {k}</p>" for k in range(items)) + "</" + tag + "><div class='legal'><p>Rights</p></div></body>"

    htmls = [page(1 + i % 3, f"own {i}", "article" if i % 2 else "div") for i in range(12)]
    pages = spark.createDataFrame([("h", x) for x in htmls + htmls[:5]], "host string, html string")
    lists, texts, around = {}, {}, {}
    for html in htmls:
        nodes, children = [], {}
        blocks, _ = op7.page_blocks(html, nodes=nodes)
        for n in nodes:
            children.setdefault(n.up, []).append(n.path)
            around[n.path] = n.up
        for n in nodes:
            lists.setdefault(n.path, []).append(tuple(children.get(n.path, ())))
        for path, text in set(blocks):
            texts.setdefault(path, []).append(text)

    def entropy(seen):
        return -sum(c / len(seen) * math.log(c / len(seen), len(seen)) for c in Counter(seen).values()) if len(seen) > 1 else 1.0

    want = {}
    for path, seen in texts.items():
        of = lists[around[path]]
        share = op7.CONTENTS ** len(set(of))
        want[op7._node("h", path)] = (len(seen), (1 - share) * entropy(of) + share * entropy(seen))
    got = {r.node % 2**64: (r.m, r.importance) for r in op7.style_nodes(op7.style_blocks(pages)).collect()}
    assert got.keys() == want.keys() and len(want) == 3  # the article's paragraphs, the plain ones, the rights of plain pages
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def test_presentation_decides_beside_contents(spark):
    """A line that pages repeat stays where the elements around it are laid out differently on each."""
    rows = [(i, "http://one.org/", f"<body><div class='list'>{'<p>Same line</p>' * (i + 1)}</div><div class='box'><p>Same box</p></div><div><p>own {i}</p></div></body>") for i in range(12)]
    got = {r.page_id: r.text for r in op7.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == "\n\n".join(["Same line"] * (i + 1) + [f"own {i}"]) for i in range(12))
