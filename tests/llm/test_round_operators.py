"""Filter audit, importance resampling and the metric n-gram join against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shoplake.llm import filter_audit, resampling
from shoplake.llm.queries import op11_filter_diagrams, op12_importance_resampling

from conftest import SF001

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _documents(spark, rows):
    """rows: (doc_id, text, source)"""
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def _table(spark, name):
    return spark.read.parquet(f"{SF001}/{name}.parquet")


# --- filter interaction audit -------------------------------------------------


def brute_audit(docs, labels):
    """docs: (doc_id, text, source), labels: doc_id to (good, toxic)."""
    texts, found = {}, []
    for i, t, _ in docs:
        texts.setdefault(t or "", []).append(i)
    for i, t, source in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = set()
        if len(words) < 50:
            failed.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            failed.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            failed.add("C")
        if re.search(r"[#$%&*|]", t):
            failed.add("D")
        if any(o is not None and (i is None or o < i) for o in texts[t]):
            failed.add("E")
        found.append((source or "", failed, *labels.get(i, (False, False))))
    out, shares = {}, Counter()
    for part in {f[0] for f in found}:
        own = [f for f in found if f[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone, left = [f for f in left if name in f[1]], [f for f in left if name not in f[1]]
                shares[part, name] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(name in f[1] for f in own) - len(gone), sum(f[1] == {name} for f in own),
                    sum(f[2] for f in gone), sum(f[3] for f in gone)]
    return {k: (*v, shares[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def _audited(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in filter_audit.COLUMNS) for r in df.collect()}


def test_audit_of_a_table_equals_brute_force(spark):
    docs = [(r.doc_id, r.text, r.source) for r in _table(spark, "documents").collect()]
    labels = {r.doc_id: (r.quality == 1, r.toxic == 1) for r in _table(spark, "labels").collect()}
    assert _audited(op11_filter_diagrams(spark, SF001)) == brute_audit(docs, labels)


def test_audit_of_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = [(5, "same text", "a"), (2, "same text", None), (2, "same text", ""), (None, "same text", "a"), (7, None, "a"),
            (3, "", "b"), (None, None, None), (9, "X" * 5000 + " " + "y " * 100000, "b"), (10, long, "b"), (10, long, "b"),
            (11, long + " #", "b"), (12, "\x1c  one word", "c"), (4, long, "c")]
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (9, None, 1), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    df = _documents(spark, docs).selectExpr("*", "1 as mask", "'x' as part", "2 as hash", "true as good", "0 as words", "'b' as body", "1 as first")
    assert _audited(filter_audit.audit(df, labels)) == brute_audit(docs, {5: (True, True), 9: (False, True)})


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(_documents(spark, []), none).collect() == []
    assert len(filter_audit.audit(_documents(spark, [(1, "a", "s")]), none).collect()) == 600


@pytest.mark.parametrize("n", [1, 2, 3, 4, 6])
def test_adjacent_swaps_reach_every_order_once(n):
    order = list(range(n))
    seen = {tuple(order)}
    for at in filter_audit.adjacent_swaps(n):
        order[at], order[at + 1] = order[at + 1], order[at]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == math.factorial(n)


def test_swapped_diagram_is_the_diagram_of_that_order():
    rng = random.Random(3)
    counts = {m: (rng.randrange(4), rng.randrange(3), rng.randrange(2)) for m in rng.sample(range(32), 20)}
    counts = {m: c for m, c in counts.items() if any(c)}
    diagram = filter_audit.Diagram(counts, 5)
    for _ in range(200):
        diagram.swap(rng.randrange(4))
        place = {f: i for i, f in enumerate(diagram.order)}
        turned = {sum(1 << place[f] for f in range(5) if m >> f & 1): c for m, c in counts.items()}
        built = filter_audit.Diagram(turned, 5)
        assert [(r, k) for _, r, k in diagram.steps()] == [(r, k) for _, r, k in built.steps()]
        assert list(map(len, diagram.levels)) == list(map(len, built.levels))


# --- importance resampling ----------------------------------------------------


def _features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute_resample(docs, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = (Counter(bucket(f) for text in texts for f in _features(text)[1]) for texts in ([d[1] for d in docs], target))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log(((t[b] + 1) * (s_all + 10000)) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        words, features = _features(text)
        weight = sum(gain[bucket(f)] for f in features)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = {id(r): n for n, r in enumerate(able[:5 * len(able) // 100], 1)}
    return sorted(((*r[:4], ranks.get(id(r))) for r in rows), key=str)


def test_resampling_of_a_table_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in _table(spark, "documents").collect()]
    target = [r.text for r in _table(spark, "benchmark").collect()]
    got = op12_importance_resampling(spark, SF001)
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(docs, target)
    assert {t for _, t in got.dtypes} == {"bigint"}


def test_resampling_of_awkward_rows(spark):
    rng = random.Random(1)
    vocabulary = ["Alpha", "be-ta", "ça", "数据", "x9", "Ünder_score", " ", "don't"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(150)]
    docs += [(None, "a b " * 30), (1, None), (2, ""), (3, "!!! ,,,"), (4, "a b " * 30), (4, "a b " * 30), (5, "word " * 300_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as rank", "2 as score", "'k' as key", "0 as _at", "0 as _row")
    target = [None, "", "alpha beta alpha", "数据 ça x9"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(df, frame).collect()
    assert sorted(map(tuple, got), key=str) == brute_resample(docs, target)


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c " * 10)], "doc_id long, text string")
    assert resampling.resample(none, some).collect() == []
    assert [tuple(r) for r in resampling.resample(some, none).collect()] == brute_resample([(1, "a b c " * 10)], [])


def test_pieces_of_a_long_text_give_the_same_checksums(monkeypatch):
    text = " ".join(f"w{i % 7}é" for i in range(500)).encode() + b"  " + b"z" * 400 + b" end"
    whole = sorted(c for _, found in resampling.checksums(text) for c in found.tolist())
    for size in (1, 2, 3, 5, 50, 399):
        monkeypatch.setattr(resampling, "PIECE", size)
        assert sorted(c for _, found in resampling.checksums(text) for c in found.tolist()) == whole


def test_ranks_over_many_ranges(spark):
    rows = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("score"), "id")
    got = resampling.ranked(rows.repartition(13), [F.col("score").desc(), F.col("id")]).orderBy("rank").collect()
    assert [r.rank for r in got] == list(range(1, 5001))
    assert [(r.score, r.id) for r in got] == sorted(((r.score, r.id) for r in got), key=lambda x: (-x[0], x[1]))


# --- metric n-gram join -------------------------------------------------------


def _shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 3]) for i in range(max(1, len(words) - 2)))


def brute_join(docs, percent=90):
    """docs: (doc_id, text); rows (doc_id, size, component)."""
    sets = [_shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if a and b and 100 * common >= percent * (len(a) + len(b) - common):
                parent[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted([(doc, len(s), least.get(top(i))) for i, ((doc, _), s) in enumerate(zip(docs, sets, strict=True))], key=str)


def _near_texts(rng, groups, copies, length=60, edits=3, vocabulary=40):
    out = []
    for _ in range(groups):
        base = [f"w{rng.randrange(vocabulary)}" for _ in range(length)]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randrange(edits + 1)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(500)}"
            out.append(" ".join(words))
    return out


def _joined(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_join_of_a_table_equals_brute_force(spark):
    from shoplake.llm.queries import op13_metric_ngram_join

    docs = [(r.doc_id, r.text) for r in _table(spark, "documents").collect()]
    got = op13_metric_ngram_join(spark, SF001)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert _joined(got) == brute_join(docs)


def test_join_of_awkward_rows(spark):
    from shoplake.llm import ngram_join

    rng = random.Random(2)
    texts = _near_texts(rng, 12, 14) + _near_texts(rng, 3, 40, length=200, edits=9)
    docs = list(enumerate(texts, 10))
    docs += [(None, texts[0]), (None, "only here and nowhere else at all"), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"),
             (6, "one two"), (7, "one two"), (7, "one two"), (8, "\x1cone two"), (9, "w1 " * 300_000), (0, "w1 w1 w1 "), (9000, "Ärger ÄRGER x")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 as row", "2 as n", "'k' as key", "0 as region", "'r' as raw", "3 as label")
    assert _joined(ngram_join.join(df)) == brute_join(docs)


@pytest.mark.parametrize("percent", [70])
def test_join_at_other_similarities(spark, percent):
    from shoplake.llm import ngram_join

    docs = list(enumerate(_near_texts(random.Random(percent), 10, 20, length=50, edits=6)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _joined(ngram_join.join(df, percent=percent)) == brute_join(docs, percent)


@pytest.mark.parametrize(("leaf", "crowd", "spread"), [(1000, 8, 100), (1000, 8, 1)])
def test_join_recurses_to_cells_and_blocks(spark, monkeypatch, leaf, crowd, spread):
    from shoplake.llm import ngram_join

    for name, value in (("LEAF", leaf), ("CROWD", crowd), ("SPREAD", spread)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(leaf + spread)
    # one template with slots: every region of single shingles holds many texts
    words = [f"t{i}" for i in range(60)]
    texts = []
    for _ in range(90):
        text = list(words)
        for slot in range(0, 60, 8):
            text[slot] = f"s{rng.randrange(3)}"
        texts.append(" ".join(text))
    docs = list(enumerate(texts + _near_texts(rng, 2, 40)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _joined(ngram_join.join(df)) == brute_join(docs)


def test_block_join_finds_every_component():
    import numpy as np

    from shoplake.llm import ngram_join

    rng = random.Random(9)
    for _ in range(30):
        texts = _near_texts(rng, 3, 40, length=40, edits=5)
        sets = [ngram_join.shingle_set(t.encode()) for t in texts]
        side = np.array([rng.randrange(2) for _ in texts])
        for given in (None, side):
            links = ngram_join.join_block(sets, np.arange(len(sets)), 90, given)
            joined, true = ngram_join._Joined(np.arange(len(sets))), ngram_join._Joined(np.arange(len(sets)))
            for i, j in links:
                assert _jaccard_linked(sets[i], sets[j]) and (given is None or given[i] != given[j])
                joined.add(i, np.array([j]))
            for i, j in itertools.combinations(range(len(sets)), 2):
                if (given is None or given[i] != given[j]) and _jaccard_linked(sets[i], sets[j]):
                    true.add(i, np.array([j]))
            pairs = set(zip(joined.of.tolist(), true.of.tolist(), strict=True))
            assert len(pairs) == len(set(joined.of.tolist())) == len(set(true.of.tolist()))


def _jaccard_linked(a, b, percent=90):
    common = len(set(a.tolist()) & set(b.tolist()))
    return 100 * common >= percent * (len(a) + len(b) - common)


def test_join_of_nothing(spark):
    from shoplake.llm import ngram_join

    none = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.join(none).collect() == []
    assert _joined(ngram_join.join(spark.createDataFrame([(3, None)], none.schema))) == [(3, 0, 3)]


@pytest.mark.parametrize("bits", [1, 6, 40])
def test_regions_counted_by_some_bits_of_a_shingle_lose_no_link(spark, monkeypatch, bits):
    from shoplake.llm import ngram_join

    monkeypatch.setattr(ngram_join, "COUNTED", bits)
    rng = random.Random(bits)
    docs = []
    for group in range(12):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(3, 90))]
        for _ in range(3):
            near = list(base)
            if rng.random() < 0.6:
                near[rng.randrange(len(near))] = f"x{rng.randrange(5)}"
            docs.append((len(docs), " ".join(near)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert _joined(ngram_join.join(df)) == brute_join(docs)


@pytest.mark.parametrize("operator", ["neardup", "ngram_join"])
def test_workers_keep_little_of_a_batch_and_nothing_after_it(spark, monkeypatch, operator):
    import importlib
    import tracemalloc

    import pyarrow as pa

    module = importlib.import_module(f"shoplake.llm.{operator}")
    caught = {}

    class Rows:
        def mapInArrow(self, run, schema):
            caught["arrow"] = run

        def mapInPandas(self, run, schema):
            caught["pandas"] = run

    monkeypatch.setattr(module, "shipped", lambda df: Rows())
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    (module.signatures if operator == "neardup" else module.points)(docs)
    texts = [" ".join(f"w{i * 50 + j}" for j in range(50)) for i in range(8_000)]  # 400,000 words
    columns = {"doc_id": list(range(8_000)), "row": list(range(8_000)), "raw": ["r"] * 8_000, "text": texts}
    if operator == "ngram_join":
        columns = {"key": list(map(str, columns["row"])), "row": columns["row"], "raw": columns["raw"], "data": [t.encode() for t in texts]}
    batch = pa.RecordBatch.from_pydict(columns)
    del columns, texts
    tracemalloc.start()
    try:
        kind, run = caught.popitem()
        rows = 0
        for out in run(iter([batch if kind == "arrow" else batch.to_pandas()])):
            rows += len(out) if kind == "pandas" else out.num_rows
            out = None
        left, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert rows == 8_000
    assert peak < 64e6 and left < 2e6


def test_components_of_chains_rings_and_stars_match_union_find(spark):
    from shoplake.llm.neardup import components

    rng = random.Random(8)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 17) for i in range(17)]
    links += [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(35)] + [(500, 500), (7, 3)]
    top = {x: x for link in links for x in link}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        top[b] = a
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == {x: root(x) for x in top} and len(got) == len(top)


def test_small_tables_of_the_join_are_few_files_whatever_the_shuffle_partitions(spark, monkeypatch):
    from shoplake.llm import neardup, ngram_join

    parts, staged = {}, ngram_join.staged

    def count(df, name):
        out = staged(df, name)
        parts.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(neardup, "staged", count)
    monkeypatch.setattr(ngram_join, "staged", count)
    for name, value in (("LEAF", 1000), ("CROWD", 8)):  # as in the recursion's own test
        monkeypatch.setattr(ngram_join, name, value)
    docs = list(enumerate(_near_texts(random.Random(4), 2, 60)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    conf = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    held = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = _joined(ngram_join.join(df))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == brute_join(docs)
    small = ["links", "labels", "ngram_same", "ngram_regions", "ngram_reach", "ngram_stars", "ngram_wanted", "ngram_mixed",
             "ngram_sizes", "ngram_leaves", "ngram_rings", "ngram_left"]
    assert set(small) <= set(parts) and all(max(parts[name]) <= 1 for name in small), parts


def test_packed_tables_get_tasks_by_their_rows(spark, monkeypatch):
    from shoplake.llm import common

    monkeypatch.setattr(common, "PACK", 10)
    df = spark.range(95).repartition(40)
    assert common.packed(df, 95).rdd.getNumPartitions() == 10 and common.packed(df, 10_000).rdd.getNumPartitions() == 40
    assert sorted(r["id"] for r in common.packed(df, 95).collect()) == list(range(95))


def test_only_texts_that_share_a_bucket_are_shuffled_for_their_sets(spark, monkeypatch):
    from shoplake.llm import neardup

    words = random.Random(2)
    texts = [" ".join(f"w{words.randrange(10**9)}" for _ in range(12)) for _ in range(300)]
    texts += [texts[0] + " more", texts[1]]
    found, staged = {}, neardup.staged

    def count(df, name):
        if name == "dart_sets":
            found["plan"] = df._jdf.queryExecution().optimizedPlan().toString()
        return staged(df, name)

    monkeypatch.setattr(neardup, "staged", count)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(df).collect()}
    assert got == {i: i for i in range(300)} | {300: 0 if got[300] == 0 else 300, 301: 1}
    assert "_mask" in found["plan"]


def edited(n: int, seed: int, length: int = 150) -> list[str]:
    """Copies of one text with up to three words replaced anywhere, and some with four: too far from the middle, but near a few."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(length)]
    texts = [" ".join(base)]
    while len(texts) < n:
        words = list(base)
        for at in rng.sample(range(length), rng.choice((1, 1, 2, 2, 2, 3, 3, 4))):
            words[at] = f"edit{rng.randrange(40)}"
        texts.append(" ".join(words))
    return texts


def test_a_group_of_near_copies_makes_no_rows_by_the_square_of_its_size(spark, monkeypatch):
    from shoplake.llm import neardup

    texts = edited(1000, 5) + [" ".join(f"v{i}_{j}" for j in range(30)) for i in range(5)]
    sets = [{tuple(w[j:j + 5]) for j in range(len(w) - 4)} for w in map(str.split, texts)]
    near = [[] for _ in texts]
    for i, j in itertools.combinations(range(len(texts)), 2):
        common = len(sets[i] & sets[j])
        if common >= 0.8 * (len(sets[i]) + len(sets[j]) - common):
            near[i].append(j)
            near[j].append(i)
    expected = {}
    for i in range(len(texts)):
        todo = [i]
        while todo:
            if (j := todo.pop()) not in expected:
                expected[j] = i
                todo += near[j]
    made, verified = [], neardup._verified

    def counted(pairs, *rest):
        made.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(neardup, "_verified", counted)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = neardup.classes(df).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == expected
    assert sum(made) <= 8 * len(texts)
    assert all(r["links"] <= len(near[r["doc_id"]]) for r in got)
    # the links of a text don't hang on how many texts a task compares
    monkeypatch.setattr(neardup, "CROWD", 30)
    monkeypatch.setattr(neardup, "LEAF", 6_000)
    assert sorted(neardup.classes(df).collect()) == sorted(got)


def test_links_across_classes_are_counted_once_and_each_class_joined(spark):
    import numpy as np
    import pandas as pd

    from shoplake.llm import neardup

    rng = random.Random(3)
    base = list(range(100))
    sets = [sorted({*base, *range(1000, 1012)} - set(rng.sample(base, rng.randrange(12)))) for _ in range(40)]
    label = [i % 3 if i < 30 else 100 + i for i in range(40)]
    for sided in (False, True):
        side = [i % 2 for i in range(40)]
        regions = [[7, 9] if i % 4 else [5, 7] for i in range(40)]
        pairs = [(i, j) for i in range(40) for j in range(i) if label[i] != label[j] and not (sided and side[i] == side[j])
                 and len({*sets[i]} & {*sets[j]}) >= 0.8 * len({*sets[i]} | {*sets[j]})
                 and min({*regions[i]} & {*regions[j]}) == 7]
        part = pd.DataFrame({"region": 7, "sided": sided, "doc_id": range(40), "row": range(40), "label": label,
                             "side": side, "regions": regions, "set": [np.array(s) for s in sets]})
        found = neardup._block_links(part, 0.8)
        assert {r[1]: r[4] for r in found if r[3] < 0} == Counter(x for p in pairs for x in p)
        joins = [(r[1], r[3]) for r in found if r[3] >= 0]
        assert all((a, b) in pairs or (b, a) in pairs for a, b in joins)
        assert 0 < len(joins) <= len(set(label)) - 1
