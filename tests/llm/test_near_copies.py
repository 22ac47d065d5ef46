import random

from tidemark.llm import near_copies as nc
from tidemark.llm.blocks import Block

from .awkward import TEXTS, awkward, empty


def classes_of(frame):
    return {(r.doc_id, r.text_key): r.class_id for r in frame.collect()}


def by_id(frame):
    return {r.doc_id: r.class_id for r in frame.collect()}


def exact(rows, steps):
    """Classes by comparing all pairs."""
    sets = []
    for _, text in rows:
        _, term, count = nc.shingles(Block(0, [(text or "").encode()]))
        sets.append(dict(zip(term.tolist(), nc.weights(term, count, steps).tolist(), strict=True)) if len(term) else {("text", text or ""): 1.0})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            shared = sum(min(a[t], b[t]) for t in a.keys() & b.keys())
            if shared >= 0.8 * (sum(a.values()) + sum(b.values()) - shared) - 1e-9:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: least[find(i)] for i, (d, _) in enumerate(rows)}


def group(draw, base, size, most):
    words = base.split()
    for _ in range(size):
        own = list(words)
        for _ in range(draw.randint(0, most)):
            own[draw.randrange(len(own))] = f"new{draw.randrange(10**6)}"
        yield " ".join(own)


def corpus():
    draw = random.Random(3)
    texts = []
    for g in range(12):
        base = " ".join(f"g{g}w{draw.randrange(500)}" for _ in range(90))
        texts += group(draw, base, 9, 5)
    base = " ".join(f"hot{draw.randrange(500)}" for _ in range(120))
    texts += group(draw, base, 70, 2)  # more than a crowd
    texts += [" ".join(f"s{draw.randrange(10**6)}" for _ in range(40)) for _ in range(20)]
    texts += ["one two three", "One, two: three!", "one two", "solo", "...", "...", "", None]
    return list(enumerate(texts))


def test_against_all_pairs(spark):
    rows = corpus()
    docs = awkward(spark, rows)
    steps = nc.idf_steps(nc.document_frequencies(docs, "text"), len(rows))
    assert by_id(nc.classes(docs)) == exact(rows, steps)


def drifting(draw, size, breaks=(), same=200, own=60, step=20):
    """Texts that share words but are near only to the next one; after ``breaks`` to none."""
    shared = " ".join(f"both{draw.randrange(10**6)}" for _ in range(same))
    words = [f"d{draw.randrange(10**6)}" for _ in range(own + step * size + 200 * len(breaks))]
    at = 0
    for k in range(size):
        at += 200 if k in breaks else step
        yield f"{shared} {' '.join(words[at - step : at - step + own])}"


def test_a_crowd_that_drifts_against_all_pairs(spark):
    draw = random.Random(5)
    rows = list(enumerate(drifting(draw, 240, breaks=(60, 61, 160))))
    draw.shuffle(rows)
    docs = awkward(spark, rows)
    steps = nc.idf_steps(nc.document_frequencies(docs, "text"), len(rows))
    want = exact(rows, steps)
    assert len(set(want.values())) == 4
    assert by_id(nc.classes(docs)) == want


def variants(draw, size, words=120, most=0.3):
    """Copies of one text, each with its own share of words replaced, dropped or added; some of them copied again."""
    base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(size):
        text = list(draw.choice(out).split() if out and draw.random() < 0.2 else base)
        for _ in range(int(draw.random() * most * words / 5)):
            at = draw.randrange(len(text))
            text[at : at + draw.randint(0, 2)] = [f"x{draw.randrange(10**6)}" for _ in range(draw.randint(0, 2))]
        out.append(" ".join(text))
    return out


def test_a_crowd_of_variants_against_all_pairs(spark, monkeypatch):
    seen = []
    real = nc.verify
    monkeypatch.setattr(nc, "CROWD", 8)
    monkeypatch.setattr(nc, "verify", lambda pairs, *more: (seen.append(pairs.count()), real(pairs, *more))[1])
    rows = list(enumerate(variants(random.Random(8), 300)))
    docs = awkward(spark, rows)
    steps = nc.idf_steps(nc.document_frequencies(docs, "text"), len(rows))
    want = exact(rows, steps)
    assert by_id(nc.classes(docs)) == want and 20 < len(set(want.values())) < 250
    assert sum(seen) < 300 * 299 / 2 / 4, seen


def test_rare_shingles_settle_pairs(spark):
    terms = [(1, 10, 1.0), (1, 11, 3.0), (2, 10, 2.0), (2, 12, 2.0)] + [(n, 99, 6.0) for n in range(1, 80)]
    total = {n: sum(w for m, _, w in terms if m == n) for n, _, _ in terms}
    terms = [(n, total[n], t, w) for n, t, w in terms]
    shares, rows = nc.rare_shares(spark.createDataFrame(terms, "node bigint, total double, term bigint, weight double"))
    found = {r.node: (r.total, r.rare) for r in shares.collect()}
    assert found[1] == (10.0, 4.0) and found[2] == (10.0, 4.0) and found[3] == (6.0, 0.0)
    # shingle 11 is the rarest of 1 and more than a fifth of it, so 10 is not among its first
    assert sorted(tuple(r) for r in rows.collect()) == [(1, 10, False), (2, 10, True)]


def test_document_frequencies_are_of_all_documents(spark):
    rows = corpus()
    total = nc.document_frequencies(awkward(spark, rows), "text")
    alone = [nc.document_frequencies(awkward(spark, [r]), "text") for r in rows[:3]]
    assert sum(alone).max() <= total.max() and ((sum(alone) > 0) <= (total > 0)).all()


def test_awkward_rows_and_keep_one(spark):
    docs = awkward(spark)
    found = nc.classes(docs).collect()
    assert len(found) == len(TEXTS)
    kept = nc.keep_one(docs)
    assert kept.columns == docs.columns
    texts = sorted((r.text or "", -1 if r.doc_id is None else r.doc_id) for r in kept.collect())
    # null and empty are equal texts; of the repeated row one stays
    assert len(texts) == len(TEXTS) - 2 and [i for t, i in texts if t == ""] == [1]


def test_empty_table(spark):
    assert nc.classes(empty(spark)).count() == 0
    assert nc.keep_one(empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)]
    found = {r["node"]: r["class"] for r in nc.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert set(found[k] for k in range(41)) == {0} and set(found[k] for k in range(100, 130)) == {100}


def test_pairs_compared_in_a_crowd_grow_like_its_texts(spark, monkeypatch):
    monkeypatch.setattr(nc, "FEW_PAIRS", 64)
    seen = []
    real = nc.verify
    monkeypatch.setattr(nc, "verify", lambda pairs, *more: (seen.append(pairs.count()), real(pairs, *more))[1])
    for size in (200, 400):
        seen.clear()
        rows = list(enumerate(variants(random.Random(size), size, most=0.15)))
        docs = awkward(spark, rows)
        steps = nc.idf_steps(nc.document_frequencies(docs, "text"), len(rows))
        want = exact(rows, steps)
        assert by_id(nc.classes(docs)) == want and 1 < len(set(want.values())) < size / 2
        assert sum(seen) < 5 * size, seen


def test_bits_leave_out_no_near_pair(spark):
    draw = random.Random(11)
    texts = variants(draw, 60, most=0.4) + ["one two three", "one two three", "solo"]
    texts += variants(draw, 12, words=2000, most=0.2)  # more shingles than bits
    docs = awkward(spark, list(enumerate(texts)))
    steps = nc.idf_steps(nc.document_frequencies(docs, "text"), len(texts))
    shared = docs.sparkSession.sparkContext.broadcast(steps)
    rows = nc.signatures(docs.withColumn("raw", nc.text_bytes("text")), "raw", shared, ["doc_id"]).select("doc_id", "total", "bits")
    both = rows.toDF("a", "x", "p").crossJoin(rows.toDF("b", "y", "q")).filter("a < b")
    maybe = {(r.a, r.b) for r in both.filter(nc.may_be_near(both.x, both.p, both.y, both.q)).collect()}
    near = {(i, j) for j in range(len(texts)) for i in range(j) if len(set(exact([(0, texts[i]), (1, texts[j])], steps).values())) == 1}
    assert near <= maybe and 20 < len(near)
    assert len(maybe) < 0.7 * both.count()


def test_few_rows_take_few_tasks(spark):
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    sc = spark.sparkContext
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup("few-tasks", "few-tasks")
        found = by_id(nc.classes(awkward(spark, corpus())))
    finally:
        for name in ("spark.jobGroup.id", "spark.job.description"):
            sc.setLocalProperty(name, None)
        for k, v in before.items():
            spark.conf.set(k, v)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("few-tasks") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))
    assert len(found) == len(corpus())
    assert 0 < tasks < 900, tasks


def test_few_and_many_rows_have_equal_classes(spark, monkeypatch):
    draw = random.Random(23)
    rows = list(enumerate([*variants(draw, 200), *(t for _, t in corpus())]))
    few = by_id(nc.classes(awkward(spark, rows)))
    monkeypatch.setattr(nc, "FEW_ROWS", -1)
    monkeypatch.setattr(nc, "TASK_PAIRS", 16)
    assert by_id(nc.classes(awkward(spark, rows))) == few
