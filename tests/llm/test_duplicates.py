"""Near duplicates, decontamination and the pipeline."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sectorloom.llm import decontaminate, near_dup, queries

from .conftest import prose

SMALL = "/root/testdata/sf0.001"


def word_list(text):
    return re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").lower().encode())


def bag(found, weight=lambda s: 1):
    size = min(5, len(found))
    out = Counter()
    for i in range(len(found) - size + 1 if found else 0):
        out[tuple(found[i : i + size])] += weight(found[i : i + size])
    return out


def jaccard(a, b):
    shared = sum(min(n, b[k]) for k, n in a.items())
    return shared / max(sum(a.values()) + sum(b.values()) - shared, 1e-12)


def test_similarity_is_weighted_jaccard():
    rng = random.Random(1)
    idf = near_dup.idf_table(np.full((near_dup.DEPTH, near_dup.WIDTH), 3), 1000)
    base = prose(1, 80).split()
    pairs = [(base, [w if rng.random() > p else "x" for w in base]) for p in (0, 0.01, 0.05, 0.3, 1)]
    pairs += [([], base), ([], []), (["a"], ["a"]), (["a", "b"], ["a"]), (base + base, base)]
    a, b = (pa.array([" ".join(p[i]) for p in pairs]) for i in (0, 1))
    expected = [jaccard(bag(word_list(x)), bag(word_list(y))) for x, y in zip(a.to_pylist(), b.to_pylist())]
    assert np.allclose(near_dup.similarity(a, b, idf), expected)


def test_samples_agree_as_often_as_the_similarity():
    rng = random.Random(5)
    frequencies = np.random.default_rng(1).integers(1, 900, (near_dup.DEPTH, near_dup.WIDTH))
    idf = near_dup.idf_table(frequencies, 1000)
    base = [f"v{rng.randrange(400)}" for _ in range(300)]
    texts = [" ".join(base)] + [" ".join(w if rng.random() > p else "zz" for w in base) for p in (0.01, 0.03, 0.08)]
    marks = near_dup.samples(pa.array([*texts, None, "..."]), idf, 1500)
    assert not marks[-2:].any()
    for i in (1, 2, 3):
        expected = near_dup.similarity(pa.array(texts[:1]), pa.array(texts[i : i + 1]), idf)[0]
        assert abs((marks[0] == marks[i]).mean() - expected) < 0.05


def linked_classes(ids, texts, idf, threshold=0.8):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    column = pa.array([t or "" for t in texts], pa.string())
    for i in range(len(ids)):
        others = pa.array([column[j].as_py() for j in range(i)], pa.string())
        values = near_dup.similarity(pa.array([column[i].as_py()] * i, pa.string()), others, idf)
        for j in range(i):
            if values[j] >= threshold or column[i] == column[j]:
                parent[find(i)] = find(j)
    members = {}
    for i, own in enumerate(ids):
        members.setdefault(find(i), []).append(own)
    return sorted((sorted(m, key=repr) for m in members.values()), key=repr)


def found_classes(df):
    members = {}
    for r in near_dup.classes(df).collect():
        members.setdefault((r.class_id, r.class_size), []).append(r.doc_id)
        assert r.class_id == r.doc_id or r.class_id is None or r.class_id < (r.doc_id or 10**9)
    assert all(len(m) == size for (_, size), m in members.items())
    return sorted((sorted(m, key=repr) for m in members.values()), key=repr)


@pytest.mark.parametrize("nodes", [16, 512])
def test_classes_equal_brute_force_in_a_hot_bucket(spark, monkeypatch, nodes):
    """A family of near copies that are linked only in chains, in blocks of a few nodes."""
    monkeypatch.setattr(near_dup, "BLOCK_NODES", nodes)
    monkeypatch.setattr(near_dup, "SPARSE", 1)
    rng = random.Random(3)
    base = prose(2, 120).split()
    texts = []
    for _ in range(60):
        own = list(base)
        for _ in range(rng.randrange(5)):
            own[rng.randrange(len(own))] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    texts += [texts[0]] * 30 + [prose(50 + i, 60) for i in range(10)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    idf = near_dup.idf_table(near_dup.document_frequencies(df), len(texts))
    assert found_classes(df) == linked_classes(range(len(texts)), texts, idf)


def test_awkward_documents(docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    idf = near_dup.idf_table(near_dup.document_frequencies(docs), len(rows))
    assert found_classes(docs) == linked_classes(*zip(*rows), idf)
    assert near_dup.classes(no_docs).collect() == []
    kept = near_dup.deduplicated(docs)
    assert kept.columns == docs.columns
    classes = found_classes(docs)
    assert kept.count() == len(classes)
    assert near_dup.deduplicated(no_docs).collect() == []


def test_document_frequencies_never_undercount(spark):
    df = spark.createDataFrame([(f"a b c d e x{i % 7} y z w v",) for i in range(70)], "text string").repartition(5)
    sketch = near_dup.document_frequencies(df)
    _, hashes, _ = near_dup.weighted(pa.array(["a b c d e"]))
    assert min(sketch[row][slots[0]] for row, slots in enumerate(near_dup._sketch_slots(hashes))) >= 70
    assert sketch.sum() == near_dup.DEPTH * 70 * 6


def brute_spans(texts, items):
    """For each text, the items of some window of at least the threshold, with their best similarity."""
    out = []
    for text in texts:
        own, best = word_list(text), {}
        for item_id, item in items:
            target = word_list(item)
            width = min(5, len(target))
            if not width or len(own) < width:
                continue
            weight = lambda s: sum(map(len, s))
            grams = [own[i : i + width] for i in range(len(own) - width + 1)]
            wanted = Counter()
            for i in range(len(target) - width + 1):
                wanted[tuple(target[i : i + width])] += weight(target[i : i + width])
            size = len(target) - width + 1
            for s in range(1 - size, len(grams)):
                window = Counter()
                for gram in grams[max(s, 0) : s + size]:
                    window[tuple(gram)] += weight(gram)
                value = jaccard(window, wanted)
                if value >= 0.8:
                    best[item_id] = max(value, best.get(item_id, 0))
        out.append(best)
    return out


ITEMS = [(10, prose(70, 30)), (11, prose(71, 14)), (12, prose(72, 59)), (13, None), (14, ""), (15, "lone rare quip"), (16, prose(70, 30)), (17, "..")]


def leaks():
    rng = random.Random(9)
    texts = [None, "", "a b", "so lone Rare, quip here", prose(70, 30), prose(70, 28), prose(71, 14) + " " + prose(72, 59)]
    for _, item in ITEMS[:3]:
        for changes in range(4):
            own = item.upper().split()
            for _ in range(changes):
                own[rng.choice([0, 1, len(own) - 1, rng.randrange(len(own))])] = "swapped"
            texts.append(f"{prose(5, 40)}, {' - '.join(own)}. {prose(6, 35)}")
        texts.append(" ".join(item.split()[2:]) + " " + prose(8, 50))
        texts.append(prose(8, 50) + " " + " ".join(item.split()[:-2]))
    return texts + [prose(90, 5000) + " " + prose(71, 14)] + [prose(200 + i, 100) for i in range(10)]


def test_spans_equal_brute_force():
    indexes = decontaminate.build([i for i, t in ITEMS if t is not None], [t for _, t in ITEMS if t is not None])
    texts = leaks()
    got = decontaminate.find(pa.array(texts), indexes).to_pylist()
    for text, own, best in zip(texts, got, brute_spans(texts, ITEMS)):
        found = {s["item_id"]: s["similarity"] for s in own}
        assert set(found) == set(best), (text, found, best)
        assert all(abs(found[i] - best[i]) < 1e-9 for i in best)
    assert decontaminate.find(pa.array([], pa.string()), indexes).to_pylist() == []
    assert decontaminate.find(pa.array(["a"]), []).to_pylist() == [[]]


@pytest.mark.parametrize("pass_bytes", [100, 1 << 24])
def test_contamination(spark, docs, no_docs, monkeypatch, pass_bytes):
    monkeypatch.setattr(decontaminate, "PASS_BYTES", pass_bytes)
    items = spark.createDataFrame([*ITEMS, (None, "x"), ITEMS[0]], "item_id bigint, text string")
    texts = leaks()
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    got = {r.doc_id: r for r in decontaminate.contamination(df, items).collect()}
    for i, best in enumerate(brute_spans(texts, ITEMS)):
        assert got[i]["items"] == sorted(best) and got[i].contaminated == bool(best)
        assert abs(got[i].similarity - max(best.values(), default=0)) < 1e-9
    clean = decontaminate.clean(df, items)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {i for i in got if not got[i].contaminated}
    assert decontaminate.contamination(docs, items.where("false")).where("contaminated").count() == 0
    assert decontaminate.contamination(no_docs, items).collect() == []


def test_pipeline(spark):
    docs = corpus_pipeline.table(spark, SMALL, "documents")
    columns, kept = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialised(stage(spark, docs, SMALL), name)
        assert docs.columns == columns and 0 < docs.count() <= kept
        kept = docs.count()
        assert stage(spark, docs.where("false"), SMALL).collect() == []
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert {r.doc_id: bytes(r.decoded).decode() for r in last} == texts
    assert near_dup.classes(docs).where("class_size > 1").count() == 0


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 11))
    assert set(queries.QUERIES) < set(entry.queries()) and "pipeline" in entry.queries()
    assert set(queries.ORACLE) < set(queries.QUERIES)


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_queries_equal_their_sql(spark, name):
    import check_oracle

    assert check_oracle.compare(queries.QUERIES[name](spark, SMALL), check_oracle.oracle(SMALL), name) is None


@pytest.mark.parametrize("run_bytes", [2000, 4 << 20])
def test_weights_are_exact_at_any_size(spark, monkeypatch, run_bytes):
    """Texts of a common passage and a tail of their own; counters that all shingles share would link them."""
    monkeypatch.setattr(near_dup, "WIDTH", 64)
    monkeypatch.setattr(near_dup, "RUN_BYTES", run_bytes)
    monkeypatch.setattr(near_dup, "BUCKET_SHINGLES", 2)
    texts = [f"{prose(31, 104)} " + " ".join(f"t{i}x{k}" for k in range(9)) for i in range(40)]
    texts += [texts[0], None, texts[1].replace("t1x8", "other"), "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    held = Counter(shingle for text in texts for shingle in bag(word_list(text)))
    n = len(texts)
    bags = [bag(word_list(t), lambda s: 1 + near_dup.SPAN * np.log(n / held[tuple(s)]) / np.log(n)) for t in texts]
    linked = {(i, j) for j in range(n) for i in range(j) if texts[i] == texts[j] or jaccard(bags[i], bags[j]) >= 0.8}
    assert linked == {(0, 40), (1, 42)}
    got = near_dup.classes(df).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == {
        **{i: (i, 1) for i in range(n)}, 0: (0, 2), 40: (0, 2), 1: (1, 2), 42: (1, 2)
    }


def test_exact_frequencies(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "RUN_BYTES", 1500)
    texts = [prose(i % 5, 30 + i) for i in range(40)] + [None, "", "..", "one"]
    runs = near_dup._runs(spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string").repartition(4))
    rows = runs.collect()
    assert len(rows) > 4 and sum(r["size"] for r in rows) == len(texts)
    held = Counter(h for t in texts for h in near_dup.weighted(pa.array([t], pa.string()))[1].tolist())
    answers = {}
    for r in near_dup.exact_frequencies(runs, 9).collect():
        answers.setdefault(r.run, []).append((r.bucket, np.frombuffer(r.frequencies, "<u4").tolist()))
    for r in rows:
        asked = np.unique(near_dup.weighted(pa.array(r.texts, pa.string()))[1]).tolist()
        assert [held[h] for h in asked] == [n for _, own in sorted(answers.get(r.run, [])) for n in own]


def test_classes_without_ids_and_with_repeated_ids(spark):
    near = prose(5, 200)
    rows = [(None, "no id at all"), (None, "another one without"), (7, prose(1, 60)), (7, prose(2, 60)), (7, prose(1, 60))]
    rows += [(8, near), (None, near.replace(near.split()[100], "changed")), (9, near), (None, None), (7, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, class_node string")
    got = near_dup.classes(df).collect()
    assert len(got) == len(rows)
    members = {}
    for r in got:
        members.setdefault(r.class_node, []).append(r)
    assert sorted(len(own) for own in members.values()) == [1, 1, 1, 2, 2, 3]
    for own in members.values():
        assert {r.class_size for r in own} == {len(own)} and min(r.node for r in own) == own[0].class_node
        assert {r.class_id for r in own} == {min((r.doc_id for r in own if r.doc_id is not None), default=None)}
    kept = near_dup.deduplicated(df)
    assert kept.columns == df.columns
    left = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert [r[1] for r in left if r[0] is None] == ["another one without", "no id at all"]
    assert sorted((r for r in left if r[0] is not None), key=repr) == sorted(
        [(7, None), (7, prose(1, 60)), (7, prose(2, 60)), (8, near)], key=repr
    )
