"""Registered queries of the package: SQL where there is some, brute force or invariants elsewhere."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from oracle import compare, connect

from delaylens.llm import quality_classifier, textbytes
from delaylens.llm.queries import CHECKS, QUERIES

from conftest import SMALL

WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.fixture(scope="module")
def documents(con):
    return con.sql("SELECT doc_id, text, source FROM documents").fetchall()


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], CHECKS[name], SMALL) is None


def test_registration():
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in QUERIES


def link_components(texts, n, percent):
    """Components by comparing all pairs of distinct sets that share a member."""
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = {}
    for d, t in texts:
        w = re.findall(WORD, (t or "").translate(low))
        sets[d] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    shared = collections.Counter()
    holders = collections.defaultdict(list)
    for d, s in sets.items():
        for g in s:
            for other in holders[g]:
                shared[other, d] += 1
            holders[g].append(d)
    for (a, b), k in shared.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_jaccard_components_equal_brute_force(spark, documents):
    expected = link_components([(d, t) for d, t, _ in documents], 4, 85)
    rows = QUERIES["op6_jaccard_join"](spark, SMALL).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected and len(rows) == len(documents)


def removed_bytes(texts, length):
    """Per text which bytes a string of ``length`` covers that starts elsewhere too."""
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    marks = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = True
        marks.append(gone)
    return marks


def test_suffix_dedup_equals_brute_force(spark, documents):
    texts = [(t or "").encode() for _, t, _ in documents]
    rows = {r.doc_id: r for r in QUERIES["op7_suffix_dedup"](spark, SMALL).collect()}
    for (d, _, _), t, gone in zip(documents, texts, removed_bytes(texts, 400)):
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        r = rows[d]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(t), int(gone.sum()), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_resharding_law(spark, documents):
    rows = QUERIES["op8_reshard"](spark, SMALL).toPandas()
    texts = {d: (t or "").encode() for d, t, _ in documents}
    assert len(rows) == len(documents) and set(rows.law) == {"bytes"}
    for r in rows.itertuples():
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]))
    load = rows.groupby("shard")["size"].sum()
    assert len(load) == 8 and load.max() - load.min() <= 0.02 * load.mean()
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    assert rows.groupby("text_crc32").shard.nunique().max() == 1  # equal texts stay together here
    # no plan moves fewer bytes than what the old shards hold above their new capacity
    old = rows.groupby("old_shard")["size"].sum()
    least = sum(max(0, n - rows["size"].sum() / 8) for n in old)
    moved = rows[rows.old_shard != rows.shard]["size"].sum()
    assert moved <= least + 0.05 * rows["size"].sum()


def test_nearest_recall(spark, con):
    rows = con.sql("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = QUERIES["op9_nearest"](spark, SMALL).toPandas()
    hits = total = 0
    for q in ids[ids % 20 == 0]:
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        own = found[found.query_id == q].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 21))
        assert np.allclose(own.score, [score[ids == v][0] for v in own.vec_id], atol=1e-12)
        assert (np.diff(own.score) <= 0).all()
        hits, total = hits + len(set(best) & set(own.vec_id)), total + 20
    assert hits >= 0.9 * total


def test_classifier_on_held_out_rows(spark):
    folder = SMALL.replace("0.001", "0.01")
    rows = QUERIES["op10_quality_classifier"](spark, folder).toPandas().set_index("doc_id")
    labels = connect(folder).sql("SELECT doc_id, quality FROM labels").df().set_index("doc_id").quality
    assert ((rows.score >= 0) & (rows.score <= 1)).all() and (rows.predicted == (rows.score >= 0.3)).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in rows.held_out.items())
    own = rows.join(labels, how="inner")
    own = own[own.held_out]
    assert (own.predicted == own.quality).mean() >= 0.95


def test_classifier_updates_against_plain_ones():
    """Two passes over texts of one part, feature by feature and coordinate by coordinate in plain Python."""
    texts = ["Good words, read well.", "x x x ### 12", "", "Good words again and again", "12 ### x", "  spaced\tout\nwords "]
    labels = [1, 0, 1, 1, 0, 1]

    def grams(text):
        """Names of the features: words and pairs, then shapes, pairs and triples of shapes."""
        words = re.findall(r"[^ \t\n\x0b\x0c\r]+", text)
        kind = lambda c: ("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c)
        shapes = []
        for i, w in enumerate(words):
            shapes.append((kind(w[0]), kind(w[-1]), kind(w[1] if len(w) > 1 else w[-1]),
                           min(6, math.ceil(math.log2(len(w) + 1))), i > 0 and words[i - 1] == w))
        names = []
        for tag, base, n in (("w", words, 1), ("w", words, 2), ("s", shapes, 1), ("s", shapes, 2), ("s", shapes, 3)):
            names += [(tag, n, tuple(base[i - n + 1:i + 1]) if i >= n - 1 else "start") for i in range(len(words))]
        return names, max(1, len(words))

    z, n = collections.defaultdict(float), collections.defaultdict(float)
    q = quality_classifier

    def weight(f):
        return -z[f] / ((q.BETA + math.sqrt(n[f])) / q.ALPHA + q.L2)

    def margin(text):
        names, size = grams(text)
        return sum(weight(f) for f in names) / size + weight("bias")

    own_z, own_n = np.zeros((1 << q.BITS) + 1), np.zeros((1 << q.BITS) + 1)
    for _ in range(2):
        for text, y in zip(texts, labels):
            names, size = grams(text)
            x = {f: c / size for f, c in collections.Counter(names).items()} | {"bias": 1.0}
            error = 1 / (1 + math.exp(-sum(weight(f) * v for f, v in x.items()))) - y
            for f, v in x.items():
                g = error * v
                z[f], n[f] = z[f] + g - (math.sqrt(n[f] + g * g) - math.sqrt(n[f])) / q.ALPHA * weight(f), n[f] + g * g
        q.follow(pa.array(texts), np.array(labels), own_z, own_n)
    weights = q.leader(own_z, own_n)
    for lo, hi, data, offsets in textbytes.chunks(pa.array(texts)):
        assert np.allclose(q.margins(weights, data, offsets), [margin(t) for t in texts[lo:hi]], atol=1e-9)
    # as many coordinates moved as there are different features: hashes keep them apart here
    assert np.count_nonzero(own_n) == len([f for f in n if n[f] > 0])


def test_piece_sampling_round_trip(spark, documents):
    rows = QUERIES["op1_piece_sampling"](spark, SMALL).toPandas()
    assert rows.decoded.all() and set(rows.doc_id) == {d for d, _, _ in documents}
    assert rows.groupby("doc_id").ids_crc32.nunique().equals(rows.groupby("doc_id").size())
    wide = rows.pivot(index="doc_id", columns="sample", values="perturbed").dropna()
    assert (wide[0] > wide[1]).all() and (rows.log_prob <= 1e-9).all() and (rows.log_inclusion <= 0).all()


def test_pipeline_stages(spark, con):
    import corpus_pipeline
    from delaylens.llm.common import written

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, SMALL), "stage")
        kept[name] = (before, docs)
    good = {r[0] for r in con.sql(f"SELECT doc_id FROM ({CHECKS['op5_quality_rules']}) WHERE kept").fetchall()}
    assert {r.doc_id for r in kept["quality_rules"][1].collect()} == good
    before, after = kept["jaccard_join"]
    expected = link_components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, (n, c) in expected.items() if c == d or n == 0)
    before, after = kept["line_dedup"]
    counts = collections.Counter(k for r in before.collect() for k in {
        x.strip(" \t\n\x0b\x0c\r").lower() for x in r.text.split("\n")} if len(k) >= 40)
    left = collections.Counter(k for r in after.collect() for k in {
        x.strip(" \t\n\x0b\x0c\r").lower() for x in (r.text or "").split("\n")} if len(k) >= 40)
    assert before.count() == after.count() and all(left[k] == (1 if n >= 5 else n) for k, n in counts.items())
    before, after = kept["mix_sources"]
    words = lambda df: sum(len(re.findall(WORD, r.text or "")) for r in df.collect())
    assert math.isclose(words(after), 1.5 * words(before), rel_tol=0.1)
    assert all(kept[n][1].columns == names for n, _ in corpus_pipeline.STAGES[:-1])
    assert docs.count() == 2 * after.count() and docs.where("not decoded").isEmpty()
