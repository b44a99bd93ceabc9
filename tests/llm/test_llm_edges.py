"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names; forced large-data paths."""

import hashlib
import math
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from delaylens.llm import (bloom, jaccard_join, line_dedup, mixing, nearest, piece_sampling, quality_classifier,
                           quality_rules, resharding, suffix_dedup, warc)
from delaylens.llm.components import components
from delaylens.llm.textbytes import chunks
from delaylens.sources import stores

from test_llm_checks import link_components, removed_bytes

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n int, size string, h string, "
          "doc string, block int, rank int, key string, score string, s int, p int, shard string, members string")
LONG = "word and " * 3000 + "x" * 5000
LINE = "A line that many of these documents have in common."


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["", None, LONG, LONG, " \t\n\r", f"{LINE}\none", f"  {LINE.upper()}\t\ntwo\n{LINE}", f"{LINE}\n{LINE}",
             f"three\n{LINE}", f"{LINE}", "é ß \U0001f600 の", "a b c", "a b c", "A B c"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, LONG), (None, LONG), (None, "only here and without a key")]
    more = [("en", None if i is None or i % 3 == 0 else f"s{i % 3}", 1, 7, "a", "b", "c", 1, 2, "k", "v", 1, 2, "x", "m")
            for i, _ in rows]
    return spark.createDataFrame([(*a, *b) for a, b in zip(rows, more)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_quality_rules_on_odd_rows(docs, empty):
    rows = quality_rules.judged(docs)
    assert rows.count() == docs.count() and quality_rules.judged(empty).isEmpty()
    by = {(r.doc_id, r.text): r for r in rows.collect()}
    assert by[1, None]["__n_words"] == 0 and by[1, None]["__base_failed"]
    assert by[2, LONG]["__n_words"] == 6001 and by[2, LONG]["__n_repeat_words"] == 6000 and not by[2, LONG]["__kept"]
    assert quality_rules.keep_good(docs).columns == docs.columns


def test_a_rule_table_of_ones_own(spark):
    words = " ".join(f"w{i} the" for i in range(40))
    rows = spark.createDataFrame([(1, words), (2, words + " ###" * 30)], "doc_id long, text string")
    rule = (quality_rules.Rule("signs", "symbol_ratio", None, 0.2),)
    verdict = {r.doc_id: r["__failed_rules"] for r in quality_rules.judged(rows, rules=rule).collect()}
    assert verdict == {1: [], 2: ["signs"]}


def test_mixing_on_odd_rows(docs, empty):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count() and mixing.mix(empty).isEmpty()
    assert all(0 <= r.mix_times <= 2 for r in rows)
    sizes = {(r.doc_id, r.text): r.mix_size for r in rows}
    assert sizes[1, None] == 0 and sizes[2, LONG] == 6001
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (str(r.doc_id), str(r.text), r.mix_times, r.mix_target)
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mixing.mixed(docs).columns == docs.columns


@pytest.mark.parametrize("sizes", [[5, 5, 5], [1, 1000, 10, 0], [100, 1, 1, 1, 1, 1, 7], [0, 0], [3]])
def test_targets_equal_repeated_resharing(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    weights, capped = [mixing.WEIGHTS[i % 3] for i in range(len(sizes))], set()
    while True:
        left = 1.5 * sum(sizes) - sum(2 * sizes[i] for i in capped)
        open_w = sum(w for i, w in enumerate(weights) if i not in capped)
        target = [2 * s if i in capped else left * w / open_w for i, (s, w) in enumerate(zip(sizes, weights))]
        new = {i for i, t in enumerate(target) if i not in capped and t > 2 * sizes[i]}
        if not new:
            break
        capped |= new
    assert all(math.isclose(got[n], t, abs_tol=1e-9) for n, t in zip(names, target))


@pytest.mark.parametrize("sent_keys", [0, 1000])
def test_line_dedup_on_odd_rows(docs, empty, sent_keys):
    rows = line_dedup.without_repeats(docs, sent_keys=sent_keys)
    assert rows.columns == [*docs.columns, "ld_lines", "ld_dropped"]
    by = {(r.doc_id, r.ld_lines, r.ld_dropped): r.text for r in rows.collect()}
    assert rows.count() == docs.count()
    assert by[1, 1, 0] is None and by[0, 1, 0] == "" and by[2, 1, 0] == LONG
    assert by[5, 2, 1] == "one" and by[6, 3, 2] == "two" and by[7, 2, 2] == "" and by[8, 2, 1] == "three"
    assert by[9, 1, 0] == LINE  # the largest key that holds it
    if sent_keys:
        assert line_dedup.without_repeats(empty).isEmpty()


def test_bloom_filter_finds_all_repeats_even_when_full(spark):
    values = np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = spark.createDataFrame([(int(v),) for v in np.concatenate([values, values[:50]]).view(np.int64)], "v long").repartition(5)
    hashes = lambda batch: iter([batch.column(0).to_numpy().view(np.uint64)])
    found = bloom.build(rows, hashes, 5000).value
    assert found.hits(values[:50]).all() and found.hits(values[50:]).mean() < 0.01
    once = bloom.build(rows, hashes, 5000, at_least=1).value
    assert once.hits(values).all()
    full = bloom.build(rows, hashes, 5000, most_bits=1 << 16).value
    assert full.hits(values[:50]).all()


def test_jaccard_on_odd_rows(docs, empty):
    rows, _ = jaccard_join.join(docs)
    found = {(r.doc, r.size): r.component for r in rows.collect()}
    assert found[0, 0] == 0 and found[1, 0] == 1 and found[4, 0] == 4
    assert found[2, 3] == 2 and found[3, 3] == 2 and found[None, 3] == 2  # a copy without a key
    assert found[None, 2] is None
    assert found[12, 1] == 11 and found[13, 1] == 11
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IN (2, 3, 11, 12, 13)").collect()) == [2, 2, 11]
    rows, links = jaccard_join.join(empty)
    assert rows.isEmpty() and links.isEmpty()


def test_one_of_each_judges_rows_not_keys(docs, spark):
    kept = sorted(((r.doc_id, r.text) for r in jaccard_join.one_of_each(docs).collect()), key=str)
    gone = [(3, LONG), (None, LONG), (8, f"three\n{LINE}"), (9, LINE), (12, "a b c"), (13, "A B c")]  # 8 and 9 are near 5
    assert kept == sorted(((r.doc_id, r.text) for r in docs.collect() if (r.doc_id, r.text) not in gone), key=str)
    words = [f"w{i}" for i in range(100)]
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(100)) for x in "abcd")
    near_c, near_d = c + " more", d + " more"
    rows = [(5, a), (9, a), (3, b), (5, b), (7, c), (7, near_c), (None, c), (None, " ".join(words)), (None, ""),
            (1, d), (20, near_d), (20, "another text of this key"), (3, near_d + " and")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [(r.doc_id, r.text) for r in jaccard_join.one_of_each(table).collect()]
    assert len([k for k in kept if k in ((7, c), (7, near_c))]) == 1
    expected = [(5, a), (3, b), (None, " ".join(words)), (None, ""), (1, d), (20, "another text of this key")]
    assert sorted((k for k in kept if k[0] != 7), key=str) == sorted(expected, key=str)
    found = {(r.doc, r.size): r.component for r in jaccard_join.join(table)[0].where("doc = 20 OR doc = 9").collect()}
    assert found == {(20, 97): 1, (20, 1): 20, (9, 96): 5}


def test_jaccard_splits_large_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for d in range(60):
        own = list(base)
        for i in rng.integers(0, 120, rng.integers(0, 9)):
            own[i] = f"x{d}_{i}"
        texts.append((d, " ".join(own[:rng.integers(100, 121)])))
    rows = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    expected = link_components(texts, 5, 80)
    for block_sets in (256, 8):
        monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block_sets)
        got = {r.doc: (r.size, r.component) for r in jaccard_join.join(rows)[0].collect()}
        assert got == expected
    assert len({c for _, c in expected.values()}) < 60


def test_tree_never_rules_out_a_link():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(80):
        base = rng.integers(0, 1 << 63, rng.integers(2, 400), dtype=np.uint64)
        sets += [np.unique(base), np.unique(np.append(base[: int(len(base) * 0.95)], rng.integers(0, 1 << 63, 2, dtype=np.uint64)))]
    pairs = set(zip(*(x.tolist() for x in jaccard_join.candidates(
        np.array([len(s) for s in sets]), [jaccard_join.bitmap(s) for s in sets], 80))))
    pairs = {tuple(sorted(p)) for p in pairs}
    links = {(i, j) for j in range(len(sets)) for i in range(j) if jaccard_join.linked(sets[i], sets[j], 80)}
    assert links and links <= pairs and len(pairs) < len(sets) ** 2 / 8


@pytest.mark.parametrize("percent, small", [(40, 31), (20, 31), (10, 20), (80, 60)])
def test_candidates_of_widths_far_apart(percent, small):
    large = np.unique(np.random.default_rng(7).integers(0, 1 << 63, small * 100 // percent, dtype=np.uint64))
    sets = [large[:small], large]
    assert jaccard_join.linked(*sets, percent)
    i, j = jaccard_join.candidates(np.array([len(s) for s in sets]), [jaccard_join.bitmap(s) for s in sets], percent)
    assert sorted((*i.tolist(), *j.tolist())) == [0, 1]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (300, 299)]
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    found = {r.node: r.component for r in rows}
    assert len(rows) == len(found)
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(100, 130)} == {100}
    assert found[300] == 299 and 200 not in found
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_suffix_dedup_on_odd_rows(docs, empty):
    rows = suffix_dedup.without_repeats(docs)
    assert rows.columns == [*docs.columns, "sx_bytes", "sx_removed", "sx_spans", "sx_kept"]
    by = {(r.doc_id, r.sx_bytes): r for r in rows.collect()}
    assert by[1, 0].sx_removed == 0 and bytes(by[1, 0].sx_kept) == b""
    assert by[2, len(LONG)].sx_removed == len(LONG) and by[2, len(LONG)].sx_spans == 1
    assert suffix_dedup.without_repeats(empty).isEmpty()


@pytest.mark.parametrize("pairwise, piece", [(12, 1 << 22), (1, 700)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, pairwise, piece):
    monkeypatch.setattr(suffix_dedup, "PAIRWISE", pairwise)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    monkeypatch.setattr(suffix_dedup, "chunks", lambda c: __import__(
        "delaylens.llm.textbytes", fromlist=["chunks"]).chunks(c, 900))
    rng = np.random.default_rng(5)
    text = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 20, n))
    shared = [text(n) for n in (64, 70, 90, 130, 300)]
    texts = [text(rng.integers(0, 200)) + shared[i % 5][: rng.integers(50, 301)] + text(rng.integers(0, 150))
             + shared[rng.integers(0, 5)] for i in range(60)] + ["ab" * 400, shared[4], shared[4]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(rows, length=64).collect()}
    raw = [t.encode() for t in texts]
    for d, (t, gone) in enumerate(zip(raw, removed_bytes(raw, 64))):
        assert bytes(got[d].sx_kept) == np.frombuffer(t, np.uint8)[~gone].tobytes(), d
        assert got[d].sx_removed == gone.sum()
        assert got[d].sx_spans == (np.diff(np.append(False, gone).astype(int)) == 1).sum()


def test_suffix_dedup_keeps_hot_passages_out_of_the_merge(spark, monkeypatch):
    rng = np.random.default_rng(9)
    text = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 20, n))
    passage, other = text(395), text(450)
    texts = [text(260) + passage + text(260) for _ in range(150)] + [passage + text(300)] * 2
    texts += [text(300) + other + text(50) for _ in range(2)]
    texts += [texts[0][100:] + text(90), text(70) + texts[1][:500], texts[2][180:620] + text(9)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    most, merged, real = 6_000, [], suffix_dedup.covered_parts
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", most, raising=False)
    monkeypatch.setattr(suffix_dedup, "HOT_TIMES", 0, raising=False)

    def watched(runs, length, ranges):
        sizes = runs.where("run IS NOT NULL").groupBy("range").agg(F.sum(F.octet_length("run")).alias("n"))
        merged.append(sizes.agg(F.max("n")).first()[0] or 0)
        return real(runs, length, ranges)

    monkeypatch.setattr(suffix_dedup, "covered_parts", watched)
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(rows).collect()}
    assert merged and 0 < max(merged) <= most, merged
    raw = [t.encode() for t in texts]
    for d, (t, gone) in enumerate(zip(raw, removed_bytes(raw, 400))):
        assert bytes(got[d].sx_kept) == np.frombuffer(t, np.uint8)[~gone].tobytes(), d
        assert got[d].sx_removed == gone.sum()


def test_loser_tree_merges_and_knows_what_is_shared():
    rng = np.random.default_rng(6)
    runs = [sorted(bytes(rng.integers(97, 100, rng.integers(1, 12))) for _ in range(n)) for n in (0, 1, 7, 30, 30)]
    coded = [suffix_dedup.encode([(k, b"", False, b"\0" * 16, 0) for k in run]) for run in runs]
    merged = list(suffix_dedup.LoserTree([suffix_dedup.decode(c) for c in coded]))
    keys = [m[1] for m in merged]
    assert keys == sorted(k for run in runs for k in run)
    assert [m[0] for m in merged[1:]] == [suffix_dedup.shared(a, b) for a, b in zip(keys, keys[1:])]


def test_resharding_on_odd_rows(docs, empty):
    for rows, n in ((docs, docs.count()), (empty, 0)):
        blocked = resharding.blocked(rows, F.pmod(F.xxhash64("text"), F.lit(3)))
        plan = resharding.plan_transfers(blocked.select(*[F.col(f"rs_{c}").alias(c) for c in ("old", "block", "part", "bytes")]), 4)
        placed = resharding.with_slots(resharding.assigned(blocked, plan), plan.rows, ["doc_id", "rs_bytes"]).collect()
        assert len(placed) == n
        for j in {r.shard for r in placed}:
            assert sorted(r.slot for r in placed if r.shard == j) == list(range(sum(r.shard == j for r in placed)))


def test_cheapest_flow_against_all_plans():
    flow = resharding.cheapest_flow([7, 2], [3.0, 3.0, 3.0], lambda i, j: [[0, 4, 1], [9, 1, 3]][i][j])
    ship = {(i, j): flow.get((i, j), 0.0) for i in range(2) for j in range(3)}
    assert [sum(ship[i, j] for j in range(3)) for i in range(2)] == [7, 2]
    cost = sum(f * [[0, 4, 1], [9, 1, 3]][i][j] for (i, j), f in ship.items())
    plans = [4 * (7 - a - c) + c + 9 * d + e + 3 * (2 - d - e) for a in range(4) for c in range(4) for d in range(3)
             for e in range(3 - d) if 0 <= 7 - a - c <= 3 - e and a + d <= 3 and c + 2 - d - e <= 3]
    assert cost == min(plans)


def test_rewrite_touches_affected_files_only(spark, tmp_path):
    texts = [(i, f"text {i} " * (30 if i % 3 == 0 else 1), i % 3) for i in range(300)]
    old = str(tmp_path / "old")
    spark.createDataFrame(texts, "doc_id long, text string, shard int").write.partitionBy("shard").parquet(old)
    rows = resharding.blocked(spark.read.parquet(old), F.col("shard"))
    rows = rows.select(*[F.col(f"rs_{c}").alias(c) for c in ("old", "block", "part", "bytes")])
    capacities = [rows.where(f"old = {k}").agg(F.sum("bytes")).first()[0] for k in range(3)]
    plan = resharding.plan_transfers(rows, 3, [capacities[0] / 2, capacities[1] + capacities[0] / 2, capacities[2]])
    assert 2 not in plan.affected()
    places = {r.shard: r.folder for r in resharding.rewrite(spark, old, str(tmp_path / "new"), plan).collect()}
    assert places == {0: str(tmp_path / "new"), 1: str(tmp_path / "new"), 2: old}
    after = [r for j, folder in places.items() for r in spark.read.parquet(folder).where(F.col("shard") == j).collect()]
    assert sorted((r.doc_id, r.text) for r in after) == sorted((i, t) for i, t, _ in texts)
    assert plan.moved_bytes <= capacities[0] / 2 + 400


def test_resharding_goes_through_files(docs, empty, monkeypatch):
    read, removed = [], []
    layout, remove = resharding.read_layout, resharding.remove_path
    monkeypatch.setattr(resharding, "read_layout", lambda spark, places, schema: read.append(places.collect()) or layout(spark, places, schema))
    monkeypatch.setattr(resharding, "remove_path", lambda spark, path: removed.append(path) or remove(spark, path))
    rows = resharding.digest(docs).collect()
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted(
        (len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs.collect())
    folders = {r.folder for r in read[0]}
    assert len(removed) == 2 and folders <= set(removed) and {r.shard for r in rows} <= {r.shard for r in read[0]}
    assert not any(stores.path_exists(docs.sparkSession, path) for path in removed)
    for j in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == j) == list(range(sum(r.shard == j for r in rows)))
    assert resharding.digest(empty).count() == 0


def test_nearest_on_odd_rows(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((400, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(400 + i, x[0].tolist()) for i in range(60)]  # a group of equal vectors
    rows += [(500, None), (501, [0.0] * 8), (502, [1.0] * 7), (503, [float("nan")] * 8), (504, [None] * 8), (None, x[1].tolist()), (3, x[3].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1)).repartition(4)
    asked = table.where("vec_id % 20 = 0")
    ids = np.array([i for i, v in rows[:460]])
    vectors = np.array([v for _, v in rows[:460]])
    for cell in (4096, 60):
        found = nearest.nearest(table, asked, cell=cell).toPandas()
        assert set(found.query_id) == set(ids[ids % 20 == 0].tolist())
        hits = 0
        for q, own in found.groupby("query_id"):
            score = vectors @ vectors[ids == q][0]
            score[ids == q] = -np.inf
            best = ids[np.lexsort((ids, -score))[:20]]
            hits += len(set(best) & set(own.vec_id))
            assert list(own.sort_values("rank")["rank"]) == list(range(1, 21)) and q not in set(own.vec_id)
        assert hits >= 0.9 * len(found)
        ties = found[found.query_id == 0].sort_values("rank").vec_id.tolist()
        assert ties == list(range(400, 420))
    assert nearest.nearest(table.limit(0), asked).isEmpty()
    few = nearest.nearest(table.where("vec_id < 3"), asked).toPandas()
    assert len(few) == 2


def test_chi_square_quantile():
    assert math.isclose(nearest.chi_square_quantile(0.95, 8), 15.507, abs_tol=1e-3)


def test_classifier_on_odd_rows(docs, empty, spark):
    labels = spark.createDataFrame([(2, 1), (3, 1), (5, 0), (6, 0), (7, None), (None, 1), (5, 1)], "doc_id long, quality int")
    weights = quality_classifier.train(docs, labels)
    rows = quality_classifier.score(docs, weights)
    assert rows.columns == [c for c in docs.columns if c != "score"] + ["score"]
    scores = {(r.doc_id, r.text): r.score for r in rows.collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[0, ""] == scores[1, None]
    assert scores[2, LONG] > scores[6, f"  {LINE.upper()}\t\ntwo\n{LINE}"]
    assert (quality_classifier.train(docs.repartition(9), labels.repartition(5)) == weights).all()
    assert quality_classifier.score(empty, weights).isEmpty()
    none = quality_classifier.train(docs, labels.limit(0))
    assert not none.any()


def test_piece_sampling_on_odd_rows(docs, empty):
    rows = piece_sampling.sampled(docs, k=3)
    by = {}
    for r in rows.collect():
        by.setdefault((r.doc_id, r.n_pieces > 3000), []).append(r)
        assert r.decoded
    assert [r.n_pieces for r in by[1, False]] == [0] and by[1, False][0].log_inclusion == 0
    assert len({tuple(r.ids) for r in by[3, True]}) == 3
    assert len({tuple(r.ids) for r in by[2, True]}) == 3 and len(by[2, True]) == 6  # a repeated row is sampled alike
    assert piece_sampling.sampled(empty).isEmpty()


def test_lattice_has_all_pieces_and_leaves_off_where_none_goes_on():
    vocabulary = piece_sampling.Vocabulary.load()
    text = b"\xffthe\xffinternational\n" + "日本\U0001f600zq".encode()
    lat = piece_sampling.lattice(np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]), vocabulary)
    found = {(int(a), int(z)) for a in range(len(text)) for z in lat.end[lat.first[a]:lat.first[a + 1]]
             if lat.piece[lat.first[a]] >= 0}
    heads = [i for i, b in enumerate(text) if b & 0xC0 != 0x80 or b == 0xFF]
    known = set(vocabulary.pieces)
    assert found == {(a, z) for a in heads for z in range(a + 1, len(text) + 1) if text[a:z] in known}
    assert (vocabulary.seen & 2).any() and (vocabulary.seen == 0).mean() > 0.9


def test_samples_follow_the_distribution():
    """All segmentations of a short text by enumeration against many keys."""
    vocabulary = piece_sampling.Vocabulary.load()
    raw = b"the onan\n\xf0\x9f\x98\x80"
    text = b"\xff" + raw.replace(b" ", b"\xff")
    log_p = dict(zip(vocabulary.pieces, vocabulary.log_p))
    number = dict(zip(vocabulary.pieces, vocabulary.ids.tolist()))

    def spell(at):
        if at == len(text):
            return [((), 0.0)]
        width = 4 if text[at] == 0xF0 else 1
        ways = [((number[p],), log_p[p], at + len(p)) for p in (text[at:z] for z in range(at + 1, len(text) + 1)) if p in log_p]
        if text[at:at + width] not in log_p:
            ways.append((tuple(vocabulary.byte_ids[list(text[at:at + width])].tolist()), width * vocabulary.byte_log_p, at + width))
        return [(ids + more, w + v) for ids, w, z in ways for more, v in spell(z)]

    found = spell(0)
    total = np.logaddexp.reduce([w for _, w in found])
    p = {ids: math.exp(w - total) for ids, w in found}
    n = 4000
    first, second, estimate = {}, {}, 0.0
    data, offsets = np.frombuffer(raw * n, np.uint8), np.arange(n + 1) * len(raw)
    for _, r, ids, log_prob, value, inclusion in piece_sampling.segmentations(
            data, offsets, piece_sampling.mix64(np.arange(n, dtype=np.uint64)), vocabulary, 2):
        ids = tuple(ids.tolist())
        assert math.isclose(math.exp(log_prob), p[ids], abs_tol=1e-9)
        (second if r else first)[ids] = (second if r else first).get(ids, 0) + 1
        estimate += p[ids] / math.exp(inclusion) / n
    for ids in sorted(p, key=p.get)[-4:]:
        assert abs(first.get(ids, 0) / n - p[ids]) < 0.03
        expected = sum(p[o] * p[ids] / (1 - p[o]) for o in p if o != ids)
        assert abs(second.get(ids, 0) / n - expected) < 0.03
    assert math.isclose(estimate, 1.0, abs_tol=0.05)  # inclusion weights are unbiased


# --- archives --------------------------------------------------------------------------------------

def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "long page " * 50_000
    rows = [(1, "http://a", "x" * 150), (2, None, "x" * 150), (3, "http://c\r\nd e", None), (4, "http://d", None), (5, "u", "short"), (6, "u", "short"),
            (7, "u", big), (None, "u", "x" * 150), (8, "é", "é" * 60), (1, "http://a", "x" * 150)]
    rows += [(100 + i, "u", f"<html>page {i} with some words in it {i * 7}</html>") for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "w")
    warc.write_archives(pages, path)
    found = warc.read_archives(spark, path).collect()
    assert len(found) == len(rows)
    by = {r.record_id: r for r in found}
    assert by["<urn:page:2>"].record_type == "revisit" and by["<urn:page:2>"].refers_to == "<urn:page:1>"
    assert by["<urn:page:null>"].record_type == "revisit" and by["<urn:page:6>"].record_type == "response"
    assert bytes(by["<urn:page:7>"].payload).decode() == big and by["<urn:page:2>"].payload_bytes == 150
    assert by["<urn:page:3>"].uri == "http://c%0D%0Ad%20e" and by["<urn:page:3>"].payload_bytes == 0
    assert by["<urn:page:8>"].payload_digest == hashlib.sha256(("é" * 60).encode()).hexdigest()
    nothing = str(tmp_path / "e")
    warc.write_archives(pages.limit(0), nothing)
    assert warc.read_archives(spark, nothing).isEmpty()


def test_archives_with_a_packed_dictionary():
    content = zstandard.train_dictionary(2000, [f"sample {i} of some text {i * i}".encode() * 3 for i in range(200)]).as_bytes()
    packer = zstandard.ZstdCompressor(3, zstandard.ZstdCompressionDict(content))
    raw = warc.record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None, False)
    for dictionary in (content, zstandard.ZstdCompressor().compress(content)):
        archive = warc.skippable(warc.DICTIONARY_MARK, dictionary) + packer.compress(raw) + warc.SEPARATOR.encode()
        assert [warc.parse(f)["payload"] for f in warc.frames(archive)] == [b"abc"]


@pytest.mark.parametrize("change, message", [
    (lambda r: r.replace(b"WARC/1.1", b"WARC/9"), "version"), (lambda r: r.replace(b"WARC-Date", b"WARC-Day"), "missing"),
    (lambda r: r + b"x", "block of"), (lambda r: r.replace(b"abc", b"abd"), "digest"),
    (lambda r: r.replace(b"Content-Type: text/html; charset=utf-8\r\n", b"Content-Type: text/htmlx; charset=utf-8\r\n"), "block of"),
    (lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: request"), "bad request")])
def test_broken_records(change, message):
    raw = warc.record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None, False)
    assert warc.parse(raw)["payload_bytes"] == 3
    with pytest.raises(warc.BrokenArchive, match=message):
        warc.parse(change(raw))


def test_broken_frames():
    frame = zstandard.ZstdCompressor(write_checksum=True).compress(b"some content " * 20)
    assert list(warc.frames(frame + frame)) == [b"some content " * 20] * 2
    for bad in (frame[:-1], frame + b"\0\0\0\0\0\0\0\0", b"P*M\x18\xff\0\0\0", frame[:-1] + bytes([frame[-1] ^ 1])):
        with pytest.raises(warc.BrokenArchive):
            list(warc.frames(bad))


def test_one_of_each_shuffles_no_texts(docs, spark):
    def found(limit: int) -> list:
        return sorted(((r.doc_id, r.text) for r in jaccard_join.one_of_each(docs, broadcast_bytes=limit).collect()), key=str)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the keys to leave out are many
    try:
        plan = jaccard_join.one_of_each(docs)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
        sent, filtered = found(1 << 20), found(0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sent == filtered and len(sent) < docs.count()
    assert (None, "only here and without a key") in sent and (1, None) in sent


def test_only_the_representative_sends_its_members(spark):
    table = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f")], "js_doc long, js_text string").coalesce(1)
    members = next(jaccard_join.shingle_sets(pa.array(["a b c d e f"]), 5))
    d1, d2 = jaccard_join.set_digest(members)

    def sent(rep: int) -> list:
        wanted = spark.createDataFrame([(d1, d2, rep)], "d1 long, d2 long, rep long")
        return [bytes(r.members) for r in jaccard_join.members_of(table, wanted, 5, 1).collect()]

    assert sent(1) == sent(2) == [members.tobytes()] and sent(3) == []


def test_the_filter_passes_every_copy(docs):
    md5 = F.unhex(F.md5("text"))
    rows = docs.withColumn("js_md5", md5)
    gone = docs.where("doc_id IN (3, 12)").select(md5.alias("js_md5"))
    flags = jaccard_join.suspected(rows, "js_md5", gone, 2, "hit").select("doc_id", "text", "hit").collect()
    assert len(flags) == docs.count()
    assert all(r.hit for r in flags if r.text in (LONG, "a b c")) and not all(r.hit for r in flags)


def test_a_chunk_of_lattices_is_small():
    letters = np.random.Generator(np.random.PCG64(3)).integers(97, 123, (160_000, 9)).astype(np.uint8)
    letters[:, 8] = 32
    texts = pa.array([letters[i:i + 400].tobytes().decode() for i in range(0, len(letters), 400)])
    vocabulary = piece_sampling.Vocabulary.load()
    tracemalloc.start()
    try:
        for lo, hi, data, offsets in chunks(texts, piece_sampling.CHUNK):
            for _ in piece_sampling.segmentations(data, offsets, np.arange(lo, hi, dtype=np.uint64), vocabulary, 2):
                pass
        assert tracemalloc.get_traced_memory()[1] < 120 << 20  # chunks of a megabyte took 238 MB
    finally:
        tracemalloc.stop()


def test_one_of_each_beside_columns_of_any_name(spark):
    rows = [(1, LONG, "a", "b", 1), (2, LONG, "c", "d", 2), (3, "something else", None, None, 3)]
    table = spark.createDataFrame(rows, "doc_id long, text string, js_gone string, js_md5 string, js__doc int")
    kept = jaccard_join.one_of_each(table)
    assert kept.columns == table.columns and {tuple(r) for r in kept.collect()} == {rows[0], rows[2]}


def test_join_deletes_what_nothing_reads(spark, docs):
    import os
    from urllib.parse import urlparse

    from delaylens.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    folder = urlparse(spark.sparkContext.getCheckpointDir()).path
    before = set(os.listdir(folder))
    out, links = jaccard_join.join(docs)
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before}
    assert left <= {"sets", "classes", "links", "found"}
    assert out.count() == docs.count() and links.count() >= 0


def test_prefix_rows_are_those_of_sets_that_meet(spark, monkeypatch):
    one, two = (" ".join(f"{w}{i}" for i in range(60)) for w in "uv")
    near = two.replace("v59", "other")
    docs = spark.createDataFrame([(1, one), (2, one), (3, two), (4, near)], "doc_id long, text string").repartition(4)
    tables, write = {}, jaccard_join.written

    def kept(df, name):
        out = write(df, name)
        if name == "prefixes":
            tables[name] = out.collect()
        return out

    monkeypatch.setattr(jaccard_join, "written", kept)
    rows, _ = jaccard_join.join(docs)
    assert {r.doc: r.component for r in rows.collect()} == {1: 1, 2: 1, 3: 3, 4: 3}
    sets = {}
    for r in tables["prefixes"]:
        sets.setdefault(r.token, []).append(r.d1)
    assert sets and all(len(s) == len(set(s)) == 2 for s in sets.values())  # copies are one set, which meets no other


@pytest.mark.parametrize("size", [1, 2, 3, 40])
def test_rows_that_meet_in_batches_of_any_size(size):
    rng = np.random.default_rng(size)
    pairs = sorted(zip(rng.integers(0, 25, 40).tolist(), rng.integers(0, 3, 40).tolist()))
    columns = [pa.array(x, pa.int64()) for x in zip(*pairs)]
    batches = [pa.RecordBatch.from_arrays([c[i:i + size] for c in columns], ["token", "d1"]) for i in range(0, 40, size)]
    got = [tuple(r.values()) for b in jaccard_join._met(iter(batches)) for r in b.to_pylist()]
    distinct = sorted(set(pairs))
    assert got == [p for p in distinct if sum(q[0] == p[0] for q in distinct) > 1]


def test_join_leaves_no_shuffle_files(spark, docs):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        it, names = manager.getAllFiles().iterator(), set()
        while it.hasNext():
            names.add(it.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = files(), spark.conf.get(key)
    jaccard_join.join(docs)
    for _ in range(40):  # Spark deletes them in the background
        if files() <= before:
            break
        time.sleep(0.5)
    assert files() <= before and spark.conf.get(key) == setting
