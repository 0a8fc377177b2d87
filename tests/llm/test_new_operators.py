"""Spelling variants, hard negatives and the quality classifier against brute force, and on odd input."""

from __future__ import annotations

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import connect, difference
from tidemark.llm import negatives, scoring, spelling
from tidemark.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

# 11: spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_words(rows, slip_every):
    totals = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
            if slip_every and h % slip_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            totals[word] += 1
    return {w: n for w, n in totals.items() if len(w) >= 6 and n >= 5}


def brute_variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[word] = best if best is not None and words[best] >= 5 * words[word] else None
    out = {}
    for word in words:
        root = word
        while form[root] is not None:
            root = form[root]
        out[word] = (words[word], len(near[word]), form[word], words.get(form[word]), root)
    return out


def found_variants(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_sorted_scan_equals_all_pairs():
    rng = random.Random(5)
    for letters in ("ab", "abcé") * 40:
        words = sorted({"".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(40)})
        pairs = list(itertools.combinations(range(len(words)), 2))
        for longest, stop in itertools.product((3, 6, 7), (1, 3, 7)):
            first = {(i, j): len(re.match("(.*).*\0\\1", f"{words[i]}\0{words[j]}")[1]) for i, j in pairs}
            wanted = {
                (i, j) for i, j in pairs
                if one_edit(words[i], words[j]) and max(len(words[i]), len(words[j])) == longest and first[i, j] < stop
            }
            assert set(spelling.near_in_sorted(words, longest, 0, stop)) == wanted


@pytest.mark.parametrize("list_words", [1, 3, 1024])
def test_variants_equal_brute_force(spark, list_words):
    rng = random.Random(list_words)
    stems = ["".join(rng.choices("abcé", k=rng.randint(6, 12))) for _ in range(25)]
    words = dict.fromkeys(stems, 400)
    for _ in range(300):
        word = list(rng.choice(list(words)))
        at = rng.randrange(len(word))
        word[at : at + rng.randint(0, 1)] = rng.choices("abcé", k=rng.randint(0, 2))[:1]
        if len(word) >= 6:
            words.setdefault("".join(word), rng.choice([5, 6, 30, 30, 150]))
    words |= {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "baaaaa": 25, "abaaaa": 25}
    df = spark.createDataFrame([(w, n, "x", 1) for w, n in words.items()], "word string, n long, list string, root int")
    assert found_variants(spelling.group_variants(df, list_words=list_words)) == brute_variants(words)


def test_words_of_odd_texts(spark, monkeypatch):
    body = "Straße ÉCOLE écoleİx naïveté×÷ Größen-Übung " * 7 + "\u0000caféteria caféteria" * 5
    rows = [(1, body), (2, None), (3, ""), (4, " \n "), (None, body), (1, body), (5, "abcdef" * 40_000), (6, "wordword " * 30_000)]
    docs = spark.createDataFrame([(k, t, "w", 7) for k, t in rows], "doc_id long, text string, word string, n int")
    for slip_every in (None, 3, 199):
        got = {r.word: r.n for r in spelling.vocabulary(docs, "doc_id", "text", slip_every=slip_every).collect()}
        assert got == brute_words(rows, slip_every)
    monkeypatch.setattr(spelling, "PIECE", 10)
    assert [w for piece in spelling.words_of("abcdefghijklmnop qr stuvwxyz0abcdefghij") for w in piece] == ["abcdefghijklmnop", "qr", "stuvwxyz", "abcdefghij"]


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    words = spelling.vocabulary(empty, "doc_id", "text")
    assert words.collect() == []
    assert spelling.group_variants(words).collect() == []


def test_variants_query(spark):
    result = QUERIES["op11_spelling_variants"](spark, SF_DIR)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert found_variants(result) == brute_variants(brute_words(rows, 199))
    assert difference(result, ORACLES["op11_spelling_variants"], connect(SF_DIR)) is None


# 12: hard negatives


def test_curve_steps_from_cell_to_cell():
    for parts, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=parts)))
        keys = negatives.hilbert_keys(cells, bits)
        order = sorted(range(len(cells)), key=lambda i: keys[i].tobytes())
        steps = np.abs(np.diff(cells[order], axis=0)).sum(axis=1)
        assert len({k.tobytes() for k in keys}) == len(cells)
        assert (steps == 1).all()


def brute_negatives(rows, positives=5, negatives=3):
    """``rows``: id, label, quantised vector. Rows of one id are told apart by their place."""
    out = Counter()
    for i, (key, label, q) in enumerate(rows):
        if key % 5:
            continue
        scored = [(-sum(a * b for a, b in zip(q, other)), k, at, theirs) for at, (k, theirs, other) in enumerate(rows) if at != i and len(other) == len(q)]
        scored.sort()
        for minus, positive, _, _ in [s for s in scored if s[3] == label][:positives]:
            fits = [s for s in scored if s[3] != label and 50 * -minus <= 100 * -s[0] <= 95 * -minus]
            for rank, (score, k, _, _) in enumerate(fits[:negatives], 1):
                out[key, positive, rank, k, -minus, -score] += 1
    return out


@pytest.mark.parametrize("block_rows, sheet", [(4, 2), (16, 1024), (1024, 1024)])
def test_negatives_equal_brute_force(spark, monkeypatch, block_rows, sheet):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(negatives, "SHEET_BLOCKS", sheet)
    monkeypatch.setattr(negatives, "CHUNK_BLOCKS", 3)
    rng = np.random.default_rng(block_rows)
    centres = rng.standard_normal((4, 6))
    rows = [(i, int(rng.integers(3)), (centres[i % 4] + 0.4 * rng.standard_normal(6)).tolist()) for i in range(120)]
    rows += [(200 + i, i % 2, [1.0, 0.5, 0.0, 0.0, 0.0, 0.0]) for i in range(20)]  # ties
    rows += [(5, rows[5][1], rows[5][2]), (7, rows[7][1], rows[7][2])]  # repeated rows
    rows += [(300 + i, i % 2, [1.0, float(i)]) for i in range(6)] + [(310, 1, []), (311, 2, []), (320, 1, [0.0] * 6)]
    rows += [(330 + i, i % 2, [1e9 + i, -1e8, 3.0]) for i in range(8)]  # scores beyond 2^53
    known = [(k, lab, [int(np.floor(256 * x)) for x in v]) for k, lab, v in rows]
    nan, inf = float("nan"), float("inf")
    odd = [
        (None, 1, [1.0] * 6), (400, None, [1.0] * 6), (405, 1, None), (410, 1, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
        (415, 1, [nan] * 6), (420, 1, [inf, 0.0, 0.0, 0.0, 0.0, 0.0]), (425, 1, [1e300] * 6),
    ]
    schema = "vec_id long, label int, embedding array<double>, id string, q int, row int, block string"
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows + odd], schema)
    got = negatives.hard_negatives(df, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 5 == 0)
    assert Counter(map(tuple, got.collect())) == brute_negatives(known)


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    """Well-parted clusters: the bounds rule out most blocks."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(3)
    centres = 3 * np.eye(8)
    rows = [(i, i % 8, (centres[i % 8] + 0.01 * rng.standard_normal(8)).tolist()) for i in range(512)]
    df = spark.createDataFrame(rows, "id long, label long, vector array<double>")
    placed = negatives.along_curve(negatives.quantised(df)).cache()
    zones = negatives.zone_maps(placed)
    anchors = placed.where("id % 50 = 0").select("row", "label", "q", "size", "chunk", F.array(F.lit(300_000)).alias("lo"), F.array(F.lit(10**9)).alias("hi"))
    wanted = negatives.may_hold(anchors, zones, same=True)
    assert zones.count() == 32
    assert anchors.count() <= wanted.count() <= 6 * anchors.count()
    assert negatives.may_hold(anchors, zones, same=False).isEmpty()


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.hard_negatives(empty, "vec_id", "embedding", F.col("label"), F.col("vec_id") % 50 == 0).collect() == []


def test_negatives_query_equals_sql(spark):
    assert difference(QUERIES["op12_hard_negatives"](spark, SF_DIR), ORACLES["op12_hard_negatives"], connect(SF_DIR)) is None


# 13: quality by compression


def test_scores_recomputed_and_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in QUERIES["op13_quality_classifier"](spark, sf_dir).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    model = scoring.learn_quality(docs, labels, "doc_id", "text", "quality", left_out=scoring.held_out("doc_id"))
    for key, text in list(texts.items())[:200]:
        import zstandard

        sizes = []
        for content in (model.good, model.bad):
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            squeeze = zstandard.ZstdCompressor(level=9, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)
            raw = text.encode()
            sizes.append(sum(len(squeeze.compress(raw[i : i + 2000])) for i in range(0, len(raw), 2000)))
        assert got[key].difference == pytest.approx((sizes[1] - sizes[0]) / max(1, len(raw)))
        assert got[key].score == pytest.approx(1 / (1 + np.exp(-model.offset - model.slope * got[key].difference)))
        assert got[key].predicted == (got[key].score >= 0.5)
        assert got[key].held_out == (zlib.crc32(str(key).encode()) % 3 == 1)
    held = [(got[r.doc_id].score, r.quality) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert np.mean([(s >= 0.5) == q for s, q in held]) > 0.93
    good, bad = ([s for s, q in held if q == k] for k in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_model_reads_no_row_that_is_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    held = scoring.held_out("doc_id")
    learn = lambda d, lab: scoring.learn_quality(d, lab, "doc_id", "text", "quality", left_out=held)
    spoiled = docs.withColumn("text", F.when(held, F.lit("x")).otherwise(F.col("text")))
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert learn(docs, labels) == learn(spoiled, turned)


def test_quality_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (None, "one two"), (3, "word " * 50_000), (3, "word " * 50_000), (4, "\u0000\U0001f600")]
    docs = spark.createDataFrame([(k, t, 0.5, "x") for k, t in rows], "doc_id long, text string, score double, key string")
    model = scoring.Quality(b"good words here " * 9, b"bad, bad &&& " * 9, 50.0, 1.0)
    got = scoring.score_quality(docs, "doc_id", "text", model).collect()
    assert sorted((r.doc_id or 0) for r in got) == [0, 1, 2, 3, 3, 4]
    assert {r.score for r in got if r.doc_id in (1, 2)} == {1 / (1 + np.exp(-1.0))}
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    assert scoring.score_quality(docs.limit(0), "doc_id", "text", model).collect() == []


@pytest.mark.parametrize(
    "labels, share",
    [([], 0.5), ([(1, 1), (1, 0), (None, 1), (2, None), (3, 7)], 0.5), ([(1, 1), (2, 1), (3, 1)], 3.5 / 4)],
)
def test_nothing_to_learn_from(spark, labels, share):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, "")], "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    model = scoring.learn_quality(docs, known, "doc_id", "text", "quality")
    assert [r.score for r in scoring.score_quality(docs, "doc_id", "text", model).collect()] == pytest.approx([share] * 3)
