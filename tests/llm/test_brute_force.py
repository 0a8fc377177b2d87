"""Queries without SQL, row by row against plain Python; the pipeline as the chain of these."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tests.llm.test_operators import SF_DIR, brute_lines, brute_print, check_packing, words
from tidemark.llm import language, mixing, pii, vectors
from tidemark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def corpus(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]


def spark_hash(*values):
    """xxhash64 of several columns as an unsigned number: each value seeded by the one before, NULLs passed over."""
    seed = 42
    for value in values:
        if value is None:
            continue
        raw = value.encode() if isinstance(value, str) else (value & (1 << 64) - 1).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed


# 2: personal data


def test_forest_admits_and_rejects_by_context(spark):
    """Numbers that the rules accept after one word and refuse after another: the forest goes by the word."""
    rows = []
    for i in range(200):
        rows.append((i, f"tel +49 30 {1000000 + i * 37} end"))  # valid: 11 digits
        rows.append((1000 + i, f"ref +49 30 {i:03d} end"))  # written alike, but seven digits
    rows.append((5000, "call (030) 123 456 78 soon"))
    rows.append((5001, "order (030) 123 456 78 soon"))
    rows.append((5002, "tel (030) 12 34 soon"))  # eight digits: out of the rule's range, admitted by context
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_pii(frame, "doc_id", "text").collect()}
    assert [(s.start, s.end) for s in found[5000].added] == [(5, 21)]
    assert found[5001].added == []
    assert [(s.kind, s.in_range) for s in found[5002].added] == [(3, False)]
    assert all(len(found[i].base) == 1 and not found[1000 + i].base for i in range(200))


def brute_forest(forest, row):
    total = forest.bias
    for node in forest.trees:
        while isinstance(node, tuple):
            f, at, low, high = node
            node = low if row[pii.FEATURES[f]] <= at else high
        total += node
    return total


def test_added_spans_row_by_row(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    spans = pii.candidates(docs, "doc_id", "text").cache()
    forest = pii.train(spans)
    got = {r.doc_id: sorted((s.start, s.kind, s.end) for s in r.added) for r in pii.find_pii(docs, "doc_id", "text").collect()}
    for row in spans.collect():
        base = [s for s in row.spans if s.base and s.in_range]
        wanted = [
            (s.start, s.kind, s.end) for s in row.spans
            if not s.base and brute_forest(forest, s) >= forest.thresholds[s.kind]
            and not any(b.start < s.end and s.start < b.end for b in base)
        ]
        assert got[row.key] == sorted(wanted)


def test_too_few_spans_give_no_threshold(spark):
    rows = [(i, f"tel +49 30 {1000000 + i} end, call (030) 123 456 78") for i in range(30)]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect()
    assert all(r.added == [] and len(r.base) == 1 for r in found)


# 7: mixing


def brute_topic(text, model):
    """The centre nearest to the sum of the words' directions."""
    known = dict(zip(model.hashes.tolist(), model.weights.tolist()))
    total = np.zeros(64)
    for word, n in Counter((text or "").encode().lower().split()).items():
        h = xxhash.xxh64_intdigest(word)
        signs = np.array([1.0 if h >> (63 - bit) & 1 else -1.0 for bit in range(64)])
        total += known.get(h, model.rarest) * math.log(1 + n) * signs
    if not total.any():
        return "none"
    return f"topic{int(np.argmax(model.centres @ total))}"


def brute_mix(rows, model):
    """``{doc_id: (topic, tokens, probability, drawn)}`` for tempered shares and a budget of 0.7."""
    cell = {r["doc_id"]: (r["source"], r["lang"], brute_topic(r["text"], model)) for r in rows}
    size = {r["doc_id"]: len(words(r["text"])) for r in rows}
    weight = Counter()
    for r in rows:
        weight[cell[r["doc_id"]]] += size[r["doc_id"]]
    total = sum(weight.values())
    live = {c: w for c, w in weight.items() if w}
    targets = []
    for d in range(3):
        sums = Counter()
        for c, w in live.items():
            sums[c[d]] += w
        powers = {v: w**0.7 for v, w in sums.items()}
        targets.append({v: p / sum(powers.values()) for v, p in powers.items()})
    mass = {c: float(w) for c, w in live.items()}
    for _ in range(400):
        for d in range(3):
            sums = Counter()
            for c, m in mass.items():
                sums[c[d]] += m
            whole = sum(sums.values())
            mass = {c: m * targets[d][c[d]] * whole / sums[c[d]] for c, m in mass.items()}
    factor = {c: mass[c] / live[c] for c in live}
    low, high = 0.0, 1e9
    for _ in range(200):  # the scale at which the expected tokens meet the budget
        scale = (low + high) / 2
        low, high = (scale, high) if sum(w * min(1, scale * factor[c]) for c, w in live.items()) < 0.7 * total else (low, scale)
    out = {}
    for r in rows:
        p = min(1.0, scale * factor.get(cell[r["doc_id"]], 0.0))
        uniform = (spark_hash("mix", str(r["doc_id"])) >> 11) / (1 << 53)
        out[r["doc_id"]] = (cell[r["doc_id"]][2], size[r["doc_id"]], p, uniform < p)
    return out


def test_mixing_row_by_row(spark, corpus):
    model = mixing.learn_topics(spark.read.parquet(f"{SF_DIR}/documents.parquet"), "doc_id", "text")
    wanted = brute_mix(corpus, model)
    got = {r.doc_id: r for r in QUERIES["op7_mixing"](spark, SF_DIR).collect()}
    assert got.keys() == wanted.keys()
    for key, (topic, tokens, p, drawn) in wanted.items():
        assert (got[key].topic, got[key].n_tokens, got[key].drawn) == (topic, tokens, drawn)
        assert got[key].probability == pytest.approx(p, rel=1e-4)
    assert 0 < sum(w[3] for w in wanted.values()) < len(wanted)


def test_topics_part_texts_by_their_words(spark):
    """Texts over three vocabularies: each gets a topic or more of its own, whatever the order of its words."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"v{i % 3}w{k}" for k in rng.integers(0, 30, 60))) for i in range(300)] + [(900, None), (901, " \n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = mixing.with_topic(frame, "text", mixing.learn_topics(frame, "doc_id", "text", 3)).collect()
    by = {k: {r.form.topic for r in found if r.doc_id < 900 and r.doc_id % 3 == k} for k in range(3)}
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == 3
    assert [tuple(r.form) for r in found if r.doc_id >= 900] == [("none", 0)] * 2


# 8: sharding


def brute_shard(key, shards):
    at = onward = 0
    while onward < shards:
        at = onward
        drawn = (spark_hash(key, "jump", at) >> 11) + 1
        onward = math.floor((at + 1) * float(1 << 53) / drawn)
    return at


def test_jumps_row_by_row(spark, corpus):
    got = {r.doc_id: (r.shard, r.grown_shard) for r in QUERIES["op8_sharding"](spark, SF_DIR).collect()}
    assert got == {r["doc_id"]: (brute_shard(r["doc_id"], 24), brute_shard(r["doc_id"], 25)) for r in corpus}


# 10: language ID


def brute_language(text, model):
    """Language and whether it is clear: sizes under each dictionary, chunk by chunk."""
    import regex
    import zstandard

    plain = regex.sub(r"[^\p{L}\p{M}]+", " ", (text or "").lower()).strip()
    if not any(c.isalpha() for c in plain):
        return "und", False
    raw = plain.encode()
    for level in (3, 12):
        sizes = []
        for content in model.dictionaries.values():
            data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            squeeze = zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(squeeze.compress(raw[i : i + 1000])) for i in range(0, len(raw), 1000)))
        order = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))
        margin = 1 - sizes[order[0]] / sizes[order[1]]
        if margin >= 0.05:
            break
    return list(model.dictionaries)[order[0]], margin >= 0.004


def learned(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return language.learn(docs.where(~language.held_out("doc_id")), "doc_id", "text", "lang")


def test_sizes_row_by_row(spark, corpus):
    model = learned(spark)
    got = {r.doc_id: (r.lang_pred, r.accepted) for r in QUERIES["op10_language_id"](spark, SF_DIR).collect()}
    assert got == {r["doc_id"]: brute_language(r["text"], model) for r in corpus}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in QUERIES["op10_language_id"](spark, SF_DIR).collect())


# 9: links


@pytest.mark.parametrize("cosine", [0.9005, 0.92, 0.95])
def test_recall_of_planted_pairs(spark, cosine):
    """Pairs at a given cosine, far from all others: what is found of them."""
    rng = np.random.default_rng(int(cosine * 1e4))
    a = rng.standard_normal((1000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((1000, 64))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    rows = [*a, *(cosine * a + math.sqrt(1 - cosine**2) * b)]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vectors.vector_links(frame, "vec_id", "embedding").collect()}
    found = sum(got[1000 + i].component == i for i in range(1000))
    assert found >= 965  # of 1000; planned: 980 at the threshold itself
    assert all(r.n_links <= 1 for r in got.values())


@pytest.mark.parametrize("spread", [0.01, 0.05, 0.12])
def test_links_of_dense_groups(spark, spread):
    """Groups of near copies, tight ones and such that reach beyond the certain radius, with copies in them."""
    rng = np.random.default_rng(int(spread * 100))
    centres = rng.standard_normal((4, 32))
    rows = [c + spread * rng.standard_normal(32) * np.sqrt(c @ c / 32) * (1 + i % 3) for c in centres for i in range(60)]
    rows += [rows[0], rows[0], 3 * rows[61], *rng.standard_normal((30, 32))]
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component) for r in vectors.vector_links(frame, "vec_id", "embedding", recall=0.999999).collect()}
    x = np.array(rows) / np.linalg.norm(rows, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    label = np.arange(len(x))
    for _ in range(20):
        label = np.array([label[np.flatnonzero(r)].min() for r in near])
    assert got == {i: (int(near[i].sum()) - 1, int(label[i])) for i in range(len(x))}


# the pipeline


def test_pipeline_equals_the_chain_of_brute_force(spark, corpus, path):
    short = sorted((r for r in corpus if len(r["text"]) < 6000), key=lambda r: r["doc_id"])[:90]
    copies = [dict(r, doc_id=10_000 + r["doc_id"]) for r in short[:7]] + [dict(short[8], doc_id=20_000, text=short[8]["text"].replace("\n", " \n"))]
    rows = [*short, *copies, dict(short[0], doc_id=30_000, text=None), dict(short[0], doc_id=30_001, text="12 34 !!")]
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    folder = path()
    docs = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)
    docs.write.parquet(f"{folder}/documents.parquet")

    model = language.learn(docs.where(~language.held_out("doc_id")), "doc_id", "text", "lang")
    left = [r for r in rows if brute_language(r["text"], model)[1]]
    assert {30_000, 30_001}.isdisjoint(r["doc_id"] for r in left)

    texts = brute_lines([(r["doc_id"], r["text"]) for r in left])
    cleaned = [dict(r, text=texts[r["doc_id"], r["text"]]) for r in left]
    cleaned = [r for r, old in zip(cleaned, left) if words(r["text"]) or r["text"] == old["text"]]

    prints = {r["doc_id"]: brute_print(r["text"]) for r in cleaned}
    label = {k: k for k in prints}
    for _ in prints:
        label = {a: min(label[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 2) for a in prints}
    alone = [r for r in cleaned if label[r["doc_id"]] == r["doc_id"]]
    assert len(alone) < len(rows) - 2

    found = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in alone], schema)
    drawn = brute_mix(alone, mixing.learn_topics(found, "doc_id", "text"))
    last = [r for r in alone if drawn[r["doc_id"]][3]]

    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in pieces} == {r["doc_id"] for r in last}
    ids = dict(zip([r["doc_id"] for r in last], check_packing(pieces, [r["text"] for r in last]), strict=True))
    for r in pieces:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert (len(part), zlib.crc32(part.tobytes()), r.doc_tokens) == (r.length, r.ids_crc32, len(ids[r.doc_id]))


def all_texts_model(texts):
    """``{hash: weight}`` of the words in more than one of 1000 texts, counted over all of them whole, and the other words' weight."""
    read = [set((t or "").encode().lower().split()) for t in texts]
    n, seen = sum(map(bool, read)), Counter(w for r in read for w in r)
    rare = max(1, n // 1000)
    return {xxhash.xxh64_intdigest(w): math.log((1 + n) / (1 + c)) for w, c in seen.items() if c > rare}, math.log((1 + n) / (1 + rare))


def test_words_of_all_texts_are_weighed(spark):
    """Far more texts than any sample held, and words that stand only at the end of long ones."""
    texts = [f"all t{i % 7} once{i} " + ("pad " * 600 + "late" if i % 3 == 0 else "x") for i in range(9000)] + [None, " \n"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    model = mixing.learn_topics(frame, "doc_id", "text")
    weights, rarest = all_texts_model(texts)
    assert dict(zip(model.hashes.tolist(), model.weights.tolist())) == pytest.approx(weights)
    assert model.rarest == pytest.approx(rarest)
    assert xxhash.xxh64_intdigest(b"late") in weights


def test_centres_are_fitted_to_all_texts(spark):
    """Each centre is the mean direction of the different vectors nearest to it, however the rows are partitioned."""
    rng = np.random.default_rng(4)
    pick = rng.integers(0, 20, (6000, 60))
    texts = [" ".join(f"v{i % 3}w{k}" for k in row) for i, row in enumerate(pick)]
    frame = spark.createDataFrame(list(enumerate([*texts, *texts[:500]])), "doc_id long, text string")
    model = mixing.learn_topics(frame, "doc_id", "text", 3)
    again = mixing.learn_topics(frame.repartition(3, "text"), "doc_id", "text", 3)
    assert np.array_equal(model.centres, again.centres) and len(model.centres) == 3
    vectors = {mixing.summed_up(*mixing.words_and_counts(t.encode())[:2], model.hashes, model.weights, model.rarest).tobytes() for t in texts}
    x = np.array([np.frombuffer(v) for v in vectors])
    nearest = (x @ model.centres.T).argmax(axis=1)
    for k, centre in enumerate(model.centres):
        mean = x[nearest == k].sum(axis=0)
        assert mean @ centre / np.linalg.norm(mean) > 1 - 1e-6


def test_pipeline_mixes_by_whole_texts(spark):
    """Texts that differ after 2500 characters only: the topic of few texts is lifted to probability 1."""
    ends = ("common things there", "seldom words here")
    rows = [(i, "same " * 500 + ends[i % 10 == 0], "en", "web") for i in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    drawn = {r.doc_id for r in corpus_pipeline.mixing(spark, frame, SF_DIR).collect()}
    assert set(range(0, 1000, 10)) <= drawn and 600 < len(drawn) < 800
