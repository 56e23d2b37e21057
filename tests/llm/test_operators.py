"""Each operator against brute force, on small rows with nulls, empty texts, copies and extra columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallybook.llm import (
    class_lm,
    embeddings,
    exact_dedup,
    jaccard,
    mixing,
    packing,
    quality,
    sharding,
    token_counts,
    token_files,
)
from tallybook.llm.common import collapsed, connected, word_count
from tallybook.llm.queries import tokenizer_file

LONG = " ".join(f"w{i}" for i in range(3000))
TEXTS = [None, "", " \t ", "a b c", "a  b\nc", "A b c d", "one", "ONE", LONG, LONG + " x", LONG + "  x", "é ü 😀  z", *(f"t{i} u v w" for i in range(6))]
SCHEMA = "doc_id long, text string, lang string, source string, name string, _row long, size long"


@pytest.fixture(scope="module")
def docs(spark):
    data = [(i, t, "en", None if i % 5 == 4 else f"s{i % 3}", "n", 0, 7) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_connected_finds_the_smallest_reachable(spark):
    pairs = [(5, 4), (4, 3), (9, 8), (3, 7), (7, 1), (2, None), (6, 6)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {1: 1, 3: 1, 4: 1, 5: 1, 7: 1, 8: 8, 9: 8}


def test_sharding_is_gapless_stable_and_grows_into_the_new_shard(spark, docs, none):
    again = docs.unionByName(docs.where("doc_id = 3")).unionByName(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    written = sharding.write_shards(sharding.shard(again, 4, bucket_rows=2)).toPandas()
    assert len(written) == len(TEXTS) + 2 and set(docs.columns) <= set(written.columns)
    for _, rows in written.groupby("_shard"):
        assert sorted(rows["_slot"]) == list(range(len(rows)))
    moved = spark.range(500).select(sharding.shard_of(F.col("id"), 4).alias("a"), sharding.shard_of(F.col("id"), 5).alias("b"))
    assert moved.where("a <> b and b <> 4").isEmpty() and not moved.where("b = 4").isEmpty()
    assert sharding.write_shards(sharding.shard(none, 4)).count() == 0


def test_sharding_spreads_a_hot_id_and_a_repeated_row(spark):
    ids = F.when(F.col("id") < 600, F.lit(7)).otherwise(F.col("id")).alias("doc_id")
    texts = F.when(F.col("id") < 300, F.lit("same")).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text")
    rows = spark.range(1200).select(ids, texts, F.col("id").alias("number"))
    keyed = rows.select(
        F.xxhash64("number").alias("_scatter"), sharding.shard_of(F.col("doc_id"), 4).alias("_shard"), F.lit(20).alias("_size")
    )
    counts = sharding.scatter(keyed, 4, 1 << 20, 20)[1].toPandas()
    assert counts["_rows"].max() <= 60 and counts["_rows"].sum() == 1200
    written = sharding.write_shards(sharding.shard(rows, 4, bucket_rows=20)).toPandas()
    assert sorted(written["number"]) == list(range(1200))
    assert written[written["doc_id"] == 7]["_shard"].nunique() == 1
    for _, own in written.groupby("_shard"):
        assert sorted(own["_slot"]) == list(range(len(own)))
    # Copies of the repeated row do not stand together.
    same = written[written["text"] == "same"]["_slot"]
    assert same.max() - same.min() > 450


def test_fisher_yates_is_a_permutation(spark):
    got = spark.range(40).select(sharding.fisher_yates(F.col("id").cast("int"), F.col("id")).alias("p")).collect()
    assert all(sorted(r["p"]) == list(range(i)) for i, r in enumerate(got))
    assert len({tuple(r["p"][:3]) for r in got[10:]}) > 15


@pytest.mark.parametrize("block, weak", [(4096, False), (8, True)])
def test_exact_duplicates(docs, block, weak):
    kind = (lambda c: F.pmod(F.xxhash64(c), F.lit(2))) if weak else F.xxhash64
    got = exact_dedup.exact_duplicates(docs, block_bytes=block, fingerprint=kind).collect()
    first, size = {}, Counter(map(norm, TEXTS))
    for i, t in enumerate(TEXTS):
        first.setdefault(norm(t), i)
    assert len(got) == len(TEXTS)
    for r in got:
        text = norm(TEXTS[r["doc_id"]])
        assert (r["keep_id"], r["group_size"], r["kept"]) == (first[text], size[text], first[text] == r["doc_id"])
        assert r["text_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_exact_duplicates_of_repeated_and_missing_ids(spark, docs, none):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "b"), (None, "c")], "doc_id long, text string")
    got = exact_dedup.exact_duplicates(rows)
    assert got.where("kept").count() == 3 and got.count() == 5
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(map(norm, TEXTS)))
    assert exact_dedup.exact_duplicates(none).count() == 0


@pytest.mark.parametrize("options", [{}, {"chunk": 2, "boundary": 0}, {"boundary": 14}])
def test_jaccard_components(spark, options):
    rng = np.random.default_rng(1)
    texts = [None, "", "x", "X", "x y"]
    for n in (8, 11, 15, 30, 90):
        base = [f"b{n}_{i}" for i in range(n)]
        for _ in range(7):
            own = list(base)
            for i in rng.integers(0, n, max(1, n // 40)):
                own[i] = f"e{rng.integers(9)}"
            texts.append(" ".join(own))
    rule = jaccard.Rule(2, 70)
    sets = [set(jaccard.shingles(t, 2).tolist()) for t in texts]
    part = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 70 * len(a | b):
                part = [part[j] if p == part[i] else p for p in part]
    least = {p: part.index(p) for p in part}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = jaccard.jaccard_components(frame, rule, **options).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: least[p] for i, p in enumerate(part)}
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in enumerate(sets)}


def test_mix_reaches_its_targets(docs, none):
    mixed = mixing.mix(docs, word_count(F.col("text")), run_rows=2)
    got = mixed.toPandas()
    assert len(got) == len(TEXTS) and (got["taken"] <= 2 * got["size"]).all() and (got["taken"] >= 0).all()
    for _, rows in got.assign(p=got["pattern"].map(str)).groupby("p"):
        assert abs(rows["taken"].sum() - rows["target"].iloc[0]) <= 1
    assert sorted(map(tuple, mixed.drop("pattern").collect())) == sorted(map(tuple, got.drop(columns="pattern").values.tolist()))
    assert mixing.mix(none, word_count(F.col("text"))).count() == 0
    copied = mixing.take_copies(docs, mixed)
    assert copied.columns == docs.columns


def test_water_fill_and_flow():
    assert mixing.water_fill([10, 100, 5], [3, 1, 2], 172.5, 2) == [20.0, 142.5, 10.0]
    assert mixing.route([10, 10], [[0], [0, 1]], [10, 10], 1) == [10, 10]  # the second gives way
    assert mixing.route([10, 4], [[0], [0]], [16], 2) == [12, 4]  # first copies before second ones


def test_packing_places_everything_and_keeps_conflicts_apart(docs, none):
    got = packing.pack(docs, word_count(F.col("text")), F.xxhash64(collapsed(F.col("text"))), capacity=16, per_source=2, group_rows=8).toPandas()
    sizes = {i: len((t or "").encode().split()) for i, t in enumerate(TEXTS)}
    assert got.groupby("doc_id")["piece_size"].sum().to_dict() == sizes
    for _, rows in got.groupby("bin"):
        spans = sorted(zip(rows["bin_start"], rows["piece_size"]))
        assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:])) and rows["piece_size"].sum() <= 16
        assert rows.groupby("source", dropna=False).size().max() <= 2
        assert rows["doc_id"].map(lambda i: norm(TEXTS[i])).is_unique
    assert packing.pack(none, word_count(F.col("text")), F.lit(None)).count() == 0


def test_packing_spreads_a_repeated_row_over_groups(spark):
    same = spark.range(2500).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source"))
    got = packing.pack(same, word_count(F.col("text")), F.lit(5).cast("long"), group_rows=100).toPandas()
    assert len(got) == 2500 and got["bin"].is_unique and (got["bin"] // 2**32).nunique() > 20


def test_best_fit_takes_the_tightest_compatible_bin():
    packed = {i: (b, at) for i, _, _, b, at in packing.best_fit([(0, 9, "a", 1), (1, 7, "b", 2), (2, 1, "c", 1), (3, 1, "a", 3)], 10, 1)}
    assert packed[2][0] == packed[1][0]  # the fuller bin holds its cluster
    assert packed[3][0] == packed[1][0]  # and its source


def test_near_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 8))
    vectors = [*(base[i % 12] + rng.normal(size=8) * 0.25 * (i % 3) for i in range(60)), base[0]]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(100, None), (101, [0.0] * 8), (102, [1.0, None] * 4), (103, [float("nan")] * 8), (104, []), (None, [1.0] * 8), (105, [1.0] * 3)]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=7).collect()
    unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.9
    part = jaccard.smallest_reachable(links.copy())
    found = {r["vec_id"]: r for r in got}
    assert len(got) == len(rows)
    for i in range(len(vectors)):
        assert (found[i]["n_links"], found[i]["component_id"]) == (links[i].sum() - 1, part[i])
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] for i in (100, 101, 102, 103, 104, 105))
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_quality_agrees_with_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scorer = quality.fit(docs)
    got = quality.quality_scores(docs, scorer).join(labels.withColumnRenamed("quality", "good"), "doc_id").toPandas()
    assert (got["kept"] == (got["good"] == 1)).mean() > 0.98 and got[got["good"] == 1]["kept"].all()
    assert quality.keep_good(docs, scorer).columns == docs.columns


def test_quality_of_odd_rows(docs, none):
    scorer = quality.fit(docs)
    assert quality.quality_scores(docs, scorer).count() == len(TEXTS)
    assert quality.keep_good(none, quality.fit(none)).count() == 0


def test_lm_base_score_and_model(docs, none):
    got = {r["doc_id"]: r for r in class_lm.lm_scores(docs).collect()}
    words = [(t or "").encode().lower().split() + ["end"] for t in TEXTS]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(TEXTS))]
    counts = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    total = counts.total()
    for i, ws in enumerate(words):
        base = sum(np.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1))) for w in ws)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[i], len(ws), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in ws) and abs(r["base_score"] - base) < 1e-6
        assert r["score"] < 0 and np.isfinite(r["score"])
    assert class_lm.lm_scores(none).count() == 0


def test_exchange_finds_classes():
    pairs = np.zeros((6, 6))
    pairs[:2, 2:4] = pairs[2:4, :2] = 10  # two kinds of words that alternate
    pairs[5, 0] = pairs[1, 5] = 1
    first, second = np.nonzero(pairs)
    label = class_lm.exchange(class_lm.Neighbours.of(6, first, second, pairs[first, second]), 2, 10)
    assert label[0] == label[1] != label[2] == label[3]


def gain(pairs, label):
    """What the exchange raises, from the whole matrix."""
    k = max(label) + 1
    joint = np.zeros((k, k))
    np.add.at(joint, (np.array(label)[:, None], np.array(label)[None, :]), pairs)
    weigh = lambda x: (x * np.log(np.maximum(x, 1))).sum()
    return weigh(joint) - weigh(joint.sum(0)) - weigh(joint.sum(1))


def test_exchange_ends_where_no_move_is_better():
    rng = np.random.default_rng(12)
    pairs = rng.integers(0, 9, (14, 14)) * rng.integers(0, 2, (14, 14)).astype(float)
    first, second = np.nonzero(pairs)
    label = class_lm.exchange(class_lm.Neighbours.of(14, first, second, pairs[first, second]), 4, 100)
    best = gain(pairs, label)
    for w in range(12):
        for c in range(4):
            other = label.copy()
            other[w] = c
            assert gain(pairs, other) <= best + 1e-6


def test_lm_score_equals_a_plain_class_model(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(9)] + ["The", "the"], rng.integers(0, 30))) + f" rare{n % 60}" for n in range(150)]
    texts += [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = [(t or "").lower().split() for t in texts]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))]
    counts = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    ends = held.count(False)
    total, share = counts.total() + ends, 0.03
    training = docs.where(~class_lm.held_out(F.col("doc_id")))
    rows = spark.createDataFrame([(bytearray(w.encode()), n) for w, n in counts.items()], "word binary, count long")
    model = class_lm.fit(rows, training, "text", (total, len(counts) + 1, ends), share, 3)
    classes = {w.decode(): c for w, c in model.classes.items()}
    assert set(classes) == {w for w, n in counts.items() if n >= share * total} and 5 < len(classes) < len(counts)
    open_class, end, k = model.open_class, model.end_class, max(model.end_class, model.open_class) + 1
    path = lambda ws: [end, *(classes.get(w, open_class) for w in ws), end]
    moves = Counter(p for ws, h in zip(words, held) if not h for p in zip(path(ws), path(ws)[1:]))
    out = Counter()
    for (a, _), n in moves.items():
        out[a] += n
    size = Counter(classes.values())
    inside = Counter()
    for w, c in classes.items():
        inside[c] += counts[w]
    open_words = sum(n for w, n in counts.items() if w not in classes)
    open_kinds = len(counts) - len(classes) + 1

    def emission(w):
        if w in classes:
            return (counts[w] + 0.5) / (inside[classes[w]] + 0.5 * size[classes[w]])
        return (counts[w] + 0.5) / (open_words + 0.5 * open_kinds)

    for r in class_lm.lm_scores(docs, share=share, classes=3).collect():
        ws = words[r["doc_id"]]
        wanted = sum(np.log10((moves[p] + 0.5) / (out[p[0]] + 0.5 * k)) for p in zip(path(ws), path(ws)[1:]))
        wanted += sum(np.log10(emission(w)) for w in ws)
        assert abs(r["score"] - wanted) < 1e-6


def test_token_files_round_trip(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    parts = token_files.write_token_files(docs, tokenizer_file(), length=16, part_bytes=200)
    got = {r["doc_id"]: r for r in token_files.read_documents(parts).collect()}
    start, flat = 0, []
    for i, t in enumerate(TEXTS):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start, flat = start + len(ids), flat + ids
    read = []
    for row in parts.orderBy("part").collect():
        file = token_files.SequenceFile(pa.memory_map(re.sub("^file:/*", "/", row["file"]) + ".ids.arrow"))
        read += [int(x) for k in range(len(file)) for x in file.ids(k)[file.mask(k)]]
    assert read == flat
    assert token_files.read_documents(token_files.write_token_files(none, tokenizer_file())).count() == 0


def test_token_counts_add_up(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    got = token_counts.token_counts(docs, tokenizer_file(), ("source", "text")).toPandas()
    whole = {i: len(tokenizer.encode(f"{'' if i % 5 == 4 else f's{i % 3}'} {t or ''}", add_special_tokens=False).ids) for i, t in enumerate(TEXTS)}
    assert got.groupby("doc_id")["n_tokens"].sum().to_dict() == whole
    assert token_counts.token_counts(none, tokenizer_file()).count() == 0


def test_attribution_rules():
    starts, ends, edges = np.array([0, 2, 5]), np.array([2, 5, 6]), np.array([0, 3, 6])
    assert [token_counts.attribute(starts, ends, edges, r)[0].tolist() for r in token_counts.RULES] == [[0, 1, 1], [0, 0, 1], [0, 1, 1]]


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_pipeline_keeps_clean_documents_and_packs_them(spark):
    import corpus_pipeline

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    good = corpus_pipeline.reject_poor(spark, docs, sf_dir)
    once = corpus_pipeline.drop_copies(spark, good, sf_dir)
    assert once.columns == docs.columns
    near = corpus_pipeline.drop_near_copies(spark, once, sf_dir)
    texts = {r["doc_id"]: set(jaccard.shingles(r["text"], 5).tolist()) for r in once.collect()}
    kept = {r["doc_id"] for r in near.collect()}
    for i, own in texts.items():  # whoever goes has a smaller one in its group; who stays links with none that stays
        if i in kept:
            assert not any(j in kept and j != i and own and 100 * len(own & o) >= 80 * len(own | o) for j, o in texts.items())
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
