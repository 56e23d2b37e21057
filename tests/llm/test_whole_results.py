"""Results that must be whole: links in long lists, rows that share an id, names that clash, order of files."""

import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallybook.llm import class_lm, embeddings, encoding, exact_dedup, jaccard, mixing, packing, quality, sharding, token_counts
from tallybook.llm.common import collapsed, word_count
from tallybook.llm.queries import tokenizer_file


def test_no_link_is_lost_in_long_lists(spark):
    common = [f"c{i}" for i in range(1500)]
    passages = [[f"p{k}_{i}" for i in range(20)] for k in range(6)]
    texts = []
    for n in range(1150):
        at, own = n * 7 % 1400, passages[n % 6]
        texts.append(" ".join(common[:at] + own + common[at:] + [f"u{n}"]))
    texts += [" ".join(common + [f"v{n}"]) for n in range(250)]
    pairs = [(" ".join(p + ["q"]), " ".join(p + ["q", f"r{k}"])) for k, p in enumerate(passages)]
    texts += [t for pair in pairs for t in pair]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(frame, jaccard.Rule(3, 90)).collect()}
    for k in range(6):
        a, b = 1400 + 2 * k, 1401 + 2 * k
        assert got[a] == got[b] == a
    assert len({got[i] for i in range(1150, 1400)}) == 1


@pytest.mark.parametrize("chunk", [40, 1024])
def test_lists_longer_than_a_chunk_equal_brute_force(spark, chunk, monkeypatch):
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    rng = np.random.default_rng(5)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for n in range(220):  # all share most of one text, few are near enough to link
        own = list(base)
        for i in rng.choice(60, rng.integers(0, 9), replace=False):
            own[i] = f"x{rng.integers(40)}"
        texts.append(" ".join(own))
    rule = jaccard.Rule(1, 80)
    sets = [set(t.split()) for t in texts]
    part = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                part = [part[j] if p == part[i] else p for p in part]
    least = {p: part.index(p) for p in part}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = jaccard.jaccard_components(frame, rule, chunk=chunk, boundary=0).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: least[p] for i, p in enumerate(part)}
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in enumerate(sets)}


STRANGE = "doc_id long, text string, lang string, source string, n_chars long, row_number long, mix_times int, _shard int, _size string, _row int"


@pytest.fixture(scope="module")
def strange(spark):
    prose = " ".join(f"word{i % 37} and thing{i}" for i in range(60))
    other = " ".join(f"other{i % 31} of thing{i}" for i in range(60))
    rows = [
        (1, prose, "en", "a"), (1, other, "en", "a"), (1, prose, "en", "b"),  # one id, two texts
        (None, prose + " x", "en", None), (None, other + " y", "en", "b"), (None, " ".join(f"z{i}" for i in range(90)), "en", "b"),
        (7, prose.replace(" ", "  "), "en", "a"), (8, None, None, None), (9, "", "en", "a"), (10, " \n", "en", "a"),
        (11, " ".join(f"long{i % 5000} w{i}" for i in range(9000)), "en", "c"),
    ]
    return spark.createDataFrame([(*r, 0, i, 3, 4, "s", 5) for i, r in enumerate(rows)], STRANGE)


def shown(frame):
    return sorted(map(repr, frame.collect()))


def test_stages_keep_rows_that_share_an_id(spark, strange):
    import corpus_pipeline as pipeline

    once = pipeline.drop_copies(spark, strange, "")
    assert once.columns == strange.columns
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    assert Counter(norm(r["text"]) for r in once.collect()) == {norm(r["text"]): 1 for r in strange.collect()}
    assert {r["doc_id"] for r in once.where("text like 'word%' and row_number <> 3").collect()} == {1}
    near = pipeline.drop_near_copies(spark, once, "")
    # Of the two near pairs the rows with an id stay, also where another row of the id has a near copy.
    assert near.columns == strange.columns and {r["row_number"] for r in near.collect()} >= {0, 1, 5}
    assert near.where("row_number in (3, 4)").isEmpty()
    mixed = pipeline.mix_sources(spark, near, "")
    assert mixed.columns == strange.columns and mixed.where("text like 'other%'").count() >= 1
    assert set(shown(mixed)) <= set(shown(near))
    packed = pipeline.pack_sequences(spark, mixed, "")
    assert packed.agg(F.sum("piece_size")).first()[0] == mixed.select(F.sum(word_count(F.col("text")))).first()[0]


def test_stages_pass_an_empty_table(spark, strange):
    import corpus_pipeline as pipeline

    rows = strange.limit(0)
    for _, stage in pipeline.STAGES[:-1]:
        rows = stage(spark, rows, "")
        assert rows.columns == strange.columns and rows.isEmpty()
    assert pipeline.STAGES[-1][1](spark, rows, "").isEmpty()


def test_mix_spreads_rows_of_one_id(spark):
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s").alias("source"))
    got = mixing.mix(rows, word_count(F.col("text")), run_rows=100)
    assert got.count() == 3000 and got.agg(F.sum("taken")).first()[0] == 13500


def test_shards_carry_clashing_names_and_lie_in_order(spark, strange, tmp_path):
    more = strange.unionByName(strange.withColumn("doc_id", F.col("row_number") + 100))
    made = sharding.shard(more, 3, bucket_rows=2, bucket_bytes=400)
    size, shard, slot = sharding.shard_columns(more.columns)
    assert (size, shard, slot) == ("_size_", "_shard_", "_slot") and made.columns == [*more.columns, size, shard, slot]
    written = sharding.write_shards(made, str(tmp_path / "s"), shard, slot)
    assert shown(written.select(more.columns)) == shown(more)
    for folder in (tmp_path / "s").glob(f"{shard}=*"):
        slots = [x for file in sorted(folder.glob("*.parquet")) for x in pq.read_table(file, columns=[slot]).column(0).to_pylist()]
        assert slots == list(range(len(slots)))


def test_sharding_equals_a_plain_walk(spark):
    rows = spark.range(200).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), (F.col("id") % 7).cast("int")).alias("text"))
    scores = spark.range(200).select("id", F.array(*(F.xxhash64("id", F.lit(s), F.lit(sharding.SEED)) for s in range(4))).alias("s"))
    best = {r["id"]: int(np.argmax(r["s"])) for r in scores.collect()}
    got = sharding.shard(rows, 4, bucket_rows=9).collect()
    assert {r["doc_id"]: (r["_shard"], r["_size"]) for r in got} == {i: (best[i], 2 * (i % 7) + 16) for i in range(200)}
    for s in range(4):
        own = [r for r in got if r["_shard"] == s]
        assert sorted(r["_slot"] for r in own) == list(range(len(own)))
        assert [r["doc_id"] for r in sorted(own, key=lambda r: r["_slot"])] != sorted(r["doc_id"] for r in own)


def plain_best_fit(items, capacity, per_source):
    """Bins as lists of members, all searched for the tightest one that may take the piece."""
    out, bins, rests = [], [], []
    for item, size, source, cluster in items:
        for start in range(0, size - size % capacity, capacity):
            out.append((item, start, capacity, len(bins), 0))
            bins.append((0, [], True))
        if size % capacity or not size:
            rests.append((-(size % capacity), item, size - size % capacity, source, cluster))
    order = {s: k for k, s in enumerate(dict.fromkeys(x[2] for x in items))}
    twice = {c for c, n in Counter(x[3] for x in items if x[3] is not None).items() if n > 1}
    marks = {c: k for k, c in enumerate(c for c in dict.fromkeys(x[3] for x in items) if c in twice)}
    rests.sort(key=lambda r: (r[0], r[1], r[2], order[r[3]], 1 << marks[r[4]] if r[4] in marks else 0))
    for negative, item, start, source, cluster in rests:
        size = -negative
        fits = [
            (room, k) for k, (room, members, whole) in enumerate(bins)
            if not whole and room >= size and sum(s == source for s, _ in members) < per_source
            and (cluster is None or all(c != cluster for _, c in members))
        ]
        if fits:
            room, k = min(fits)
        else:
            room, k = capacity, len(bins)
            bins.append((capacity, [], False))
        out.append((item, start, size, k, capacity - room))
        bins[k] = (room - size, [*bins[k][1], (source, cluster)], False)
    return sorted(out)


def test_no_bucket_of_records_is_gathered_in_an_array(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), F.col("id").cast("int")).alias("text"))
    sharded = sharding.shard(docs, 3, bucket_bytes=1 << 20)
    assert "collect_list" not in sharded._jdf.queryExecution().toString()
    slots = sharded.groupBy("_shard").agg(F.sort_array(F.collect_list("_slot")).alias("s")).collect()
    assert sum(len(r["s"]) for r in slots) == 5000 and all(r["s"] == list(range(len(r["s"]))) for r in slots)


def test_packing_equals_a_search_of_all_bins():
    rng = np.random.default_rng(9)
    for _ in range(30):
        items = [(i, int(rng.integers(0, 25)), "abc"[rng.integers(3)], [None, 1, 2, 3][rng.integers(4)]) for i in range(60)]
        assert sorted(packing.best_fit(items, 10, 2)) == plain_best_fit(items, 10, 2)


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_token_counts_equal_a_plain_attribution(spark, rule):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file())
    width = {k: len(t) for t, k in tokenizer.get_vocab().items()}
    rows = [(i, f"s{i}é" * (i % 3), ["a b", "", "é ü😀\n\nx", "word  two", None][i % 5]) for i in range(15)] + [(3, "x", "y")]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    wanted = Counter()
    for i, source, text in rows:
        whole = f"{source} {text or ''}"
        first = len(source.encode())
        at = 0
        for token in tokenizer.encode(whole, add_special_tokens=False).ids:
            span = range(at, at + width[token])
            # What lies between the fields counts with the field after it.
            parts = [0 if b < first else 1 if b == first else 2 for b in span]
            if rule == "overlap":
                part = max(sorted(set(parts)), key=lambda p: parts.count(p))
            else:
                part = parts[0] if rule == "first" else parts[-1]
            wanted[i, "source" if part == 0 else "text"] += 1
            at += width[token]
    got = Counter()
    for r in token_counts.token_counts(frame, tokenizer_file(), ("source", "text"), rule=rule).collect():
        got[r["doc_id"], r["field"]] += r["n_tokens"]
    assert +got == +wanted


def test_words_alone_can_decide(spark):
    rng = np.random.default_rng(7)
    letters = [a + b for a in "abcdefghij" for b in "klmnop"]
    good, bad = [f"go{x}" for x in letters], [f"bu{x}" for x in letters]
    rows = [(i, " ".join(rng.choice(good, 40, replace=False)) + ".") for i in range(300)]
    rows += [(300 + i, " ".join(w + "&&&" for w in rng.choice(bad, 40, replace=False))) for i in range(300)]
    # No heuristic looks at fewer than five words, and these have the same shapes.
    rows += [(1000 + i, " ".join(rng.choice(good, 4, replace=False))) for i in range(20)]
    rows += [(2000 + i, " ".join(rng.choice(bad, 4, replace=False))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.quality_scores(docs, quality.fit(docs)).collect()}
    assert {got[1000 + i]["votes"] for i in range(20)} == {got[2000 + i]["votes"] for i in range(20)}
    assert min(got[1000 + i]["quality"] for i in range(20)) > max(got[2000 + i]["quality"] for i in range(20))


def test_the_sample_does_not_depend_on_how_rows_are_dealt(spark):
    rows = [(1 if i < 300 else None if i < 350 else i, f"text number {i % 90} of {i % 7}") for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = [quality.fit(docs.repartition(n), sample=50) for n in (1, 3, 7)]
    for other in made[1:]:
        assert other.bias == made[0].bias and (other.weight == made[0].weight).all()


def test_training_equals_a_dense_one():
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(quality.FEATURES, 12)), rng.random(12)) for _ in range(40)]
    good = rng.random(40)
    x = np.zeros((40, quality.FEATURES))
    for k, (at, value) in enumerate(rows):
        np.add.at(x[k], at, value)
    weight, bias, before, before_bias = np.zeros(quality.FEATURES), 0.0, np.zeros(quality.FEATURES), 0.0
    rate = 4 / (1 + max(float((v * v).sum()) for _, v in rows))
    for step in range(quality.STEPS):
        momentum = (step - 1) / (step + 2) if step else 0.0
        ahead, ahead_bias = weight + momentum * (weight - before), bias + momentum * (bias - before_bias)
        wrong = 1 / (1 + np.exp(-(x @ ahead + ahead_bias))) - good
        before, before_bias = weight, bias
        weight = ahead - rate * (x.T @ wrong / 40 + quality.SHRINK * ahead)
        bias = ahead_bias - rate * wrong.mean()
    got = quality.train(rows, good)
    assert np.allclose(got[0], weight) and np.isclose(got[1], bias)


def test_training_widens_few_entries_at_a_time(monkeypatch):
    rng = np.random.default_rng(5)

    def made(n):
        return [(rng.integers(0, quality.FEATURES, 500).astype("<u2"), rng.random(500).astype("<f4")) for _ in range(n)]

    monkeypatch.setattr(quality, "STEPS", 3)
    rows, good = made(2000), rng.random(2000)
    tracemalloc.start()
    try:
        weight, bias = quality.train(list(rows), good)
        # A million entries of 6 bytes are held once.
        assert tracemalloc.get_traced_memory()[1] < 16e6
    finally:
        tracemalloc.stop()
    monkeypatch.setattr(quality, "BLOCK", 1234, raising=False)
    other, other_bias = quality.train(list(rows), good)
    assert (weight == other).all() and bias == other_bias


def test_posteriors_equal_plain_expectation_maximisation():
    rng = np.random.default_rng(1)
    patterns = {"".join(map(str, rng.integers(0, 3, 9))): int(rng.integers(1, 50)) for _ in range(30)}
    good = {p: 0.01 if "0" in p else 0.99 for p in patterns}
    for _ in range(60):
        total = sum(patterns.values())
        prior = (sum(n * good[p] for p, n in patterns.items()) + 1) / (total + 2)
        table = {}
        for side in (1, 0):
            for k in range(9):
                own = [sum(n * (good[p] if side else 1 - good[p]) for p, n in patterns.items() if p[k] == v) + 0.1 for v in "012"]
                table[side, k] = [x / sum(own) for x in own]
        for p in patterns:
            yes = prior * np.prod([table[1, k][int(p[k])] for k in range(9)])
            no = (1 - prior) * np.prod([table[0, k][int(p[k])] for k in range(9)])
            good[p] = yes / (yes + no)
    got = quality.posteriors(patterns)
    assert all(abs(got[p] - good[p]) < 1e-6 for p in patterns)


def test_bounds_decide_nothing_wrong():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16)) * 10.0 ** rng.integers(-150, 150, (40, 1))
    x = np.concatenate([base + rng.normal(size=base.shape) * np.abs(base).max(axis=1, keepdims=True) * s for s in (0, 0.05, 0.15, 0.2)])
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    cosine = unit @ unit.T
    q = embeddings.quantise(x)
    assert q.q.dtype == np.int8
    linked, open_ = embeddings.tile_masks(q, q, 0.9, False)
    assert (cosine[linked] >= 0.9).all() and (cosine[~linked & ~open_] < 0.9).all() and open_.mean() < 0.2 and linked.any()


def test_every_training_word_has_a_class(spark):
    """Two kinds of words alternate; rare words of either kind join the class of their kind, none is left open."""
    rng = np.random.default_rng(9)
    kinds = [[f"{k}{i}" for i in range(4)] for k in "ab"]
    texts = []
    for n in range(200):
        words = [str(rng.choice(kinds[i % 2])) for i in range(12)]
        words[4 + n % 2] = f"rare{n % 2}x{n % 26}"  # in place of a word of its kind
        texts.append(" ".join(words))
    texts += [None, "new words"]
    ids = [*range(201), next(i for i in range(201, 300) if zlib.crc32(str(i).encode()) % 5 == 1)]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    words = [(t or "").split() for t in texts]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in ids]
    counts = Counter(w for ws, h in zip(words, held) if not h for w in ws)
    ends = held.count(False)
    total, core = counts.total() + ends, 0.02
    training = docs.where(~class_lm.held_out(F.col("doc_id")))
    table = spark.createDataFrame([(bytearray(w.encode()), n) for w, n in counts.items()], "word binary, count long")
    model = class_lm.fit(table, training, "text", (total, len(counts) + 1, ends), core, 2)
    rows = class_lm.word_classes(table, training, "text", model, len(counts)).collect()
    label = {bytes(r["word"]).decode(): r["cls"] for r in rows}
    assert {bytes(r["word"]).decode(): r["count"] for r in rows} == counts
    kind = {w: label[w[0] + "0"] if w[0] in "ab" else label["ab"[int(w[4])] + "0"] for w in label}
    assert label == kind and len(set(label.values())) == 2 and len(model.classes) == 8
    k, end = model.end_class + 1, model.end_class
    path = lambda ws: [end, *(label.get(w, model.open_class) for w in ws), end]
    moves = Counter(p for ws, h in zip(words, held) if not h for p in zip(path(ws), path(ws)[1:]))
    out, inside, size = Counter(), Counter(), Counter(label.values())
    for (a, _), n in moves.items():
        out[a] += n
    for w, c in label.items():
        inside[c] += counts[w]
    got = {r["doc_id"]: r for r in class_lm.lm_scores(docs, classes=2, core=core).collect()}
    assert len(got) == 202
    for n, ws in zip(ids, words):
        wanted = sum(np.log10((moves[p] + 0.5) / (out[p[0]] + 0.5 * k)) for p in zip(path(ws), path(ws)[1:]))
        wanted += sum(np.log10((counts[w] + 0.5) / (inside[label[w]] + 0.5 * size[label[w]])) for w in ws if w in label)
        assert abs(got[n]["score"] - wanted) < 1e-6
        assert got[n]["n_known"] == sum(w in counts for w in ws) + 1


def test_lm_scores_do_not_depend_on_what_tasks_hold(spark, monkeypatch):
    """Words that no task holds meet their documents by the join, several times in a text or once."""
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(60)], rng.integers(0, 90))) for _ in range(120)]
    docs = spark.createDataFrame([*enumerate(texts), (None, "w1 w1 unheard"), (3, "w2")], "doc_id long, text string").repartition(3)
    read = lambda: sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in class_lm.lm_scores(docs, core=0.02).collect())
    wanted = read()
    monkeypatch.setattr(class_lm, "HELD", 5)
    monkeypatch.setattr(class_lm, "PART_DOCS", 7)
    monkeypatch.setattr(class_lm, "PART_WORDS", 9)
    assert read() == wanted and len(wanted) == 122


def test_tiles_compare_by_bounds_only_what_is_near(monkeypatch):
    """The masks are those of all bounds, though rows and columns that are far from all others are not compared by them."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 24))
    x, y = base, np.concatenate([base[:9] + rng.normal(size=(9, 24)) * 0.3, rng.normal(size=(200, 24)) * 1e6, base[:3] * 2])
    a, b = embeddings.quantise(x), embeddings.quantise(y)
    monkeypatch.setattr(embeddings, "STRIP", 1 << 16)
    for p, q, same in ((a, b, False), (b, b, True)):
        whole = embeddings._by_bound(p, q, 0.9)
        part = np.triu(np.ones((len(p), len(q)), bool), 1) if same else np.ones((len(p), len(q)), bool)
        compared = []
        with monkeypatch.context() as patch:
            by_bound = embeddings._by_bound
            patch.setattr(embeddings, "_by_bound", lambda s, t, u: compared.append(len(s) * len(t)) or by_bound(s, t, u))
            got = embeddings.tile_masks(p, q, 0.9, same)
        assert all((g == w & part).all() for g, w in zip(got, whole)) and got[0].any()
        assert 0 < sum(compared) < len(p) * len(q) / 20


@pytest.mark.parametrize("kept", [encoding.CACHED_PIECES, 60])
def test_encoder_equals_the_tokenizer_and_shares_words_between_lines(monkeypatch, kept):
    monkeypatch.setattr(encoding, "CACHED_PIECES", kept)
    monkeypatch.setattr(encoding, "GATHERED", 50, raising=False)
    encode = encoding.Encoder(tokenizer_file())
    words = ["Thlyer", "haou", "Éaielle", "don't", "x1", "42", "漢字", "a b", "I'll", "<|endoftext|>"]
    pairs = [f"{a}.\n{b}!?" for a in words for b in words]
    odd = ["", " ", "\n", "a\n", "\na", " a", "a ", "a  b", "a \n b", "a\n\nb.", "a.\n b", "a\r\nb", "a.\t\nb", "a\n.\nb", "..\n..", "a.\x85\nb", "﻿a\nb", "a.\n　b"]
    mixed = [" ".join(pairs[k::7]) + o for k, o in enumerate(odd)] + ["one " + o + " two" for o in odd]
    for texts in (pairs, odd, mixed, pairs[::-1], mixed[::-1]):
        want = [encode.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        ids, n = encode.encode(texts)
        assert ids.tolist() == sum(want, []) and n.tolist() == [len(x) for x in want]
    encode.clear()
    encode.encode(pairs)
    # 100 pairs of lines are made of 10 words, with and without a blank before them, a line end and marks.
    if kept > len(pairs):
        assert encode.held < 4 * len("".join(words))


def test_words_meet_before_they_are_looked_up(monkeypatch):
    texts = ["", None, " ", "The the\tTHE\x0b\x0cÉté été", "\n\x1c a\x85b \x00 c ", "x" * 50, "漢字　the", "  lead", "trail  "] * 3
    wanted = [(t or "").encode().lower().split() for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    monkeypatch.setattr(class_lm, "SLICE_BYTES", 60, raising=False)

    def never(text):
        raise AssertionError("words were made one by one")

    monkeypatch.setattr(class_lm, "words_of", never, raising=False)
    counts = Counter()
    for part in class_lm._count_words(iter([batch.slice(2), batch.slice(0, 2)])):
        for row in part.to_pylist():
            counts[row["word"]] += row["count"]
    assert counts == Counter(w for words in wanted for w in words)
    number = {b"the": 0, b"c": 1}
    got = Counter()
    for part in class_lm._count_pairs(iter([batch]), number):
        got.update(dict(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)))
    run = [3] + [n for words in wanted for n in (*(number.get(w, 2) for w in words), 3)]
    assert got == Counter(a * 4 + b for a, b in zip(run, run[1:]))


def test_neighbours_and_steps_are_counted_in_little_memory():
    rng = np.random.default_rng(8)
    k, n = 50, 3000
    classes = {b"%d" % i: i % 48 for i in range(100)}
    lists = [rng.integers(0, 3000, 200) for _ in range(n)]
    texts = pa.RecordBatch.from_arrays([pa.array([" ".join(map(str, x)) for x in lists], pa.string())], names=["text"])
    paths = [rng.integers(0, 48, 500, dtype=np.uint8).tobytes() + b"\x31" for _ in range(n)]
    counts = pa.array(np.full(n, 501))
    zero = pa.array(np.zeros(n))
    scored = pa.RecordBatch.from_arrays([counts, counts, counts, zero, zero, pa.array(paths, pa.binary())], names=list("abcdef"))
    scale, step = class_lm.Scale(np.ones(k), 1.0, 1, 48, 49), rng.normal(size=(k, k))

    def peak(made):
        tracemalloc.start()
        try:
            return list(made), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()

    contexts, most = peak(class_lm._count_contexts(iter([texts]), classes, 48, 49))
    # 600,000 words, nearly all without a class.
    assert most < 32e6
    seen = Counter()
    for part in contexts:
        for row in part.to_pylist():
            seen.update({(row["word"], c): t for c, t in zip(row["codes"], row["times"], strict=True)})
    wanted = Counter()
    for x in lists:
        path = [49, *(int(w) % 48 if w < 100 else 48 for w in x), 49]
        for i, w in enumerate(x.tolist()):
            if w >= 100:
                wanted.update([(b"%d" % w, path[i]), (b"%d" % w, k + path[i + 2])])
    assert seen == wanted
    moves, most = peak(class_lm._count_steps(iter([scored.select(["f"])]), scale))
    assert most < 12e6 and sum(sum(p.column(1).to_pylist()) for p in moves) == n * 501
    scores, most = peak(class_lm._score(iter([scored, scored.slice(5, 2)]), step, scale))
    assert most < 16e6
    got = [x for p in scores for x in p.column(4).to_pylist()]
    along = [sum(step[a, b] for a, b in zip(b"\x31" + p, p)) for p in paths]
    assert np.allclose(got, along + along[5:7])


def test_most_frequent_words_are_those_of_the_whole_order(spark):
    rows = [(bytearray(b"w%d" % i), i % 7 + 1, i % 3) for i in range(70)]
    counts = spark.createDataFrame(rows, "word binary, count long, cls int")
    order = sorted(rows, key=lambda r: (-r[1], bytes(r[0])))
    for limit in (1, 10, 13, 70, 80):
        assert [(bytes(r["word"]), r["count"]) for r in class_lm.most_frequent(counts, limit).collect()] == [(bytes(w), n) for w, n, _ in order[:limit]]
    assert class_lm.most_frequent(counts.limit(0), 5).collect() == []


def test_few_long_documents_are_completed_in_as_many_parts_as_their_tokens_need(spark, monkeypatch):
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice([f"w{i}" for i in range(60)], 200)) for _ in range(40)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(class_lm, "HELD", 5)
    made, parts = [], class_lm._parts
    monkeypatch.setattr(class_lm, "_parts", lambda *sizes: made.append(sizes) or parts(*sizes))
    read = lambda: [(r["doc_id"], r["n_known"], round(r["score"], 6)) for r in class_lm.lm_scores(docs, core=0.02).orderBy("doc_id").collect()]
    wanted = read()
    monkeypatch.setattr(class_lm, "PART_TOKENS", 500)
    assert read() == wanted and len(wanted) == 40
    training = sum(zlib.crc32(str(i).encode()) % 5 != 1 for i in range(40))
    assert [s[2] for s in made] == [201 * training, 201 * 40] * 2
    number = lambda column: spark.range(1).select(column).first()[0]
    assert number(parts(40, 2000, 201 * 40)) == 17 and number(parts(40, 7, 0)) == 6 and number(parts(0, 7, 0)) == 1
