"""Merkle manifest, phrase mining and rule ledger against plain re-computations on small rows."""

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tallybook.llm import merkle, phrases, rule_ledger
from tallybook.llm.common import arrow_batches

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, at int, total int, id string, words string, failed int"


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(4)
    sources = [None, "", "a", "b", "é", "hot"]
    rows = []
    for i in range(160):
        source = "hot" if i % 3 else sources[i % 5]
        text = None if i % 31 == 0 else "" if i % 29 == 0 else f"line {i}\nnext é {rng.integers(9)}"
        rows.append((None if i in (5, 77) else i // 2 if i > 150 else i, source, "en", i, text, 0, 0, "x", "y", 0))
    rows += rows[40:44]  # rows that repeat
    return spark.createDataFrame(rows, SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Levels from the leaves to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        own = levels[-1]
        levels.append([sha("".join(own[k : k + 3])) for k in range(0, len(own), 3)])
    return levels


def siblings(levels, at):
    out = []
    for own in levels[:-1]:
        start = at - at % 3
        out.append(("".join(own[start:at]), "".join(own[at + 1 : start + 3])))
        at //= 3
    return out


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_equals_a_plain_tree(docs, levels):
    got = merkle.merkle_manifest(docs, COLUMNS, levels=levels).collect()
    rows = docs.collect()
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([d for *_, d in sorted(by_source[s])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    assert len(got) == len(rows)
    for r in got:
        own = trees[r["group"]]
        assert own[0][r["at"]] == r["leaf"] and r["total"] == len(own[0])
        assert (r["subroot"], r["root"]) == (own[-1][0], top[-1][0])
        wanted = siblings(own, r["at"]) + siblings(top, names.index(r["group"]))
        assert [(s["left"], s["right"]) for s in r["path"]] == wanted
    assert sorted((str(r["group"]), r["at"]) for r in got) == sorted((str(s), k) for s in names for k in range(len(trees[s][0])))


def test_manifest_shows_what_was_changed(spark, docs):
    bare = F.when(F.col("n_chars") % 2 == 0, merkle.digest(merkle.encoded(*(F.regexp_replace("text", "\n", "") if c == "text" else F.col(c) for c in COLUMNS))))
    manifest = merkle.merkle_manifest(docs, COLUMNS, also={"bare": bare, "n": F.col("n_chars"), "text": F.col("text")})
    for r in merkle.verified(manifest, F.coalesce("bare", "leaf")).collect():
        assert r["verified"] == (r["n"] % 2 == 1 or "\n" not in (r["text"] or ""))
        assert r["verified"] == (r["folded_root"] == r["root"])
    later = docs.withColumn("text", F.when(F.col("n_chars") == 9, "new").otherwise(F.col("text"))).where("n_chars <> 11")
    diff = merkle.changed(merkle.merkle_manifest(docs, COLUMNS), merkle.merkle_manifest(later, COLUMNS)).collect()
    assert sorted((r["id"], r["copies"]) for r in diff) == [(9, -1), (9, 1), (11, -1)]


def test_manifest_of_one_row_and_of_none(spark, docs):
    one = merkle.merkle_manifest(docs.where("doc_id = 9"), COLUMNS).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["path"] == []
    assert merkle.merkle_manifest(docs.limit(0), COLUMNS).count() == 0


def plain_collocations(rows, least, cover, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, 5):
                own.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, own in counts.items():
        many = {p: n for p, n in own.items() if n >= least}
        kept = []
        for p, a in many.items():
            if len(p) < 2:
                continue
            score, k = min((2_000_000 * a // (many[p[:k]] + many[p[k:]]), k) for k in range(1, len(p)))
            inside = any(
                len(q) > len(p) and 100 * n >= cover * a and any(q[i : i + len(p)] == p for i in range(len(q)))
                for q, n in many.items()
            )
            if not inside:
                kept.append((-score, -a, " ".join(p).encode(), a, many[p[:k]], many[p[k:]], score))
        for rank, (_, _, phrase, a, left, right, score) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, left, right, totals[lang], score))
    return sorted(out)


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(8)
    words = ["the", "The", "of", "é", "x", " ", "New", "york", "city", "a\x1cb", *(f"w{i}" for i in range(12))]
    rows = []
    for i in range(150):
        own = rng.choice(words, rng.integers(0, 60), p=[0.3, 0.05, 0.1, *[0.55 / (len(words) - 3)] * (len(words) - 3)])
        seps = rng.choice([" ", "\t", "  ", ", ", ".", "\n", "! ", "\x0b", "\r\n"], len(own), p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.03, 0.03, 0.02, 0.02])
        text = "".join(a + b for a, b in zip(own, seps))
        rows.append((("en", "de", None, "und")[i % 4], None if i % 17 == 0 else text + "new york city " * (i % 4)))
    rows.append(("en", "the of " * 400))  # one piece far longer than a chunk
    return rows + rows[:9]


@pytest.mark.parametrize("options", [{}, {"chunk_words": 50, "burst": 4, "trie_entries": 30, "filter_bits": 1 << 15}])
def test_collocations_equal_a_plain_count(spark, texts, options):
    frame = spark.createDataFrame([(*r, "x", 1) for r in texts], "lang string, text string, phrase string, n long").repartition(3)
    got = phrases.collocations(frame, least=5, top=40, **options)
    wanted = plain_collocations(texts, 5, 80, 40)
    assert sorted(map(tuple, got.collect())) == wanted and len(wanted) > 60
    assert phrases.collocations(frame.limit(0)).count() == 0


def test_a_trie_bursts_and_gives_sorted_runs():
    rng = np.random.default_rng(3)
    trie, counts = phrases.HatTrie(burst=5), Counter()
    for _ in range(20):
        first, rest = np.sort(rng.integers(1, 6, 40)), rng.integers(1, 4, 40) << 42 | rng.integers(0, 3, 40) << 21
        trie.add(first, rest, np.ones(40, int))
        counts.update(zip(first.tolist(), rest.tolist()))
    assert trie.entries == len(counts) and any(t.held is None for t in trie.root.values())
    heads = trie.largest(0.5)
    first, rest, n = trie.take(heads)
    assert {(h, r): c for h, r, c in zip(first.tolist(), rest.tolist(), n.tolist())} == {k: c for k, c in counts.items() if k[0] in heads}
    assert trie.entries == len(counts) - len(n) and trie.take(trie.largest(1.0))[2].sum() == counts.total() - n.sum()
    assert trie.entries == 0 and not trie.root


def test_a_spill_is_in_the_order_of_its_words():
    counter = phrases._Counter([(b"\xff" * 4096, 0), (b"\xff" * 4096, 30), (bytes(4096), 30)], burst=3, limit=10)
    rng = np.random.default_rng(2)
    words = [b"b", b"a-", b"a", "é".encode(), b"zz"]
    found = Counter()
    for _ in range(6):
        ids = rng.integers(0, 6, 60).astype(np.int32)
        runs = [b.to_pylist() for b in counter.add("en", words, ids, 0)]
        for run in runs:
            assert run == sorted(run, key=lambda r: [w.encode() for w in r["phrase"].split(" ")])
        for r in sum(runs, []):
            found[r["phrase"]] += r["n"]
        names = [b"", *words]
        for x, y in zip(ids, ids[1:]):
            if x and y:
                found[(names[x] + b" " + names[y]).decode()] -= 1
    for r in sum((b.to_pylist() for b in counter.close()), []):
        found[r["phrase"]] += r["n"]
    assert not any(found.values())


def test_bitmaps_hold_what_tasks_ask_for(spark):
    rows = [("en", f"word{i}") for i in range(300)] + [("é", "a b"), ("", "ü")]
    keys = spark.createDataFrame(rows, "lang string, phrase string").select(F.xxhash64("lang", "phrase").alias("key"))
    frequent = phrases._Frequent(phrases._bitmap(keys, 1 << 20))
    import xxhash

    for lang, phrase in rows:
        assert frequent(phrases._hashes([phrase.encode()], xxhash.xxh64_intdigest(lang.encode(), 42))).all()
    other = phrases._hashes([b"no%d" % i for i in range(300)], xxhash.xxh64_intdigest(b"en", 42))
    assert frequent(other).mean() < 0.5


TEXTS = [
    None, "", " \t\n ", "one", "a b c d e f g h", "a b c d e f g h a b c d e f g h", "x " * 40, "#* $ | <>&% é",
    "same line\nsame line\n \n\nsame line ", "p q r s t u v w x " * 3 + " ".join(f"w{i}" for i in range(50)),
    "BIG WORDS É " * 9, " ".join(f"w{i % 701}" for i in range(30_000)), "a\x0bb\x0cc d",
]


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("weak", [False, True])
def test_ledger_equals_plain_measures(spark, weak):
    kind = (lambda *c: F.pmod(F.xxhash64(*c), F.lit(3))) if weak else F.xxhash64
    rows = [(i, t, "x", 0) for i, t in enumerate(TEXTS)] + [(None, "one two", "x", 0), (3, "one", "x", 0)]
    if weak:
        rows = [r for r in rows if len(r[1] or "") < 1000]
    frame = spark.createDataFrame(rows, "doc_id long, text string, words string, failed int")
    got = rule_ledger.ledger(frame, fingerprint=kind).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted(((r["id"] is None, r["id"] or 0), tuple(r[c] for c in names)) for r in got) == sorted(
        ((r[0] is None, r[0] or 0), plain_measures(r[1])) for r in rows
    )
    assert rule_ledger.ledger(frame.limit(0)).count() == 0


def test_policies_and_ablations_follow_from_the_bits(spark):
    rng = np.random.default_rng(6)
    bits = [int(x) for x in rng.integers(0, 256, 300) & rng.integers(0, 256, 300) & rng.integers(0, 256, 300)]
    rows = spark.createDataFrame([(i, b, 10) for i, b in enumerate(bits)], "id long, failed long, n_words long")
    policy = rule_ledger.PROSE
    kept = {r["id"]: r["kept"] for r in rule_ledger.apply_policy(rows, policy).collect()}
    assert kept == {i: b & policy.mask == 0 for i, b in enumerate(bits)}
    for r in rule_ledger.ablations(rows, policy).collect():
        own, rest = r["bit"], policy.mask & ~r["bit"]
        assert r["failed_docs"] == sum(b & own > 0 for b in bits) and r["failed_words"] == 10 * r["failed_docs"]
        assert r["only_docs"] == sum(b & own > 0 and b & rest == 0 for b in bits)
        assert r["kept_without"] == sum(b & rest == 0 for b in bits)
    both = {(r["old_kept"], r["new_kept"]): r["docs"] for r in rule_ledger.moved(rows, rule_ledger.BASE, policy).collect()}
    assert sum(both.values()) == 300 and (False, True) not in both


def test_ledger_runs_in_the_jvm(docs):
    plan = rule_ledger.ledger(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_a_run_holds_each_phrase_once():
    """Pairs and triples leave a task counted, not once for each window that begins with them."""
    every = b"\xff" * 4096
    counter = phrases._Counter([(every, 0), (every, 30), (every, 30)], burst=3, limit=10**6)
    rng = np.random.default_rng(6)
    words, names, found = [b"b", b"a", b"c"], [b"", b"b", b"a", b"c"], Counter()
    for _ in range(5):
        ids = rng.integers(0, 4, 80).astype(np.int32)
        assert not list(counter.add("en", words, ids, 0))
        for i in range(len(ids)):
            for size in (2, 3, 4):
                own = ids[i : i + size]
                if len(own) == size and own.all():
                    found[b" ".join(names[k] for k in own).decode()] += 1
    rows = [r for b in counter.close() for r in b.to_pylist()]
    assert len(rows) == len(found) and {r["phrase"]: r["n"] for r in rows} == found


def test_quadruples_of_frequent_triples_that_are_rare_leave_no_task(spark, monkeypatch):
    texts = [f"a b c x{i}. y{i} b c d. a b c z{i}" for i in range(40)] + ["a b c d"] * 3
    seen, own = [], phrases._merged

    def merged(runs, least):
        blocks = runs.collect()
        assert len({(r["lang"], r["part"]) for r in blocks}) > 1
        seen.extend(p for r in blocks for p in r["phrases"])
        return own(runs, least)

    monkeypatch.setattr(phrases, "_merged", merged)
    counts, _ = phrases.phrase_counts(spark.createDataFrame([("en", t) for t in texts], "lang string, text string").repartition(2), 30)
    longer = {r["phrase"]: r["n"] for r in counts.where("size > 1").collect()}
    assert longer == {"a b": 83, "b c": 123, "c d": 43, "a b c": 83, "b c d": 43}
    assert set(seen) == set(longer)


def test_encoded_rows_are_written_and_handed_over_a_few_at_a_time(spark, monkeypatch):
    """However many rows of megabytes a file or a partition has, no row group or batch gathers them all."""
    seen, files, own, batch_bytes = [], [], phrases.cut, "spark.sql.execution.arrow.maxBytesPerBatch"

    def cut(df, name, **options):
        out = own(df, name, **options)
        files.extend(f.removeprefix("file://") for f in out.inputFiles() if name == "encoded-texts")
        return out

    monkeypatch.setattr(phrases, "cut", cut)
    before = spark.conf.get(batch_bytes)
    frame = spark.createDataFrame([("en", f"a b c w{i}") for i in range(400)], "lang string, text string").coalesce(1)
    counts, _ = phrases.phrase_counts(frame, 30, chunk_words=40)
    assert {(r["phrase"], r["n"]) for r in counts.where("size = 3").collect()} == {("a b c", 400)}
    for path in files:
        meta = pq.ParquetFile(path).metadata
        seen += [meta.row_group(i).num_rows for i in range(meta.num_row_groups)]
    assert sum(seen) >= 40 and max(seen) <= phrases.GROUP_ROWS
    wide = spark.range(0, 64, 1, 1).selectExpr("array_repeat(id, 4096) AS ids")
    with arrow_batches(spark, 1 << 16):
        sizes = wide.mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in it), "n long").collect()
    assert len(sizes) >= 32 and max(r["n"] for r in sizes) < 1 << 17
    assert spark.conf.get(batch_bytes) == before


def test_steps_carry_no_bitmaps(spark):
    """Bitmaps reach an executor once; what a step sends with its code does not grow with them."""
    with phrases._sent_levels(spark) as levels:
        for k in range(4):
            levels.add(bytes([k]) * (1 << 20), k)
        read = levels.reader()
        assert len(cloudpickle.dumps(read)) < 10_000
        found = spark.range(2).mapInArrow(
            lambda it: (pa.RecordBatch.from_pydict({"n": [x for b, k in read() for x in (len(b), b[0], k)]}) for _ in it), "n long"
        ).collect()
        sent = [x for k in range(4) for x in (1 << 20, k, k)]
        assert [r["n"] for r in found][:12] == sent
