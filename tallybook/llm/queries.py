"""One query per operator, over its whole table, and the same in SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import (
    class_lm,
    embeddings,
    exact_dedup,
    jaccard,
    merkle,
    mixing,
    packing,
    phrases,
    quality,
    rule_ledger,
    sharding,
    token_counts,
    token_files,
)
from tallybook.llm.common import collapsed, word_count

SHARDS = 40
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written into 40 shards, and what the shards then hold."""
    written = sharding.write_shards(sharding.shard(_read(spark, sf_dir, "documents"), SHARDS))
    return written.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        sharding.shard_of(F.col("doc_id"), SHARDS + 1).alias("grown_shard"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 words."""
    return packing.pack(
        _read(spark, sf_dir, "documents"), word_count(F.col("text")), F.xxhash64(collapsed(F.col("text")))
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts among all documents."""
    return exact_dedup.exact_duplicates(_read(spark, sf_dir, "documents")).drop("row_number")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix with weights 3, 1, 2 takes of each document."""
    return mixing.mix(_read(spark, sf_dir, "documents"), word_count(F.col("text"))).drop("pattern")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.9."""
    return embeddings.near_vectors(_read(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document by the weak-label model."""
    docs = _read(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.fit(docs))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by the class model."""
    return class_lm.lm_scores(_read(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded into Arrow stream files, and read back from them."""
    return token_files.read_documents(
        token_files.write_token_files(_read(spark, sf_dir, "documents"), tokenizer_file())
    )


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each field of every document."""
    return token_counts.token_counts(_read(spark, sf_dir, "documents"), tokenizer_file())


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents by their 3-word shingles at a similarity of 0.9."""
    return jaccard.jaccard_components(_read(spark, sf_dir, "documents"), jaccard.Rule(3, 90)).drop("set_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, and whether documents of even checksums stand up without their line ends."""
    docs = _read(spark, sf_dir, "documents")
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    bare = [F.regexp_replace("text", "\n", "") if c == "text" else F.col(c) for c in columns]
    tampered = F.when(even & (F.locate("\n", "text") > 0), merkle.digest(merkle.encoded(*bare)))
    manifest = merkle.merkle_manifest(docs, columns, also={"tampered": tampered})
    return merkle.verified(manifest, F.coalesce("tampered", "leaf")).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", "verified",
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return phrases.collocations(_read(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of all documents under the policy for prose, and what the base policy decides."""
    ledger = rule_ledger.apply_policy(rule_ledger.ledger(_read(spark, sf_dir, "documents")), rule_ledger.PROSE)
    return ledger.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(rule_ledger.BASE.mask)) != 0).alias("base_failed"), "kept", "failed",
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_packing,
        op3_exact_dedup,
        op4_mixing,
        op5_embedding_dedup,
        op6_quality,
        op7_lm_scoring,
        op8_token_files,
        op9_token_counts,
        op10_jaccard_join,
        op11_merkle_manifest,
        op12_collocations,
        op13_quality_rules,
    )
}


def _merkle_sql(levels: int = 16, top_levels: int = 8) -> str:
    """The manifest level by level, for up to 3 ** levels documents of a source and 3 ** top_levels sources."""
    enc = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    head = f"{enc('doc_id')} || {enc('source')} || {enc('lang')} || {enc('n_chars')}"
    parts = [
        f"""d AS (
            SELECT doc_id, source, sha256({head} || {enc('text')}) AS leaf,
                   sha256({head} || {enc("replace(text, chr(10), '')")}) AS bare,
                   xor(4294967295, list_reduce(list_concat([4294967295], list_transform(
                           string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                       lambda a, b: list_reduce(list_concat([xor(a, b)], range(0, 8)),
                           lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) AS crc
            FROM documents
        )""",
        """n0 AS (
            SELECT doc_id, source, leaf, bare, crc, leaf AS d,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
                   count(*) OVER (PARTITION BY source) AS m
            FROM d
        )""",
        "f0 AS (SELECT *, CASE WHEN crc % 2 = 0 THEN bare ELSE leaf END AS v, '' AS proof FROM n0)",
    ]

    def grow(n: str, f: str, group: str, count: int) -> None:
        for i in range(count):
            run = f"OVER (PARTITION BY {group}, p // 3 ORDER BY p ROWS BETWEEN"
            parts.append(
                f"""{n}{i + 1} AS (
                    SELECT {group}, p // 3 AS p, (any_value(m) + 2) // 3 AS m,
                           CASE WHEN any_value(m) > 1 THEN sha256(string_agg(d, '' ORDER BY p)) ELSE any_value(d) END AS d
                    FROM {n}{i} GROUP BY {group}, p // 3
                ), {n}s{i} AS (
                    SELECT {group}, p, m > 1 AS open,
                           coalesce(string_agg(d, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                           coalesce(string_agg(d, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
                    FROM {n}{i}
                ), {f}{i + 1} AS (
                    SELECT f.* REPLACE (CASE WHEN s.open THEN sha256(s.l || f.v || s.r) ELSE f.v END AS v,
                                        CASE WHEN s.open THEN f.proof || s.l || s.r ELSE f.proof END AS proof, f.p // 3 AS p)
                    FROM {f}{i} f JOIN {n}s{i} s ON f.{group} IS NOT DISTINCT FROM s.{group} AND f.p = s.p
                )"""
            )

    grow("n", "f", "source", levels)
    parts.append(
        f"""t0 AS (
            SELECT 0 AS one, source, d, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS p, count(*) OVER () AS m
            FROM n{levels}
        ), u0 AS (
            SELECT f.doc_id, f.leaf, t.d AS subroot, f.v, f.proof, t.p, 0 AS one
            FROM f{levels} f JOIN t0 t ON f.source IS NOT DISTINCT FROM t.source
        )"""
    )
    grow("t", "u", "one", top_levels)
    return (
        "WITH "
        + ", ".join(parts)
        + f""" SELECT u.doc_id, u.leaf, u.subroot, t.d AS root, sha256(u.proof) AS proof_sha256,
                     u.v AS folded_root, u.v = t.d AS verified
              FROM u{top_levels} u, t{top_levels} t"""
    )


def _ledger_sql() -> str:
    """The measurements and rules; windows are compared as texts."""
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {r.mask} ELSE 0 END" for r in rule_ledger.RULES)
    return rf"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents
        ), w AS (
            SELECT row, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
                   list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
            FROM d
        ), g AS (
            SELECT row, i, array_to_string(words[i:i + 7], ' ') AS own
            FROM (SELECT row, words, unnest(range(1, len(words) - 6)) AS i FROM w)
        ), twice AS (
            SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, own) AS n FROM g) WHERE n > 1
        ), covered AS (
            SELECT row, count(DISTINCT i + k) AS n FROM (SELECT row, i, unnest(range(0, 8)) AS k FROM twice) GROUP BY row
        ), m AS (
            SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
                   len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
                   len(list_distinct(words)) AS n_distinct_words,
                   len(list_filter(words, lambda x: length(x) > 1 AND x = upper(x) AND x <> lower(x))) AS n_capital_words,
                   coalesce(c.n, 0) AS n_repeat_words
            FROM w LEFT JOIN covered c USING (row)
        ), b AS (
            SELECT *, CAST({bits} AS BIGINT) AS failed FROM m
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed,
               n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
               failed & {rule_ledger.PROSE.mask} = 0 AS kept
        FROM b
    """


ORACLE = {
    "op3_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM t
    """,
    "op4_mixing": r"""
        WITH d AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
                   row_number() OVER (ORDER BY source NULLS LAST) AS place
            FROM d GROUP BY source
        ), r AS (
            SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS ratio,
                   CAST(1.5 AS DOUBLE) * (SELECT sum(source_size) FROM s) AS budget,
                   (SELECT sum(weight) FROM s) AS weights
            FROM s
        ), l AS (
            SELECT *, row_number() OVER o AS rank,
                   (budget - CAST(coalesce(sum(2 * source_size) OVER b, 0) AS DOUBLE))
                       / (weights - coalesce(sum(weight) OVER b, 0)) AS level
            FROM r
            WINDOW o AS (ORDER BY ratio, place),
                   b AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), f AS (
            SELECT min_by(level, rank) AS level FROM l WHERE level <= ratio
        ), t AS (
            SELECT source, source_size,
                   CASE WHEN ratio < (SELECT level FROM f) THEN CAST(2 * source_size AS DOUBLE)
                        ELSE (SELECT level FROM f) * weight END AS target
            FROM l
        ), c AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS quota,
                   CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
                        ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS start
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
        )
        SELECT doc_id, size, source_size, target,
               greatest(least(quota - start, size), 0)
                   + greatest(least(quota - source_size - start, size), 0) AS taken
        FROM c
    """,
    "op5_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ), u AS (
            SELECT * FROM v
            WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.9
        ), reach(node, other) AS (
            SELECT a, b FROM links
            UNION
            SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
        )
        SELECT v.vec_id,
               (SELECT count(*) FROM links WHERE a = v.vec_id) AS n_links,
               least(v.vec_id, coalesce((SELECT min(other) FROM reach WHERE node = v.vec_id), v.vec_id)) AS component_id,
               v.vec_id = least(v.vec_id, coalesce((SELECT min(other) FROM reach WHERE node = v.vec_id), v.vec_id)) AS kept
        FROM v
    """,
    "op10_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), s AS (
            SELECT doc_id, list_distinct(
                CASE WHEN len(words) = 0 THEN []
                     WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
                     ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
                END) AS shingles
            FROM w
        ), e AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s
        ), pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
        ), reach(node, other) AS (
            SELECT a, b FROM pairs
            UNION
            SELECT r.node, p.b FROM reach r JOIN pairs p ON r.other = p.a
        )
        SELECT s.doc_id, len(s.shingles) AS n_shingles,
               least(s.doc_id, coalesce((SELECT min(other) FROM reach WHERE node = s.doc_id), s.doc_id)) AS component_id
        FROM s
    """,
    "op11_merkle_manifest": _merkle_sql(),
    "op12_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), w AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
        ), totals AS (
            SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang
        ), s AS (
            SELECT lang, words, unnest([1, 2, 3, 4]) AS size FROM w
        ), g AS (
            SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM s
        ), f AS (
            SELECT lang, size, words[i:i + size - 1] AS words, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30
        ), c AS (
            SELECT lang, size, words, a, unnest(range(1, size)) AS k FROM f WHERE size > 1
        ), cuts AS (
            SELECT c.lang, c.size, c.words, c.a, c.k, l.a AS l, r.a AS r,
                   CAST(CAST(2000000 AS HUGEINT) * c.a // (l.a + r.a) AS BIGINT) AS score
            FROM c JOIN f l ON l.lang = c.lang AND l.words = c.words[1:c.k]
                   JOIN f r ON r.lang = c.lang AND r.words = c.words[c.k + 1:c.size]
        ), best AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
        ), inner_ones AS (
            SELECT lang, a, words[i:i + n - 1] AS words
            FROM (SELECT lang, a, words, n, unnest(range(1, size - n + 2)) AS i
                  FROM (SELECT lang, a, words, size, unnest(range(2, size)) AS n FROM f WHERE size > 2))
        ), gone AS (
            SELECT DISTINCT b.lang, b.words FROM best b JOIN inner_ones i ON i.lang = b.lang AND i.words = b.words
            WHERE 100 * i.a >= 80 * b.a
        ), ranked AS (
            SELECT b.lang, array_to_string(b.words, ' ') AS phrase, b.a, b.l, b.r, b.score,
                   row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, array_to_string(b.words, ' ')) AS rank
            FROM best b ANTI JOIN gone g ON g.lang = b.lang AND g.words = b.words
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
    "op13_quality_rules": _ledger_sql(),
}
