"""One query for each operator, with production parameters, and SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasieve.functions.staging import new_path
from terrasieve.llm import chat_format
from terrasieve.llm.byte_bpe import round_trip
from terrasieve.llm.conversation_trie import prefix_trie
from terrasieve.llm.exact_dedup import exact_dedup
from terrasieve.llm.hamming import binary_codes, hamming_topk
from terrasieve.llm.langid import identify, learn_languages
from terrasieve.llm.merkle import tampering
from terrasieve.llm.minhash import near_duplicates
from terrasieve.llm.packing import pack
from terrasieve.llm.quality import learn_quality, score_quality
from terrasieve.llm.sharding import balanced_shards
from terrasieve.llm.token_store import read_store, write_store
from terrasieve.llm.toxicity import learn_toxicity, score_toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, size=2048)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"), shards=16)


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-store")
    write_store(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_store(spark, path)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, learn_quality(docs, table(spark, sf_dir, "labels"), cut=0.3, mod=5, remainder=0), mod=5, remainder=0)


def op6_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = binary_codes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", bits=64)
    return hamming_topk(codes, codes.filter("id % 20 = 0"), k=10, bits=64)


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn_languages(docs, mod=4, remainder=2), mod=4, remainder=2)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, learn_toxicity(docs, table(spark, sf_dir, "labels"), mod=3, remainder=1), cut=0.7, mod=3, remainder=1)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("key")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tampering(table(spark, sf_dir, "documents"), one_in=5)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok")
    odd = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    return chat_format.round_trip(given.unionByName(odd))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_packing, op2_byte_bpe, op3_sharding, op4_token_store, op5_quality, op6_hamming_topk, op7_langid, op8_toxicity, op9_exact_dedup, op10_minhash, op11_merkle, op12_prefix_trie, op13_chat_format)
}

SQL: dict[str, str] = {
    "op6_hamming_topk": """
        WITH c AS (SELECT vec_id AS id, list_transform(embedding, lambda v: CASE WHEN v > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings WHERE len(embedding) = 64),
        p AS (SELECT q.id AS query_id, r.id AS id, list_sum(list_transform(list_zip(q.bits, r.bits), lambda x: CASE WHEN x[1] <> x[2] THEN 1 ELSE 0 END))::BIGINT AS distance
              FROM c q JOIN c r ON q.id % 20 = 0 AND q.id <> r.id),
        k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM p)
        SELECT query_id, rank, id, distance FROM k WHERE rank <= 10
    """,
    "op9_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
        r AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS rn,
                     first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id,
                     count(*) OVER (PARTITION BY norm) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM r
    """,
    "op10_minhash": r"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) = 1 THEN ws
                     ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS g FROM w),
        n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY 1),
        j AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
        e AS (SELECT a, b FROM j JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
        l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        reach(doc_id, spot) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, l.b FROM reach r JOIN l ON l.a = r.spot)
        SELECT n.doc_id, n.n AS n_shingles, min(r.spot) AS component_id, n.doc_id = min(r.spot) AS kept FROM n JOIN reach r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n
    """,
}


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII text in SQL: each byte's code (from 1000 up), then eight shifts."""
    steps = f"list_concat([4294967295], flatten(list_transform(string_split({text}, ''), lambda x: list_concat([1000 + ascii(x)], [-1, -1, -1, -1, -1, -1, -1, -1]))))"
    return f"xor(list_reduce({steps}, lambda c, x: CASE WHEN x >= 1000 THEN xor(c, x - 1000) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295)"


def _merkle_sql(levels: int = 6) -> str:
    """Trees of at most 16^levels leaves: each level's runs, each leaf's place in them, and what it folds to."""
    field = lambda c: f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    out = f"""d AS (SELECT doc_id, source, {leaf("text")} AS leaf, CASE WHEN doc_id IS NOT NULL AND {_crc32_sql("doc_id::VARCHAR")} % 5 = 0 THEN {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} END AS tampered FROM documents),
        a0 AS (SELECT source AS s, leaf AS h, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n, doc_id, tampered FROM d)"""

    def climb(prefix: str) -> str:
        more = ""
        for k in range(levels):
            more += f""",
        {prefix}r{k} AS (SELECT s, i // 16 AS j, any_value(n) AS n, list(h ORDER BY i) AS hs FROM {prefix}{k} GROUP BY s, i // 16),
        {prefix}{k + 1} AS (SELECT s, j AS i, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h, (n + 15) // 16 AS n FROM {prefix}r{k})"""
        return more

    out += climb("a") + f""",
        t0 AS (SELECT 0 AS s, h, row_number() OVER (ORDER BY s NULLS FIRST) - 1 AS i, count(*) OVER () AS n, s AS source FROM a{levels})""" + climb("t")
    joins = "".join(f" JOIN ar{k} ON ar{k}.s IS NOT DISTINCT FROM a0.s AND ar{k}.j = a0.i // {16 ** (k + 1)}" for k in range(levels))
    joins += " JOIN t0 ON t0.source IS NOT DISTINCT FROM a0.s" + "".join(f" JOIN tr{k} ON tr{k}.j = t0.i // {16 ** (k + 1)}" for k in range(levels))
    steps = [(f"ar{k}", f"a0.i // {16**k} % 16") for k in range(levels)] + [(f"tr{k}", f"t0.i // {16**k} % 16") for k in range(levels)]
    proof = " || ".join(f"CASE WHEN {r}.n > 1 THEN array_to_string({r}.hs[:{at}], '') || array_to_string({r}.hs[{at} + 2:], '') ELSE '' END" for r, at in steps)
    out += f""",
        p AS (SELECT a0.doc_id, a0.h AS leaf, t0.h AS subroot, sha256({proof}) AS proof_sha256, coalesce(tampered, a0.h) AS f, [{", ".join(f"{{'n': {r}.n, 'at': {at}, 'hs': {r}.hs}}" for r, at in steps)}] AS steps FROM a0 {joins}),
        f0 AS (SELECT * FROM p)"""
    for k in range(2 * levels):
        x = f"steps[{k + 1}]"
        out += f""",
        f{k + 1} AS (SELECT * REPLACE (CASE WHEN {x}.n > 1 THEN sha256(array_to_string({x}.hs[:{x}.at], '') || f || array_to_string({x}.hs[{x}.at + 2:], '')) ELSE f END AS f) FROM f{k})"""
    return f"WITH {out} SELECT doc_id, leaf, subroot, t{levels}.h AS root, proof_sha256, f AS folded_root, f = t{levels}.h AS verified FROM f{2 * levels}, t{levels}"


SQL["op11_merkle"] = _merkle_sql()
SQL["op12_prefix_trie"] = f"""
    WITH o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM conversations WHERE conv_id IS NOT NULL),
    m AS (SELECT DISTINCT c, {_crc32_sql("c::VARCHAR")} % 6 AS h FROM o),
    b AS (SELECT m.c, 0 AS own, o.i, role, text FROM m JOIN o ON o.c = m.c - m.c % 100 AND o.i <= m.h UNION ALL SELECT m.c, 1, o.i, role, text FROM m JOIN o ON o.c = m.c AND o.i > m.h),
    t AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY own, i) AS d, sha256(length(role) || ':' || role || text) AS x FROM b),
    k AS (SELECT c, d, length(text) AS chars, string_agg(x, '') OVER (PARTITION BY c ORDER BY d) AS key FROM t UNION ALL SELECT c, 0, 0, '' FROM m),
    l AS (SELECT c, max(d) AS last FROM k GROUP BY 1),
    n AS (SELECT key, d, min(k.c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, coalesce(string_agg(CASE WHEN d = last THEN k.c::VARCHAR END, ',' ORDER BY k.c), '') AS ends FROM k JOIN l ON l.c = k.c GROUP BY 1, 2),
    z AS (SELECT n.*, (SELECT count(*) FROM n u WHERE u.d = n.d + 1 AND starts_with(u.key, n.key)) AS n_children FROM n),
    s AS (SELECT v.key, sum((u.n_children = 0)::INT)::BIGINT AS n_leaves, sum((u.n_convs - 1) * u.chars)::BIGINT AS saved_tokens FROM z v JOIN z u ON starts_with(u.key, v.key) GROUP BY 1)
    SELECT z.conv_id, z.d::BIGINT AS depth, p.conv_id AS parent_conv_id, z.n_convs, z.n_children, n_leaves, saved_tokens, sha256(z.ends) AS ends_sha256
    FROM z JOIN s ON s.key = z.key LEFT JOIN n p ON p.d = z.d - 1 AND p.key = left(z.key, 64 * (z.d - 1))
"""
SQL["op13_chat_format"] = r"""
    WITH o AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
    e AS (SELECT *, regexp_replace(regexp_replace(text, '#(\\*)## ', '#\\\1## ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g') AS raw,
        CASE WHEN role IN ('user', 'system', 'assistant') THEN length(role) WHEN role IN ('User', 'System', 'Assistant') OR starts_with(role, '\') OR regexp_matches(role, '#\\*## |<\\*/turn>|:\\* ')
             THEN 1 + length(regexp_replace(regexp_replace(regexp_replace(role, '#(\\*)## ', '#\\\1## ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g'), ':(\\*) ', ':\\\1 ', 'g')) ELSE length(role) END AS name FROM o),
    g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
                 coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS under, sum(4 + name + 2 + length(raw) + 8)::BIGINT AS formatted_chars FROM e GROUP BY 1)
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(under) AS loss_chars, sha256(under) AS loss_sha256, formatted_chars FROM g
"""
