"""The registered queries of the numbered operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dealgauge.llm import conversation_trie, language_id, lm_score, mixing, near_dedup, neighbours, packing, quality, spelling, substring_dedup, suffix_dedup, token_files, warc
from dealgauge.llm.scratch import Scratch, documents

#: Vocabulary of the packing query; a parameter of the operator.
TOKENIZER = "word_bpe_49k.json"
#: Vocabulary of the token files query.
BYTE_TOKENIZER = "byte_bpe_50k.json"
#: Words of the longest n-gram of the scoring query.
ORDER = 3
HELD_OUT = "pmod(crc32(cast(doc_id as string)), 4) = 2"


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicate_groups(documents(spark, folder)).select("doc_id", "n_shingles", "component_id", "kept")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.dedup_digest(documents(spark, folder))


def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup_digest(documents(spark, folder))


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    sized = documents(spark, folder).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mix_sizes(sized, Scratch(spark, "op4")).select("doc_id", "size", "source_size", "target", "taken")


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = F.coalesce(F.expr(HELD_OUT), F.lit(False))
    model = language_id.fit(docs, f"not coalesce({HELD_OUT}, false)")
    told = language_id.identify(docs.select("doc_id", "text"), model)
    return told.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(packing.cut_pieces(documents(spark, folder), public_tokenizers.path(TOKENIZER)))


def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score_documents(documents(spark, folder), ORDER)


def op8_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_pages(documents(spark, folder, "pages"))


def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = neighbours.usable(documents(spark, folder, "embeddings"), "vec_id", "embedding")
    return neighbours.nearest(rows, rows.filter("vec_id % 20 = 0"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(documents(spark, folder))


def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_files.token_files(documents(spark, folder), public_tokenizers.path(BYTE_TOKENIZER))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, folder))


def op13_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.prefix_trie(documents(spark, folder, "conversations"))


QUERIES = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_mixing": op4_mixing,
    "op5_language_id": op5_language_id,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_lm_score": op7_lm_score,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_quality_rules": op10_quality_rules,
    "op11_token_files": op11_token_files,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_prefix_trie": op13_conversation_prefix_trie,
}

def _crc32_sql(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text of characters below U+0080 or from U+00C0 to U+00FF, bit by bit."""
    shifts = "[" + ", ".join(["-1"] * 8) + "]"
    of_byte = "[CAST({} AS BIGINT)] || " + shifts
    narrow, wide = of_byte.format("ord(c)"), of_byte.format("195") + " || " + of_byte.format("ord(c) - 64")
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN ord(c) < 128 THEN {narrow} ELSE {wide} END))"
    return f"""xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {steps}),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END))"""


ORACLES: dict[str, str] = {
    "op12_spelling_variants": f"""
        WITH RECURSIVE runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL),
        hashed AS (SELECT run, n, {_crc32_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs),
        words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
                SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
                FROM hashed) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        cut AS (
            SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
            FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
        best AS (
            SELECT word, count(*) AS n_near, max(other_n) AS best_n, arg_min(other, (-other_n, other)) AS other FROM near GROUP BY word),
        formed AS (
            SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= 2 * w.n THEN b.other END AS form,
                   CASE WHEN b.best_n >= 2 * w.n THEN b.best_n END AS form_n
            FROM words w LEFT JOIN best b ON b.word = w.word),
        steps AS (
            SELECT word, word AS root FROM formed
            UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
        FROM formed f JOIN steps s ON s.word = f.word JOIN formed last ON last.word = s.root AND last.form IS NULL""",
    "op13_conversation_prefix_trie": f"""
        WITH own AS (
            SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                                 ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        cut AS (SELECT conv_id, turns, {_crc32_sql("CAST(conv_id AS VARCHAR)")} % 4 AS h FROM own),
        rebuilt AS (
            SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
            FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20),
        members AS (SELECT conv_id, turns, len(turns) AS length, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
        nodes AS (
            SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(length) = depth AS leaf,
                   (count(*) - 1) * CASE WHEN depth = 0 THEN 0
                       ELSE len(regexp_extract_all(any_value(turns[depth].text), '[^\x20\x09-\x0D]+')) END AS saved,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth), '')) AS ends
            FROM members GROUP BY turns[1:depth], depth),
        above AS (SELECT *, unnest(range(0, depth + 1)) AS top FROM nodes),
        subtrees AS (
            SELECT path[1:top] AS path, sum(saved) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves,
                   count(*) FILTER (WHERE depth = top + 1) AS n_children
            FROM above GROUP BY path[1:top], top)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, s.n_children, s.n_leaves,
               CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
        FROM nodes n JOIN subtrees s ON s.path = n.path
        LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]""",
    "op8_warc_revisits": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        r AS (SELECT payload, max(page_id) AS response FROM p WHERE strlen(payload) >= 1000 GROUP BY payload)
        SELECT p.page_id, CAST(strlen(p.payload) AS BIGINT) AS payload_bytes, sha1(p.payload) AS payload_digest,
               CASE WHEN r.response <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN r.response <> p.page_id THEN r.response END AS refers_to, TRUE AS digest_holds
        FROM p LEFT JOIN r ON r.payload = p.payload""",
}
