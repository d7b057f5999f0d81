"""One query per operator over the given tables, and SQL where it can say the same."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curate.llm.divergence import divergence
from curate.llm.lexical import search
from curate.llm.packing import pack_documents
from curate.llm.pair_bpe import round_trip
from curate.llm.personal_data import find_personal_data
from curate.llm.preference import against_earlier_reply
from curate.llm.quality import judge_documents
from curate.llm.simhash import near_duplicates
from curate.llm.stream_dedup import exact_duplicates
from curate.llm.suffixes import without_repeats
from curate.llm.token_counts import count_tokens
from curate.llm.token_files import token_files
from curate.llm.toxicity import score_documents

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pair_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), VOCABULARY)


def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, each against itself with an earlier reply; the spans as text."""
    pairs = against_earlier_reply(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return pairs.withColumns({
        name: F.array_join(F.transform(name, lambda span: F.concat_ws(":", span["start"], span["end"])), ",")
        for name in ("chosen_trained", "rejected_trained")
    })


def op3_isolation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), distance=2, shingle=3, seed=42)


def op5_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir), VOCABULARY, end_id=2)


def op6_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_pretoken_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(documents(spark, sf_dir), VOCABULARY, limit=512)


def op8_island_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), VOCABULARY, capacity=1024, end_id=2)


def op9_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(documents(spark, sf_dir))


def op10_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/documents.parquet"
    return exact_duplicates(spark, path, spark.read.parquet(path).schema).drop("file", "row")


def op11_term_at_a_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=10)


def op12_two_stage_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each text; spans and rest as numbers and a digest."""
    return without_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_pointer_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir), least_docs=30, ranks=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    function.__name__: function
    for function in (
        op1_pair_bpe, op2_preference_pairs, op3_isolation_rules, op4_pigeonring, op5_id_planes, op6_nnpu_toxicity, op7_pretoken_counts,
        op8_island_packing, op9_weak_supervision, op10_stream_dedup,
        op11_term_at_a_time, op12_two_stage_suffixes, op13_pointer_sort,
    )
}
ORACLES: dict[str, str] = {
    "op2_preference_pairs": r"""
        WITH turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
                coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
        ), replies AS (
            SELECT *, lag(text) OVER (PARTITION BY conv_id ORDER BY n) AS earlier,
                n = max(n) OVER (PARTITION BY conv_id) AS is_last
            FROM turns WHERE role = 'assistant'
        ), last AS (
            SELECT conv_id, n AS place, earlier, text AS reply FROM replies WHERE is_last
        ), sides AS (
            SELECT t.conv_id, 'chosen' AS side, n, role, text, l.place, l.earlier, l.reply
            FROM turns t LEFT JOIN last l ON l.conv_id = t.conv_id
            UNION ALL
            SELECT t.conv_id, 'rejected', n, role, CASE WHEN n = l.place THEN l.earlier ELSE text END, l.place, l.earlier, l.reply
            FROM turns t LEFT JOIN last l ON l.conv_id = t.conv_id
            WHERE l.place IS NULL OR l.earlier IS NOT NULL OR n < l.place
        ), parted AS (
            SELECT *, place IS NULL OR earlier = reply OR n < place AS shared,
                concat('<|im_start|>', role, chr(10), text, '<|im_end|>', chr(10)) AS line,
                length(role) + 13 AS head, length(role) + length(text) + 24 AS size
            FROM (SELECT conv_id, side, n, role, text, place, earlier, reply FROM sides)
        ), placed AS (
            SELECT *, sum(size) OVER (PARTITION BY conv_id, side, coalesce(shared, false) ORDER BY n) - size AS begins FROM parted
        )
        SELECT conv_id,
            CAST(count(*) FILTER (side = 'chosen' AND coalesce(shared, false)) AS INT) AS prompt_turns,
            coalesce(string_agg(line, '' ORDER BY n) FILTER (side = 'chosen' AND coalesce(shared, false)), '') AS prompt,
            coalesce(string_agg(line, '' ORDER BY n) FILTER (side = 'chosen' AND NOT coalesce(shared, false)), '') AS chosen,
            coalesce(string_agg(line, '' ORDER BY n) FILTER (side = 'rejected' AND NOT coalesce(shared, false)), '') AS rejected,
            coalesce(string_agg(concat(CAST(begins + head AS BIGINT), ':', CAST(begins + size AS BIGINT)), ',' ORDER BY n)
                FILTER (side = 'chosen' AND role = 'assistant' AND NOT coalesce(shared, false)), '') AS chosen_trained,
            coalesce(string_agg(concat(CAST(begins + head AS BIGINT), ':', CAST(begins + size AS BIGINT)), ',' ORDER BY n)
                FILTER (side = 'rejected' AND role = 'assistant' AND NOT coalesce(shared, false)), '') AS rejected_trained,
            coalesce(bool_or(NOT coalesce(shared, false)), false) AS differs
        FROM placed GROUP BY conv_id
    """,
    "op10_stream_dedup": r"""
        WITH texts AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
        ), named AS (
            SELECT doc_id, sha256(text) AS text_sha256, min(doc_id) OVER (PARTITION BY text) AS keep_id,
                count(*) OVER (PARTITION BY text) AS group_size
            FROM texts
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM named
    """,
    "op11_term_at_a_time": r"""
        WITH terms AS (
            SELECT row, doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)
        ), sizes AS (
            SELECT row, any_value(doc_id) AS doc_id, count(*) AS n FROM terms GROUP BY row
        ), whole AS (
            SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes
        ), postings AS (
            SELECT row, term, count(*) AS tf FROM terms GROUP BY row, term
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM postings, whole GROUP BY term
        ), asked AS (
            SELECT item, any_value(item_id) AS item_id, term, count(*) AS times FROM (
                SELECT item, item_id, unnest(regexp_extract_all(
                    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)
            ) GROUP BY item, term
        ), scored AS (
            SELECT item, any_value(item_id) AS item_id, any_value(doc_id) AS doc_id, CAST(sum(
                times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words)))
            ) AS BIGINT) AS score
            FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (row), whole
            GROUP BY item, row
        ), ranked AS (
            SELECT item_id, doc_id, score,
                CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op13_pointer_sort": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), words AS (
            SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
        ), kept AS (
            SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 30
        ), counts AS (
            SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term
        ), groups AS (
            SELECT lang, source, coalesce(c.n, 0) AS n, coalesce(v.terms, 0) AS terms
            FROM (SELECT DISTINCT lang, source FROM docs)
            LEFT JOIN (SELECT lang, source, sum(n) AS n FROM counts GROUP BY lang, source) c USING (lang, source)
            LEFT JOIN (SELECT lang, count(*) AS terms FROM kept GROUP BY lang) v USING (lang)
        ), shares AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 5)) // (g.n + 5 * g.terms) AS p
            FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
        ), langs AS (
            SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (total + 5 * terms) AS q
            FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY lang, term)
            JOIN (SELECT lang, sum(n) AS total, max(terms) AS terms FROM groups GROUP BY lang) USING (lang)
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                CAST(coalesce(sum(abs(s.p - t.p)), 0) AS BIGINT) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN shares s ON s.lang = a.lang AND s.source = a.source
            LEFT JOIN shares t ON t.lang = b.lang AND t.source = b.source AND t.term = s.term
            WHERE s.term IS NULL OR t.term IS NOT NULL
            GROUP BY a.lang, a.source, b.source
        ), telling AS (
            SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value
            FROM shares JOIN langs USING (lang, term) WHERE n > 0 AND p > q
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM telling)
        )
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
    """,
}
