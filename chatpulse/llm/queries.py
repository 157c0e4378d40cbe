"""The registered queries of this package and the SQL for those that have one."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from chatpulse.llm import (
    chat_tree,
    decontaminate,
    language_id,
    packing,
    ranked_search,
    secret_scan,
    simhash,
    spelling,
    token_counts,
    toxicity,
    url_filter,
    vector_search,
    winnowing,
)
from chatpulse.llm.common import documents, ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A conversation that is made of the template's own marks.
MARKED = "\\### Assistant: </turn> ok"


def op1_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", MARKED), (-7, 1, "assistant", MARKED)], known.schema)
    forest = chat_tree.format_chats(
        known.union(more),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )
    return chat_tree.digests(forest)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select(
        "doc_id", simhash.fingerprint_text(found["fp"]).alias("fingerprint"), "component_id"
    )


def _joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir).select("doc_id", "text"))
    spans = F.col("spans")

    def of(*kinds: str) -> Column:
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    base = [rule.kind for rule in secret_scan.BASE_RULES]
    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base),
        F.sha2(_joined(of(*base)), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(documents(spark, sf_dir), model)


def op8_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edit_survey(documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


URL_RULES = (
    url_filter.Rule(url_filter.ALLOW, "org/"),
    url_filter.Rule(url_filter.BLOCK, "example.org/es/"),
    url_filter.Rule(url_filter.BLOCK, "example.org/en/1"),
    url_filter.Rule(url_filter.ALLOW, "com/fr/"),
    url_filter.Rule(url_filter.BLOCK, "com/de/"),
)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op13_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest(_table(spark, sf_dir, "embeddings"))


Query = Callable[[SparkSession, str], DataFrame]


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _shipped(query)
    for query in (
        op1_chat_tree,
        op2_simhash,
        op3_secrets,
        op4_decontaminate,
        op5_language_id,
        op6_toxicity,
        op7_token_counts,
        op8_winnowing,
        op9_packing,
        op10_url_filter,
        op11_spelling,
        op12_ranked_search,
        op13_vector_search,
    )
}

ORACLE: dict[str, str] = {
    "op4_decontaminate": """
        WITH split AS (
            SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+') AS words
            FROM documents
            UNION ALL
            SELECT 'i', item_id, regexp_extract_all(lower(coalesce(text, '')), '[\\p{L}\\p{N}_]+') FROM benchmark
        ),
        shingles AS (
            SELECT DISTINCT kind, id, unnest(
                CASE WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
                     WHEN len(words) <= 5 THEN [array_to_string(words, ' ')]
                     ELSE list_transform(range(1, len(words) - 3), lambda i : array_to_string(words[i : i + 4], ' '))
                END) AS shingle
            FROM split
        ),
        sizes AS (SELECT id AS item_id, count(*) AS n_shingles FROM shingles WHERE kind = 'i' GROUP BY id),
        shared AS (
            SELECT d.id AS doc_id, i.id AS item_id, count(*) AS shared
            FROM shingles d JOIN shingles i ON d.kind = 'd' AND i.kind = 'i' AND d.shingle = i.shingle
            GROUP BY d.id, i.id
        )
        SELECT doc_id, item_id, n_shingles, shared, CAST(shared AS DOUBLE) / n_shingles AS containment
        FROM shared JOIN sizes USING (item_id) WHERE shared >= 0.8 * n_shingles
    """,
    "op11_spelling": """
        WITH RECURSIVE runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
            GROUP BY ALL
        ),
        digits AS (
            SELECT *, hex(encode(concat(doc_id, ':', run))) AS digits FROM runs WHERE length(run) >= 5
        ),
        -- crc32 by half bytes, the lower half of each byte first.
        sums AS (
            SELECT *, xor(4294967295, list_reduce(
                list_transform(range(length(digits)),
                    lambda i : CAST(strpos('0123456789ABCDEF', digits[CAST(xor(i, 1) AS BIGINT) + 1]) - 1 AS BIGINT)),
                lambda c, x : xor(c >> 4, [0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
                    3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108][(xor(c, x) & 15) + 1]),
                4294967295)) AS crc
            FROM digits
        ),
        counted AS (
            SELECT CASE WHEN crc % 97 = 0 THEN run[1 : crc % length(run)] || run[crc % length(run) + 2 :] ELSE run END AS word,
                CAST(sum(times) AS BIGINT) AS n
            FROM sums GROUP BY word
        ),
        words AS (SELECT word, n FROM counted WHERE length(word) >= 5 AND n >= 3),
        shorter AS (
            SELECT word, n, i, word[1 : i] || word[i + 2 :] AS rest
            FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
        ),
        near AS (
            SELECT a.word AS word, b.word AS other, b.n AS other_n
            FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.rest = b.word
        ),
        best AS (
            SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word
        ),
        firsts AS (
            SELECT word, n_near, most, min(other) AS other
            FROM best JOIN near USING (word) WHERE other_n = most GROUP BY ALL
        ),
        forms AS (
            SELECT word, n, CASE WHEN most >= 2 * n THEN other END AS form, CASE WHEN most >= 2 * n THEN most END AS form_n,
                coalesce(n_near, 0) AS n_near
            FROM words LEFT JOIN firsts USING (word)
        ),
        paths AS (
            SELECT word, word AS at FROM forms
            UNION ALL
            SELECT paths.word, forms.form FROM paths JOIN forms ON paths.at = forms.word WHERE forms.form IS NOT NULL
        ),
        roots AS (
            SELECT paths.word, paths.at AS root FROM paths JOIN forms ON paths.at = forms.word WHERE forms.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
    """,
    "op12_ranked_search": """
        WITH split AS (
            SELECT 'd' AS kind, doc_id AS id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
            UNION ALL
            SELECT 'i', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark
        ),
        terms AS (
            SELECT kind, id, term, count(*) AS tf
            FROM (SELECT kind, id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM split)
            GROUP BY ALL
        ),
        sizes AS (SELECT id, CAST(sum(tf) AS BIGINT) AS size FROM terms WHERE kind = 'd' GROUP BY id),
        whole AS (SELECT count(*) AS n, CAST(sum(size) AS BIGINT) AS total FROM sizes),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM terms, whole WHERE kind = 'd' GROUP BY term, n
        ),
        scores AS (
            SELECT i.id AS item_id, d.id AS doc_id,
                CAST(sum(i.tf * w * ((1000000000 * d.tf) // (1000 * d.tf + 12 * (75 + (25 * size * n) // total)))) AS BIGINT) AS score
            FROM terms i JOIN terms d ON i.kind = 'i' AND d.kind = 'd' AND i.term = d.term
            JOIN weights ON weights.term = i.term JOIN sizes ON sizes.id = d.id, whole
            GROUP BY i.id, d.id
        ),
        ranked AS (
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
            FROM scores WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
    """,
}
