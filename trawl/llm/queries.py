"""The registered queries of the training-data operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.llm import alignment, dac, exact_search, line_dedup, lsh_forest, mixing, packing, prefix_trie, quality, secret_scan, simhash, warc
from trawl.llm import license_scan as licenses
from trawl.llm.common import read
from trawl.session import scratch_path


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return licenses.license_scan(docs).select("doc_id", *licenses.summary(F.col("license_scan")))


def op2_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return warc.derive(warc.responses_from_pages(pages))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    rows = rows.select("vec_id", exact_search.scaled(F.col("embedding")).alias("vec"))
    return exact_search.exact_top_k(rows, rows.where("vec_id % 100 = 0"), 10)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents", "doc_id", "text"))


def op5_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return lsh_forest.nearest(rows, rows.where("vec_id % 20 = 0"), 20)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_scan(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", *secret_scan.summary(F.col("secret_scan")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.fit_on_kept_labels(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    scored = docs.select("doc_id", quality.held_out().alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    docs = docs.withColumn("domain", F.expr(mixing.domain()))
    taken = mixing.mix_sources(docs, mixing.CORPUS_MIX)
    return taken.select("doc_id", "domain", "lang", "source", F.col("epoch").cast("bigint").alias("epoch"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read(spark, sf_dir, "documents", "doc_id", "text"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(prefix_trie.turns_of(conversations)))


def op12_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-codes")
    dac.write_ids(read(spark, sf_dir, "documents", "doc_id", "text"), path)
    return dac.read_documents(spark, path)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.cross_alignment(read(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_warc_derivatives": op2_warc_derivatives,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_lsh_forest": op5_lsh_forest,
    "op6_simhash": op6_simhash,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality": op8_quality,
    "op9_mixing": op9_mixing,
    "op10_line_dedup": op10_line_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_codes": op12_token_codes,
    "op13_token_alignment": op13_token_alignment,
}



def _filled(level: str, parent: str, name: str) -> str:
    """One level of the budget: children ``(parent path, name, cap, weight, budget)`` in ``level``."""
    group = f"PARTITION BY {parent}" if parent else ""
    order = f"ORDER BY CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE), {name}"
    return f"""(
        SELECT * EXCLUDE (budget, owned, r, w, share, left_over),
               share + CASE WHEN owned = 0 AND row_number() OVER ({group} ORDER BY left_over DESC, {name})
                                 <= budget - sum(share) OVER ({group}) THEN 1 ELSE 0 END AS budget
        FROM (
            SELECT *, CASE WHEN owned = 1 THEN cap ELSE (r * weight) // w END AS share,
                   CASE WHEN owned = 1 THEN -1 ELSE (r * weight) % w END AS left_over
            FROM (
                SELECT * EXCLUDE (own),
                       budget - sum(CASE WHEN owned = 1 THEN cap ELSE 0 END) OVER ({group}) AS r,
                       sum(CASE WHEN owned = 0 THEN weight ELSE 0 END) OVER ({group}) AS w
                FROM (
                    SELECT *, min(own) OVER ({group} {order} ROWS UNBOUNDED PRECEDING) AS owned
                    FROM (
                        SELECT *, CASE WHEN (budget - coalesce(sum(cap) OVER ({group} {order}
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
                                 >= cap * sum(weight) OVER ({group} {order}
                                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                               THEN 1 ELSE 0 END AS own
                        FROM {level} WHERE weight > 0 AND cap > 0
                    )
                )
            )
        )
    )"""


_MIXING_SQL = f"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, lang, source,
               'd' || CAST(ascii(md5(coalesce(source, ''))) % 4 AS VARCHAR) AS domain,
               coalesce(lang, '') AS p1, coalesce(source, '') AS p2
        FROM documents
    ), counted AS (
        SELECT doc_id, lang, source, domain, domain AS p0, p1, p2,
               CAST(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS HUGEINT) AS n
        FROM d
    ), leaves AS (
        SELECT p0, p1, p2, CAST(sum(n) AS HUGEINT) AS tokens, CAST(sum(n) AS HUGEINT) * 4 AS cap
        FROM counted GROUP BY ALL
    ), l0 AS (
        SELECT p0, CAST(sum(cap) AS HUGEINT) AS cap,
               CAST(CASE p0 WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END AS HUGEINT) AS weight,
               (SELECT CAST(sum(tokens) AS HUGEINT) FROM leaves) AS budget
        FROM leaves GROUP BY p0
    ), b0 AS (SELECT * FROM {_filled("l0", "", "p0")}
    ), l1 AS (
        SELECT p0, p1, CAST(sum(leaves.cap) AS HUGEINT) AS cap,
               CAST(CASE p1 WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS HUGEINT) AS weight,
               any_value(b0.budget) AS budget
        FROM leaves JOIN b0 USING (p0) GROUP BY p0, p1
    ), b1 AS (SELECT * FROM {_filled("l1", "p0", "p1")}
    ), l2 AS (
        SELECT p0, p1, p2, CAST(leaves.cap AS HUGEINT) AS cap, CAST(1 AS HUGEINT) AS weight, b1.budget
        FROM leaves JOIN b1 USING (p0, p1)
    ), b2 AS (SELECT * FROM {_filled("l2", "p0, p1", "p2")}
    ), spent AS (
        SELECT p0, p1, p2,
               CASE WHEN tokens > 0 THEN coalesce(budget, 0) // tokens ELSE 0 END AS whole,
               CASE WHEN tokens = 0 THEN 0 WHEN coalesce(budget, 0) % tokens = 0 THEN -1
                    ELSE budget % tokens END AS rest
        FROM leaves LEFT JOIN b2 USING (p0, p1, p2)
    ), placed AS (
        SELECT *, sum(n) OVER (PARTITION BY p0, p1, p2 ORDER BY key) AS upto
        FROM (
            SELECT *, md5('17:' || CAST(CAST(whole AS BIGINT) AS VARCHAR) || ':' || coalesce(CAST(doc_id AS VARCHAR), ''))
                   AS key
            FROM counted JOIN spent USING (p0, p1, p2)
        )
    ), copies AS (
        SELECT *, unnest(range(0, CAST(whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS BIGINT))) AS epoch FROM placed
    )
    SELECT doc_id, domain, lang, source, CAST(epoch AS BIGINT) AS epoch FROM copies
"""

# Rarest words first by the true count of sets that hold a word; any order gives the same pairs.
_LINES_SQL = """
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    lines AS (
        SELECT doc_id, unnest(range(len(parts))) AS line_no, unnest(parts) AS line, len(parts) AS n_lines FROM d
    ), sets AS (
        SELECT doc_id, line_no, list_sort(list_distinct(regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+'))) AS words
        FROM lines
    ), worded AS (SELECT * FROM sets WHERE len(words) > 0
    ), classes AS (
        SELECT words, min(struct_pack(d := doc_id, l := line_no)) AS place, row_number() OVER () AS c FROM worded GROUP BY words
    ), words AS (SELECT c, unnest(words) AS w FROM classes
    ), counts AS (SELECT w, count(*) AS n FROM words GROUP BY w
    ), ordered AS (
        SELECT c, w, row_number() OVER (PARTITION BY c ORDER BY n, w) AS pos FROM words JOIN counts USING (w)
    ), prefixes AS (
        SELECT c, w FROM ordered JOIN classes USING (c)
        WHERE pos <= len(words) - CAST(ceil(len(words) * 4 / 5.0) AS INTEGER) + 1
    ), pairs AS (
        SELECT DISTINCT a.c AS a, b.c AS b FROM prefixes AS a JOIN prefixes AS b ON a.w = b.w AND a.c <> b.c
    ), gone AS (
        SELECT DISTINCT b.c FROM pairs JOIN classes AS a ON pairs.a = a.c JOIN classes AS b ON pairs.b = b.c
        WHERE a.place < b.place
          AND 9 * len(list_intersect(a.words, b.words)) >= 4 * (len(a.words) + len(b.words))
    ), removed AS (
        SELECT doc_id, line_no FROM worded JOIN classes USING (words)
        WHERE NOT (place.d = doc_id AND place.l = line_no) OR c IN (SELECT c FROM gone)
    )
    SELECT d.doc_id, CAST(len(parts) AS BIGINT) AS n_lines, coalesce(r.n, 0) AS n_removed, coalesce(r.l, '') AS removed_lines
    FROM d LEFT JOIN (
        SELECT doc_id, count(*) AS n, string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) AS l
        FROM removed GROUP BY doc_id
    ) AS r ON d.doc_id = r.doc_id
"""

# FLOOR of a product with a power of two is exact, and so are the integer products.
ORACLE: dict[str, str] = {
    "op3_exact_top_k": """
        WITH v AS (
            SELECT DISTINCT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS vec
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, q.vec AS query, c.vec_id AS vec_id,
                   CAST(list_sum([q.vec[i] * c.vec[i] FOR i IN range(1, len(q.vec) + 1)]) AS BIGINT) AS score
            FROM v AS q JOIN v AS c ON len(q.vec) = len(c.vec) AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id, query ORDER BY score DESC, vec_id) AS INTEGER)
                       AS rank, vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op9_mixing": _MIXING_SQL,
    "op10_line_dedup": _LINES_SQL,
}
