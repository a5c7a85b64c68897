"""The registered queries of the operators in this folder, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import (
    chat_tree, chunk_divergence, es_mix, exact_blocks, hilbert_pack, lang_kn, phrase_graph, pii_boost, secret_cost,
    simhash_grid, topk_blocks, url_bloom, warc_zstd)
from shelfcast.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: Rules of the URL filter: verdict, host, path start.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Host labels of sites whose URLs are listed.
BAD_LABELS = ["spam-farm", "adult-x", "cheap-pills", "casino-win"]


@query("op1_exact_blocks", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op1(spark, sf_dir):
    return exact_blocks.exact_groups(table(spark, sf_dir, "documents")).drop("twins")


@query("op2_pii_boost")
def op2(spark, sf_dir):
    return pii_boost.personal_spans(table(spark, sf_dir, "documents"))


@query("op3_chat_tree")
def op3(spark, sf_dir):
    said = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    breaking = chat_tree.END + chat_tree.START + "assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", breaking), (-1, 1, "assistant", breaking)], said.schema)
    return chat_tree.read_back(*chat_tree.prefix_tree(said.unionByName(extra), vocabulary()), vocabulary())


@query("op4_language_kn")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    marked = lang_kn.identified(docs.select("doc_id", "text"), lang_kn.train_on_fold(docs))
    return marked.select("doc_id", lang_kn.held_out(marked).alias("held_out"), "lang_pred", "score", "rejected")


@query("op5_simhash_grid")
def op5(spark, sf_dir):
    classes = simhash_grid.near_classes(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op6_secret_cost")
def op6(spark, sf_dir):
    return secret_cost.secret_spans(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op7_url_bloom", """
WITH cut AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)
), parts AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw_host, rest FROM cut
), hosts AS (
    SELECT page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM parts
), rules(verdict, rule_host, rule_path) AS (
    VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), matched AS (
    SELECT h.*, r.verdict, r.rule_host || r.rule_path AS rule,
           row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.rule_host || r.rule_path) DESC) AS place,
           len(list_intersect(string_split(h.host, '.'), ['spam-farm', 'adult-x', 'cheap-pills', 'casino-win'])) > 0 AS bad
    FROM hosts h LEFT JOIN rules r ON (h.host = r.rule_host OR ends_with(h.host, '.' || r.rule_host))
         AND starts_with(h.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict, bad AS listed
FROM matched WHERE place = 1""")
def op7(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return url_bloom.judged(pages, RULES, url_bloom.listed_by_label(pages, BAD_LABELS))


@query("op8_hilbert_packing")
def op8(spark, sf_dir):
    return hilbert_pack.packed(table(spark, sf_dir, "documents"), vocabulary()).drop("ids")


@query("op9_mix_sources")
def op9(spark, sf_dir):
    return es_mix.mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_topk_blocks", """
WITH fine AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM fine q JOIN fine c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 10""")
def op10(spark, sf_dir):
    return topk_blocks.top_k(table(spark, sf_dir, "embeddings"))


@query("op11_chunk_divergence", r"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), kept AS (
    SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs) GROUP BY ALL HAVING count(*) >= 10
), counts AS (
    SELECT d.lang, d.source, d.term, count(*)::HUGEINT AS n
    FROM (SELECT lang, source, unnest(terms) AS term FROM docs) d JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
    SELECT g.lang, g.source, coalesce(v.kinds, 0) AS kinds, coalesce(t.total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN (SELECT lang, count(*) AS kinds FROM kept GROUP BY 1) v USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL) t USING (lang, source)
), shares AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (g.total + 2 * g.kinds)::HUGEINT AS p
    FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), langs AS (
    SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang))::HUGEINT AS q
    FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM counts GROUP BY ALL)
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
           CAST(coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
), terms AS (
    SELECT s.lang, s.source, 'term' AS part, s.term AS item, CAST((s.p - l.q) * (s.p - l.q) // (s.p + l.q) AS BIGINT) AS value
    FROM shares s JOIN langs l USING (lang, term) WHERE s.n > 0 AND s.p > l.q
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10""")
def op11(spark, sf_dir):
    return chunk_divergence.divergence(table(spark, sf_dir, "documents"))


@query("op12_warc_dictionary", """
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
named AS (
    SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS payload_digest,
           max(page_id) OVER (PARTITION BY body) AS keep_id FROM bodies
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keep_id THEN keep_id END AS refers_to
FROM named""")
def op12(spark, sf_dir):
    archive = scratch_path(spark, "warc")
    warc_zstd.write_archive(table(spark, sf_dir, "pages"), archive)
    return warc_zstd.read_archive(spark, archive, payloads=False).drop("url")


@query("op13_phrase_graph", r"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), words AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY 1
), occurring AS (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM pieces, range(1, 5) AS s(size) WHERE len(w) >= size
), counts AS (
    SELECT lang, size, phrase, count(*) AS f FROM occurring GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
    SELECT lang, size, phrase, f AS a, k, string_split(phrase, ' ') AS w
    FROM counts, range(1, 4) AS c(k) WHERE size > 1 AND k < size
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
           CAST(2000000::HUGEINT * c.a // (x.f + y.f)::HUGEINT AS BIGINT) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), held AS (
    SELECT DISTINCT s.lang, s.phrase FROM counts s JOIN counts g ON s.lang = g.lang AND s.size > 1 AND g.size > s.size
    AND contains(' ' || g.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * g.f >= 80 * s.f
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
FROM best b JOIN words USING (lang) ANTI JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase QUALIFY rank <= 2000""")
def op13(spark, sf_dir):
    return phrase_graph.collocations(table(spark, sf_dir, "documents"))
