"""The operators as queries over whole tables, each beside its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import html_text, language_id, nearest, toxicity
from textloom.llm.centroids import CENTROIDS, ROUNDS, centroid_clusters
from textloom.llm.conversation_trie import prefix_trie
from textloom.llm.decontaminate import contained_items
from textloom.llm.license_scan import scan_licenses
from textloom.llm.lm_score import lm_scores
from textloom.llm.mixing import mixture
from textloom.llm.ngram_join import ngram_components
from textloom.llm.substring_dedup import remove_repeated
from textloom.llm.token_output import read_ids, write_ids
from textloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register ``function(spark, sf_dir)`` under its name."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

_OP1_SQL = rf"""
WITH docs AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS words FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS window_text
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs WHERE len(words) >= 13)
),
earliest AS (SELECT window_text, min(doc_id) AS low FROM windows GROUP BY window_text),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
    FROM windows JOIN earliest USING (window_text) WHERE low < doc_id
),
kept AS (
    SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS text, count(*) AS n
    FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs) w
    ANTI JOIN covered c ON w.doc_id = c.doc_id AND w.i = c.i
    GROUP BY w.doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""


@query(_OP1_SQL)
def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of 13 words that an earlier document has are cut out of all documents."""
    kept = remove_repeated(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


_OP2_SQL = rf"""
WITH RECURSIVE docs AS (
    SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS words FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM docs WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
),
links AS (
    SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * shared >= 80 * (x.n + y.n - shared)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a
)
SELECT d.doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM docs d JOIN reach r USING (doc_id) LEFT JOIN sizes s ON d.doc_id = s.doc_id GROUP BY d.doc_id
"""


@query(_OP2_SQL)
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents of similar word shingles."""
    return ngram_components(table(spark, folder, "documents"))


def tokenizer_file(name: str) -> str:
    """A file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def crc_of_id(modulus: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


@query()
def op3_token_output(spark: SparkSession, folder: str) -> DataFrame:
    """All texts as token ids in files, read back."""
    path = scratch_path(spark, "token-ids")
    write_ids(table(spark, folder, "documents"), path, tokenizer_file("byte_bpe_50k.json"))
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


_ALNUM_WORDS = "regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP4_SQL = f"""
WITH docs AS (SELECT doc_id, {_ALNUM_WORDS.format(_LOWER.format("text"))} AS words FROM documents WHERE text IS NOT NULL),
items AS (SELECT item_id, {_ALNUM_WORDS.format(_LOWER.format("text"))} AS words FROM benchmark WHERE text IS NOT NULL),
doc_shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM docs WHERE len(words) >= 5)
),
item_shingles AS (
    SELECT DISTINCT item_id, array_to_string(words[i:i + 4], ' ') AS s
    FROM (SELECT item_id, words, unnest(range(1, len(words) - 3)) AS i FROM items WHERE len(words) >= 5)
),
sizes AS (SELECT item_id, count(*) AS n_item FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, any_value(n_item) AS n_item, count(*) AS n_shared
FROM doc_shingles JOIN item_shingles USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING 100 * count(*) >= 80 * any_value(n_item)
"""


@query(_OP4_SQL)
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that contain benchmark items, with these."""
    return contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def language_model(docs: DataFrame) -> language_id.Model:
    """Fitted on the rows that are not held out."""
    return language_id.train(docs.where(crc_of_id(4) != 2))


@query()
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, folder, "documents")
    found = language_id.languages_of(docs, language_model(docs))
    return found.select("doc_id", (crc_of_id(4) == 2).alias("held_out"), "lang_pred", "score")


@query()
def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """How many words of each document the mix takes."""
    mix = mixture(table(spark, folder, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence marks of every document."""
    found = scan_licenses(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.train(docs, labels.where(crc_of_id(3) != 1))
    scored = toxicity.toxicity(docs, model)
    return scored.select("doc_id", (crc_of_id(3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query()
def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    vectors = table(spark, folder, "embeddings")
    found = nearest.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)
    return found.select("query_id", "rank", "vec_id", "score")


@query()
def op10_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of every document."""
    docs = table(spark, folder, "documents")
    scored = lm_scores(docs, crc_of_id(10) == 0, tokenizer_file("piece_bpe_32k.model"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _op11_sql(k: int, rounds: int) -> str:
    """The rounds one after the other; all numbers are integers that doubles hold exactly."""
    assign = """a{n} AS MATERIALIZED (
    SELECT vec_id, x, arg_min(cluster, [d, cluster]) AS cluster, min(d) AS distance FROM (
        SELECT v.vec_id, v.x, c.cluster, list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x) AS d
        FROM vectors v CROSS JOIN c{n} c
    ) GROUP BY vec_id, x
)"""
    update = """c{next} AS MATERIALIZED (
    SELECT o.cluster, coalesce(n.x, o.x) AS x FROM c{n} o LEFT JOIN (
        SELECT cluster, list(mean ORDER BY i) AS x FROM (
            SELECT cluster, i, floor(sum(v) / count(*)) AS mean
            FROM (SELECT cluster, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM a{n}) GROUP BY cluster, i
        ) GROUP BY cluster
    ) n USING (cluster)
)"""
    steps = [assign.format(n=0)]
    for n in range(rounds):
        steps += [update.format(n=n, next=n + 1), assign.format(n=n + 1)]
    return f"""
WITH vectors AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda v: floor(256 * CAST(v AS DOUBLE))) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda v: v IS NOT NULL AND isfinite(v))) = 64
),
c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), x) - 1 AS INTEGER) AS cluster, x FROM vectors QUALIFY cluster < {k}
),
{", ".join(steps)}
SELECT vec_id, a.cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.x, lambda v: CAST(v AS BIGINT)), ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)
"""


@query(_op11_sql(CENTROIDS, ROUNDS))
def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """The cluster of every vector."""
    return centroid_clusters(table(spark, folder, "embeddings"))


@query()
def op12_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """The article of every page."""
    pages = table(spark, folder, "pages")
    return html_text.main_texts(pages, html_text.train(pages))


_OP13_SQL = r"""
WITH crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t
),
named AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
taken AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, xor(list_reduce(
        list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT)),
        lambda c, b: xor(c // 256, t[CAST(xor(c % 256, b) + 1 AS BIGINT)]), CAST(4294967295 AS BIGINT)), 4294967295) % 4 AS h
    FROM named, crc_table
),
turns AS (
    SELECT conv_id, [coalesce(role, ''), coalesce(text, '')] AS said,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
    FROM conversations WHERE conv_id IS NOT NULL
),
joined AS (
    SELECT k.conv_id, t.said, 0 AS part, t.n FROM taken k JOIN turns t ON t.conv_id = k.base AND t.n <= k.h
    UNION ALL SELECT k.conv_id, t.said, 1, t.n FROM taken k JOIN turns t ON t.conv_id = k.conv_id AND t.n > k.h
),
whole AS (
    SELECT conv_id, coalesce(list(said ORDER BY part, n) FILTER (said IS NOT NULL), []) AS path
    FROM taken LEFT JOIN joined USING (conv_id) GROUP BY conv_id
),
steps AS (SELECT conv_id, path, unnest(range(len(path) + 1)) AS depth FROM whole),
keyed AS (SELECT conv_id, depth, sha256(CAST(path[1:depth] AS VARCHAR)) AS node, path[depth][2] AS said, depth = len(path) AS is_end,
                 sha256(CAST(path[1:depth - 1] AS VARCHAR)) AS above FROM steps),
nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(above) AS above, any_value(said) AS said,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
    FROM keyed GROUP BY node, depth
),
children AS (SELECT above AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY above, depth),
valued AS (
    SELECT n.*, coalesce(c.n, 0) AS n_children, (n_convs - 1) * len(regexp_extract_all(coalesce(said, ''), '[^ 	-
]+')) AS saved
    FROM nodes n LEFT JOIN children c USING (node, depth)
),
sums AS (
    SELECT k.node, k.depth, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(v.saved) AS saved_tokens
    FROM valued v JOIN keyed k ON k.conv_id = v.conv_id AND k.depth <= v.depth GROUP BY k.node, k.depth
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, CAST(v.n_children AS BIGINT) AS n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN sums s USING (node, depth) LEFT JOIN nodes p ON p.node = v.above AND p.depth = v.depth - 1
"""


@query(_OP13_SQL)
def op13_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Which conversations begin alike, and what keeping shared turns once saves."""
    return prefix_trie(table(spark, folder, "conversations"))
