"""One thin query for each operator, over whole tables, with the SQL that checks it where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import lexical, mixing, near_text, near_vectors, packing, passages, prefix_trie, quality, repeats, token_files, toxicity, url_filter, vector_search
from tidemark.llm.common import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_file("word_bpe_49k.json"), end_id=1)
    return token_files.read_tokens(spark, folder)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0, capacity=2048)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op6_near_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_text.near_text(table(spark, sf_dir, "documents"), percent=85)


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END)) AS sh FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT r.a AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id, min(r.b) = r.a AS kept FROM reach r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


OP8_SQL = """
WITH rest AS (
  SELECT page_id, row_number() OVER () AS row, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), parts AS (
  SELECT page_id, row, translate(regexp_extract(r, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), rules(rhost, rpath, action) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), fits AS (
  SELECT p.*, r.*, row_number() OVER (PARTITION BY row ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS n
  FROM parts p LEFT JOIN rules r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rhost || rpath AS rule, coalesce(action, 'allow') AS verdict FROM fits WHERE n = 1
"""


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH drawn AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    -ln((('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'text ' || coalesce(text, ''))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / (0.05 + 0.95 * coalesce(length(regexp_replace(text, '[^\p{L}]+', '', 'g'))::DOUBLE / greatest(length(text), 1), 0.0)) AS key
  FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM drawn GROUP BY source
), weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0, 1.0][1 + (rn - 1) % 3] AS w, source_size * 3.0::DOUBLE AS cap FROM sizes
), levels AS (
  SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM weighed WINDOW b AS (ORDER BY cap / w, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, CASE WHEN level >= cap / w THEN cap ELSE w * max(CASE WHEN level < cap / w THEN level END) OVER () END AS target FROM levels
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM targets
), ordered AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size / 2.0 AS middle
  FROM drawn d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, ((epochs + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM ordered
"""


def op11_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(table(spark, sf_dir, "documents")).drop("kept")


OP11_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), windows AS (
  SELECT row, doc_id, s, array_to_string(ws[s:s + 19], ' ') AS t FROM (SELECT row, doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM w)
), again AS (
  SELECT row, s FROM (SELECT row, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT row, s + k AS i FROM again, range(0, 20) r(k)
), words AS (
  SELECT row, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w
), kept AS (
  SELECT words.row, string_agg(word, ' ' ORDER BY words.i) AS t, count(*) AS n FROM words ANTI JOIN gone ON words.row = gone.row AND words.i = gone.i GROUP BY words.row
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (row)
"""


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents
), q AS (
  SELECT row_number() OVER () AS item, item_id, unnest(list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark
), c AS (
  SELECT count(*) FILTER (len(ts) > 0) AS docs, sum(len(ts))::BIGINT AS total FROM d
), tf AS (
  SELECT row, doc_id, term, n, count(*) AS tf FROM (SELECT row, doc_id, len(ts) AS n, unnest(ts) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term, docs
), scores AS (
  SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term), c GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0) WHERE rank <= 10
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as their turns stand, but that the first of each, by the hash of its id, are those of the first conversation of its five."""
    turns = prefix_trie.numbered(table(spark, sf_dir, "conversations"))
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    plan = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % 5).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % 9).alias("h"))
    plan = plan.join(convs.select(F.col("conv_id").alias("base"), F.col("n").alias("held")), "base", "left")
    start = F.least("h", F.coalesce("held", F.lit(0).cast("long")))
    head = turns.where("pos <= 8").withColumnRenamed("conv_id", "base").join(plan.select("conv_id", "base", "h"), "base").where("pos <= h")
    tail = turns.join(plan, "conv_id").where("pos > h")
    rebuilt = head.select("conv_id", "pos", "turn_id").union(tail.select("conv_id", (start + F.col("pos") - F.col("h")).alias("pos"), "turn_id"))
    return prefix_trie.prefix_trie(rebuilt, convs.select("conv_id"))


OP13_SQL = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL
), original AS (
  SELECT c, list({'role': role, 'text': text} ORDER BY pos) AS ts FROM turns GROUP BY c
), hashed AS (
  SELECT c, ts, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 9 AS h FROM original
), rebuilt AS (
  SELECT x.c, list_concat(coalesce(b.ts, [])[1:x.h], x.ts[x.h + 1:]) AS ts FROM hashed x LEFT JOIN original b ON b.c = x.c - x.c % 5
), members AS (
  SELECT c, d, ts[1:d] AS path, len(ts) = d AS ends FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, d, min(c) AS c, count(*) AS n, (count(*) - 1) * coalesce(octet_length(encode(path[d].text)), 0) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends FROM members GROUP BY path, d
), children AS (
  SELECT path[1:d - 1] AS path, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), full_nodes AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path, d)
), below AS (
  SELECT path[1:a] AS path, a AS d, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_nodes) GROUP BY ALL
)
SELECT x.c AS conv_id, x.d AS depth, p.c AS parent_conv_id, x.n AS n_convs, x.n_children, n_leaves, saved_tokens, x.ends AS ends_sha256
FROM full_nodes x JOIN below USING (path, d) LEFT JOIN nodes p ON p.d = x.d - 1 AND p.path = x.path[1:x.d - 1]
"""

QUERIES = {
    "op1_repeats": op1_repeats,
    "op6_near_text": op6_near_text,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_near_vectors": op5_near_vectors,
    "op7_top_k": op7_top_k,
    "op2_token_files": op2_token_files,
    "op9_packing": op9_packing,
    "op8_url_filter": op8_url_filter,
    "op10_mixing": op10_mixing,
    "op11_passages": op11_passages,
    "op12_lexical": op12_lexical,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES = {"op6_near_text": OP6_SQL, "op7_top_k": OP7_SQL, "op8_url_filter": OP8_SQL, "op10_mixing": OP10_SQL, "op11_passages": OP11_SQL, "op12_lexical": OP12_SQL, "op13_prefix_trie": OP13_SQL}
