"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (
    contamination,
    fingerprints,
    ngrams,
    packing,
    quality,
    rollups,
    runs,
    substrings,
    suffixes,
    tokenfile,
    toxicity,
    vectors,
    whitening,
)
from ledgerline.sources.staging import new_path, stage

PACKING_VOCABULARY = "word_bpe_49k.json"
FILE_VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file; only the queries that tokenize need the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(packing.pack(table(spark, sf_dir, "documents"), vocabulary(PACKING_VOCABULARY)))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.similar_documents(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeated_words(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after all documents came in, German ones were recounted, and later copies left.

    The first batch is sent twice, as after a restart; it counts once.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    book = rollups.Rollup(spark, new_path(spark, "rollup"))
    arrivals = rollups.changes(docs, "space-1").unionByName(rollups.changes(docs, "alnum-1"))
    book.commit("arrivals", arrivals)
    book.commit("arrivals", arrivals)
    german = docs.where(F.col("lang") == "de")
    book.commit("recount", rollups.changes(german, "alnum-1", -1).unionByName(rollups.changes(german, "mark-1")))
    copies = stage(rollups.later_copies(docs, list(rollups.VERSIONS)), "copies")
    mine = F.col("lang").eqNullSafe("de")
    gone = rollups.removals(copies, "space-1")
    gone = gone.unionByName(rollups.removals(copies.where(~mine), "alnum-1"))
    gone = gone.unionByName(rollups.removals(copies.where(mine), "mark-1"))
    book.commit("copies", gone)
    return book.totals()


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_vector_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenfile.new_file_set(spark)
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), vocabulary(FILE_VOCABULARY), 2, path)
    read = tokenfile.read_tokens(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return tokenfile.positions(read, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_vectors(table(spark, sf_dir, "embeddings"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` where the text of every tenth, by a hash of its id, repeats from some word on.

    With h the crc32 of the decimal doc_id and g = floor(h / 10), texts of n > 0 words and h % 10 = 0
    have, from word a = g % n on, the original words a, a + 1, .. of period
    p = 1 + floor((n - a) / (3 + g % 8) ), again and again.
    """
    h = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    planted = docs.withColumn("words", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)))
    g, n = F.floor(h / 10), F.size("words")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    front, back = F.slice("words", 1, a), F.slice("words", a + 1, p)
    text = F.array_join(F.slice(F.concat(front, F.flatten(F.array_repeat(back, 12))), 1, n), " ")
    return planted.withColumn("text", F.when(n > 0, text).otherwise(F.col("text"))).drop("words")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.repeated_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    # exact order by length / period: products of numbers of words
    before = lambda x, y: F.when(x.length * y.period != y.length * x.period, F.sign(y.length * x.period - x.length * y.period)).otherwise(
        F.when(x.start != y.start, F.sign(x.start - y.start)).otherwise(F.sign(x.period - y.period))
    ).cast("int")
    best = F.get(F.array_sort("runs", before), F.lit(0))
    line = lambda r: F.concat_ws(",", r.start, r.length, r.period)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    "op1_packing": op1_packing,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality": op5_quality,
    "op6_token_counts": op6_token_counts,
    "op7_toxicity": op7_toxicity,
    "op8_vector_near_dup": op8_vector_near_dup,
    "op9_token_files": op9_token_files,
    "op10_decontamination": op10_decontamination,
    "op11_whitening": op11_whitening,
    "op12_fingerprints": op12_fingerprints,
    "op13_runs": op13_runs,
}

SQL: dict[str, str] = {
    "op4_substring_dedup": r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)),
f AS (SELECT k, min(doc_id) AS first_id FROM g GROUP BY k HAVING count(*) > 1),
hit AS (SELECT DISTINCT g.doc_id, i + o AS p FROM g JOIN f USING (k), range(0, 13) t(o) WHERE g.doc_id > first_id),
x AS (SELECT doc_id, ws[p] AS word, p FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w)),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.p) AS t FROM x LEFT JOIN hit ON x.doc_id = hit.doc_id AND x.p = hit.p
         WHERE hit.p IS NULL GROUP BY x.doc_id),
n AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op2_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
link AS MATERIALIZED (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM g x JOIN g y ON x.k = y.k AND x.doc_id <> y.doc_id
                        GROUP BY 1, 2) p JOIN n u ON u.doc_id = p.a JOIN n v ON v.doc_id = p.b
  WHERE 100 * shared >= 85 * (u.n + v.n - shared)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT a AS doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id
FROM (SELECT a, min(b) AS c FROM reach GROUP BY a) r LEFT JOIN n ON n.doc_id = r.a""",
    "op6_token_counts": r"""
WITH d AS (SELECT source, lang, text, doc_id = min(doc_id) OVER (PARTITION BY text) AS kept FROM documents),
v AS (SELECT source, lang, 'space-1' AS version, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM d WHERE kept
      UNION ALL SELECT source, lang, 'alnum-1', len(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z]+')) FROM d
      WHERE kept AND lang IS DISTINCT FROM 'de'
      UNION ALL SELECT source, lang, 'mark-1', len(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z]+|[^\x00-\x20\x7F0-9A-Za-z]')) FROM d
      WHERE kept AND lang = 'de')
SELECT source, lang, version, count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM v GROUP BY ALL""",
    "op8_vector_near_dup": r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
       WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM ok x JOIN ok y ON x.label = y.label AND x.vec_id <> y.vec_id
                      AND len(x.e) = len(y.e) AND list_inner_product(x.e, y.e) / (x.norm * y.norm) >= 0.98),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
c AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.c AS component_id, v.vec_id = c.c AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id""",
    "op10_decontamination": r"""
WITH u AS (SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents
           UNION ALL SELECT 'i', CAST(item_id AS VARCHAR), text FROM benchmark),
w AS (SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM u),
iw AS (SELECT id, least(len(ws), 13) AS n, ws, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS i FROM w WHERE kind = 'i' AND len(ws) > 0),
win AS (SELECT DISTINCT id, n, array_to_string(ws[i:i + n - 1], ' ') AS k FROM iw),
lens AS (SELECT DISTINCT n FROM win),
dw AS (SELECT id, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM w, lens WHERE kind = 'd' AND len(ws) >= n),
hit AS (SELECT dw.id AS doc, dw.n AS n, i, win.id AS item FROM (SELECT id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS k FROM dw) dw
        JOIN win ON dw.n = win.n AND dw.k = win.k),
pos AS (SELECT doc, count(*) AS n_hit FROM (SELECT DISTINCT doc, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc),
its AS (SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc, item FROM hit) GROUP BY doc)
SELECT CAST(w.id AS BIGINT) AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN pos ON pos.doc = w.id LEFT JOIN its ON its.doc = w.id WHERE kind = 'd'""",
}
