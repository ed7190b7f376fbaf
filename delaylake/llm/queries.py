"""The registered queries of this package; each reads whole tables through its operator and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylake.llm import (
    conversation_repair, decontamination, exact_dedup, html_text, mixing, near_dedup, phrases, pii, secrets, sharding, substring_dedup, suffix_dedup, toxicity,
)

SHARDS = 8
PSEUDONYM_KEY = "registered query"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every occurrence of a benchmark item in a document."""
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "stop", "edits")


def op2_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards whose row counts are at most one apart."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return sharding.shard(rows, SHARDS).withColumn("grown_shard", F.lit(None).cast("int"))


def op6_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(rows, F.col("size"), n_shards=SHARDS)
    return mixed.select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("size") * F.col("copies")).alias("taken"), "copies", "shards",
    )


def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms in place of personal data."""
    rows = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(rows, PSEUDONYM_KEY)


def op4_secret_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; base_sha256 covers the plain patterns, spans also what was confirmed by structure."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), "n_key", "n_token",
    )


def op5_golomb_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of equal texts each document keeps."""
    found = exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", F.col("group_size").cast("long").alias("group_size"), "kept", F.col("sha").alias("text_sha256"))


def op7_min_cut_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_fast_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components on two-word shingles."""
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def op9_convolution_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    found = toxicity.score(docs, model)
    return found.select(
        F.col("id").alias("doc_id"), toxicity.held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
        "rejected",
    )


def op10_super_kmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document without windows of 13 words that an earlier document has."""
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=13)
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_interval_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    whole = table(spark, sf_dir, "conversations")
    rows = conversation_repair.damage(whole)
    names = {"conv": "conv", "turn": "turn", "role": "role", "text": "text", "tie": ("was_role", "was_text")}
    parsed = conversation_repair.parse(rows, **names)
    hashes = conversation_repair.digest(conversation_repair.repair(rows, parsed, **names))
    known = whole.select(F.col("conv_id")).distinct()
    out = known.join(parsed, known["conv_id"].eqNullSafe(parsed["conv"]), "left").drop("conv")
    out = out.join(hashes, out["conv_id"].eqNullSafe(hashes["conv"]), "left").drop("conv")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_column_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of every document without strings of 50 bytes that an earlier document has."""
    found = suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"), window=50)
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_stream_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of every language that most outdo their parts."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_qgram_decontamination, op2_hypergeometric_shards, op3_feistel_pseudonyms, op4_secret_structure, op5_golomb_dedup,
        op6_mixture, op7_min_cut_text, op8_fast_sketch_dedup, op9_convolution_toxicity, op10_super_kmer_dedup, op11_interval_repair,
        op12_column_suffix_dedup, op13_stream_collocations,
    )
}
WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op5_golomb_dedup": r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
  sha256(t) AS text_sha256 FROM n WINDOW w AS (PARTITION BY t)""",
    "op8_fast_sketch_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[k] || ' ' || w[k + 1] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS k FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
classes AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY h, n) AS rep FROM (
  SELECT doc_id, count(*) AS n, sha256(string_agg(g, chr(10) ORDER BY g)) AS h FROM s GROUP BY 1)),
r AS (SELECT s.* FROM s JOIN classes c USING (doc_id) WHERE c.rep = c.doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM r x JOIN r y USING (g) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)
  UNION SELECT rep, doc_id FROM classes WHERE rep <> doc_id),
e AS (SELECT a AS u, b AS v FROM l UNION SELECT b, a FROM l),
reach AS (SELECT u, v FROM e UNION SELECT reach.u, e.v FROM reach JOIN e ON reach.v = e.u),
c AS (SELECT u, min(v) AS low FROM reach GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.low, w.doc_id)) AS component_id,
  w.doc_id <= coalesce(c.low, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.u = w.doc_id""",
    "op10_super_kmer_dedup": f"""
WITH w AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, k, array_to_string(w[k : k + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM w WHERE len(w) >= 13)),
hit AS (SELECT doc_id, k FROM (SELECT doc_id, k, min(doc_id) OVER (PARTITION BY g) AS low FROM g) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, k + j AS k FROM (SELECT doc_id, k, unnest(range(13)) AS j FROM hit)),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS t, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY 1)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    # Bytes as pairs of hexadecimal digits.
    "op12_column_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
g AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS g
  FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 49)) AS p FROM d WHERE len(h) >= 100)),
hit AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY g) AS low FROM g) WHERE low < doc_id),
marked AS (SELECT *, p > coalesce(lag(p) OVER w + 50, -1) AS is_new FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM (
  SELECT *, sum(CASE WHEN is_new THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS s FROM marked) GROUP BY doc_id, s),
parts AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM spans
  UNION ALL SELECT d.doc_id, coalesce(max(b), 0), any_value(len(h)) // 2 FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, CAST(any_value(len(h)) // 2 AS BIGINT) AS n_bytes, CAST(any_value(len(h)) // 2 - sum(y - x) AS BIGINT) AS n_removed,
  count(*) - 1 AS n_spans, sha256(unhex(string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY x))) AS kept_sha256
FROM d JOIN parts USING (doc_id) GROUP BY d.doc_id""",
    "op13_stream_collocations": f"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang, {LOWER.format("coalesce(text, '')")} AS t FROM documents),
piece AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM d),
words AS (SELECT lang, sum(len(w))::BIGINT AS n FROM piece GROUP BY 1),
spot AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece),
gram AS (SELECT lang, w[i : i + k - 1] AS w, count(*) AS f
  FROM (SELECT *, unnest([1, 2, 3, 4]) AS k FROM spot) WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30),
cut AS (SELECT g.lang, g.w, g.f AS a, k, x.f AS l, y.f AS r, 2000000::HUGEINT * g.f // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, len(w))) AS k FROM gram) g
  JOIN gram x ON x.lang = g.lang AND x.w = g.w[1 : k] JOIN gram y ON y.lang = g.lang AND y.w = g.w[k + 1 :]),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
longer AS (SELECT lang, w[i : i + m - 1] AS w, max(f) AS f
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT *, unnest(range(2, len(w))) AS m FROM gram)) GROUP BY ALL),
rest AS (SELECT b.lang, array_to_string(b.w, ' ') AS phrase, a, l, r, score FROM best b
  LEFT JOIN longer o ON o.lang = b.lang AND o.w = b.w WHERE o.f IS NULL OR 100 * o.f::HUGEINT < 80 * a::HUGEINT)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM rest) JOIN words USING (lang)
WHERE rank <= 2000""",
}
