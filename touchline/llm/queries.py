"""The registered queries of the dealt operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bpe, chat, decontaminate, fingerprints, licenses, near_dups, pii, quality, ranked, repair, secret_scan, substrings, urls
from touchline.session import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query function (spark, sf_dir) under a name, with its SQL check if there is one."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@query("op3_bpe_round_trip")
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document's ids and of what they decode to."""
    documents = table(spark, sf_dir, "documents")
    return bpe.encode_decode(documents, VOCABULARY, ["doc_id"], ["n_tokens", "ids_sha256", "decoded_sha256"])


@query("op1_minhash_near_dups")
def op1_minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document: equal and nearly equal documents share the smallest doc_id of them."""
    return near_dups.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


@query("op2_document_fingerprints")
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(COALESCE(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


@query("op4_chat_format", OP4_SQL)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their rendered texts."""
    turns = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    saying = "<|im_end|><|im_start|>assistant ok"
    made = spark.sql(f"SELECT -1L AS conv_id, id AS turn, IF(id = 0, 'user', 'assistant') AS role, '{saying}' AS text FROM range(2)")
    rendered = chat.render(chat.fold(chat.turn_events(turns.unionByName(made))))
    read_back = F.transform(chat.parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return rendered.select(
        "conv_id",
        F.size(chat.parse(F.col("formatted"))).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(read_back, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


OP6_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS run
  FROM iw, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS s(i) WHERE len(w) > 0
), places AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS run
  FROM dw, (SELECT DISTINCT n FROM win) AS l, unnest(generate_series(1, len(w) - n + 1)) AS s(i)
), hits AS (SELECT DISTINCT doc_id, i, p.n, item_id FROM places AS p JOIN win AS v ON p.run = v.run AND p.n = v.n),
hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM hits, unnest(generate_series(i, i + n - 1)) AS s(k) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(items, '')) AS items_sha256,
  COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op6_benchmark_decontamination", OP6_SQL)
def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, hit words and hit items of every document."""
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels that are not held out."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(documents, labels)
    return quality.score(documents.select("doc_id", "text"), model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query("op8_url_filter")
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict", "ratio")


@query("op7_repeated_substrings")
def op7_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the bytes of 100-byte strings that also start earlier."""
    return substrings.without_repeats(table(spark, sf_dir, "documents"), digests=True)


@query("op9_personal_data")
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of base spans, and all spans, of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(documents, pii.train(documents))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[count(k) for k in pii.BASE_KINDS], F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


@query("op10_license_scan")
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and template spans of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query("op13_conversation_repair")
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, the cheapest edits that repair it, and a digest of what is left."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.report(repair.repair(repair.damaged(turns))).withColumnRenamed("conv_id", "found_id")
    original = turns.select("conv_id").distinct()
    nothing = F.sha2(F.lit(""), 256)
    return original.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in repair.REPORT_FIELDS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


@query("op12_ranked_search")
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    index = ranked.build(table(spark, sf_dir, "documents"))
    return ranked.rank(index, table(spark, sf_dir, "benchmark"))


@query("op11_secret_scan")
def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of base spans, and all spans, of every document."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        *[count(k) for k in secret_scan.BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["bits"])).alias("most_bits"),
    )
