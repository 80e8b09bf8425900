"""One query for each operator of this folder, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from quarry.llm import (
    addressable_codes,
    chunked_bpe,
    digest_index,
    host_rules,
    lexical_packing,
    order_minhash,
    periodic_runs,
    pii_surrogates,
    secret_scan,
    sentence_spans,
    snapshots,
    spelling_variants,
    url_trees,
)
from quarry.llm.common import documents, known_groups, salted, table
from quarry.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def llm_query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@llm_query("op1_chunked_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = chunked_bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    told = ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), "ids")
    return (chunked_bpe.decode(told, ranks)
            .select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256")))


@llm_query("op2_pii_surrogates")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_surrogates.replace(documents(spark, sf_dir), key="quarry")


@llm_query("op3_order_minhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (order_minhash.classes(documents(spark, sf_dir))
            .select("doc_id", "class_id", "class_size", "kept"))


@llm_query("op4_password_guess_cost")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
                        count("hex").alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), count("guess").alias("n_guess"))


@llm_query("op5_lexical_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = lexical_packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "seed_id")


@llm_query("op6_sentence_spans")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.dedup(documents(spark, sf_dir))


@llm_query("op7_url_trees")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_trees.judge(table(spark, sf_dir, "pages"))


@llm_query("op8_digest_index", """
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS c,
                  sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h ORDER BY c DESC, doc_id)""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches, the longer texts first, so that the row which stays is in
    the batch that comes first: the second batch meets the first's digests."""
    index = digest_index.DigestIndex(spark, scratch_path(spark, "op8-index"))
    docs = documents(spark, sf_dir)
    size = F.length(F.coalesce("text", F.lit("")))
    middle = docs.agg(F.percentile_approx(size, 0.5).alias("m")).first()["m"] or 0
    longer = index.ingest(docs.filter(size >= middle), batch_id="longer")
    rows = longer.unionByName(index.ingest(docs.filter(size < middle), batch_id="shorter")).withColumn("_salt", salted("doc_id"))
    sizes = known_groups(rows, ["text_sha256"], {"n": F.count(F.lit(1))}, {"group_size": F.sum("n")})
    return (rows.drop("group_size").join(sizes, ["text_sha256", "_salt"])
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


@llm_query("op9_host_rules")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = host_rules.judge(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "host_failed")


@llm_query("op10_snapshot_collapse", """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
c AS (SELECT conv_id, count(*) AS n_turns,
             string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn) AS text,
             first(text ORDER BY turn) AS head
      FROM t GROUP BY conv_id),
k AS (SELECT min(conv_id) AS conv_id, n_turns, count(*) AS copies, text, any_value(head) AS head FROM c GROUP BY n_turns, text)
SELECT conv_id, n_turns, copies, text FROM k
WHERE NOT EXISTS (SELECT 1 FROM k o WHERE o.head = k.head AND o.n_turns > k.n_turns AND starts_with(o.text, k.text))""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.render(table(spark, sf_dir, "conversations"))


@llm_query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's words: of one document in ten, those from word ``a`` on
    repeat the first ``p`` of them."""
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("h", F.crc32(F.col("doc_id").cast("string")))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    looped = (docs.filter("h % 10 = 0").withColumn("w", words).withColumn("n", F.size("w")).filter("n > 0")
              .withColumn("g", F.expr("h div 10")).withColumn("a", F.expr("cast(g % n AS int)"))
              .withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) AS int)"))
              .withColumn("text", F.expr("array_join(slice(concat(slice(w, 1, a), flatten(array_repeat(slice(w, a + 1, p), "
                                         "cast(ceil((n - a) / p) AS int)))), 1, n), ' ')"))
              .select("doc_id", "text"))
    plain = docs.filter(F.coalesce(F.col("h") % 10 != 0, F.lit(True)) | ~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    found = periodic_runs.runs(plain.select("doc_id", "text").union(looped))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # greatest length, then least start, then least period
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    told = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("b"),
                        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return told.select("doc_id", "n_runs", F.col("b.s").alias("start"), (-F.col("b.l")).alias("length"), F.col("b.p").alias("period"),
                       F.expr("(-1000 * b.l) div b.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


@llm_query("op12_addressable_codes")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    addressable_codes.write(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return addressable_codes.read(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@llm_query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's words: one occurrence in 97 lacks a letter."""
    words = spelling_variants.occurrences(documents(spark, sf_dir))
    h = F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word")))
    at = F.pmod(h, F.char_length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
    words = words.select(F.when(h % 97 == 0, cut).otherwise(F.col("word")).alias("word"))
    return spelling_variants.group(spelling_variants.vocabulary(words))
