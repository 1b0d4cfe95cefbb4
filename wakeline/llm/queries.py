"""The registered queries of the operators, and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.llm.bpe import encode_documents, ids_digest
from wakeline.llm.exact_dedup import exact_duplicates
from wakeline.llm.extraction import extract_main_text
from wakeline.llm.fill_in_middle import draws, fill_in_middle, restored_text
from wakeline.llm.fingerprints import entropy_ranks, fingerprints
from wakeline.llm.licenses import license_scan
from wakeline.llm.near_dedup import near_duplicates
from wakeline.llm.packing import pack, token_pieces
from wakeline.llm.periodic_runs import periodic_runs
from wakeline.llm.quality_rules import quality_rules, train
from wakeline.llm.repeats import remove_repeats
from wakeline.llm.resampling import importance_sample, quality_share, target_documents
from wakeline.llm.tables import prepare
from wakeline.llm.token_counts import token_counts


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of a tree: source, language, a thousand ids, doc_id.

    Rows without doc_id are files without a name, one for each source and language.
    """
    docs = _table(spark, sf_dir, "documents")
    thousand = F.floor(F.col("doc_id") / 1000)
    numbers = [F.coalesce(c.cast("string"), F.lit("")) for c in (thousand, F.col("doc_id"))]
    files = docs.select(F.concat_ws("/", "source", "lang", *numbers).alias("path"), "text")
    doc_id = F.element_at(F.split("path", "/"), -1).try_cast("long")
    licensed_by = F.element_at(F.split("licensed_by", "/"), -1).try_cast("long")
    return license_scan(files).select(
        doc_id.alias("doc_id"), "path", "license", "score", "found",
        licensed_by.alias("licensed_by"),
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    pieces = token_pieces(docs, vocabulary("word_bpe_49k.json"))
    return pack(
        pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return importance_sample(docs, target_documents(docs, labels), quality_share(labels))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return encode_documents(docs, vocabulary("byte_bpe_50k.tiktoken")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    classifier = train(docs, _table(spark, sf_dir, "labels"))
    return quality_rules(docs, classifier)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def _with_repeated_tail(docs: DataFrame) -> DataFrame:
    """Of a tenth of the documents, by their doc_id, a stretch of words repeats to the end."""
    n = F.greatest(F.size("words"), F.lit(1))
    first = F.pmod("g", n)
    period = 1 + F.floor((n - first) / (3 + F.pmod("g", F.lit(8))))
    place = lambda i: F.when(i < first, i).otherwise(first + F.pmod(i - first, period))
    tail = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.get("words", place(i).cast("int"))
    )
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.pmod(h, F.lit(10)) == 0
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return (
        docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(chosen, words).alias("words"))
        .select("doc_id", F.when(F.size("words") > 0, F.array_join(tail, " ")).alias("repeated"), "text")
        .select("doc_id", F.coalesce("repeated", "text").alias("text"))
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_repeated_tail(_table(spark, sf_dir, "documents")))
    # Runs are in order of start and period, so the first of equal exponents stays.
    nothing = F.lit(None).cast("struct<start: long, length: long, period: long>")
    top = F.aggregate(
        "runs",
        nothing,
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    lines = F.transform("runs", lambda run: F.concat(line(run), F.lit("\n")))
    return found.withColumn("top", top).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return fingerprints(docs, entropy_ranks(docs)).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return fill_in_middle(draws(docs, seed=7), percent=100, spm_percent=50).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored_text(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_license_scan,
        op2_best_fit_packing,
        op3_exact_dedup,
        op4_quality_classifier,
        op5_suffix_array_dedup,
        op6_near_dedup,
        op7_bpe,
        op8_quality_rules,
        op9_token_counts,
        op10_html_extraction,
        op11_periodic_runs,
        op12_fingerprints,
        op13_fill_in_middle,
    ]
    return {f.__name__: f for f in found}


def statements() -> dict[str, str]:
    return {
        "op3_exact_dedup": r"""
            WITH d AS (
                SELECT doc_id,
                    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
                FROM documents
            )
            SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
                count(*) OVER (PARTITION BY t) AS group_size,
                doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
                sha256(t) AS text_sha256
            FROM d
        """,
        "op13_fill_in_middle": r"""
            WITH d AS (
                SELECT doc_id, coalesce(text, '') AS t,
                    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
                    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
                FROM documents
            ), drawn AS (
                SELECT doc_id, t, lines, CAST(len(lines) AS BIGINT) AS n,
                    CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS c1,
                    CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS c2,
                    CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS spm,
                    t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                        OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100 AS plain
                FROM d
            ), cut AS (
                SELECT *, array_to_string(lines[1:least(c1, c2)], '') AS prefix,
                    array_to_string(lines[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
                    array_to_string(lines[greatest(c1, c2) + 1:], '') AS suffix
                FROM drawn
            )
            SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
                CASE WHEN NOT plain THEN length(prefix) END AS prefix_chars,
                CASE WHEN NOT plain THEN length(middle) END AS middle_chars,
                sha256(CASE WHEN plain THEN t
                    WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
                sha256(CASE WHEN plain THEN t ELSE prefix || middle || suffix END) AS restored_sha256
            FROM cut
        """,
    }
