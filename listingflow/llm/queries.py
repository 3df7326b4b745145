"""Queries on the driver's tables, one per operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listingflow.llm import codes, decontam, langid, licenses, line_rules, mixing, quality, resampling, scoring, secrets, sharding, simhash, tokens
from listingflow.llm.shared import BLANK, WORD, fold, shared_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query("op2_sharding")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard and slot; the law is equal row counts."""
    records = sharding.document_records(_table(spark, folder, "documents"))
    out = sharding.external_shuffle(records, "size")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query("op4_language_id")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every whole text, learned from four folds of five."""
    docs = _table(spark, folder, "documents")
    model = langid.fit(docs.where(fold(F.col("doc_id"), 5) != 0))
    out = langid.identify(docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"),
    )


#: Documents of at least this score stay.
KEEP_QUALITY = 0.3


@_query("op6_quality_classifier")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every whole text, learned from the labels of four folds of five."""
    docs = _table(spark, folder, "documents")
    labels = _table(spark, folder, "labels").where(fold(F.col("doc_id"), 5) != 0)
    model = quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))
    out = quality.score(docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= KEEP_QUALITY, 1).otherwise(0).alias("predicted"),
    )


@_query("op3_simhash_near_dedup")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document: four-word shingles, four bits."""
    found = simhash.near_duplicates(_table(spark, folder, "documents"), words=4, radius=4)
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


# Spans of one kind: what lies before a match is all pieces up to it and all matches before it.
_SPANS = """list_transform(list_filter(generate_series(1, len(m_{k})), lambda i: length(g_{k}[i]) >= {least}), lambda i: {{
    'start': list_sum(list_transform(p_{k}[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(m_{k}[1:i - 1], lambda x: length(x))), 0),
    'place': {place}, 'kind': '{k}', 'size': length(m_{k}[i])}})"""


def _secret_sql() -> str:
    found, spans = [], []
    for place, rule in enumerate(secrets.RULES):
        quoted = rule.pattern.replace("'", "''")
        found.append(f"regexp_extract_all(t, '{quoted}', 0) AS m_{rule.kind}, string_split_regex(t, '{quoted}') AS p_{rule.kind}, "
                     f"regexp_extract_all(t, '{quoted}', {rule.part}) AS g_{rule.kind}")
        spans.append(_SPANS.format(k=rule.kind, place=place, least=rule.least))
    base = ", ".join(f"'{r.kind}'" for r in secrets.BASE)
    joined = "array_to_string(list_transform({}, lambda s: s.kind || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.start + s.size AS BIGINT)), ',')"
    chosen = f"list_filter(spans, lambda s: s.kind IN ({base}))"
    counts = ", ".join(f"CAST(len(list_filter(spans, lambda s: s.kind = '{r.kind}')) AS BIGINT) AS n_{r.kind}" for r in secrets.BASE)
    return f"""
        SELECT doc_id, {counts}, sha256({joined.format(chosen)}) AS base_sha256, {joined.format("spans")} AS spans
        FROM (SELECT doc_id, list_sort(list_concat({", ".join(spans)})) AS spans
              FROM (SELECT doc_id, {", ".join(found)} FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)))"""


@_query("op10_secret_scan", _secret_sql())
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every whole text, each distinct text scanned once by way of a new ledger."""
    ledger = secrets.Ledger(spark, shared_path(spark, "ledger"))
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = secrets.scan_versions(docs, ledger, "text")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["place"] < len(secrets.BASE))
    counts = [secrets.count_of(spans, r.kind).alias(f"n_{r.kind}") for r in secrets.BASE]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"),
                        secrets.listed(spans).alias("spans"))


def _text_sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_LINE_SQL = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
    win AS (SELECT doc_id, unnest(list_transform(range(0, len(w) - 4), lambda i: {{'i': i, 'k': w[i + 1:i + 5]}})) AS x FROM d),
    dup AS (SELECT doc_id, x.i AS i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, x.k) > 1),
    rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM dup, (SELECT unnest(range(0, 5)) AS o) GROUP BY doc_id),
    ln AS (SELECT * FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '{WORD}')),
    judged AS (SELECT *, length(regexp_replace(x, '{BLANK}+', '', 'g')) AS chars, NOT (
            len(regexp_extract_all(x, {_text_sql(line_rules.SYMBOLS)})) * {line_rules.SYMBOL_EVERY} > length(x)
            OR (len(regexp_extract_all(x, '\\p{{Lu}}')) * 2 > length(x) AND length(x) >= 20)
            OR regexp_matches(x, {_text_sql(line_rules.NAVIGATION)}) OR regexp_matches(x, {_text_sql(line_rules.BOILERPLATE)})
            OR (NOT regexp_matches(x, {_text_sql(line_rules.SENTENCE_END)})
                AND len(regexp_extract_all(x, '{WORD}')) >= {line_rules.OPEN_WORDS})) AS stays FROM ln),
    per AS (SELECT doc_id, count(*) - count(DISTINCT x) AS dup_lines, coalesce(sum(chars) FILTER (stays), 0) AS chars_left
            FROM judged GROUP BY doc_id),
    counts AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
            CAST(len(regexp_extract_all(t, {_text_sql(line_rules.SYMBOLS)})) AS BIGINT) AS n_symbols,
            CAST(coalesce(dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
            CASE WHEN len(w) > 0 THEN 1 - CAST(coalesce(chars_left, 0) AS DOUBLE) / length(array_to_string(w, '')) ELSE 0.0 END AS part
        FROM d LEFT JOIN per USING (doc_id) LEFT JOIN rep USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
        (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND part <= 0.4) AS kept, round(part, 6) AS lost
    FROM counts"""


@_query("op8_quality_rules", _LINE_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every whole text and whether the line-first rules keep it."""
    out = line_rules.clean(_table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      F.round("lost", 6).alias("lost"))


def _words_sql(table: str, key: str) -> str:
    return f"SELECT {key}, regexp_extract_all(lower(coalesce(text, '')), '{decontam.TOKEN}') AS w FROM {table}"


# An item's shingles have five words, or all its words if it has fewer; a document's have the item's length.
@_query("op7_benchmark_decontamination", f"""
    WITH d AS ({_words_sql("documents", "doc_id")}), b AS (SELECT item_id, w, least(len(w), 5) AS n
        FROM (SELECT DISTINCT item_id, w FROM ({_words_sql("benchmark", "item_id")})) WHERE len(w) > 0 AND item_id IS NOT NULL),
    ds AS (SELECT DISTINCT doc_id, n, unnest(list_transform(range(0, greatest(len(w) - n + 1, 0)), lambda i: array_to_string(w[i + 1:i + n], ' '))) AS s
        FROM d, (SELECT DISTINCT n FROM b)),
    bs AS (SELECT DISTINCT item_id, w, n, unnest(list_transform(range(0, len(w) - n + 1), lambda i: array_to_string(w[i + 1:i + n], ' '))) AS s FROM b),
    q AS (SELECT item_id, w, count(*) AS size FROM bs GROUP BY item_id, w),
    found AS (SELECT doc_id, item_id, w, count(*) AS shared, any_value(size) AS size FROM ds JOIN bs USING (n, s) JOIN q USING (item_id, w)
        GROUP BY doc_id, item_id, w HAVING count(*) >= ceil(any_value(size) * 0.8 - 1e-9))
    SELECT doc_id, item_id, round(shared / CAST(size AS DOUBLE), 6) AS containment, shared, CAST(size AS BIGINT) AS item_shingles FROM found
    QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY containment DESC, shared DESC, size DESC) = 1""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the benchmark items they contain."""
    return decontam.find(_table(spark, folder, "documents").select("doc_id", "text"), _table(spark, folder, "benchmark"))


#: Nats of the weights in the production mix; twenty like sources have 2.996.
MIX_ENTROPY = 2.9


@_query("op1_source_mixing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """One epoch's worth of tokens from all documents, sources flattened to the target entropy."""
    docs = _table(spark, folder, "documents").select("doc_id", "source", mixing.tokens_of(F.col("text")).alias("n_tokens"))
    return mixing.mix(docs, tokens="n_tokens", entropy=MIX_ENTROPY, epochs=1.0)


@_query("op5_lm_scoring")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Model and base scores of every whole text, learned from nine folds of ten."""
    number = fold(F.col("doc_id"), 10)
    out = scoring.score(_table(spark, folder, "documents").select("doc_id", "text"), number != 0)
    return out.withColumn("held_out", F.coalesce(number == 0, F.lit(False)))


@_query("op9_license_scan")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """License notices and texts in every whole text."""
    return licenses.scan(_table(spark, folder, "documents"))


@_query("op11_importance_resampling")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's weight towards the benchmark, and the rank of the quarter that is drawn."""
    return resampling.resample(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), percent=25, least_words=20, seed=7)


@_query("op12_token_output")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every whole text, written in range-coded blocks and read back from them."""
    path = shared_path(spark, "token-files")
    tokens.write(_table(spark, folder, "documents").select("doc_id", "text"), path, tokens.public("word_bpe_49k.json", end=2))
    return tokens.read(spark, path).withColumnRenamed("key", "doc_id")


# Entries of a codebook beside the parts they are held against; the lowest index wins a tie.
_NEAREST = """a{i} AS MATERIALIZED (SELECT r, p, v, arg_min(e, (d, e)) AS e, min(d) AS d FROM (
        SELECT r, k.p, k.v, c.e, CAST(list_sum(list_transform(list_zip(k.v, c.c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT) AS d
        FROM parts k JOIN c{i} c ON k.p = c.p) GROUP BY r, p, v)"""
_MOVED = """c{j} AS MATERIALIZED (SELECT c.p, c.e, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN (
        SELECT p, e, list(m ORDER BY pos) AS c FROM (SELECT p, e, pos, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m FROM (
            SELECT p, e, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{i}) GROUP BY p, e, pos) GROUP BY p, e) m
        ON m.p = c.p AND m.e = c.e)"""
_CODE_SQL = f"""
    WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
            list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
        FROM embeddings WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS MATERIALIZED (SELECT r, p, v[p * len(v) // 16 + 1:(p + 1) * len(v) // 16] AS v
        FROM kept, (SELECT unnest(range(0, 16)) AS p)),
    c0 AS MATERIALIZED (SELECT p, r - 1 AS e, v AS c FROM parts WHERE r <= 64),
    {_NEAREST.format(i=0)}, {_MOVED.format(i=0, j=1)}, {_NEAREST.format(i=1)}, {_MOVED.format(i=1, j=2)}, {_NEAREST.format(i=2)},
    named AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY r),
    books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept JOIN named USING (r), books"""


@_query("op13_vector_codes", _CODE_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Product codes of every sound vector, with the errors of two rounds of codebooks."""
    return codes.compress(_table(spark, folder, "embeddings"))
