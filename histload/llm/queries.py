"""The queries of the operators, one each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histload.llm import (
    chat,
    collocations,
    decontamination,
    edit_counts,
    exact_dedup,
    mixing,
    ordered_minhash,
    packing,
    secrets,
    spelling,
    token_files,
    toxicity,
    warc,
)
from histload.llm.tables import stored
from histload.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path)
    return token_files.read_documents(spark, path)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm
    FROM documents
), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
       sha256(norm) AS text_sha256
FROM d JOIN g USING (norm)
"""


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = ordered_minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "class_size", "kept")


def op5_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document before and after three edits: a third into the text some characters
    are replaced, half-way some are cut out, and words are added at the end."""
    state = stored(edit_counts.count_tokens(table(spark, sf_dir, "documents")), "token_trees")
    size = F.length("text").cast("long")
    third, half = F.floor(size / 3), F.floor(size / 2)

    def edit(begin, end, new):
        return F.struct(begin.alias("begin"), end.alias("end"), new.alias("replacement"))

    edits = F.array(
        edit(third, third + 7, F.concat(F.lit("an edit in "), "doc_id", F.lit(","))),
        edit(half, half + 11, F.lit("")),
        edit(size + 100, size + 100, F.lit(" and words at the end.")),
    )
    edited = edit_counts.apply_edits(state.withColumn("edits", edits))
    return edited.select(
        "doc_id",
        F.col("n_before").alias("n_tokens"),
        "n_edits",
        F.col("n_tokens").alias("n_tokens_after"),
        F.length("text").cast("long").alias("n_chars_after"),
        "encoded_chars",
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mixed(docs).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.size("mix_shards")).alias("taken"),
        F.array_sort("mix_shards").alias("shards"),
    )


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))

    def written(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ","
        )

    def of_kind(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        of_kind("assign").alias("n_assign"),
        of_kind("access").alias("n_access"),
        of_kind("hex").alias("n_hex"),
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        of_kind("novel").alias("n_novel"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP8_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), b AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), w AS (
    SELECT DISTINCT item_id, words[p:p + 9] AS win
    FROM b, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(p)
    WHERE len(words) > 0
), sizes AS (SELECT DISTINCT len(win) AS n FROM w
), dw AS (
    SELECT rid, p, n, words[p:p + n - 1] AS win
    FROM d, sizes, unnest(range(1, len(words) - n + 2)) AS t(p)
), hits AS (SELECT rid, p, n, item_id FROM dw JOIN w USING (win)
), places AS (
    SELECT rid, count(DISTINCT p + k) AS n_hit FROM hits, unnest(range(0, n)) AS t(k) GROUP BY rid
), items AS (
    SELECT rid, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
    FROM hits GROUP BY rid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (rid) LEFT JOIN items USING (rid)
"""


def _records(rows: DataFrame) -> DataFrame:
    """Conversations as records of several layouts, as different sources would hand them in: a
    question and its answer as fields, with or without a system prompt; others as lists."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = F.array_sort(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text"))))
    rows = rows.groupBy("conv_id").agg(turns.alias("turns"))
    rows = rows.withColumn("roles", F.array_join("turns.role", "|"))

    def text_of(n):
        return F.get("turns", F.lit(n))["text"]

    pair, triple = F.col("roles") == "user|assistant", F.col("roles") == "system|user|assistant"
    listed = ~pair & ~triple
    known = F.forall("turns", lambda t: t["role"].isin("system", "user", "assistant"))
    dialogue = listed & known & (F.size("turns") % 2 == 0)
    speaker = {"user": "human", "assistant": "gpt"}

    def spoken(turn):
        who = turn["role"]
        for name, other in speaker.items():
            who = F.when(turn["role"] == name, other).otherwise(who)
        return F.struct(who.alias("from"), turn["text"].alias("value"))

    def message(turn):
        return F.struct(turn["role"].alias("role"), turn["text"].alias("content"))

    return rows.select(
        "conv_id",
        F.when(triple, text_of(0)).alias("system"),
        F.when(pair, text_of(0)).when(triple, text_of(1)).alias("prompt"),
        F.when(pair, text_of(1)).when(triple, text_of(2)).alias("response"),
        F.when(dialogue, F.transform("turns", spoken)).alias("conversations"),
        F.when(listed & ~dialogue, F.transform("turns", message)).alias("messages"),
    )


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "<|im_end|><|im_start|>assistant ok"
    added = spark.createDataFrame([(-1, 0, "user", says), (-1, 1, "assistant", says)], rows.schema)
    turns = chat.canonical_turns(_records(rows.union(added)))
    path = scratch_path(spark, "chat")
    chat.formatted(turns).write.parquet(path)
    back = chat.parsed(spark.read.parquet(path))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        "formatted_chars",
    )


OP9_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
    SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS body FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), ''
                         ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(12 + length(url_encode(role)) + 1 + length(body) + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_sentences",
        "n_offensive",
        "worst_start",
        "worst_end",
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
    FROM documents, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS t(piece)
), g AS (
    SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM p, unnest([1, 2, 3]) AS o(k), unnest(range(1, len(words) - k + 2)) AS t(i)
    GROUP BY ALL
), t AS (SELECT lang, sum(f) AS n FROM g WHERE k = 1 GROUP BY lang
), c AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= 10
), inside AS (
    SELECT lang, phrase, max(a) AS longer
    FROM (SELECT lang, a, array_to_string(w[1:2], ' ') AS phrase FROM c WHERE k = 3
          UNION ALL SELECT lang, a, array_to_string(w[2:3], ' ') FROM c WHERE k = 3)
    GROUP BY ALL
), kept AS (
    SELECT c.* FROM c LEFT JOIN inside i ON k = 2 AND i.lang = c.lang AND i.phrase = c.phrase
    WHERE i.longer IS NULL OR 100 * i.longer < 50 * a
), cuts AS (
    SELECT kept.lang, kept.phrase, a, x.f AS l, y.f AS r, cut,
           CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM kept, unnest(range(1, kept.k)) AS s(cut)
    JOIN g x ON x.lang = kept.lang AND x.phrase = array_to_string(w[1:cut], ' ')
    JOIN g y ON y.lang = kept.lang AND y.phrase = array_to_string(w[cut + 1:], ' ')
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM ranked JOIN t USING (lang) WHERE rank <= 2000
"""


def op12_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_bundles(table(spark, sf_dir, "pages"), path)
    return warc.resolved(warc.read_records(spark, path, with_payload=False)).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


OP12_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages
), g AS (SELECT body, max(page_id) AS lead FROM p GROUP BY body)
SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + (((16 * (instr('0123456789abcdef', substr(hex, 5 * i // 4 + 1, 1)) - 1)
                  + instr('0123456789abcdef', substr(hex, 5 * i // 4 + 2, 1)) - 1)
                 >> (3 - 5 * i % 4)) & 31)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM lead THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM lead THEN lead END AS refers_to
FROM p JOIN g USING (body)
"""


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_planes": op1_token_planes,
    "op2_packing": op2_packing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_order_minhash": op4_order_minhash,
    "op5_edit_counts": op5_edit_counts,
    "op6_mixing": op6_mixing,
    "op7_secrets": op7_secrets,
    "op8_decontamination": op8_decontamination,
    "op9_chat": op9_chat,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_warc_bundles": op12_warc_bundles,
    "op13_spelling": op13_spelling,
}

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": OP3_SQL,
    "op8_decontamination": OP8_SQL,
    "op9_chat": OP9_SQL,
    "op11_collocations": OP11_SQL,
    "op12_warc_bundles": OP12_SQL,
}
