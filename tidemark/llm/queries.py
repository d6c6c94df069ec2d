"""The registered queries of this subpackage, each beside its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import automata, chat, decontaminate, fingerprint, mixing, pii, quality, repair, secrets, simhash, suffix, tokens, variants
from tidemark.llm.common import batches, read, values
from tidemark.session import new_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix.deduplicate(read(spark, folder, "documents"), digest=True)
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"]).alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.lower(F.hex("kept")).alias("kept_sha256"),
    )


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op3_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    schema = pa.schema(
        [(n, pa.int64()) for n in ("doc_id", "n_assign", "n_access", "n_hex")]
        + [("base_sha256", pa.string()), ("spans", pa.string())]
    )

    def run(stream):
        def rows():
            for doc_id, found in values(stream):
                spans = [(s["kind"], s["start"], s["end"]) for s in found]
                base = [s for s in spans if s[0] in ("assign", "access", "hex")]
                counts = [sum(s[0] == kind for s in base) for kind in ("assign", "access", "hex")]
                yield doc_id, *counts, secrets.digest(base), secrets.joined(spans)

        yield from batches(schema, rows())

    return secrets.scan(read(spark, folder, "documents")).mapInArrow(
        run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    )


def op4_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"), words=4, radius=4)


def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.find(read(spark, folder, "documents"), read(spark, folder, "benchmark"), ["doc_id"])
    return found.select(
        "kept.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    scored = quality.score(docs, quality.train(docs, read(spark, folder, "labels")), ["doc_id"]).select("kept.doc_id", "score")
    predicted = (F.col("score") >= quality.KEEP).cast("int").alias("predicted")
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = automata.deduplicate(read(spark, folder, "documents"), digest=True)
    return found.select("doc_id", "n_words", "n_removed", F.lower(F.hex("kept")).alias("kept_sha256"))


#: A conversation whose texts are made of control strings.
CONTROL_CHAT = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    chats = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    chats = chats.unionByName(spark.createDataFrame(CONTROL_CHAT, "conv_id bigint, turn bigint, role string, text string"))
    return chat.read_back(chat.format_chats(chats, public_tokenizers.path("byte_bpe_50k.json")))


def op9_token_output(spark: SparkSession, folder: str) -> DataFrame:
    path = new_dir(spark, "op9")
    tokens.write_tokens(read(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), 1)
    return tokens.documents_of(tokens.read_tokens(spark, path))


def op10_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.compare(read(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.group_variants(read(spark, folder, "documents"))


def op12_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    found = pii.find(docs, pii.train(docs), ["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    sha = F.sha2(text(base).cast("binary"), 256).alias("base_sha256")
    return found.select("kept.doc_id", *counts, sha, text(F.col("spans")).alias("spans"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    damaged = repair.damage(read(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    found = repair.repair(damaged, digest=True)
    return found.withColumn("repaired_sha256", F.lower(F.hex("kept"))).drop("kept")


QUERIES: dict[str, Query] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_secret_scans": op3_secret_scans,
    "op4_simhash_dedup": op4_simhash_dedup,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_chat_formatting": op8_chat_formatting,
    "op9_token_output": op9_token_output,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_pii": op12_pii,
    "op13_conversation_repair": op13_conversation_repair,
}

_ESCAPED = r"""replace(replace(replace(replace(replace({}, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')"""

_WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""



def _edited(way: str, cost: str, edit: str) -> str:
    """A way with one more edit: six digits of cost, then the audit, so that the least text is the best way."""
    return f"lpad((left({way}, 6)::INT + {cost})::VARCHAR, 6, '0') || substr({way}, 7) || '{edit}'"


def _with_insertions(w: list[str]) -> str:
    """The best ways to the four states of the grammar, insertions at the end included, as columns w0 to w3."""
    user = f"least({w[2]}, " + ", ".join(_edited(w[s], "5", "I") for s in (0, 1, 3)) + ")"
    return f"{w[0]} AS w0, {w[1]} AS w1, {user} AS w2, least({w[3]}, {_edited(user, '5', 'I')}) AS w3"


_REPAIR = f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(n, range(8)), lambda c, k: if(c & 1 = 1, xor(c >> 1, 3988292384), c >> 1))) AS t),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
hashed AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(name) + 1), lambda k: ascii(name[k])::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM given, crc),
damaged AS (
  SELECT conv_id, turn, if(kind = 4, 'user', role) AS role, unnest(range(if(kind = 3, 2, 1))) AS copy,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed WHERE kind <> 0),
turns AS (
  SELECT dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS g, *,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending FROM damaged),
faults AS (
  SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS before,
    CASE WHEN ending = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM turns),
rows_ AS (
  SELECT g, i, c, coalesce(fault IN ('blank', 'duplicate'), false) AS gone, if(fault = 'truncated', 5, 0) AS stays FROM faults),
ways AS (
  SELECT g, 0 AS i, {_with_insertions(["'000000'", "NULL::VARCHAR", "NULL::VARCHAR", "NULL::VARCHAR"])}
  FROM (SELECT DISTINCT g FROM faults)
  UNION ALL
  SELECT g, i, {_with_insertions(["d0", "d1", "d2", "d3"])} FROM (
    SELECT r.g, r.i,
      {_edited("w0", "2", "D")} AS d0,
      least({_edited("w1", "2", "D")}, if(NOT gone AND c = 's', {_edited("w0", "stays", "K")}, NULL)) AS d1,
      least({_edited("w2", "2", "D")},
        if(NOT gone AND c = 'u', least({", ".join(_edited(w, "stays", "K") for w in ("w0", "w1", "w3"))}), NULL),
        if(NOT gone AND c <> 'u', least({", ".join(_edited(w, "stays + 1", "R") for w in ("w0", "w1", "w3"))}), NULL)) AS d2,
      least({_edited("w3", "2", "D")}, if(NOT gone, if(c = 'a', {_edited("w2", "stays", "K")}, {_edited("w2", "stays + 1", "R")}), NULL)) AS d3
    FROM ways w JOIN rows_ r ON r.g = w.g AND r.i = w.i + 1) AS steps (g, i, d0, d1, d2, d3)),
best AS (
  SELECT w.g, least(w0, w3) AS way FROM ways w JOIN (SELECT g, max(i) AS i FROM faults GROUP BY g) USING (g, i)),
edits AS (SELECT g, substr(way, 7) AS audit, unnest(range(1, length(way) - 5)) AS p FROM best),
left_ AS (
  SELECT g, p, audit[p] AS edit, length(replace(left(audit, p), 'I', '')) AS i,
    length(replace(left(audit, p), 'D', '')) AS place FROM edits WHERE audit[p] <> 'D'),
placed AS (
  SELECT l.*, f.role, f.text, max(if(place = 1 AND edit = 'K' AND f.c = 's', 1, 0)) OVER (PARTITION BY l.g) AS led
  FROM left_ l LEFT JOIN faults f ON f.g = l.g AND f.i = l.i),
repaired AS (
  SELECT g, sha256(string_agg(if(edit = 'K', role, if((place - led) % 2 = 1, 'user', 'assistant')) || ':'
    || if(edit = 'I', '', text), chr(10) ORDER BY p)) AS sha FROM placed GROUP BY g),
counted AS (
  SELECT conv_id, g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id, g)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(left(way, 6)::BIGINT, 0) AS cost,
  coalesce(substr(way, 7), '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best USING (g) LEFT JOIN repaired USING (g)"""

ORACLES: dict[str, str] = {
    "op13_conversation_repair": _REPAIR,
    "op5_benchmark_decontamination": f"""
WITH items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, list_slice(w, i, i + 9) AS win
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, i, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths)),
hits AS (SELECT doc_id, i, len(win) AS n, item FROM places JOIN windows USING (win)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op8_chat_formatting": f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<s>[INST]  [/INST]</s>') + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id""",
}
