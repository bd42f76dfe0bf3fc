"""The registered queries of the package and their SQL forms."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexcorpus.llm import (
    chat, decontaminate, embed_dedup, lang_id, packing, periodic_runs, prefix_trie, sharding, simhash, suffix_dedup, suffix_tree_lm,
    token_counts, toxicity,
)
from lexcorpus.llm.batches import sliced
from lexcorpus.llm.store import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(job: Query) -> Query:
        QUERIES[name] = job
        if sql is not None:
            ORACLES[name] = sql
        return job

    return add


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns)


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: words in threes, two differing bits at most."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.near_duplicates(docs, words=3, distance=2).select("doc_id", "fingerprint", "component_id")


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), shown AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS body,
    regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') AS who
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(12 + length(who) + 1 + length(body) + 11)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""


@query("op7_chat", CHAT_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as event logs, folded, rendered, and read back."""
    own = "<|im_end|><|im_start|>assistant ok"
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    messages = chat.fold(chat.events_of(rows.unionByName(extra)))
    return chat.digests(chat.rendered(messages))


VECTORS_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b
  WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT low.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, low.vec_id = component_id AS kept
FROM low LEFT JOIN n USING (vec_id)
"""


@query("op8_vectors", VECTORS_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors with a cosine of 0.9 or more."""
    return embed_dedup.near_vectors(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), cosine=0.9)


@query("op10_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards whose row counts differ by one at most."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    known = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(known) + 1).cast("long").alias("size"), F.crc32(known.cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("text_hash"),
    )
    placed = sharding.shuffled_shards(rows, ["doc_id", "size", "text_crc32", "text_hash"], shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def remainder(divisor: int) -> F.Column:
    """crc32 of the document id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


@query("op1_language")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from four of five."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = lang_id.train(docs.where(remainder(5) != 0))
    held_out = F.coalesce(remainder(5) == 0, F.lit(True)).alias("held_out")
    rows = lang_id.identified(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out, "lang_pred", "score", "rejected")


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels of three of four."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    labels = read(spark, sf_dir, "labels", "doc_id", "toxic")
    rows = toxicity.scored(docs, toxicity.train(docs, labels, remainder(4) != 2))
    held_out = F.coalesce(remainder(4) == 2, F.lit(True)).alias("held_out")
    return rows.select("doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op9_decontaminate")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it covers."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return decontaminate.leaks(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    return packing.packed(read(spark, sf_dir, "documents", "doc_id", "text"))


@query("op4_language_model")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the suffix tree and the unigram of six of seven."""
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model, counts = suffix_tree_lm.train(docs.where(F.coalesce(remainder(7) != 2, F.lit(False))))
    rows = suffix_tree_lm.scored(docs, model, counts)
    held_out = F.coalesce(remainder(7) == 2, F.lit(True)).alias("held_out")
    return rows.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score", "spelled_score", "event_score")


@query("op2_suffix_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without the 200-byte strings that start at two places."""
    rows = suffix_dedup.deduplicated(read(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op11_token_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, and whether they are over 512."""
    return token_counts.counted(read(spark, sf_dir, "documents", "doc_id", "text"), limit=512)


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeating words in all documents, a tenth of which get a periodic end first."""
    return periodic_runs.summarized(repeating(read(spark, sf_dir, "documents", "doc_id", "text")))


def repeating(docs: DataFrame) -> DataFrame:
    """``docs`` where the texts of ids whose crc32 h (of the id as text) is a multiple of 10 repeat a
    stretch from some word on: for n words and g = h div 10, from word a = g mod n, with a period of
    1 + (n - a) div (3 + g mod 8). Null ids and texts without words stay as they are."""
    at, id_at = docs.columns.index("text"), docs.columns.index("doc_id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column(at).to_pylist()
            for i, doc_id in enumerate(batch.column(id_at).to_pylist()):
                h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
                words = texts[i].split() if h is not None and h % 10 == 0 and texts[i] else []
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    texts[i] = b" ".join(words[: a + p] + [words[a + k % p] for k in range(p, n - a)])
            columns = [pa.array(texts, pa.binary()) if k == at else batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    as_bytes = docs.withColumn("text", F.col("text").cast("binary"))
    return as_bytes.mapInArrow(work, as_bytes.schema)


TRIE_SQL = r"""
WITH crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS mark,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), info AS (
  SELECT conv_id, n, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 4 AS h
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id), crc
), built AS (
  SELECT i.conv_id, t.place, t.mark, t.words FROM info i JOIN turns t ON t.conv_id = i.conv_id - i.conv_id % 20 AND t.place < i.h
  UNION ALL SELECT i.conv_id, t.place + 10, t.mark, t.words FROM info i JOIN turns t ON t.conv_id = i.conv_id AND t.place >= i.h
), paths AS (
  SELECT info.conv_id, coalesce(list(mark ORDER BY place) FILTER (WHERE mark IS NOT NULL), []) AS path,
    coalesce(list(words ORDER BY place) FILTER (WHERE mark IS NOT NULL), []) AS words
  FROM info LEFT JOIN built ON built.conv_id = info.conv_id GROUP BY info.conv_id
), nodes AS (
  SELECT path[1:d] AS node, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce((count(*) - 1) * any_value(words[d]), 0) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(path) = d), '')) AS ends_sha256
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM paths) GROUP BY ALL HAVING true
), children AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), shaped AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)
), below AS (
  SELECT node[1:k] AS node, sum(saved) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM shaped) GROUP BY 1
)
SELECT s.conv_id, s.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, s.n_convs, s.n_children::BIGINT AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, s.ends_sha256
FROM shaped s JOIN below b USING (node) LEFT JOIN shaped p ON s.depth > 0 AND p.node = s.node[1:s.depth - 1]
"""


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations whose first h = crc32(id as text) mod 4 turns are those of conversation
    c - c mod 20, and the ids of all conversations."""
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    givers = sizes.select(F.col("conv_id").alias("giver"), F.col("n").alias("given"))
    known = sizes.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 20).alias("giver"))
    known = known.join(givers, "giver", "left").withColumn("given", F.least("h", F.coalesce("given", F.lit(0))))
    known = stored(known, "trie-rebuilt")
    own = turns.join(known, "conv_id").where("place >= h")
    own = own.select("conv_id", (F.col("place") - F.col("h") + F.col("given") + 1).alias("depth"), "mark", "words")
    heads = turns.where("place < 3 AND conv_id % 20 = 0").withColumnRenamed("conv_id", "giver")
    taken = heads.join(known, "giver").where("place < h").select("conv_id", (F.col("place") + 1).alias("depth"), "mark", "words")
    return own.unionByName(taken), known.select("conv_id")


@query("op12_prefix_trie", TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prefixes of the rebuilt conversations."""
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return prefix_trie.nodes(*rebuilt(stored(prefix_trie.turns_of(rows), "trie-placed")))
