"""Named queries of the training-data operators over the test tables, and reference SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleloom.llm import (chat, hnsw, line_dedup, minhash, packing, piece_codec, prefix_trie, quality, resampling, set_join,
                          surrogates, token_counts, token_ids)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

PII_KEY = "corpus-surrogates"  # a deployment passes its own secret


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sha256(text: Column) -> Column:
    """Lowercase hex digest of a text in UTF-8."""
    return F.sha2(text.cast("binary"), 256)


@query
def op1_token_ids(spark, folder):
    """Documents written as Elias-Fano bounded token shards, and read back."""
    manifest = token_ids.write_token_ids(table(spark, folder, "documents"), BYTE_BPE, end_id=2)
    read = token_ids.read_token_ids(manifest)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op2_quality_classifier(spark, folder):
    """Quality and keep decision of every document; hosts are the sources, paths their languages."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    model = quality.train(docs, table(spark, folder, "labels"))
    scored = quality.score(docs, model, host=F.col("source"), path=F.col("lang"))
    return scored.select("doc_id", "evidence", "host_share", "path_share", "quality", "keep")


@query
def op3_hnsw_neighbours(spark, folder):
    """The ten nearest vectors of every hundredth vector."""
    return hnsw.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op4_best_fit_packing(spark, folder):
    """Pieces of all documents packed into sequences of 2048 ids by the configuration LP."""
    pieces = packing.cut_pieces(table(spark, folder, "documents"), WORD_BPE, end_id=0, capacity=2048)
    digests = pieces.select("row_id", "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.place(digests, capacity=2048).drop("row_id")


@query
def op5_token_counts(spark, folder):
    """Tokens of every document by rank-synchronous array merging."""
    return token_counts.count_tokens(table(spark, folder, "documents"), PIECE_BPE, limit=4096)


@query
def op6_piece_codec(spark, folder):
    """Every document encoded by the pair agenda and decoded by the library."""
    coded = piece_codec.encode_decode(table(spark, folder, "documents"), PIECE_BPE)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op7_pii_surrogates(spark, folder):
    """All documents with their personal data replaced by surrogates."""
    return surrogates.replace_entities(table(spark, folder, "documents").select("doc_id", "text"), PII_KEY)


@query
def op8_chat_format(spark, folder):
    """All conversations, and one made of control strings, formatted and read back."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    rows = [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)]
    turns = turns.union(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    formatted = chat.format_conversations(turns.withColumn("content", chat.text_part(F.col("text"))))
    read = formatted.withColumn("turns", chat.read_turns(F.col("formatted")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256(F.array_join(lines, "")).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        sha256(loss).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


# formatted_chars follows from the template: 23 characters of marks a turn, one more for each escaped character.
ORACLE["op8_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(23 + length(role) + length(text)
           + (length(text) - length(replace(text, chr(92), '')))
           + (length(text) - length(replace(text, '<|', ''))) / 2
           + (length(text) - length(replace(text, '<s>', ''))) / 3
           + (length(text) - length(replace(text, '</s>', ''))) / 4
           + (length(text) - length(replace(text, '[INST]', ''))) / 6
           + (length(text) - length(replace(text, '[/INST]', ''))) / 7) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query
def op9_minhash_fingerprints(spark, folder):
    """MinHash fingerprints of all documents and their edited texts."""
    return minhash.fingerprint_edits(table(spark, folder, "documents"))


@query
def op10_ngram_jaccard_join(spark, folder):
    """Components of all documents under links of 85 percent Jaccard of 4-word shingles."""
    return set_join.link_components(table(spark, folder, "documents"), width=4, percent=85)


@query
def op13_line_dedup(spark, folder):
    """All documents without the lines that at least ten documents share."""
    done = line_dedup.drop_shared_lines(table(spark, folder, "documents"), min_chars=1, min_docs=10)
    return done.select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


ORACLE["op13_line_dedup"] = """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), cut AS (
    SELECT r, unnest(range(1, len(lines) + 1)) AS place, unnest(lines) AS line FROM docs
), keyed AS (
    SELECT r, place, line,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM cut
), shared AS (
    SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10
), kept AS (
    SELECT keyed.r, string_agg(line, chr(10) ORDER BY place) AS text, count(*) AS n
    FROM keyed ANTI JOIN shared ON keyed.key = shared.key GROUP BY keyed.r
)
SELECT doc_id, len(lines) AS n_lines, len(lines) - coalesce(n, 0) AS n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept ON docs.r = kept.r
"""


@query
def op12_prefix_trie(spark, folder):
    """Nodes of the prefix trie of all conversations, each rebuilt with a head of its group's first conversation."""
    return prefix_trie.conversation_trie(table(spark, folder, "conversations"), group=100, heads=6)


# The crc32 of a list of bytes: the usual table of 256 steps, then one step a byte.
CRC_TABLE = """crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)),
        lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS steps
)"""

ORACLE["op12_prefix_trie"] = f"""
WITH {CRC_TABLE}, turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, xor(4294967295, list_reduce(
               list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda b: CAST(ascii(b) AS BIGINT))),
               lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM turns), crc
), rebuilt AS (
    SELECT c.conv_id, t.n, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.n <= c.h
    UNION ALL
    SELECT c.conv_id, t.n, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.n > c.h
), numbered AS (
    SELECT conv_id, text, row_number() OVER w AS depth,
           sha256(string_agg(length(role) || ':' || length(text) || ':' || role || text, '|') OVER w) AS prefix
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY n)
), members AS (
    SELECT conv_id, depth, prefix, length(text) AS chars FROM numbered
    UNION ALL SELECT conv_id, 0, '', 0 FROM convs
), sized AS (
    SELECT *, max(depth) OVER (PARTITION BY conv_id) AS turns FROM members
), nodes AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends_sha256
    FROM sized GROUP BY depth, prefix
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, p.prefix AS parent
    FROM nodes n LEFT JOIN members m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1
    LEFT JOIN nodes p ON p.depth = m.depth AND p.prefix = m.prefix
), counted AS (
    SELECT l.*, (SELECT count(*) FROM linked k WHERE k.depth = l.depth + 1 AND k.parent = l.prefix) AS n_children FROM linked l
), below AS (
    SELECT m.depth, m.prefix, sum(CAST(c.n_children = 0 AS BIGINT)) AS n_leaves, sum((c.n_convs - 1) * c.chars) AS saved_tokens
    FROM counted c JOIN members m ON m.conv_id = c.conv_id AND m.depth <= c.depth GROUP BY m.depth, m.prefix
)
SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, CAST(b.n_leaves AS BIGINT) AS n_leaves,
       CAST(b.saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN below b ON b.depth = c.depth AND b.prefix = c.prefix
"""


@query
def op11_importance_resampling(spark, folder):
    """Every document's weight towards the benchmark texts, and the rank of the quarter that is drawn."""
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"), percent=25, min_words=20)


ORACLE["op11_importance_resampling"] = f"""
WITH {CRC_TABLE}, texts AS (
    SELECT row_number() OVER () AS r, doc_id, true AS source, text FROM documents
    UNION ALL SELECT NULL, NULL, false, text FROM benchmark
), cut AS (
    SELECT r, doc_id, source, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS words
    FROM texts
), runs AS (
    SELECT r, doc_id, source, len(words) AS n_words, list_concat(words, list_transform(
        range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS features
    FROM cut
), each AS (
    SELECT r, source, unnest(features) AS feature FROM runs
), named AS (
    SELECT feature, xor(4294967295, list_reduce(
               list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(feature)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
               lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
    FROM (SELECT DISTINCT feature FROM each), crc
), totals AS (
    SELECT bucket, count(*) FILTER (WHERE source) AS s, count(*) FILTER (WHERE NOT source) AS t
    FROM each JOIN named USING (feature) GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000) / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
    FROM totals
), weights AS (
    SELECT r, count(*) AS n, sum(gain) AS total FROM each JOIN named USING (feature) JOIN gains USING (bucket) WHERE source GROUP BY r
), scored AS (
    SELECT doc_id, n_words, coalesce(n, 0) AS n_features,
           CAST(coalesce((total - ((total % n) + n) % n) // n, 0) AS BIGINT) AS weight,
           CAST(floor(-1000 * ln(-ln((CAST('0x' || substring(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
               / 4294967296))) AS BIGINT) AS noise
    FROM runs LEFT JOIN weights USING (r) WHERE source
), ranked AS (
    SELECT *, weight + noise AS score, n_words >= 20 AS able,
           row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id NULLS LAST, weight, n_features) AS place,
           count(*) FILTER (WHERE n_words >= 20) OVER () AS n_able
    FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * n_able // 100 THEN place END AS rank FROM ranked
"""
