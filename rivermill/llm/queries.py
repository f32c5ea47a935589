"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivermill.llm import (
    chat,
    lexical,
    merkle,
    mixing,
    pii,
    quality,
    repeats,
    simhash,
    suffixes,
    token_counts,
    token_files,
    topk,
    transducer,
)
from rivermill.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def vocabulary() -> str:
    """Where the byte-level vocabulary file is on this machine."""
    return public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    out = mixing.mixed(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and loss text of every conversation, read back from its formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"),
    )
    return chat.digests(rows.unionByName(planted))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    out = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang"
    )


@query
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text decoded from them, as digests."""
    return transducer.round_trip(table(spark, sf_dir, "documents"), vocabulary())


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every text."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary())


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document in token files, read back."""
    return token_files.read(token_files.write(table(spark, sf_dir, "documents"), vocabulary()))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: base spans, and those that the detector adds."""
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of near-duplicates of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 vectors of highest inner product with every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20, scale=64)


ORACLE["op6_topk"] = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 200 bytes that also start elsewhere."""
    return suffixes.digests(table(spark, sf_dir, "documents"))


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether it still verifies after tampering with some."""
    return merkle.verified(merkle.manifest(table(spark, sf_dir, "documents")))


@query
def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without windows of 13 words that an earlier document has."""
    return repeats.digests(table(spark, sf_dir, "documents"))


ORACLE["op2_chat"] = r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
clean AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows),
sized AS (
  SELECT *, length('[INST][/INST]</s>') + length(role) + length(text)
    + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')) AS chars FROM clean),
listed AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars) AS chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss
  FROM sized GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(3 + chars AS BIGINT) AS formatted_chars FROM listed
"""

# Every 200-byte string with its number of starts; covered bytes; then the runs of bytes that are left, in hexadecimal.
ORACLE["op9_suffixes"] = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
sized AS (SELECT *, octet_length(b) AS n FROM texts),
starts AS (SELECT r, unnest(range(1, n - 198)) AS s FROM sized WHERE n >= 200),
strings AS (SELECT starts.r, s, hash(hex(array_slice(b, s, s + 199))) AS h,
  md5(hex(array_slice(b, s, s + 199))) AS m FROM starts JOIN sized USING (r)),
often AS (SELECT h, m FROM strings GROUP BY h, m HAVING count(*) > 1),
hits AS (SELECT r, s FROM strings SEMI JOIN often USING (h, m)),
runs AS (SELECT r, s, sum(CASE WHEN s <= before + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY s) AS run
  FROM (SELECT r, s, lag(s) OVER (PARTITION BY r ORDER BY s) AS before FROM hits)),
spans AS (SELECT r, run, min(s) AS a, max(s) + 199 AS z FROM runs GROUP BY r, run),
gaps AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
pieces AS (
  SELECT r, a, hex(array_slice(b, before + 1, a - 1)) AS piece FROM gaps JOIN sized USING (r) WHERE a - 1 > before
  UNION ALL
  SELECT sized.r, n + 1, hex(array_slice(b, coalesce(z, 0) + 1, n))
  FROM sized LEFT JOIN (SELECT r, max(z) AS z FROM spans GROUP BY r) USING (r) WHERE n > coalesce(z, 0)),
rest AS (SELECT r, string_agg(piece, '' ORDER BY a) AS left_over FROM pieces GROUP BY r),
counted AS (SELECT r, sum(z - a + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(left_over, ''))) AS kept_sha256
FROM sized LEFT JOIN counted USING (r) LEFT JOIN rest USING (r)
"""


def _merkle_sql() -> str:
    """Checksums bit by bit; then the levels of all languages' trees, and of the tree over their subroots, one after another."""

    def field(name: str) -> str:
        return f"coalesce(CAST(strlen(CAST({name} AS VARCHAR)) AS VARCHAR) || ':' || CAST({name} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        fields = [field(name) for name in ("doc_id", "source", "lang", "n_chars")]
        return f"sha256({' || '.join([*fields, field(text)])})"

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = "xor(c, ascii(d)::BIGINT)"
    for _ in range(8):
        steps = f"list_transform([{steps}], lambda x: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)[1]"
    parts = [
        f"""WITH RECURSIVE crc AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS rest, 4294967295::BIGINT AS c FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, rest[2:], {steps} FROM (SELECT doc_id, rest, c, rest[1] AS d FROM crc WHERE rest <> '')),
checked AS (SELECT doc_id AS id, xor(c, 4294967295) % 3 = 0 AS tampered FROM crc WHERE rest = ''),
rows AS (
  SELECT doc_id, lang, {leaf("text")} AS leaf, CASE WHEN tampered THEN {leaf("lowered")} END AS folded
  FROM (SELECT *, {lowered} AS lowered FROM documents) LEFT JOIN checked ON doc_id = id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM rows),
down0 AS (
  SELECT doc_id, lang, i, i AS at, leaf, leaf AS node, coalesce(folded, leaf) AS folded, '' AS proof FROM placed),
n0 AS (SELECT lang, i, leaf AS node, count(*) OVER (PARTITION BY lang) AS n FROM placed)"""
    ]

    def level(k: int, tree: str, n: str, down: str) -> str:
        """One level up for ``n`` (nodes by tree) and ``down`` (documents with the node over them)."""
        on = f"s.{tree} IS NOT DISTINCT FROM d.{tree} AND s.i // 8 = d.at // 8" if tree else "s.i // 8 = d.at // 8"
        by = f"{tree}, " if tree else ""
        part = f"PARTITION BY {tree}" if tree else ""
        return f"""{n}{k + 1} AS (
  SELECT {by}i, node, count(*) OVER ({part}) AS n FROM (
    SELECT {by}i // 8 AS i, CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY i)) END AS node
    FROM {n}{k} GROUP BY {by}i // 8)),
r{n}{k} AS (SELECT {by}i // 8 AS i, any_value(n) AS n, list(node ORDER BY i) AS run FROM {n}{k} GROUP BY {by}i // 8),
{down}{k + 1} AS (
  SELECT d.doc_id, d.lang, d.i, d.at // 8 AS at, d.leaf, {"d.node" if tree else "d.subroot"},
    CASE WHEN r.n = 1 THEN d.folded ELSE sha256(array_to_string(r.run[:d.at % 8], '') || d.folded
      || array_to_string(r.run[d.at % 8 + 2:], '')) END AS folded,
    d.proof || CASE WHEN r.n = 1 THEN '' ELSE array_to_string(r.run[:d.at % 8], '') || array_to_string(r.run[d.at % 8 + 2:], '') END
      AS proof
  FROM {down}{k} d JOIN r{n}{k} r ON {on.replace("s.i // 8", "r.i").replace("s.", "r.")})"""

    depth = 9
    parts += [level(k, "lang", "n", "down") for k in range(depth)]
    parts.append(f"""m0 AS (
  SELECT row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, lang, node, count(*) OVER () AS n FROM n{depth}),
up0 AS (
  SELECT d.doc_id, d.lang, d.i, m.i AS at, d.leaf, m.node AS subroot, d.folded, d.proof
  FROM down{depth} d JOIN m0 m ON m.lang IS NOT DISTINCT FROM d.lang)""")
    parts += [level(k, "", "m", "up") for k in range(depth)]
    parts.append(f"""last AS (
  SELECT u.*, m.node AS root FROM up{depth} u, m{depth} m)""")
    return ",\n".join(parts) + """
SELECT doc_id, lang, i AS place, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = root AS verified FROM last"""


ORACLE["op11_merkle"] = _merkle_sql()

ORACLE["op12_lexical"] = r"""
WITH found AS (
  SELECT doc_id, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS r FROM documents)),
asked AS (
  SELECT DISTINCT item_id, r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS r FROM benchmark)),
counted AS (SELECT doc_id, r, term, count(*) AS tf FROM found GROUP BY doc_id, r, term),
sized AS (SELECT r, count(*) AS n FROM found GROUP BY r),
means AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS total FROM sized),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(documents) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counted, means GROUP BY term),
factors AS (SELECT r, 100 - 50 + ((50 * n * documents) // total) AS m FROM sized, means),
scored AS (
  SELECT a.r AS q, item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM asked a JOIN counted c USING (term) JOIN weights USING (term) JOIN factors f ON f.r = c.r
  GROUP BY a.r, item_id, c.r, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLE["op13_repeats"] = r"""
WITH said AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT r, doc_id, words, unnest(range(1, len(words) - 11)) AS s FROM said WHERE len(words) >= 13),
windows AS (SELECT r, doc_id, s, md5(array_to_string(words[s:s + 12], ' ')) AS w FROM starts),
least AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w),
late AS (SELECT r, s FROM windows JOIN least USING (w) WHERE least < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(s, s + 13)) AS place FROM late),
each AS (SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM said),
remaining AS (
  SELECT r, string_agg(word, ' ' ORDER BY place) AS rest, count(*) AS n FROM each ANTI JOIN gone USING (r, place) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(rest, '')) AS kept_sha256
FROM said LEFT JOIN remaining USING (r)
"""
