"""The operators' queries over the given tables, and their SQL checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .contamination import contaminated
from .convnet import quality
from .conversations import CONTROL, END, MIDDLE, START, chained, digest, format_conversations
from .hilbert import shard
from .minhash import near_duplicates
from .mixing import mix
from .nearest import binary_code, nearest
from .pages import main_text
from .quantise import digest as codebook_digest
from .quantise import product_codes, with_label_errors
from .substrings import remove_repeats
from .toxicity import toxicity
from .trie import borrowed_openings, prefix_trie
from .urls import judge

QUERIES = {}
ORACLES = {}


def table(spark, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


@query("op1_substring_dedup")
def substring_dedup(spark, folder):
    kept = remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_minhash_near_dedup")
def minhash_near_dedup(spark, folder):
    return near_duplicates(table(spark, folder, "documents"))


@query("op3_cube_mixing")
def cube_mixing(spark, folder):
    mixed = mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op5_hilbert_sharding")
def hilbert_sharding(spark, folder):
    return shard(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op8_toxicity")
def toxic_documents(spark, folder):
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op9_decontamination")
def decontamination(spark, folder):
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


_CODE = " | ".join(f"CASE WHEN embedding[{i + 1}] > 0 THEN 1::UBIGINT << {i} ELSE 0::UBIGINT END" for i in range(64))


@query(
    "op7_multi_index_hashing",
    f"""WITH c AS (SELECT vec_id, {_CODE} AS code FROM embeddings),
    p AS (SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id, CAST(bit_count(xor(q.code, c.code)::BIT) AS INT) AS distance
      FROM c q JOIN c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INT) AS rank FROM p)
    SELECT query_id, neighbor_id, distance, rank FROM r WHERE rank <= 10""",
)
def multi_index_hashing(spark, folder):
    rows = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), binary_code(F.col("embedding")).alias("code"))
    return nearest(rows.where("id % 100 = 0"), rows, 10)


#: The rule list (verdict, host, path).
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


@query("op10_url_rules")
def url_rules(spark, folder):
    """A page's label is the quality of the document whose number its path ends with."""
    pages = table(spark, folder, "pages")
    number = F.regexp_extract("url", r"://[^/?#]*/(?:[^?#]*/)?(\d+)[^/\d?#]*/?(?:[?#].*)?$", 1).cast("long")
    quality = table(spark, folder, "labels").groupBy("doc_id").agg((1 - F.min("quality")).alias("bad"))
    labelled = pages.select("url", number.alias("doc_id")).join(quality, "doc_id").select("url", "bad")
    return judge(pages, labelled, URL_RULES)


def _escaped(column: str) -> str:
    out = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for c in CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


@query(
    "op4_reply_trees",
    f"""WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      CAST(sum({len(START + MIDDLE + END)} + length({_escaped('role')}) + length({_escaped('text')})) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id""",
)
def reply_trees(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    more = spark.range(2).select(F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = turns.unionByName(more)
    return digest(format_conversations(chained(turns)))


@query("op2_page_differencing")
def page_differencing(spark, folder):
    return main_text(table(spark, folder, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def _product_code_sql(parts: int = 16, entries: int = 64, length: int = 4, rounds: int = 2) -> str:
    """The same rounds by comparing each part with its whole codebook."""
    along = range(length)
    each = lambda text: ", ".join(text.format(j=j) for j in along)
    square = " + ".join(f"(c.x{j} - e.x{j}) * (c.x{j} - e.x{j})" for j in along)
    steps = [f"""
      k AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) - 1 AS r, vec_id, label, embedding FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      c AS (SELECT r, p, {each(f"CAST(floor(256 * CAST(embedding[p * {length} + {{j}} + 1] AS DOUBLE)) AS BIGINT) AS x{{j}}")} FROM k, range({parts}) t(p)),
      e0 AS (SELECT p, r AS e, {each("x{j}")} FROM c WHERE r < {entries})"""]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS (SELECT c.r, c.p, min(({square}) * {entries} + e.e) AS best FROM c JOIN e{n} e ON c.p = e.p GROUP BY c.r, c.p)")
        if n < rounds:
            steps.append(f"""m{n} AS (SELECT a.p, a.best % {entries} AS e, {each("CAST(floor(sum(x{j}) / count(*)) AS BIGINT) AS x{j}")}
              FROM a{n} a JOIN c ON a.r = c.r AND a.p = c.p GROUP BY ALL),
              e{n + 1} AS (SELECT p, e, {each(f"coalesce(m{n}.x{{j}}, e{n}.x{{j}}) AS x{{j}}")} FROM e{n} LEFT JOIN m{n} USING (p, e))""")
    book = " || ',' || ".join(f"x{j}" for j in along)
    steps.append(f"s AS (SELECT sha256(string_agg({book}, ',' ORDER BY p, e)) AS h FROM e{rounds})")
    steps.append(f"""o AS (SELECT r, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error
      FROM a{rounds} GROUP BY r)""")
    return f"""WITH {", ".join(steps)} SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      h AS codebooks_sha256 FROM o JOIN k USING (r), s"""


@query("op11_vector_codes", _product_code_sql())
def vector_codes(spark, folder):
    codes, codebooks = product_codes(table(spark, folder, "embeddings"))
    codes = with_label_errors(codes).select(F.col("id").alias("vec_id"), "code", "error", "label_error")
    return codes.withColumn("codebooks_sha256", F.lit(codebook_digest(codebooks)))


@query(
    "op12_conversation_trie",
    """WITH t AS (SELECT conv_id, turn, length(coalesce(text, '')) AS n, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
        FROM conversations WHERE conv_id IS NOT NULL),
      b AS (SELECT DISTINCT conv_id, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)) AS bytes FROM t),
      -- crc32 bit by bit: each byte is taken in at the first of its eight steps
      h AS (SELECT conv_id, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(bytes, lambda c: [c, 0, 0, 0, 0, 0, 0, 0]))),
        lambda a, x: xor(xor(a, x) >> 1, CASE WHEN xor(a, x) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 6 AS h FROM b),
      o AS (SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(n ORDER BY turn NULLS FIRST, id) AS ns FROM t GROUP BY conv_id),
      r AS (SELECT o.conv_id, list_concat(coalesce(s.ids[1:h], []), o.ids[h + 1:]) AS ids, list_concat(coalesce(s.ns[1:h], []), o.ns[h + 1:]) AS ns
        FROM o JOIN h USING (conv_id) LEFT JOIN o s ON s.conv_id = o.conv_id - o.conv_id % 100),
      p AS (SELECT conv_id, d, ids[1:d] AS key, CASE WHEN d > 0 THEN ns[d] ELSE 0 END AS n, d = len(ids) AS ends FROM r, range(len(ids) + 1) u(d)),
      k AS (SELECT key, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(n) AS saved,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY key, d),
      c AS (SELECT key[1:d - 1] AS key, count(*) AS n_children FROM k WHERE d > 0 GROUP BY ALL),
      w AS (SELECT k.*, coalesce(n_children, 0) AS n_children FROM k LEFT JOIN c USING (key)),
      a AS (SELECT key[1:v] AS key, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM w, range(d + 1) u(v) GROUP BY ALL)
    SELECT w.conv_id, w.d AS depth, q.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
    FROM w JOIN a ON w.key = a.key LEFT JOIN k q ON w.d > 0 AND q.key = w.key[1:w.d - 1]""",
)
def conversation_trie(spark, folder):
    return prefix_trie(borrowed_openings(table(spark, folder, "conversations")))


@query("op13_byte_convnet")
def byte_convnet(spark, folder):
    return quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
