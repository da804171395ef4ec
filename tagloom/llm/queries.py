"""The registered queries of this subpackage: ``opN_<name>`` and ``pipeline``, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm import alignment, byte_pairs, chat, fill_in_middle, fixity, language, licences, mixing, near_text, near_vectors, top_inner, toxicity, url_filter, url_seeds
from tagloom.llm.scratch import Scratch
from tagloom.small import small_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(plan: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = plan
        if oracle is not None:
            ORACLES[name] = oracle
        return plan

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op8_minhash_near_dedup")
def minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_text.near_duplicates(table(spark, folder, "documents"), Scratch(spark, "op8"), size=4, percent=80)


@query("op2_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, folder, "embeddings"), Scratch(spark, "op2"), threshold=0.9)


@query("op6_exact_top_k")
def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_inner.top_inner(table(spark, folder, "embeddings"), Scratch(spark, "op6"), lambda vec_id: vec_id % 20 == 0, k=20, scale=64.0)


RANKS = "byte_bpe_50k.tiktoken"


def token_digests(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    ranks = byte_pairs.read_ranks(public_tokenizers.path(RANKS))
    return byte_pairs.encode_and_check(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN).drop("ids")


@query("op3_byte_level_bpe")
def byte_level_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"))


@query("op5_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.languages_of(table(spark, folder, "documents"), Scratch(spark, "op5"))


@query("op9_toxicity")
def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_of(table(spark, folder, "documents"), table(spark, folder, "labels"), Scratch(spark, "op9"))


def _licence_sql() -> str:
    known = " UNION ALL ".join(
        f"SELECT '{name}' AS licence, {licences._pairs(licences._words(text))!r} AS pairs" for name, text in licences.TEMPLATES.items()
    )
    return f"""
    WITH units AS (
      SELECT DISTINCT doc_id, unnest(list_concat(string_split(text, chr(10)), list_concat(string_split(text, chr(10) || chr(10)), [text]))) AS unit
      FROM documents WHERE text IS NOT NULL),
    words AS (SELECT doc_id, string_split(trim(regexp_replace(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM units),
    grams AS (
      SELECT doc_id, list_distinct(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS g
      FROM words WHERE w <> ['']),
    known AS ({known}),
    scored AS (
      SELECT doc_id, licence, len(list_intersect(g, pairs)) AS shared, len(g) + len(pairs) AS total
      FROM grams JOIN known ON 200 * least(len(g), len(pairs)) >= 80 * (len(g) + len(pairs)))
    SELECT doc_id, licence, max(2.0::DOUBLE * shared / total) AS dice, count(*) AS n_units
    FROM scored WHERE 200 * shared >= 80 * total GROUP BY doc_id, licence"""


@query("op4_licence_scan", _licence_sql())
def licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licences(table(spark, folder, "documents"), percent=80)


_CHAT_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, regexp_matches(text, '[<\[]\\+/?(?:s>|INST\]|ROLE\])') OR contains(text,
      CASE role WHEN 'user' THEN ' [/INST]' WHEN 'assistant' THEN '</s>' ELSE ' [/ROLE]' END) AS clash
  FROM rows),
written AS (
  SELECT *, length(CASE WHEN clash THEN regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]|ROLE\]))', '\1\\\2\3', 'g') ELSE text END)
    + CASE role WHEN 'user' THEN 18 WHEN 'assistant' THEN 5 ELSE 19 + length(url_encode(role)) END AS chars
  FROM marked)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id"""


@query("op7_chat_formatting", _CHAT_SQL)
def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    more = spark.sql("""
        SELECT -1L AS conv_id, 0L AS turn, 'user' AS role, '</s>[INST] ok [/INST]' AS text
        UNION ALL SELECT -1L, 1L, 'assistant', '</s>[INST] ok [/INST]'""")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat.digests(chat.format_conversations(turns))


#: Target weights of the mix, in hundredths; all other sources share the rest.
MIX = {"src0": 20, **{f"src{i}": 5 for i in range(1, 10)}, **{f"src{i}": 3 for i in range(10, 20)}}
MIX_OTHER = 5
MIX_BLOCK = 32


def _mix_sql() -> str:
    slots = ", ".join(f"('{pool}', {turn}, {place})" for pool, turn, place in mixing.windows_in_sql({**MIX, mixing.OTHER: MIX_OTHER}))
    return f"""
    WITH slots(pool, turn, place) AS (VALUES {slots}),
    shares AS (SELECT pool, count(*) AS share FROM slots GROUP BY pool),
    pooled AS (
      SELECT doc_id, CASE WHEN source IN (SELECT pool FROM shares WHERE pool <> '*') THEN source ELSE '*' END AS pool FROM documents),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY pool ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS place_in_pool FROM pooled),
    blocked AS (SELECT *, place_in_pool // {MIX_BLOCK} AS block FROM ranked JOIN shares USING (pool))
    SELECT doc_id, blocked.pool, block::BIGINT AS block, (block // share * {sum(MIX.values()) + MIX_OTHER} + place)::BIGINT AS slot,
      ((block // share * {sum(MIX.values()) + MIX_OTHER} + place) * {MIX_BLOCK} + place_in_pool % {MIX_BLOCK})::BIGINT AS "position"
    FROM blocked JOIN slots ON slots.pool = blocked.pool AND slots.turn = block % share"""


@query("op10_source_mixing", _mix_sql())
def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return mixing.mixed(docs, MIX, MIX_OTHER, MIX_BLOCK).select("row.doc_id", "pool", "block", "slot", "position")


_FIXITY_SQL = """
WITH records AS (
  SELECT page_id AS record_id, page_id // 4096 AS file_id,
    strlen('WARC/1.1' || 'WARC-Type: resource' || 'WARC-Record-ID: <urn:page:' || page_id || '>' || 'WARC-Target-URI: ' || coalesce(url, '')
      || 'Content-Type: text/html' || 'Content-Length: ' || strlen(coalesce(html, ''))) + 14 + strlen(coalesce(html, '')) + 4 AS length
  FROM pages),
placed AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY file_id ORDER BY record_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset" FROM records)
SELECT file_id, record_id, "offset"::BIGINT AS "offset", length::BIGINT AS length, CASE WHEN record_id % 211 = 5 THEN 'missing' ELSE 'changed' END AS fault
FROM placed WHERE record_id % 211 = 5 OR record_id % 97 = 3
UNION ALL SELECT file_id, record_id, NULL, length, 'extra' FROM placed WHERE record_id % 307 = 7 AND record_id % 211 <> 5"""


@query("op1_merkle_fixity_audit", _FIXITY_SQL)
def merkle_fixity_audit(spark: SparkSession, folder: str) -> DataFrame:
    records = fixity.warc_records(table(spark, folder, "pages"))
    scratch = Scratch(spark, "op1")
    original = scratch.keep(fixity.leaves(records), "leaves")
    return fixity.audit(original, fixity.leaves(fixity.damaged(records)), scratch)


@query("op11_cross_tokenizer_alignment")
def cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    both = alignment.Tokenizers.read(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN
    )
    return alignment.alignment(table(spark, folder, "documents"), both, Scratch(spark, "op11"))


_MIDDLE_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units, ('0x' || h[1:8])::BIGINT AS h1,
    ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM texts),
cuts AS (
  SELECT doc_id, text, units, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(units[1:a], '') AS p, array_to_string(units[a + 1:b], '') AS m, array_to_string(units[b + 1:], '') AS s FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""


@query("op12_fill_in_middle", _MIDDLE_SQL)
def fill_in_middle_digests(spark: SparkSession, folder: str) -> DataFrame:
    cut = fill_in_middle.transform(table(spark, folder, "documents"), seed=42, percent=50, suffix_first=80)
    whole = fill_in_middle.restored(F.col("output"), F.col("form"))
    return cut.select(*cut.columns[:-1], F.sha2("output", 256).alias("output_sha256"), F.sha2(whole, 256).alias("restored_sha256"))


#: Rules of the URL filter: a host with its subdomains, and the beginning of the path.
URL_RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


@query("op13_url_filter")
def judged_urls(spark: SparkSession, folder: str) -> DataFrame:
    model = url_filter.fit(small_table(spark, url_seeds.labelled(), "url string, blocked int"))
    return url_filter.judged(table(spark, folder, "pages"), URL_RULES, model)
