"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pluvio.llm.latent import find_leaks
from pluvio.llm.minhash import near_classes
from pluvio.llm.ordinal import grade_documents
from pluvio.llm.packing import pack_documents
from pluvio.llm.perplexity import quality_rules
from pluvio.llm.prefixes import prefix_trie
from pluvio.llm.resampling import resample
from pluvio.llm.sharding import shard_documents
from pluvio.llm.simhash import near_duplicates
from pluvio.llm.substring import remove_repeats
from pluvio.llm.suffix import remove_repeated_bytes
from pluvio.llm.tokens import id_files
from pluvio.llm.wrappers import main_text


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and selection of all documents."""
    return grade_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_kn_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and perplexity bands of all documents."""
    found = quality_rules(_table(spark, sf_dir, "documents"), characters=True)
    return found.drop("_h")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    found = near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", "fingerprint", "component_id")


def op4_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return main_text(_table(spark, sf_dir, "pages"))


def op5_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 of all documents by law ``key``."""
    return shard_documents(_table(spark, sf_dir, "documents"), shards=40)


def op6_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and the benchmark items that they hold."""
    found = find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("_h")


def op7_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of all documents after removing 13-word repeats."""
    found = remove_repeats(_table(spark, sf_dir, "documents"), length=13)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_two_stage_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes left of all documents after removing 400-byte repeats."""
    return remove_repeated_bytes(_table(spark, sf_dir, "documents"), length=400).drop("_h")


def op9_addressable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to and read back from id files."""
    return id_files(_table(spark, sf_dir, "documents"), added_tokens=True)


def op10_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return pack_documents(_table(spark, sf_dir, "documents"), capacity=2048, added_tokens=True)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of the shared prefixes of all conversations."""
    return prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents by 4-word shingles at 0.8."""
    return near_classes(_table(spark, sf_dir, "documents"), shingle=4, percent=80)


def op13_quickselect_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of all documents, drawn towards the benchmark's words."""
    found = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), percent=10)
    return found.drop("n_words")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ordinal_quality": op1_ordinal_quality,
        "op2_kn_perplexity": op2_kn_perplexity,
        "op3_simhash": op3_simhash,
        "op4_wrappers": op4_wrappers,
        "op5_hash_tree": op5_hash_tree,
        "op6_latent_decontamination": op6_latent_decontamination,
        "op7_seed_extend": op7_seed_extend,
        "op8_two_stage_suffix": op8_two_stage_suffix,
        "op9_addressable_ids": op9_addressable_ids,
        "op10_swap_packing": op10_swap_packing,
        "op11_prefix_trie": op11_prefix_trie,
        "op12_bbit_minhash": op12_bbit_minhash,
        "op13_quickselect_resampling": op13_quickselect_resampling,
    }


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"
_PLAIN_WORDS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, bit by bit."""
    code = f"hex(encode({text}))"
    octets = f"list_transform(range(1, length({code}), 2), lambda k: CAST('0x' || substr({code}, k, 2) AS BIGINT))"
    step = "list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, b: {step}))"


def _trie_sql() -> str:
    return f"""
    WITH own AS (
        SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS l,
               {_crc32_sql("CAST(conv_id AS VARCHAR)")} % 4 AS h
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    rebuilt AS (
        SELECT o.conv_id, list_concat(coalesce(f.l[1:o.h], []), o.l[o.h + 1:]) AS seq
        FROM own o LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 20),
    prefixes AS (SELECT conv_id, d, seq[1:d] AS p FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM rebuilt)),
    nodes AS (SELECT p, d, min(conv_id) AS c, count(*) AS m FROM prefixes GROUP BY p, d),
    ends AS (
        SELECT seq AS p, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS sha
        FROM rebuilt GROUP BY seq),
    children AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
    below AS (SELECT p, d, m, unnest(range(d + 1)) AS k FROM nodes),
    subtree AS (
        SELECT b.p[1:b.k] AS p, count(*) FILTER (WHERE c.n IS NULL) AS leaves,
               sum(CASE WHEN b.d > 0 THEN (b.m - 1) * len(regexp_extract_all(b.p[b.d].t, {_WORDS})) ELSE 0 END) AS saved
        FROM below b LEFT JOIN children c ON c.p = b.p GROUP BY 1)
    SELECT n.c AS conv_id, n.d AS depth, u.c AS parent_conv_id, n.m AS n_convs, coalesce(c.n, 0) AS n_children,
           s.leaves AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, coalesce(e.sha, sha256('')) AS ends_sha256
    FROM nodes n JOIN subtree s ON s.p = n.p LEFT JOIN children c ON c.p = n.p LEFT JOIN ends e ON e.p = n.p
    LEFT JOIN nodes u ON n.d > 0 AND u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]"""


def _repeats_sql() -> str:
    return f"""
    WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
    windows AS (
        SELECT doc_id, unnest(s) AS s, generate_subscripts(s, 1) AS i
        FROM (SELECT doc_id, list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' ')) AS s FROM texts)),
    first AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
    gone AS (
        SELECT DISTINCT doc_id, i + unnest(range(13)) AS i
        FROM windows JOIN first USING (s) WHERE doc_id > least),
    words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM texts),
    kept AS (
        SELECT doc_id, count(g.i) AS n_removed, string_agg(x, ' ' ORDER BY w.i) FILTER (WHERE g.i IS NULL) AS kept
        FROM words w LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (doc_id)"""


def _near_sql() -> str:
    return f"""
    WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_WORDS}) AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                       ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda k: array_to_string(w[k:k + 3], ' '))) END AS g
        FROM texts),
    shingles AS (SELECT doc_id, unnest(g) AS x FROM sets),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
        FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
        SELECT a, b FROM pairs JOIN sets s ON s.doc_id = a JOIN sets t ON t.doc_id = b
        WHERE 100 * n >= 80 * (len(s.g) + len(t.g) - n)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM sets UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    classes AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, len(g) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN classes USING (doc_id)"""


def _resampling_sql() -> str:
    return f"""
    WITH docs AS (SELECT doc_id, regexp_extract_all({_FOLDED}, {_PLAIN_WORDS}) AS w FROM documents),
    goal AS (SELECT regexp_extract_all({_FOLDED}, {_PLAIN_WORDS}) AS w FROM benchmark),
    here AS (SELECT doc_id, unnest(w) AS x FROM docs),
    there AS (SELECT unnest(w) AS x FROM goal),
    buckets AS (SELECT x, {_crc32_sql("x")} % 10000 AS k FROM (SELECT x FROM here UNION SELECT x FROM there)),
    s AS (SELECT k, count(*) AS n FROM here JOIN buckets USING (x) GROUP BY k),
    t AS (SELECT k, count(*) AS n FROM there JOIN buckets USING (x) GROUP BY k),
    gains AS (
        SELECT k, CAST(floor(1000 * ln(
                   CAST((coalesce(t.n, 0) + 1) * ((SELECT sum(n) FROM s) + 10000) AS DOUBLE)
                   / CAST((s.n + 1) * (coalesce((SELECT sum(n) FROM t), 0) + 10000) AS DOUBLE))) AS BIGINT) AS gain
        FROM s LEFT JOIN t USING (k)),
    weights AS (SELECT doc_id, sum(gain) AS weight FROM here JOIN buckets USING (x) JOIN gains USING (k) GROUP BY doc_id),
    scores AS (
        SELECT doc_id, len(w) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
               CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((
                   CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                   / 4294967296))) AS BIGINT) AS score
        FROM docs LEFT JOIN weights USING (doc_id)),
    ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scores WHERE n_features >= 20)
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
    FROM scores LEFT JOIN ranks USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    """SQL of those queries that DuckDB can run over whole tables (doc_id unique, as in the tables)."""
    return {
        "op7_seed_extend": _repeats_sql(),
        "op11_prefix_trie": _trie_sql(),
        "op12_bbit_minhash": _near_sql(),
        "op13_quickselect_resampling": _resampling_sql(),
    }
