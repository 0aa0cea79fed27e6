"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.bpe import bpe_encode
from skein.llm.collocations import collocations, frequent_phrases
from skein.llm.decontaminate import contained_items
from skein.llm.fingerprints import fingerprint_documents
from skein.llm.html_extract import extract_main_text
from skein.llm.language_id import identify, train
from skein.llm.lm_scoring import lm_score
from skein.llm.pieces import piece_encode
from skein.llm.simhash import simhash_near_dups
from skein.llm.spelling import corpus_words, spelling_variants
from skein.llm.substring_dedup import relative_lz_dedup
from skein.llm.token_counts import count_tokens
from skein.llm.warc import warc_round_trip

LEARN_LANGUAGE = "crc32(cast(doc_id as string)) % 3 <> 1"
LEARN_LM = "crc32(cast(doc_id as string)) % 10 <> 0"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_documents(spark, sf_dir)).select("doc_id", "n_tokens")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = train(docs, LEARN_LANGUAGE)
    return identify(docs.select("doc_id", "text"), model).select("doc_id", (~F.expr(LEARN_LANGUAGE)).alias("held_out"), "lang_pred", "score", "lang_ambiguous")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = relative_lz_dedup(_documents(spark, sf_dir))
    words = F.array_join(F.filter(F.split(F.coalesce("kept_text", F.lit("")), "[\x20\x09-\x0D]+"), lambda w: w != ""), " ")
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2(F.encode(words, "UTF-8"), 256).alias("kept_sha256"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_pages(spark, sf_dir))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(_pages(spark, sf_dir))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(_documents(spark, sf_dir))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dups(_documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(_documents(spark, sf_dir), LEARN_LM)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(corpus_words(_documents(spark, sf_dir)))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(frequent_phrases(_documents(spark, sf_dir)))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_encode(_documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_language_id, op3_fingerprints, op4_substring_dedup, op5_html_extraction, op6_warc_revisits, op7_byte_bpe, op8_decontamination, op9_simhash, op10_lm_scoring, op11_spelling_variants, op12_collocations, op13_sentencepiece)}

ORACLES = {
    "op4_substring_dedup": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
        m AS (SELECT s, min(doc_id) AS least FROM g GROUP BY s),
        c AS (SELECT DISTINCT doc_id, i + j AS p FROM g JOIN m USING (s), unnest(range(13)) AS t(j) WHERE doc_id > least),
        p AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
        k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM p ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op11_spelling_variants": r"""
        WITH x AS (SELECT range AS i FROM range(256)),
        x1 AS (SELECT i, CASE WHEN i & 1 = 1 THEN xor(i >> 1, 3988292384) ELSE i >> 1 END AS v FROM x),
        x2 AS (SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM x1),
        x3 AS (SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM x2),
        x4 AS (SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM x3),
        x5 AS (SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM x4),
        x6 AS (SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM x5),
        x7 AS (SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM x6),
        x8 AS (SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM x7),
        crc AS (SELECT list(v ORDER BY i) AS t FROM x8),
        runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
        low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM runs WHERE length(run) >= 7),
        uses AS (SELECT doc_id || ':' || w AS s, w, count(*) AS n FROM low GROUP BY ALL),
        bytes AS (SELECT w, n, list_transform(range(strlen(s)), lambda j: ('0x' || substr(hex(encode(s)), 2 * j + 1, 2))::BIGINT) AS b FROM uses),
        hashed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, c: xor(t[(xor(a, c) & 255) + 1], a >> 8)), 4294967295) AS h FROM bytes, crc),
        cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM hashed),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        holes AS (SELECT word, n, p, substr(word, 1, p) || substr(word, p + 2) AS less FROM words, unnest(range(length(word))) AS u(p)),
        pairs AS (SELECT a.word, b.word AS near, b.n AS m FROM holes a JOIN holes b ON a.less = b.less AND a.p = b.p AND a.word <> b.word
                  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.less = b.word
                  UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.less = b.word),
        best AS (SELECT word, count(*) AS n_near, max(m) AS m, arg_min(near, (-m, near)) AS near FROM pairs GROUP BY word),
        forms AS (SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.m >= 10 * w.n THEN b.near END AS form, CASE WHEN b.m >= 10 * w.n THEN b.m END AS form_n FROM words w LEFT JOIN best b USING (word)),
        steps AS (WITH RECURSIVE s AS (SELECT word, word AS at FROM forms UNION ALL SELECT s.word, f.form FROM s JOIN forms f ON f.word = s.at WHERE f.form IS NOT NULL) SELECT * FROM s),
        last AS (SELECT s.word, s.at AS root FROM steps s JOIN forms f ON f.word = s.at WHERE f.form IS NULL)
        SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM forms JOIN last USING (word)""",
    "op12_collocations": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
        p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
        g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM w, unnest(range(1, 5)) AS a(k), unnest(range(1, len(w) + 2 - k)) AS b(i) WHERE len(w) >= k),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
        ns AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
        cuts AS (SELECT c.lang, c.phrase, c.a, cut, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a::HUGEINT + r.a) AS score
                 FROM c, unnest(range(1, k)) AS u(cut) JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')),
        worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM c, unnest(range(2, k)) AS a(m), unnest(range(1, k + 2 - m)) AS b(i) GROUP BY ALL),
        kept AS (SELECT worst.* FROM worst LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
        FROM kept JOIN ns USING (lang) QUALIFY rank <= 2000""",
    "op6_warc_revisits": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
        SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
               CASE WHEN strlen(h) >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN strlen(h) >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM p""",
}
