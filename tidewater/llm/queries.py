"""The registered queries of this package and the SQL that checks them."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        _QUERIES[name] = fn
        if sql:
            _SQL[name] = textwrap.dedent(sql).strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


#: The rules that the URL query applies.
URL_RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)


@query("op3_url_filters", r"""
    WITH rules(action, rule) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'),
                                        ('allow', 'com/fr/'), ('block', 'com/de/')),
    parts AS (SELECT action, rule, split_part(rule, '/', 1) AS rh, substr(rule, strpos(rule, '/')) AS rp FROM rules),
    judged AS (
        SELECT page_id,
               translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
        FROM pages)
    SELECT page_id, host, path,
           (SELECT max_by(rule, length(rule)) FROM parts WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS rule,
           coalesce((SELECT max_by(action, length(rule)) FROM parts
                     WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)), 'allow') AS verdict
    FROM judged
    """)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.url_filters import filter_urls, rules_table

    found = filter_urls(table(spark, sf_dir, "pages"), rules_table(spark, URL_RULES))
    return found.select("page_id", "host", "path", "rule", "verdict")


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.byte_bpe import decode_ids, encode_texts

    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return decode_ids(encode_texts(table(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern, with_bytes=False)


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_nearest_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.nearest import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op4_quality_rules", r"""
    WITH base AS (
        SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text,
               list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    tri AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM base WHERE len(w) >= 3),
    keyed AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM tri),
    twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM keyed),
    rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE c > 1) GROUP BY r),
    m AS (
        SELECT doc_id, CASE WHEN regexp_matches(lower(lang), '^[a-z]{2}$') THEN lower(lang) ELSE 'other' END AS stratum,
               len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
        FROM base LEFT JOIN rep USING (r)),
    v AS (
        SELECT *, CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
               CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
               CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_share,
               CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS word_chars_mean
        FROM m),
    grid AS (
        SELECT 'symbols_per_word' AS rule, unnest([2.0, 1.5, 1.0, 0.75, 0.5, 0.35, 0.25, 0.15, 0.1])::DOUBLE AS cutoff
        UNION ALL SELECT 'dup_line_share', unnest([0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1])::DOUBLE
        UNION ALL SELECT 'repeat_share', unnest([0.9, 0.75, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1])::DOUBLE
        UNION ALL SELECT 'word_chars_mean', unnest([40.0, 30.0, 20.0, 16.0, 13.0, 11.0])::DOUBLE),
    truth AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
    trials AS (
        SELECT * FROM v JOIN truth USING (doc_id)
        QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) = 1),
    counted AS (
        SELECT stratum, rule, cutoff, sum(good)::BIGINT AS n, sum((hit AND good = 1)::INT)::BIGINT AS k, sum((hit AND good = 0)::INT) AS caught
        FROM (SELECT stratum, rule, cutoff, good,
                     CASE rule WHEN 'symbols_per_word' THEN symbols_per_word WHEN 'dup_line_share' THEN dup_line_share
                               WHEN 'repeat_share' THEN repeat_share ELSE word_chars_mean END >= cutoff AS hit
              FROM trials CROSS JOIN grid)
        GROUP BY ALL),
    tested AS (
        SELECT *, CASE WHEN k > n * 0.01 THEN 1.0 ELSE
                 list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))) END
               > 0.05 / (4 * (SELECT count(DISTINCT stratum) FROM counted)) AS fails
        FROM counted),
    best AS (
        SELECT stratum, rule, max_by(cutoff, (caught * 0.2 - k) * 1000000 + cutoff) AS cutoff
        FROM tested t
        WHERE NOT EXISTS (SELECT 1 FROM tested u WHERE u.stratum = t.stratum AND u.rule = t.rule AND u.cutoff >= t.cutoff AND u.fails)
          AND caught * 0.2 - k > 0
        GROUP BY ALL)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT EXISTS (
               SELECT 1 FROM best b WHERE b.stratum = v.stratum AND
                   CASE b.rule WHEN 'symbols_per_word' THEN symbols_per_word WHEN 'dup_line_share' THEN dup_line_share
                               WHEN 'repeat_share' THEN repeat_share ELSE word_chars_mean END >= b.cutoff) AS kept
    FROM v
    """)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.quality_rules import judge

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return judge(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.common import remainder_col
    from tidewater.llm.toxicity import score_toxicity

    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    found = score_toxicity(docs, labels, remainder_col(F.col("doc_id"), 3) != 1)
    return found.select("doc_id", (remainder_col(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


@query("op1_substring_dedup", r"""
    WITH t AS (
        SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM (
            SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)),
    win AS (SELECT doc_id, i, md5(string_agg(word, ' ') OVER f) AS k, count(*) OVER f AS n FROM t
            WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)),
    least AS (SELECT k, min(doc_id) AS m FROM win WHERE n = 50 GROUP BY k),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM win JOIN least USING (k) WHERE n = 50 AND m < doc_id),
    marked AS (SELECT t.doc_id, t.i, word, g.i IS NOT NULL AS gone FROM t LEFT JOIN gone g ON g.doc_id = t.doc_id AND g.i = t.i),
    summed AS (SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
                      string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM marked GROUP BY doc_id)
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM documents LEFT JOIN summed USING (doc_id)
    """)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.substring_dedup import find_repeats

    return find_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


#: Mail addresses and runs of nine or more digits, which the token-count query masks.
PRIVATE = r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+|\d{9,}"


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text before and after its mail addresses and long numbers are masked."""
    from tidewater.llm.token_counts import count_edits, masking

    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return count_edits(table(spark, sf_dir, "documents"), masking(PRIVATE, "[private]"), ranks, pattern)


@query("op5_lm_scoring")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.lm_scoring import score_documents

    return score_documents(table(spark, sf_dir, "documents"))


@query("op8_jaccard_join", r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
    t AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM w),
    five AS (SELECT doc_id, i, n, md5(string_agg(word, ' ') OVER f) AS s, count(*) OVER f AS c FROM t
             WINDOW f AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
    sh AS (SELECT DISTINCT doc_id, s FROM five WHERE c = 5 OR (n < 5 AND i = 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * both_ >= 75 * (x.n + y.n - both_)),
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
    least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
    FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least ON a = doc_id
    """)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.jaccard_join import link_documents

    return link_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op12_simhash")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.simhash import near_copies

    return near_copies(table(spark, sf_dir, "documents"))


def repeated_tail(doc_id: int | None, n: int):
    """Of one document in ten, words from a place on that repeat the first p of them; a null id counts as the empty text."""
    import zlib

    import numpy as np

    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.periodic_runs import find_runs, with_digests

    found = with_digests(find_runs(table(spark, sf_dir, "documents"), repeated_tail))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


@query("op11_spelling_variants", r"""
    WITH RECURSIVE tab AS (
        SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
            FROM range(256) r(i))),
    runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k
        FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
        WHERE length(run) >= 7 GROUP BY ALL),
    hashed AS (
        SELECT run, k, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(
                   string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
                   lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))),
                   lambda c, b: xor(t[xor(c & 255, b) + 1], c >> 8))) AS h
        FROM runs, tab),
    changed AS (
        SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, k
        FROM hashed),
    words AS (SELECT word, sum(k)::BIGINT AS n FROM changed WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
    holes AS (
        SELECT word, n, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole, substr(word, 1, i - 1) || substr(word, i + 1) AS less
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
    near AS (
        SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.hole = b.hole AND a.word <> b.word
        UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.less
        UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.less),
    best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS n FROM near GROUP BY word),
    formed AS (
        SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 10 * words.n THEN other END AS form,
               CASE WHEN best.n >= 10 * words.n THEN best.n END AS form_n
        FROM words LEFT JOIN best USING (word)),
    chain(word, root, step) AS (
        SELECT word, word, 0 FROM formed
        UNION ALL SELECT chain.word, formed.form, step + 1 FROM chain JOIN formed ON formed.word = chain.root WHERE formed.form IS NOT NULL),
    roots AS (SELECT word, max_by(root, step) AS root FROM chain GROUP BY word)
    SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
    """)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.spelling import drop_one_letter, spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"), drop_one_letter)
