"""Registered queries of the training-data operators, with their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidepool.llm import (bpe, decontaminate, hamming_ann, html_extract, lexical, licenses, phrases, quality_rules, sharding,
                          simhash, substring_dedup, suffix_dedup, token_counts)
from tidepool.llm.common import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return deco


@query("op1_byte_bpe")
def op1_byte_bpe(spark, sf_dir):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode_digest(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicate_digest(table(spark, sf_dir, "documents"))


# Contaminated documents by brute force over all windows of an item's size is too slow in SQL on whole tables;
# tests/llm holds the query against it on small ones.
@query("op2_benchmark_decontamination")
def op2_benchmark_decontamination(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
u AS (SELECT rid, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM w),
g AS (SELECT rid, pos, word, lead(word, 1) OVER p AS w1, lead(word, 2) OVER p AS w2 FROM u WINDOW p AS (PARTITION BY rid ORDER BY pos)),
again AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, word, w1, w2) > 1 AND w2 IS NOT NULL AS twice FROM g),
covered AS (SELECT rid, twice OR coalesce(lag(twice, 1) OVER p, false) OR coalesce(lag(twice, 2) OVER p, false) AS c
            FROM again WINDOW p AS (PARTITION BY rid ORDER BY pos)),
rep AS (SELECT rid, count(*) FILTER (WHERE c) AS n_repeat_words FROM covered GROUP BY rid),
b AS (SELECT rid, count(*) FILTER (WHERE word = '|') AS bars FROM u GROUP BY rid),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d),
dup AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT d.rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
             coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
             coalesce(bars, 0) AS bars
      FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN b USING (rid)),
f AS (SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                + CASE WHEN 10 * n_symbols > 2 * n_words THEN 4 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 6 * n_lines THEN 8 ELSE 0 END
                + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END
                + CASE WHEN 10 * bars > 3 * n_words THEN 32 ELSE 0 END AS failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, (failed & 3) <> 0 AS base_failed,
       failed = 0 AS kept, failed::BIGINT AS failed FROM f
"""


@query("op5_quality_rules", OP5_SQL)
def op5_quality_rules(spark, sf_dir):
    return quality_rules.ledger_digest(table(spark, sf_dir, "documents"))


@query("op9_suffix_array_dedup")
def op9_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.repeats_digest(table(spark, sf_dir, "documents"))


@query("op6_sharding")
def op6_sharding(spark, sf_dir):
    return sharding.shard_digest(table(spark, sf_dir, "documents"))


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query("op10_html_extraction")
def op10_html_extraction(spark, sf_dir):
    return html_extract.extract_digest(table(spark, sf_dir, "pages"))


def _op3_sql() -> str:
    rows = ", ".join("({}, '{}', '{}')".format(i, name, text.replace("'", "''")) for i, (name, text) in enumerate(licenses.TEMPLATES))
    return r"""
WITH tpl(template, license, t) AS (VALUES """ + rows + r"""),
d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
lines AS (SELECT rid, doc_id, string_split(t, chr(10)) AS us FROM d),
paras AS (SELECT rid, doc_id, string_split_regex(t, '\n[ \t]*\n') AS us FROM d),
units AS (SELECT rid, doc_id, 'line' AS kind, unnest(range(len(us))) AS unit, unnest(us) AS t FROM lines
          UNION ALL SELECT * FROM (SELECT rid, doc_id, 'paragraph' AS kind, unnest(range(len(us))) AS unit, unnest(us) AS t FROM paras)
          WHERE contains(t, chr(10))),
have AS (SELECT rid, doc_id, kind, unit, regexp_extract_all(lower(t), '[\p{L}\p{N}]+') AS ws FROM units),
have_u AS (SELECT rid, doc_id, kind, unit, unnest(list_zip(ws[:-2], ws[2:])) AS b FROM have WHERE len(ws) > 1),
have_b AS (SELECT DISTINCT rid, doc_id, kind, unit, b FROM have_u),
have_n AS (SELECT rid, kind, unit, count(*) AS n_have FROM have_b GROUP BY ALL),
want AS (SELECT template, license, regexp_extract_all(lower(t), '[\p{L}\p{N}]+') AS ws FROM tpl),
want_u AS (SELECT template, license, unnest(list_zip(ws[:-2], ws[2:])) AS b FROM want),
want_b AS (SELECT DISTINCT template, license, b FROM want_u),
want_n AS (SELECT template, count(*) AS n_want FROM want_b GROUP BY template),
pairs AS (SELECT rid, doc_id, kind, unit, template, license, count(*) AS common FROM have_b JOIN want_b USING (b) GROUP BY ALL)
SELECT doc_id, kind, unit::INTEGER AS unit, license, template, round(2 * common / (n_have + n_want), 6) AS dice
FROM pairs JOIN have_n USING (rid, kind, unit) JOIN want_n USING (template)
WHERE 2 * common / (n_have + n_want) >= 0.9"""


@query("op3_license_scan", _op3_sql())
def op3_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


# Runs of sentences and lines by brute force are too slow in SQL on whole tables; tests/llm holds the query against it.
@query("op3_license_passages")
def op3_license_passages(spark, sf_dir):
    return licenses.passages(table(spark, sf_dir, "documents"))


# Runs under 20 words stay: with every repeated line gone, half of the documents without a repeated passage lost text.
@query("op4_substring_dedup")
def op4_substring_dedup(spark, sf_dir):
    return substring_dedup.dedup_digest(table(spark, sf_dir, "documents"), min_run=20)


# Nearest neighbours among those an index finds: tests/llm measures the recall and the scores against brute force.
@query("op11_hamming_ann")
def op11_hamming_ann(spark, sf_dir):
    return hamming_ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(""" + LOWERED.format("text") + r""", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
           FROM documents WHERE text IS NOT NULL),
stats AS (SELECT count(*) AS nd, sum(len(ws))::BIGINT AS total FROM d WHERE len(ws) > 0),
words AS (SELECT rid, unnest(ws) AS term FROM d),
tfs AS (SELECT rid, term, count(*) AS tf FROM words GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM dfs, stats),
i AS (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL),
iw AS (SELECT item_id, text, unnest(regexp_extract_all(""" + LOWERED.format("text") + r""", '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM i),
want AS (SELECT item_id, text, term, count(*) AS times FROM iw GROUP BY ALL),
m AS (SELECT rid, doc_id, 100 - 25 + ((25 * len(ws)::BIGINT * nd) // total) AS m FROM d, stats WHERE len(ws) > 0 AND doc_id IS NOT NULL),
s AS (SELECT item_id, text, rid, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM want JOIN w USING (term) JOIN tfs USING (term) JOIN m USING (rid) GROUP BY ALL),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 20
"""


@query("op12_ranked_lexical", OP12_SQL)
def op12_ranked_lexical(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(""" + LOWERED.format("coalesce(text, '')") + r""", '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM d),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
spots AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS pos FROM w),
grams AS (SELECT lang, k, array_to_string(ws[pos:pos + k - 1], ' ') AS phrase FROM spots, (VALUES (1), (2), (3), (4)) AS s(k) WHERE pos + k - 1 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k AS size, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (SELECT lang, size, phrase, a, ws, unnest(range(1, size)) AS cut FROM c),
parts AS (SELECT lang, size, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS head, array_to_string(ws[cut + 1:], ' ') AS tail FROM cuts),
scored AS (SELECT p.lang, p.size, p.phrase, p.a, p.cut, h.f AS l, t.f AS r, ((2000000::HUGEINT * p.a) // (h.f + t.f))::BIGINT AS score
           FROM parts p JOIN f h ON h.lang = p.lang AND h.k = p.cut AND h.phrase = p.head
           JOIN f t ON t.lang = p.lang AND t.k = p.size - p.cut AND t.phrase = p.tail),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS first FROM scored),
inner_at AS (SELECT lang, a AS outer_a, ws, size, unnest(range(2, size)) AS len FROM c),
inner_of AS (SELECT lang, outer_a, ws, size, len, unnest(range(1, size - len + 2)) AS pos FROM inner_at),
covered AS (SELECT lang, array_to_string(ws[pos:pos + len - 1], ' ') AS phrase, max(outer_a) AS outer_a FROM inner_of GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN covered o USING (lang, phrase) WHERE first = 1 AND (outer_a IS NULL OR 100::HUGEINT * outer_a < 80::HUGEINT * a)),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op13_phrase_collocations", OP13_SQL)
def op13_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))
