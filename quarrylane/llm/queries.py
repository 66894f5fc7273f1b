"""Registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, fingerprint, html_extract, licenses, line_dedup, mixing, quality_rules, resampling, rule_classifier, simhash, substring_dedup, url_filter, vector_codes
from .shared import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer files are; they are not part of this repository."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.size("sentence_ids").cast("bigint").alias("n_sentences"), *(F.array_join(c, ",").alias(c) for c in ("sentence_ids", "licences", "unresolved")))


def op2_fracminhash_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_pairs(table(spark, sf_dir, "documents"))


def op3_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_documents(docs, tokenizer_path()).drop("text")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op7_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))


def op11_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")


def op13_laesa_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.compressed(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", vector_codes.code_text().alias("code"), "error", "label_error", F.lit(vector_codes.codebooks_digest(codebooks)).alias("codebooks_sha256"))


_ALL = (
    op1_license_scan, op2_fracminhash_pairs, op3_risk_controlled_rules, op4_bpe_tree, op5_url_filter,
    op6_html_extract, op7_rule_ensemble, op8_curriculum_mix, op9_simhash_groups, op10_line_dedup,
    op11_fm_substring_dedup, op12_importance_resampling, op13_laesa_codes,
)
QUERIES = {f.__name__: f for f in _ALL}


def _url_sql() -> str:
    """The URL filter in DuckDB SQL; the vocabulary's boundaries become one pattern for each term."""
    upper = "".join(map(chr, range(65, 91)))
    ordered = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, a) for a, h, p in ordered]
    cases = lambda k: "CASE " + " ".join(f"WHEN {f[0]} THEN '{f[k]}'" for f in fits) + " END"
    hits = lambda terms: " + ".join(f"regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}]){t}($|[^\\p{{L}}\\p{{N}}])')::BIGINT" for t in terms)
    return f"""WITH parts AS (
  SELECT page_id, lower(coalesce(url, '')) AS low, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), '{upper}', '{upper.lower()}') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
counted AS (SELECT *, {hits(url_filter.STRICT)} AS n_strict, {hits(url_filter.SOFT)} AS n_soft, {cases(1)} AS rule, {cases(2)} AS action FROM parts)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN n_strict > 0 OR n_soft >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict, n_strict, n_soft FROM counted"""


def _substring_sql(n: int = substring_dedup.WINDOW_WORDS) -> str:
    """Substring deduplication in DuckDB SQL: all windows by their text; a null doc_id counts as the largest."""
    return f"""WITH texts AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
windows AS (SELECT row, coalesce(doc_id, {substring_dedup.LAST}) AS whose, start, array_to_string(words[start:start + {n - 1}], ' ') AS seen FROM texts, unnest(range(1, len(words) - {n - 2})) AS u(start)),
firsts AS (SELECT seen, min(whose) AS least FROM windows GROUP BY seen),
gone AS (SELECT DISTINCT row, unnest(range(start, start + {n})) AS place FROM windows JOIN firsts USING (seen) WHERE least < whose),
placed AS (SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY place) AS kept, count(*) AS n FROM placed ANTI JOIN gone USING (row, place) GROUP BY row)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM texts LEFT JOIN kept USING (row)"""


def _resampling_sql() -> str:
    """Importance resampling in DuckDB SQL: a table of the CRC's 256 steps by its rule, applied to each different word."""
    upper, poly, r = "".join(map(chr, range(65, 91))), 0xEDB88320, resampling
    words = lambda t, more: f"SELECT {more}unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM {t}"
    return f"""WITH steps AS (SELECT list_transform(range(256), lambda x: list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {poly}) ELSE c >> 1 END, x)) AS step),
texts AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
said AS ({words("texts", "row, ")}), wanted AS ({words("benchmark", "")}),
counted AS (SELECT word, count(*) AS s FROM said GROUP BY word), asked AS (SELECT word, count(*) AS t FROM wanted GROUP BY word),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM counted UNION SELECT word FROM asked)),
bucketed AS (SELECT word, xor(list_reduce(list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT), lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % {r.BUCKETS} AS bucket FROM hexed, steps),
totals AS (SELECT bucket, sum(coalesce(s, 0)) AS s, sum(coalesce(t, 0)) AS t FROM bucketed LEFT JOIN counted USING (word) LEFT JOIN asked USING (word) GROUP BY bucket),
gained AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {r.BUCKETS})::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + {r.BUCKETS})::DOUBLE)))::BIGINT AS gain FROM totals),
weighed AS (SELECT row, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM said JOIN bucketed USING (word) JOIN gained USING (bucket) GROUP BY row),
scored AS (SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{r.SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM texts LEFT JOIN weighed USING (row)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {r.MIN_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY n_features >= {r.MIN_WORDS}) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {r.MIN_WORDS} AND place <= {r.PERCENT} * n // 100 THEN place END AS rank FROM placed"""


def _codes_sql() -> str:
    """Vector codes in DuckDB SQL, every distance computed."""
    v = vector_codes
    nearest = lambda k: f"""near{k} AS MATERIALIZED (SELECT row, part, any_value(p.v) AS v, min(struct_pack(d := list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, entry := entry)) AS best FROM parts p JOIN book{k} b USING (part) GROUP BY row, part)"""
    spread = lambda k: f"(SELECT part, best.entry AS entry, unnest(v) AS x, unnest(range(len(v))) AS i FROM near{k})"
    rounds = ",\n".join(
        f"""{nearest(k)},
means{k} AS (SELECT part, entry, list(mean ORDER BY i) AS v FROM (SELECT part, entry, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS mean FROM {spread(k)} GROUP BY part, entry, i) GROUP BY part, entry),
book{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN means{k} m USING (part, entry))"""
        for k in range(v.ROUNDS)
    )
    return f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, list_transform(embedding, lambda x: floor({v.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT row, part, v[part * (len(v) // {v.PARTS}) + 1:(part + 1) * (len(v) // {v.PARTS})] AS v FROM kept, unnest(range({v.PARTS})) AS u(part)),
book0 AS (SELECT part, row - 1 AS entry, v FROM parts WHERE row <= {v.ENTRIES}),
{rounds},
{nearest(v.ROUNDS)},
coded AS (SELECT row, string_agg(lower(lpad(hex(best.entry), 2, '0')), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM near{v.ROUNDS} GROUP BY row),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{v.ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN kept USING (row), books"""


#: The other operators need what SQL lacks: Spark's hashes, models, a tokenizer, or joins too slow there.
ORACLE_SQL = {"op5_url_filter": _url_sql(), "op11_fm_substring_dedup": _substring_sql(), "op12_importance_resampling": _resampling_sql(), "op13_laesa_codes": _codes_sql()}
