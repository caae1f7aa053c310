"""The registered queries of this subpackage: name -> fn(spark, sf_dir), and SQL where it can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import bpe, collocations, decontaminate, language, line_runs, merkle, parsing, simhash, substrings, token_files, toxicity, url_filter, warc
from .common import QueryFn

QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}

#: The rules of the URL filter's query.
RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


def query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page, by the Bloom filter cascade."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), RULES)


SQL["op3_url_filter"] = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(verdict, rhost, rpath) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), fits AS (
  SELECT page_id, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS verdict
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id
)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts p LEFT JOIN fits f ON p.page_id = f.page_id
"""


@query
def op6_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, fixed-width packed, written and read back."""
    return token_files.pack_documents(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WARC archives of all pages, equal payloads as revisits, written and read back by byte ranges."""
    return warc.archive_pages(spark, table(spark, sf_dir, "pages"))


@query
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents and their decoding."""
    docs = table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False)


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of all documents (3-word shingles) and the components linked by 2 or fewer bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents; rows of fold 2 of 4 are held out of learning."""
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calibrated toxicity score of all documents; rows of fold 2 of 4 are held out of learning."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


@query
def op4_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, by locally consistent parsing."""
    return parsing.edited_likeness(table(spark, sf_dir, "documents"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a document that leaks a benchmark item."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that 13-word windows of documents with smaller ids repeat."""
    return substrings.removed_words(table(spark, sf_dir, "documents"))


@query
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents that five or more documents hold go, except in the one with the largest id."""
    return line_runs.line_report(table(spark, sf_dir, "documents"), least_chars=40, least_docs=5)


SQL["op11_line_dedup"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT rid, doc_id, pos, lines[pos] AS line,
         translate(trim(lines[pos], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rid, doc_id, lines, unnest(range(1, len(lines) + 1)) AS pos FROM docs)
), common AS (
  SELECT key, max(doc_id) AS holder FROM lines WHERE length(key) >= 40 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT l.rid, l.doc_id, l.pos, l.line, coalesce(l.doc_id < c.holder, false) AS gone FROM lines l LEFT JOIN common c ON l.key = c.key
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY rid
"""


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hash tree over all documents of each language and over the languages; every row's proof, folded from a partly altered copy."""
    docs = table(spark, sf_dir, "documents")
    return merkle.manifest(docs, merkle.lowered_claims(docs))


SQL["op12_merkle_manifest"] = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, *, CAST(doc_id AS VARCHAR) AS id_text,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents
), crc AS (
  SELECT *, xor(list_reduce([ascii(c) FOR c IN string_split(id_text, '')],
    lambda have, byte: list_reduce(range(8), lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), xor(have, byte)), 4294967295), 4294967295) AS crc FROM docs
), fields AS (
  SELECT rid, doc_id, lang, low, text, crc,
         coalesce(strlen(id_text) || ':' || id_text, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head
  FROM crc
), leaves AS (
  SELECT rid, doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(text) || ':' || CASE WHEN crc % 3 = 0 THEN low ELSE text END, '-')) AS claim
  FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves
), tree(lang, n, lvl, pos, digest) AS (
  SELECT lang, n, 0, pos, leaf FROM placed
  UNION ALL
  SELECT lang, (n + 7) // 8, lvl + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY lang, n, lvl, pos // 8
), subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), over_tree(n, lvl, pos, digest) AS (
  SELECT n, 0, pos, subroot FROM subroots
  UNION ALL
  SELECT (n + 7) // 8, lvl + 1, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)) FROM over_tree WHERE n > 1 GROUP BY n, lvl, pos // 8
), sib AS (
  SELECT a.lang, a.lvl, a.pos, string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos) AS l, string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos) AS r
  FROM tree a JOIN tree b ON a.lang IS NOT DISTINCT FROM b.lang AND a.lvl = b.lvl AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY a.lang, a.lvl, a.pos
), over_sib AS (
  SELECT a.lvl, a.pos, string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos) AS l, string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos) AS r
  FROM over_tree a JOIN over_tree b ON a.lvl = b.lvl AND a.pos // 8 = b.pos // 8 WHERE a.n > 1 GROUP BY a.lvl, a.pos
), steps AS (
  SELECT rid, s.lvl, coalesce(s.l, '') AS l, coalesce(s.r, '') AS r FROM placed p JOIN sib s ON p.lang IS NOT DISTINCT FROM s.lang AND s.pos = p.pos // CAST(8 ** s.lvl AS BIGINT)
  UNION ALL
  SELECT rid, 1000 + s.lvl, coalesce(s.l, ''), coalesce(s.r, '') FROM placed p JOIN subroots t ON p.lang IS NOT DISTINCT FROM t.lang JOIN over_sib s ON s.pos = t.pos // CAST(8 ** s.lvl AS BIGINT)
), paths AS (
  SELECT rid, list({'l': l, 'r': r} ORDER BY lvl) AS path, sha256(string_agg(l || r, '' ORDER BY lvl)) AS proof FROM steps GROUP BY rid
), folded AS (
  SELECT p.*, coalesce(proof, sha256('')) AS proof, coalesce(list_reduce([s FOR s IN path], lambda have, s: {'l': '', 'r': sha256(s.l || have.r || s.r)}, {'l': '', 'r': claim}).r, claim) AS folded
  FROM placed p LEFT JOIN paths USING (rid)
)
SELECT f.doc_id, leaf, subroot, (SELECT digest FROM over_tree WHERE n = 1) AS root, proof AS proof_sha256, folded AS folded_root,
       folded = (SELECT digest FROM over_tree WHERE n = 1) AS verified
FROM folded f JOIN subroots t ON f.lang IS NOT DISTINCT FROM t.lang
"""


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 strongest phrases of 2 to 4 words of each language, from n-gram counts over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, share=80, most=2000)


SQL["op13_collocations"] = r"""
WITH low AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM low)
), counts AS (
  SELECT lang, len, phrase, count(*) AS f
  FROM (SELECT lang, len, w[i : i + len - 1] AS phrase
        FROM (SELECT lang, w, len, unnest(range(1, len(w) - len + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS len) WHERE len(w) >= len))
  GROUP BY lang, len, phrase
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE len = 1 GROUP BY lang
), often AS (
  SELECT * FROM counts WHERE f >= 30
), cuts AS (
  SELECT c.lang, c.len, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, CAST(CAST(2000000 AS HUGEINT) * c.f // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, len)) AS k FROM often WHERE len > 1) c
  JOIN often x ON x.lang = c.lang AND x.phrase = c.phrase[1 : k] JOIN often y ON y.lang = c.lang AND y.phrase = c.phrase[k + 1 : c.len]
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, phrase[i : i + short - 1] AS phrase, max(f) AS longer
  FROM (SELECT lang, len, phrase, f, short, unnest(range(1, len - short + 2)) AS i FROM often, (SELECT unnest([2, 3]) AS short) WHERE len > short)
  GROUP BY ALL
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN inside i ON s.lang = i.lang AND s.phrase = i.phrase WHERE NOT coalesce(100 * CAST(longer AS HUGEINT) >= 80 * CAST(a AS HUGEINT), false)
), ranked AS (
  SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(phrase, ' ')) AS rank FROM kept
)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN totals t ON r.lang = t.lang WHERE rank <= 2000
"""
