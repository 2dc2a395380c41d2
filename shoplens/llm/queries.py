"""The registered queries of the subpackage, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import bpe, fingerprints, language_id, line_dedup, near_dedup, packing
from shoplens.llm import lexical_search, quality_classifier, quality_rules, secrets, spelling
from shoplens.llm import token_files, url_reputation
from shoplens.llm.tokens import word_bpe_path

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_language_id(spark, folder):
    return language_id.held_out_predictions(documents(spark, folder))


def op2_quality_rules(spark, folder):
    judged = quality_rules.judge(documents(spark, folder))
    return judged.drop("host_rejected")


def op3_fingerprints(spark, folder):
    return fingerprints.edit_likeness(documents(spark, folder))


def op4_packing(spark, folder):
    return packing.pack_documents(documents(spark, folder), word_bpe_path())


def op5_bpe(spark, folder):
    return bpe.round_trip(documents(spark, folder), word_bpe_path())


def op6_near_dedup(spark, folder):
    return near_dedup.near_duplicates(documents(spark, folder), words=3, percent=85)


def op7_token_files(spark, folder):
    return token_files.round_trip(documents(spark, folder), word_bpe_path())


def op8_quality_classifier(spark, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return quality_classifier.score_documents(documents(spark, folder), labels)


def op9_line_dedup(spark, folder):
    return line_dedup.line_digests(documents(spark, folder))


def op10_secrets(spark, folder):
    return secrets.scan(documents(spark, folder))


def op11_spelling_variants(spark, folder):
    return spelling.spelling_variants(documents(spark, folder))


def op12_url_filter(spark, folder):
    pages, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("pages", "labels"))
    return url_reputation.judge_pages(pages, labels)


def op13_lexical_search(spark, folder):
    items = spark.read.parquet(f"{folder}/benchmark.parquet")
    return lexical_search.rank_documents(documents(spark, folder), items)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_quality_rules, op3_fingerprints, op4_packing, op5_bpe,
        op6_near_dedup, op7_token_files, op8_quality_classifier, op9_line_dedup, op10_secrets,
        op11_spelling_variants, op12_url_filter, op13_lexical_search,
    )
}

# The word pattern and the characters stripped from lines are fixed by the operators.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_RULES = {
    "short": "n_words < 50",
    "repeated": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 12 * n_words",
}

OP2_SQL = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
         {_WORDS} AS words
  FROM documents),
placed AS (
  SELECT r, unnest(words) AS w, unnest(range(len(words))) AS i FROM texts),
windows AS (
  SELECT r, i, w || chr(32) || lead(w, 1) OVER o || chr(32) || lead(w, 2) OVER o AS t FROM placed
  WINDOW o AS (PARTITION BY r ORDER BY i)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS n FROM windows WHERE t IS NOT NULL)
  WHERE n > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
text_lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts),
line_counts AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM text_lines
  WHERE length(trim(line, {_SPACES})) > 0 GROUP BY r),
measures AS (
  SELECT doc_id, host, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines
  FROM texts LEFT JOIN covered USING (r) LEFT JOIN line_counts USING (r)),
long AS (
  {" UNION ALL ".join(
    f"SELECT host, '{name}' AS rule, count(*)::DOUBLE AS n, (count(*) FILTER ({rule}))::DOUBLE AS f "
    "FROM measures GROUP BY host" for name, rule in _RULES.items())}),
sums AS (
  SELECT rule, count(*)::DOUBLE AS hosts, sum(n) AS docs, sum(f) AS fails, sum(n * n) AS squares,
         sum(f * f / n) AS between_, sum(f * (1 - f / n)) AS within_ FROM long GROUP BY rule),
parts AS (
  SELECT rule, fails / docs AS mean, (docs - squares / docs) / greatest(hosts - 1, 1) AS size,
    (between_ - docs * (fails / docs) * (fails / docs)) / greatest(hosts - 1, 1) AS b,
    within_ / greatest(docs - hosts, 1) AS w FROM sums),
prior AS (
  SELECT rule, mean, 1 / greatest(least(CASE WHEN b + (size - 1) * w > 0
    THEN (b - w) / (b + (size - 1) * w) ELSE 0 END, 0.5), 0.0001) - 1 AS strength FROM parts),
rates AS (
  SELECT host, rule, (mean * strength + f) / (strength + n) AS rate FROM long JOIN prior USING (rule)),
verdicts AS (
  SELECT host, max(rate) > 0.5 AS rejected,
    {", ".join(f"bool_or(rule = '{name}' AND rate >= 0.01) AS known_{name}" for name in _RULES)}
  FROM rates GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({_RULES["short"]}) OR ({_RULES["repeated"]}) AS base_failed,
  NOT (({_RULES["short"]}) OR ({_RULES["repeated"]}) OR rejected
    OR (({_RULES["symbols"]}) AND known_symbols) OR (({_RULES["dup_lines"]}) AND known_dup_lines)
    OR (({_RULES["word_length"]}) AND known_word_length)) AS kept
FROM measures JOIN verdicts USING (host)
"""

OP6_SQL = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [words]
    ELSE list_transform(range(1, len(words) - 1), lambda i : words[i : i + 2]) END) AS s FROM texts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s
  WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a)
SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id,
  a = min(b) AS kept
FROM reached LEFT JOIN sizes ON a = sizes.doc_id GROUP BY a
"""

OP9_SQL = f"""
WITH text_lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents),
keyed AS (
  SELECT *, {_LOWER.format(f"trim(line, {_SPACES})")} AS key FROM text_lines),
marked AS (
  SELECT *, length(key) >= 10 AND doc_id <> min(doc_id) OVER (PARTITION BY key) AS lost FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# A checksum as SQL: a table of 256 steps, then one step per byte of `<doc_id>:<run>`; letters from U+00C0
# to U+00FF are the two bytes 195 and code - 64.
OP11_SQL = f"""
WITH RECURSIVE steps(i, k, c) AS (
  SELECT range, 0, range::BIGINT FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
step_table AS MATERIALIZED (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-z\u00C0-\u00FF]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
summed AS (
  SELECT run, times, xor(list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
      lambda x : CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, (unicode(x) - 64)::BIGINT] END))),
    lambda s, b : xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) AS h
  FROM runs, step_table),
words AS MATERIALIZED (
  SELECT word, sum(times)::BIGINT AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
      ELSE run END AS word FROM summed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS front, substr(word, i + 1) AS back FROM (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT DISTINCT x.word, y.word AS other, y.n AS other_n FROM cuts x JOIN cuts y USING (i, front, back) WHERE x.word <> y.word
  UNION SELECT DISTINCT cuts.word, w.word, w.n FROM cuts JOIN words w ON front || back = w.word
  UNION SELECT DISTINCT w.word, cuts.word, cuts.n FROM cuts JOIN words w ON front || back = w.word),
near AS (
  SELECT word, count(*) AS n_near, max(other_n) AS most, arg_min(other, (-other_n, encode(other))) AS best
  FROM pairs GROUP BY word),
forms AS MATERIALIZED (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN best END AS form,
    CASE WHEN most >= 5 * n THEN most END AS form_n
  FROM words LEFT JOIN near USING (word)),
followed(word, here, depth) AS (
  SELECT word, word, 0 FROM forms
  UNION ALL SELECT followed.word, form, depth + 1 FROM followed JOIN forms ON here = forms.word WHERE form IS NOT NULL)
SELECT forms.word, form, root, n, n_near, form_n
FROM forms JOIN (SELECT word, arg_max(here, depth) AS root FROM followed GROUP BY word) USING (word)
"""

_RULE_LIST = ", ".join(f"('{kind}', '{rule}')" for kind, rule in url_reputation.RULES)


def _pull(children: str, parent: str, name: str) -> str:
    """How many pages the rate of a parent counts for: one row, strength ``name``."""
    return f"""{name}_sums AS (
  SELECT sum(members) AS members, count(*)::DOUBLE AS parents, sum(pages) AS pages, sum(squares / pages) AS uneven,
    sum(rates - fails * fails / pages) AS between_, sum(within_) AS within_
  FROM (SELECT {parent}, count(*)::DOUBLE AS members, sum(n)::DOUBLE AS pages, sum(bad)::DOUBLE AS fails,
      sum(n::DOUBLE * n) AS squares, sum(bad::DOUBLE * bad / n) AS rates, sum(bad - bad::DOUBLE * bad / n) AS within_
    FROM {children} WHERE n > 0 GROUP BY {parent})),
{name}_parts AS (
  SELECT members > parents AS open, (pages - uneven) / (members - parents) AS size, between_ / (members - parents) AS b,
    within_ / greatest(pages - members, 1) AS w FROM {name}_sums),
{name} AS (
  SELECT 1 / least(greatest(CASE WHEN coalesce(open, false) THEN CASE WHEN b + (size - 1) * w > 0
    THEN (b - w) / (b + (size - 1) * w) ELSE 0 END ELSE 0.5 END, 1e-4), 0.5) - 1 AS {name} FROM {name}_parts)"""


OP12_SQL = rf"""
WITH parts AS (
  SELECT page_id, {_LOWER.format("coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
known AS (
  SELECT doc_id AS item, (avg(greatest(1 - quality, toxic)) >= 0.5)::INT AS bad FROM labels
  WHERE doc_id IS NOT NULL AND greatest(1 - quality, toxic) IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0)::BIGINT AS bad FROM (
    SELECT host, TRY_CAST(regexp_extract(path, '/([0-9]+)(\.[a-z]+)?/?$', 1) AS BIGINT) AS item FROM parts)
  LEFT JOIN known USING (item) GROUP BY host),
bare AS (
  SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM hosts),
placed AS (
  SELECT *, CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name ELSE regexp_extract(name, '([^.]*\.)?[^.]*$') END AS domain,
    CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name ELSE regexp_extract(name, '[^.]*$') END AS suffix FROM bare),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM placed GROUP BY ALL),
tops AS (SELECT suffix, '' AS root, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
overall AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS overall FROM tops),
{_pull("tops", "root", "top_pull")}, {_pull("domains", "suffix", "domain_pull")}, {_pull("placed", "domain", "host_pull")},
top_rates AS (SELECT suffix, (top_pull * overall + bad) / (top_pull + n) AS above FROM tops, top_pull, overall),
domain_rates AS (
  SELECT domain, suffix, (domain_pull * above + bad) / (domain_pull + n) AS mean FROM domains JOIN top_rates USING (suffix), domain_pull),
rated AS (
  SELECT host, host_pull + n AS weight, (host_pull * mean + bad) / (host_pull + n) AS rate
  FROM placed JOIN domain_rates USING (domain, suffix), host_pull),
blocked AS (SELECT host FROM rated WHERE rate - 1.645 * sqrt(rate * (1 - rate) / (weight + 1)) >= 0.3),
rules(kind, rule) AS (VALUES {_RULE_LIST}),
matched AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(kind, length(rule)) AS kind
  FROM parts LEFT JOIN rules
    ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
   AND starts_with(path, substr(rule, strpos(rule, '/')))
  GROUP BY page_id, host, path)
SELECT page_id, parts.host, parts.path, rule,
  coalesce(kind, CASE WHEN parts.host IN (SELECT host FROM blocked) THEN 'block' END, 'allow') AS verdict
FROM parts JOIN matched USING (page_id, host, path)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP13_SQL = f"""
WITH wanted AS (
  SELECT i, item_id, term, count(*) AS repeats FROM (
    SELECT i, item_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}')) AS term
    FROM (SELECT row_number() OVER () AS i, * FROM benchmark)) GROUP BY ALL),
own AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_TERM}') AS terms
  FROM documents),
total AS (SELECT count(*) FILTER (len(terms) > 0) AS n, sum(len(terms))::BIGINT AS l FROM own),
held AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM own)
  WHERE term IN (SELECT term FROM wanted) GROUP BY r, term),
weighed AS (
  SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total),
sized AS (SELECT r, doc_id, 75 + (25 * len(terms) * n) // greatest(l, 1) AS m FROM own, total),
scored AS (
  SELECT i, item_id, r, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN weighed USING (term) JOIN held USING (term) JOIN sized USING (r) GROUP BY ALL),
placed AS (
  SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
  FROM scored JOIN sized USING (r) WHERE score > 0)
SELECT * FROM placed WHERE rank <= 20
"""

#: The other queries learn, tokenize or report places in texts; the tests hold them to brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": OP2_SQL,
    "op6_near_dedup": OP6_SQL,
    "op9_line_dedup": OP9_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_url_filter": OP12_SQL,
    "op13_lexical_search": OP13_SQL,
}
