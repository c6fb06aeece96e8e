"""DuckDB twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

from encore.llm.quality_rules import CLASSES, WINDOW, WORDS

WS = r"[\x20\x09-\x0D]"

EXACT = rf"""
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept,
  sha256(body) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '{WS}+', ' ', 'g') AS body FROM documents)
WINDOW same AS (PARTITION BY body)"""

WARC = """
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
  if(size >= 1000 AND page_id < newest, 'revisit', 'response') AS record_type,
  if(size >= 1000 AND page_id < newest, newest, NULL) AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS size,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS newest FROM pages)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_classes = ", ".join(f"length(body) - length(regexp_replace(body, {_quoted(rx)}, '', 'g'))" for rx in CLASSES.values())
_words = "[" + ", ".join(_quoted(w) for w in WORDS) + "]"


def _js(p: str, q: str, name: str) -> str:
    a, b = f"({p}[i] / list_sum({p}))", f"({q}[i] / list_sum({q}))"
    term = "if({0} > 0, {0} * log2(2 * {0} / ({0} + {1})), 0)"
    inner = f"{term.format(a, b)} + {term.format(b, a)}"
    return (f"if(n_words >= 30 AND list_sum({p}) > 0 AND list_sum({q}) > 0, "
            f"sqrt(greatest(0, list_sum(list_transform(range(1, len({p}) + 1), lambda i: {inner})) / 2)), NULL) AS {name}")


QUALITY = rf"""
WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS body FROM documents),
split AS (
  SELECT doc_id, lang, body, list_filter(string_split_regex(body, '{WS}+'), lambda w: w != '') AS words,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM texts),
windows AS (SELECT doc_id, i, words[i:i + {WINDOW - 1}] AS five FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, five) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, range({WINDOW}) r(k) GROUP BY doc_id),
counts AS (
  SELECT doc_id, lang, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    [{_classes}] AS found, list_concat(found, [length(body) - list_sum(found)]) AS chars,
    list_transform({_words}, lambda c: len(list_filter(words, lambda w: lower(w) = c))) AS common,
    list_concat(common, [len(words) - list_sum(common)]) AS used,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(words) < 10 OR 100 * coalesce(n, 0) > 20 * len(words) AS base_failed
  FROM split LEFT JOIN covered USING (doc_id)),
sums AS (
  SELECT lang, 'c' AS kind, i, sum(chars[i]) AS n FROM (SELECT lang, chars, unnest(range(1, len(chars) + 1)) AS i FROM counts WHERE NOT base_failed) GROUP BY ALL
  UNION ALL
  SELECT lang, 'w' AS kind, i, sum(used[i]) AS n FROM (SELECT lang, used, unnest(range(1, len(used) + 1)) AS i FROM counts WHERE NOT base_failed) GROUP BY ALL),
every AS (SELECT kind, list(n ORDER BY i) AS h FROM (SELECT kind, i, sum(n) AS n FROM sums GROUP BY ALL) GROUP BY kind),
own AS (SELECT lang, kind, list(n ORDER BY i) AS h FROM sums WHERE lang IN (SELECT lang FROM sums WHERE kind = 'c' GROUP BY lang HAVING sum(n) >= 20000) GROUP BY ALL),
judged AS (
  SELECT c.*, coalesce(oc.h, ec.h) AS rc, coalesce(ow.h, ew.h) AS rw
  FROM counts c JOIN every ec ON ec.kind = 'c' JOIN every ew ON ew.kind = 'w'
  LEFT JOIN own oc ON oc.kind = 'c' AND oc.lang = c.lang LEFT JOIN own ow ON ow.kind = 'w' AND ow.lang = c.lang),
measured AS (SELECT *, {_js('chars', 'rc', 'cd')}, {_js('used', 'rw', 'wd')} FROM judged)
SELECT doc_id, n_words, word_chars, CAST(found[{list(CLASSES).index('symbol') + 1}] AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(cd, 0) <= 0.27 AND coalesce(wd, 0) <= 0.6 AS kept, round(cd, 6) AS char_distance, round(wd, 6) AS word_distance
FROM measured"""

ORACLES: dict[str, str] = {"op2_quality_rules": QUALITY, "op5_warc": WARC, "op8_exact_dedup": EXACT}
