"""DuckDB SQL of the queries that SQL can express, over whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from civica.llm.common import UPPER
from civica.llm.line_rules import INNER_PUNCTUATION, LINE_END, SEPARATORS, LineRules
from civica.llm.url_templates import ENDING, TemplateSettings


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def url_templates_sql(rules: Sequence[tuple[str, str, str]], s: TemplateSettings = TemplateSettings(), depth: int = 10) -> str:
    """The path-template tree level by level, its branches and verdicts.  Of
    the tree, ``depth`` levels are written out; segments below are wildcards."""
    shape = f"""CASE WHEN stem = '' THEN '' WHEN regexp_full_match(stem, '[0-9]+') THEN '{{num}}'
      WHEN regexp_full_match(stem, '[0-9a-f-]{{8,}}') AND regexp_matches(stem, '[0-9]') THEN '{{hex}}'
      WHEN regexp_full_match(stem, '[A-Za-z]+') THEN '{{word}}' ELSE '{{str}}' END || ending"""
    deep = shape.replace("stem", f"regexp_replace(y, '{ENDING}', '')").replace("ending", f"regexp_extract(y, '{ENDING}', 0)")
    levels = []
    for k in range(1, depth + 1):
        levels.append(f"""
k{k} AS (SELECT host, template, seg FROM (
    SELECT host, template, segs[{k}] AS seg, count(*) AS n
    FROM t{k - 1} WHERE len(segs) >= {k} GROUP BY host, template, segs[{k}])
  WHERE n >= {s.min_support}),
s{k} AS (SELECT *, segs[{k}] AS own, regexp_extract(segs[{k}], '{ENDING}', 0) AS ending,
    regexp_replace(segs[{k}], '{ENDING}', '') AS stem FROM t{k - 1}),
t{k} AS (SELECT s.page_id, s.host, s.path, s.bad, s.segs, CASE WHEN len(s.segs) < {k} THEN s.template
    WHEN k.seg IS NOT NULL THEN s.template || '/' || s.own ELSE s.template || '/' || {shape} END AS template
  FROM s{k} s LEFT JOIN k{k} k ON k.host = s.host AND k.template = s.template AND k.seg = s.own)""")
    by_length = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [f"(t.host = {_text(h)} OR ends_with(t.host, {_text('.' + h)})) AND starts_with(t.path, {_text(p)})" for h, p, _ in by_length]
    rule = "CASE " + " ".join(f"WHEN {f} THEN {_text(h + p)}" for f, (h, p, _) in zip(fits, by_length)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN {_text(v)}" for f, (_, _, v) in zip(fits, by_length)) + " END"
    strength = f"{s.strength}::DOUBLE"
    last = r"^((?:.*/)?)([^/{}]+)((?:/[^/]*\{[^/]*|/)*)$"
    url = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return rf"""
WITH lab AS (SELECT doc_id, max(CAST(quality = 0 OR toxic = 1 AS INTEGER)) AS bad FROM labels GROUP BY doc_id),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{url}', 1), '{UPPER}', '{UPPER.lower()}') AS host,
    regexp_extract(coalesce(url, ''), '{url}', 2) AS path FROM pages),
n AS (SELECT u.*, lab.bad FROM u
  LEFT JOIN lab ON lab.doc_id = TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})(?:\.[a-z]+|/)?$', 1) AS BIGINT)),
p AS (SELECT *, CASE WHEN path = '' THEN [] ELSE string_split(regexp_replace(path, '^/', ''), '/') END AS parts FROM n),
t0 AS (SELECT page_id, host, path, bad, '' AS template, parts AS segs FROM p),{",".join(levels)},
tz AS (SELECT page_id, host, path, bad, template || array_to_string(list_transform(segs[{depth + 1}:], lambda y : '/' || {deep}), '') AS template FROM t{depth}),
st AS (SELECT host, template, count(bad) AS labelled, coalesce(sum(bad), 0) AS n_bad FROM tz GROUP BY host, template),
al AS (SELECT CASE WHEN sum(labelled) > 0 THEN (sum(n_bad) + {strength} * {s.prior_bad}::DOUBLE) / (sum(labelled) + {strength})
    ELSE {s.prior_bad}::DOUBLE END AS overall FROM st),
ho AS (SELECT host, (sum(n_bad) + {strength} * max(overall)) / (sum(labelled) + {strength}) AS host_share FROM st, al GROUP BY host),
le AS (SELECT *, regexp_extract(template, '{last}', 2) AS literal,
    CASE WHEN regexp_extract(template, '{last}', 2) = '' THEN template ELSE regexp_extract(template, '{last}', 1) END AS before,
    CASE WHEN regexp_extract(template, '{last}', 2) = '' THEN '' ELSE regexp_extract(template, '{last}', 3) END AS after FROM st),
br AS (SELECT host, before, literal, sum(labelled) AS labelled, sum(n_bad) AS n_bad FROM le GROUP BY host, before, literal),
ak AS (SELECT host, before, labelled, n_bad, count(*) AS times, labelled + 1.0::DOUBLE AS size, (n_bad + 0.5::DOUBLE) / (labelled + 1.0::DOUBLE) AS share
  FROM br GROUP BY host, before, labelled, n_bad),
la AS (SELECT *, lag(share) OVER w AS last_share, lag(size) OVER w AS last_size FROM ak
  WINDOW w AS (PARTITION BY host, before ORDER BY share, labelled)),
po AS (SELECT *, (share * size + last_share * last_size) / (size + last_size) AS pooled FROM la),
ag AS (SELECT *, sum(CASE WHEN (share - last_share) > {s.z}::DOUBLE * sqrt(pooled * (1 - pooled) * (1 / size + 1 / last_size))
    THEN 1 ELSE 0 END) OVER (PARTITION BY host, before ORDER BY share, labelled ROWS UNBOUNDED PRECEDING) AS grp FROM po),
gr AS (SELECT br.*, ag.grp FROM br JOIN ag USING (host, before, labelled, n_bad)),
na AS (SELECT host, before, grp, string_agg(literal, '|' ORDER BY literal) FILTER (rk <= {s.named})
    || CASE WHEN count(*) > {s.named} THEN '|+' || (count(*) - {s.named}) ELSE '' END AS literals
  FROM (SELECT *, row_number() OVER (PARTITION BY host, before, grp ORDER BY literal) AS rk FROM gr) GROUP BY host, before, grp),
me AS (SELECT host, before, grp, (sum(n_bad * times) + {strength} * max(host_share)) / (sum(labelled * times) + {strength}) AS branch_share,
    max(literals) AS literals FROM ag JOIN ho USING (host) JOIN na USING (host, before, grp) GROUP BY host, before, grp),
lg AS (SELECT le.*, gr.grp FROM le JOIN gr USING (host, before, literal)),
ju AS (SELECT host, before, grp, after, sum(labelled) AS labelled, (sum(n_bad) + {strength} * max(branch_share)) / (sum(labelled) + {strength}) AS bad_share,
    max(literals) AS literals FROM lg JOIN me USING (host, before, grp) GROUP BY host, before, grp, after),
ve AS (SELECT lg.host, lg.template, lg.before || ju.literals || lg.after AS branch, ju.labelled, ju.bad_share
  FROM lg JOIN ju USING (host, before, grp, after))
SELECT t.page_id, t.host, t.path, {rule} AS rule,
  coalesce({verdict}, CASE WHEN bad_share >= {s.reject}::DOUBLE THEN 'block' ELSE 'allow' END) AS verdict,
  branch, CAST(labelled AS BIGINT) AS labelled, bad_share
FROM tz t JOIN ve ON ve.host = t.host AND ve.template = t.template"""


#: Windows of the benchmark joined to the same windows of the documents.
DECONTAMINATION = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT * FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
bi AS (SELECT item_id, least(13, len(w)) AS size, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS own, w FROM bw),
bk AS (SELECT item_id, size, own, array_to_string(w[own:own + size - 1], ' ') AS gram FROM bi),
sz AS (SELECT DISTINCT size FROM bk),
di AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS spot, w FROM dw, sz WHERE len(w) >= size),
hit AS (SELECT di.doc_id, bk.item_id, bk.own, di.spot, di.size FROM di JOIN bk ON bk.size = di.size
    AND bk.gram = array_to_string(di.w[di.spot:di.spot + di.size - 1], ' ')),
cov AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(spot, spot + size)) AS pos FROM hit) GROUP BY doc_id),
itm AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id),
isl AS (SELECT *, spot - row_number() OVER (PARTITION BY doc_id, item_id, spot - own ORDER BY spot) AS island FROM hit),
run AS (SELECT doc_id, max(n) AS longest FROM (
  SELECT doc_id, max(spot + size) - min(spot) AS n FROM isl GROUP BY doc_id, item_id, spot - own, island) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
  CAST(coalesce(longest, 0) AS BIGINT) AS longest_match
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN itm USING (doc_id) LEFT JOIN run USING (doc_id)"""


def line_rules_sql(r: LineRules = LineRules()) -> str:
    """Statistics of whole texts and the three rules of every line."""
    word = r"[^\x20\x09-\x0D]+"
    gram = " || ' ' || ".join(f"lead(word, {k}) OVER p" for k in range(r.window))
    phrases = " OR ".join(f"contains(low, {_text(p)})" for p in r.boilerplate)
    return rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '{word}') AS w FROM d),
ws AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT rid, i, {gram} AS gram FROM ws WINDOW p AS (PARTITION BY rid ORDER BY i)),
t AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g WHERE gram IS NOT NULL),
rep AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest(range(i, i + {r.window})) AS p FROM t WHERE n > 1) GROUP BY rid),
li AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
lr AS (SELECT rid, line, regexp_matches(line, '{word}') AS has_word, lower(line) AS low FROM li),
lf AS (SELECT rid, line, has_word, CASE
    WHEN NOT has_word THEN NULL
    WHEN length(regexp_replace(line, '[^{SEPARATORS}]', '', 'g')) > {r.max_separators} THEN 'navigation'
    WHEN {phrases} THEN 'boilerplate'
    WHEN NOT regexp_matches(regexp_replace(line, '\s+$', ''), {_text(LINE_END)})
      AND (NOT regexp_matches(line, '{INNER_PUNCTUATION}') OR len(regexp_extract_all(line, '{word}')) < {r.min_line_words})
      THEN 'punctuation' END AS why FROM lr),
ln AS (SELECT rid, count_if(has_word) - count(DISTINCT CASE WHEN has_word THEN line END) AS n_dup_lines,
    sum(length(line)) AS before, sum(CASE WHEN why IS NULL THEN length(line) ELSE 0 END) AS after,
    count(CASE WHEN why = 'punctuation' THEN 1 END) AS n_punctuation, count(CASE WHEN why = 'navigation' THEN 1 END) AS n_navigation,
    count(CASE WHEN why = 'boilerplate' THEN 1 END) AS n_boilerplate FROM lf GROUP BY rid),
s AS (SELECT d.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    CASE WHEN before > 0 THEN 1 - after::DOUBLE / before ELSE 0.0::DOUBLE END AS lost, n_punctuation, n_navigation, n_boilerplate
  FROM d JOIN w USING (rid) JOIN ln USING (rid) LEFT JOIN rep USING (rid))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
  n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words AS base_failed,
  NOT (n_words < {r.min_words} OR 100 * n_repeat_words > {r.max_repeat_percent} * n_words) AND lost <= {r.max_loss}::DOUBLE AS kept,
  lost, CAST(n_punctuation AS BIGINT) AS n_punctuation, CAST(n_navigation AS BIGINT) AS n_navigation,
  CAST(n_boilerplate AS BIGINT) AS n_boilerplate FROM s"""
