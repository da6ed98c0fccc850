"""DuckDB SQL for the queries that SQL can express, over whole tables."""

OP10 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), r AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS keeper FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < keeper THEN keeper END AS refers_to, TRUE AS digest_ok
FROM r
"""

#: Budgets by lowering the tide: the level at which the children's capped shares add up to
#: the budget is the largest that some child's cap sets, if that child and all fuller ones fit.
_FILL = """
{out}_all AS (
  SELECT a.*, (SELECT coalesce(sum(b.cap), 0) FROM {src} b WHERE {same} AND b.cap / b.w <= a.cap / a.w) AS under,
    (SELECT coalesce(sum(b.w), 0) FROM {src} b WHERE {same} AND b.cap / b.w > a.cap / a.w) AS over
  FROM {src} a
), {out}_tide AS (
  SELECT {keys} any_value(budget) AS b, max(CASE WHEN under + over * cap / w <= budget THEN cap / w END) AS low FROM {out}_all GROUP BY {group}
), {out} AS (
  SELECT a.*, CASE WHEN t.low IS NOT NULL AND a.cap / a.w <= t.low THEN a.cap
    ELSE (a.budget - (SELECT coalesce(sum(b.cap), 0) FROM {src} b WHERE {same} AND b.cap / b.w <= coalesce(t.low, -1)))
       * a.w / (SELECT sum(b.w) FROM {src} b WHERE {same} AND b.cap / b.w > coalesce(t.low, -1)) END AS given
  FROM {src} a, {out}_tide t WHERE {match}
)"""

OP8 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, 'unknown') AS lang, coalesce(source, 'unknown') AS source,
    regexp_extract(coalesce(source, 'unknown'), '([0-9]{1,9})$', 1) AS num FROM documents
), one AS (
  SELECT doc_id, lang, source, CASE WHEN num = '' THEN 'tail' WHEN CAST(num AS INT) % 5 = 0 THEN 'core' WHEN CAST(num AS INT) % 5 <= 2 THEN 'wide' ELSE 'tail' END AS domain,
    CAST(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens, md5(text) AS h FROM d
), leaf AS (
  SELECT domain, lang, source, sum(tokens) AS tokens, CAST(sum(tokens) * 2 AS DOUBLE) AS cap FROM one WHERE tokens > 0 GROUP BY ALL
), n1 AS (
  SELECT domain, sum(cap) AS cap, CASE domain WHEN 'core' THEN 3.0 WHEN 'wide' THEN 2.0 WHEN 'tail' THEN 1.0 ELSE 1.0 END::DOUBLE AS w,
    (SELECT CAST(floor(sum(tokens) * 0.5) AS DOUBLE) FROM leaf) AS budget FROM leaf GROUP BY domain
), """ + _FILL.format(out="f1", src="n1", same="TRUE", keys="", group="ALL", match="TRUE").replace("GROUP BY ALL", "").lstrip() + """, n2 AS (
  SELECT l.domain, l.lang, sum(l.cap) AS cap, CASE l.lang WHEN 'en' THEN 4.0 WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 WHEN 'es' THEN 2.0 ELSE 1.0 END::DOUBLE AS w,
    any_value(f1.given) AS budget FROM leaf l JOIN f1 USING (domain) GROUP BY l.domain, l.lang
), """ + _FILL.format(out="f2", src="n2", same="a.domain = b.domain", keys="domain,", group="domain", match="a.domain = t.domain").lstrip() + """, n3 AS (
  SELECT l.domain, l.lang, l.source, l.cap, 1.0::DOUBLE AS w, f2.given AS budget FROM leaf l JOIN f2 USING (domain, lang)
), """ + _FILL.format(out="f3", src="n3", same="a.domain = b.domain AND a.lang = b.lang", keys="domain, lang,", group="domain, lang", match="a.domain = t.domain AND a.lang = t.lang").lstrip() + """, e AS (
  SELECT o.*, epoch, md5('17|' || epoch || '|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || h) AS key FROM one o, (VALUES (0), (1)) v(epoch) WHERE tokens > 0
), s AS (
  SELECT e.*, CAST(floor(f3.given + 1e-6) AS BIGINT) AS budget,
    coalesce(sum(e.tokens) OVER (PARTITION BY e.domain, e.lang, e.source ORDER BY e.epoch, e.key, e.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM e JOIN f3 USING (domain, lang, source)
)
SELECT doc_id, domain, lang, source, tokens, epoch, CAST(least(tokens, budget - before) AS BIGINT) AS taken FROM s WHERE before < budget
"""

OP12 = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, p, sha256(array_to_string(ws[p:p + 19], ' ')) AS key FROM d, unnest(range(1, len(ws) - 18)) t(p) WHERE len(ws) >= 20
), r AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY key ORDER BY doc_id, p) AS nth FROM win
), gone AS (
  SELECT DISTINCT doc_id, p + j AS i FROM r, range(20) t(j) WHERE nth > 1
), word AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d
), kept AS (
  SELECT w.doc_id, count(*) AS n, string_agg(w.word, ' ' ORDER BY w.i) AS text
  FROM word w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_TERMS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

OP13 = f"""
WITH d AS (
  SELECT doc_id, {_TERMS} AS ts FROM documents
), s AS (
  SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(len(ts)) AS BIGINT) AS big_l FROM d WHERE len(ts) > 0
), o AS (
  SELECT doc_id, CAST(len(ts) AS BIGINT) AS n, unnest(ts) AS term FROM d
), v AS (
  SELECT doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM o GROUP BY ALL
), f AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(big_n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM v, s GROUP BY term
), q AS (
  SELECT item_id, unnest({_TERMS}) AS term FROM benchmark
), c AS (
  SELECT q.item_id, v.doc_id, CAST(sum(f.w * ((1000000000 * v.tf) // (1000 * v.tf + 12 * (100 - 25 + (25 * v.n * s.big_n) // s.big_l)))) AS BIGINT) AS score
  FROM q JOIN v USING (term) JOIN f USING (term), s GROUP BY q.item_id, v.doc_id
), k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM c WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 20
"""

ORACLE_SQL = {"op8_mixing": OP8, "op10_warc": OP10, "op12_substring_dedup": OP12, "op13_lexical_search": OP13}
