"""The registered queries of this folder, with DuckDB SQL where SQL can say them."""

from . import (
    decontamination, html_text, line_dedup, masked_ranking, mixing, packing, passages, periodic_runs, sharding, simhash, token_counts, topk_search, toxicity)
from .common import table

QUERIES, ORACLE = {}, {}


def query(name, sql=None):
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run
    return add


OP9 = """
WITH w AS (SELECT doc_id, row_number() OVER () AS r,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[s:s + least(len(ws), 10) - 1], ' ') AS win
       FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS s FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT r, n, s, array_to_string(ws[s:s + n - 1], ' ') AS win
       FROM (SELECT r, n, ws, unnest(range(1, len(ws) - n + 2)) AS s FROM w, sizes WHERE len(ws) >= n)),
m AS (SELECT r, s, dw.n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
h AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM m) GROUP BY r),
n AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN h USING (r) LEFT JOIN n USING (r)
"""


@query("op9_benchmark_decontamination", OP9)
def op9(spark, sf_dir):
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_simhash_near_dedup")
def op10(spark, sf_dir):
    return simhash.report(table(spark, sf_dir, "documents"))


@query("op7_sharding")
def op7(spark, sf_dir):
    return sharding.report(table(spark, sf_dir, "documents"))


OP4 = """
WITH l AS (SELECT doc_id, no - 1 AS no, list_filter(string_split(lines[no], ' '), lambda w: w <> '') AS ws
           FROM (SELECT doc_id, string_split(text, chr(10)) AS lines, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS no FROM documents)),
c AS (SELECT ws, min((doc_id, no)) AS place FROM l WHERE len(ws) > 0 GROUP BY ws),
m AS (SELECT * FROM c WHERE len(ws) >= 5),
v AS (SELECT place, i, ws[:i - 1] || ws[i + 1:] AS cut FROM (SELECT place, ws, unnest(range(1, len(ws) + 1)) AS i FROM m)),
near AS (SELECT x.place FROM v x JOIN v y ON x.cut = y.cut AND x.i = y.i WHERE y.place < x.place
         UNION SELECT x.place FROM v x JOIN m y ON x.cut = y.ws WHERE y.place < x.place
         UNION SELECT x.place FROM m x JOIN v y ON x.ws = y.cut WHERE y.place < x.place),
gone AS (SELECT l.doc_id, l.no FROM l JOIN c ON l.ws = c.ws WHERE (l.doc_id, l.no) <> c.place OR c.place IN (SELECT place FROM near)),
per AS (SELECT doc_id, count(*) AS n, list(no) AS nos FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  CASE WHEN n IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(nos, i - 1)), chr(10)) END AS text
FROM documents LEFT JOIN per USING (doc_id)
"""


@query("op4_line_dedup", OP4)
def op4(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query("op6_best_fit_packing")
def op6(spark, sf_dir):
    return packing.report(table(spark, sf_dir, "documents"))


@query("op1_token_counts")
def op1(spark, sf_dir):
    return token_counts.report(table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2(spark, sf_dir):
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP5 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""


@query("op5_topk_search", OP5)
def op5(spark, sf_dir):
    return topk_search.report(table(spark, sf_dir, "embeddings"))


@query("op8_html_extraction")
def op8(spark, sf_dir):
    return html_text.report(table(spark, sf_dir, "pages"))


@query("op3_substring_dedup")
def op3(spark, sf_dir):
    return passages.report(table(spark, sf_dir, "documents"))


@query("op13_periodic_runs")
def op13(spark, sf_dir):
    return periodic_runs.report(table(spark, sf_dir, "documents"))


OP11 = """
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(ws)) AS BIGINT) AS n_terms FROM d WHERE len(ws) > 0),
i AS (SELECT item_id, row_number() OVER () AS ir,
             unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
q AS (SELECT ir, item_id, t, count(*) AS times FROM i GROUP BY ALL),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ws) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM p GROUP BY t), s),
c AS (SELECT p.r, p.t, w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(ws) * n_docs) // n_terms))) AS gain
      FROM p JOIN w USING (t) JOIN d USING (r), s),
a AS (SELECT ir, item_id, r, CAST(sum(times * gain) AS BIGINT) AS score FROM q JOIN c USING (t) GROUP BY ALL HAVING sum(times * gain) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY ir ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM a JOIN d USING (r) QUALIFY row_number() OVER (PARTITION BY ir ORDER BY score DESC, doc_id) <= 20
"""


@query("op11_ranked_search", OP11)
def op11(spark, sf_dir):
    return masked_ranking.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12 = """
WITH r AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
             md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM r GROUP BY source),
t AS (SELECT CAST(sum(source_size) AS BIGINT) AS total, CAST(sum(weight) AS BIGINT) AS weights FROM s),
o AS (SELECT source_size, weight, (total - coalesce(sum(3 * source_size) OVER prior, 0)) / (weights - coalesce(sum(weight) OVER prior, 0)) AS level
      FROM s, t WINDOW prior AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT level FROM o WHERE 3 * source_size >= weight * level ORDER BY 3 * source_size / weight LIMIT 1),
g AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * level) AS target FROM s, l),
p AS (SELECT r.doc_id, r.size, g.source_size, g.target, CAST(floor(g.target + 0.5) AS BIGINT) AS need,
        coalesce(CAST(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.key, r.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start
      FROM r JOIN g ON r.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(list_sum(list_transform([0, 1, 2], lambda e: greatest(0, least(size, need - e * source_size - start)))) AS BIGINT) AS taken FROM p
"""


@query("op12_source_mix", OP12)
def op12(spark, sf_dir):
    return mixing.report(table(spark, sf_dir, "documents"))
