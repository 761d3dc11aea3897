"""The contract queries as DuckDB SQL over whole tables: plain definitions, without the operators' methods."""

from __future__ import annotations

from .url_filter import GRID, MODELS, ORDER, RULES

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


OP1 = f"""WITH t AS (SELECT doc_id AS d, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT d, h, length(h) // 2 AS n FROM t),
w AS (SELECT d, p, md5_number(substr(h, 2 * p + 1, 200)) AS k FROM (SELECT d, h, unnest(range(n - 99)) AS p FROM n WHERE n >= 100)),
f AS (SELECT d, p, first_value(d) OVER x AS d0, first_value(p) OVER x AS p0 FROM w WINDOW x AS (PARTITION BY k ORDER BY d, p)),
late AS (SELECT d, p FROM f WHERE d <> d0 OR p <> p0),
gaps AS (SELECT d, p, CASE WHEN p - lag(p) OVER (PARTITION BY d ORDER BY p) <= 100 THEN 0 ELSE 1 END AS new FROM late),
runs AS (SELECT d, p, sum(new) OVER (PARTITION BY d ORDER BY p) AS run FROM gaps),
spans AS (SELECT d, min(p) AS s, max(p) + 100 AS e FROM runs GROUP BY d, run),
kept AS (SELECT d, lag(e, 1, 0) OVER (PARTITION BY d ORDER BY s) AS a, s AS b FROM spans UNION ALL SELECT s.d, max(e), max(n.n) FROM spans s JOIN n USING (d) GROUP BY s.d),
texts AS (SELECT d, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM kept JOIN t USING (d) WHERE b > a GROUP BY d),
sums AS (SELECT d, sum(e - s) AS r, count(*) AS c FROM spans GROUP BY d)
SELECT n.d AS doc_id, n.n AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed, coalesce(c, 0) AS n_spans, sha256(unhex(CASE WHEN r IS NULL THEN n.h ELSE coalesce(texts.h, '') END)) AS kept_sha256
FROM n LEFT JOIN sums USING (d) LEFT JOIN texts USING (d)"""

OP6 = rf"""WITH dw AS (SELECT doc_id AS d, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_SMALL}'), '{_ALNUM}') AS w FROM documents),
iw AS (SELECT CAST(item_id AS VARCHAR) AS i, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_SMALL}'), '{_ALNUM}') AS w FROM benchmark),
win AS (SELECT DISTINCT i, l, array_to_string(w[p:p + l - 1], ' ') AS k FROM (SELECT i, w, least(len(w), 8) AS l, unnest(range(1, len(w) - least(len(w), 8) + 2)) AS p FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT l FROM win),
dwin AS (SELECT d, l, p, array_to_string(w[p:p + l - 1], ' ') AS k FROM (SELECT d, w, l, unnest(range(1, len(w) - l + 2)) AS p FROM dw, sizes WHERE len(w) >= l)),
hit AS (SELECT dwin.d, dwin.l, dwin.p, win.i FROM dwin JOIN win USING (l, k)),
words AS (SELECT d, count(*) AS n FROM (SELECT DISTINCT d, unnest(range(p, p + l)) AS x FROM hit) GROUP BY d),
best AS (SELECT d, max(len) AS longest FROM (SELECT d, max(p) + max(l) - min(p) AS len FROM (SELECT *, p - j AS diag, p - row_number() OVER (PARTITION BY d, i, p - j ORDER BY p) AS run FROM
  (SELECT dwin.d, dwin.p, dwin.l, x.i, x.p AS j FROM dwin JOIN (SELECT i, r, l, p, array_to_string(w[p:p + l - 1], ' ') AS k FROM (SELECT i, w, row_number() OVER () AS r, least(len(w), 8) AS l, unnest(range(1, len(w) - least(len(w), 8) + 2)) AS p FROM iw WHERE len(w) > 0)) x USING (l, k))) GROUP BY d, i, diag, run) GROUP BY d),
items AS (SELECT d, count(*) AS n, sha256(string_agg(i, ',' ORDER BY i)) AS s FROM (SELECT DISTINCT d, i FROM hit) GROUP BY d)
SELECT dw.d AS doc_id, len(dw.w)::BIGINT AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, coalesce(items.s, sha256('')) AS items_sha256, coalesce(items.n, 0) >= 2 AS contaminated, coalesce(longest, 0)::INTEGER AS longest
FROM dw LEFT JOIN words USING (d) LEFT JOIN items USING (d) LEFT JOIN best USING (d)"""

OP8 = rf"""WITH dw AS (SELECT doc_id AS d, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
win AS (SELECT d, p, md5_number(array_to_string(w[p:p + 49], ' ')) AS k FROM (SELECT d, w, unnest(range(1, len(w) - 48)) AS p FROM dw WHERE len(w) >= 50)),
late AS (SELECT d, p FROM (SELECT d, p, min(d) OVER (PARTITION BY k) AS m FROM win) WHERE d > m),
gone AS (SELECT DISTINCT d, unnest(range(p, p + 50)) AS x FROM late),
cut AS (SELECT d, list(x) AS xs FROM gone GROUP BY d),
kept AS (SELECT d, string_agg(w[x], ' ' ORDER BY x) AS t FROM (SELECT d, w, unnest(range(1, len(w) + 1)) AS x FROM dw SEMI JOIN cut USING (d)) ANTI JOIN gone USING (d, x) GROUP BY d)
SELECT dw.d AS doc_id, len(w)::BIGINT AS n_words, coalesce(len(xs), 0)::BIGINT AS n_removed, sha256(CASE WHEN xs IS NULL THEN array_to_string(w, ' ') ELSE coalesce(t, '') END) AS kept_sha256
FROM dw LEFT JOIN cut USING (d) LEFT JOIN kept USING (d)"""

OP10 = rf"""WITH RECURSIVE dw AS (SELECT doc_id AS d, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_SMALL}'), '{_SPACED}') AS w FROM documents),
sh AS (SELECT DISTINCT d, md5_number(array_to_string(w[p:p + 4], ' ')) AS k FROM (SELECT d, w, unnest(range(1, greatest(len(w) - 3, 2))) AS p FROM dw WHERE len(w) > 0)),
sets AS (SELECT d, list_sort(list(k)) AS s, count(*) AS n FROM sh GROUP BY d),
alike AS (SELECT min(d) AS r, s, n, list(d) AS ds FROM sets GROUP BY s, n),
rs AS (SELECT r, n, unnest(s) AS k FROM alike),
pairs AS (SELECT a.r AS x, b.r AS y, a.n + b.n AS total, count(*) AS c FROM rs a JOIN rs b ON a.k = b.k AND a.r < b.r AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT x, y FROM pairs WHERE 100 * c >= 75 * (total - c)),
ways AS (SELECT x AS a, y AS b FROM links UNION SELECT y, x FROM links),
reach(a, b) AS (SELECT r, r FROM alike UNION SELECT reach.a, ways.b FROM reach JOIN ways ON ways.a = reach.b),
of_one AS (SELECT a AS r, min(b) AS c FROM reach GROUP BY a),
of_doc AS (SELECT unnest(ds) AS d, c FROM alike JOIN of_one USING (r))
SELECT dw.d AS doc_id, coalesce(sets.n, 0) AS n_shingles, coalesce(c, dw.d) AS component_id FROM dw LEFT JOIN sets USING (d) LEFT JOIN of_doc USING (d)"""


def _op7() -> str:
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    longest = sorted(RULES, key=lambda r: (len(r[0] + r[1]), r), reverse=True)
    name = " ".join(f"WHEN {fits(h, p)} THEN '{h + p}'" for h, p, _ in longest)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in longest)
    cells = [f"{s}{k}" for s in "ab" for k in (0, 1)]
    sums = ", ".join(f"sum(CASE WHEN verdict = '{v}' AND fold = {k} THEN n ELSE 0 END) AS {s}{k}" for s, v in (("a", "allow"), ("b", "block")) for k in (0, 1))
    each = {(m, s): " + ".join(f"{s}{k}" for k in folds) for m, folds in MODELS.items() for s in "ab"}
    counts = ", ".join(f"{x} AS c{s}{m}, sum({x}) OVER z AS n{s}{m}, count(CASE WHEN {x} > 0 THEN 1 END) OVER z AS t{s}{m}" for (m, s), x in each.items())
    levels = []
    for size in range(1, ORDER + 1):
        low = (lambda m, s: "1.0::DOUBLE / 256") if size == 1 else (lambda m, s: f"q.p{s}{m}")
        p = ", ".join(f"CASE WHEN g.ca{m} + g.cb{m} > 0 AND g.n{s}{m} > 0 THEN (g.c{s}{m} + (g.t{s}{m} + 1) * {low(m, s)}) / (g.n{s}{m} + g.t{s}{m} + 1) ELSE {low(m, s)} END AS p{s}{m}" for m, s in each)
        shorter = f" JOIN p{size - 1} q ON q.gram = substr(g.gram, 2)" if size > 1 else ""
        levels.append(f"p{size} AS (SELECT g.gram, {p} FROM known g{shorter} WHERE g.size = {size})")
    value = ", ".join(f'ln(pa{m} / pb{m}) AS "{m}"' for m in MODELS)
    values = " UNION ALL ".join(f"SELECT gram, {value} FROM p{size}" for size in range(1, ORDER + 1))
    return f"""WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{_UPPER}', '{_SMALL}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
ruled AS (SELECT *, CASE {name} END AS rule, CASE {verdict} END AS verdict FROM hp),
texts AS (SELECT host, path, verdict, count(*) AS n, host || path AS chars, CASE WHEN substr(md5(host || path), 1, 1) IN ('0', '2', '4', '6', '8', 'a', 'c', 'e') THEN 0 ELSE 1 END AS fold FROM ruled GROUP BY ALL),
wins AS (SELECT *, substr(chars, pos - least(pos, {ORDER}) + 1, least(pos, {ORDER})) AS win FROM (SELECT *, unnest(range(1, length(chars) + 1)) AS pos FROM texts)),
counted AS (SELECT win, {sums} FROM wins GROUP BY win),
grams AS (SELECT substr(win, length(win) - size + 1, size) AS gram, size, {", ".join(f"sum({c}) AS {c}" for c in cells)} FROM (SELECT *, unnest(range(1, length(win) + 1)) AS size FROM counted) GROUP BY ALL),
known AS (SELECT gram, size, {counts} FROM grams WINDOW z AS (PARTITION BY size, substr(gram, 1, size - 1))),
{", ".join(levels)},
vals AS ({values}),
diffs AS (SELECT host, path, sum("all") AS a, sum(CASE WHEN fold = 0 THEN "0" ELSE "1" END) AS o FROM wins JOIN vals ON vals.gram = win GROUP BY host, path),
scored AS (SELECT t.host, t.path, t.verdict, round(coalesce(a / length(chars), 0), 9) AS difference, round(coalesce(o / length(chars), 0), 9) AS held FROM texts t LEFT JOIN diffs USING (host, path)),
bins AS (SELECT floor(held * {GRID // 2})::INTEGER AS bin, count(CASE WHEN verdict = 'allow' THEN 1 END) AS g, count(CASE WHEN verdict = 'block' THEN 1 END) AS b FROM scored WHERE verdict IS NOT NULL GROUP BY 1),
walk AS (SELECT bin, sum(g) OVER () AS ng, sum(b) OVER () AS nb, coalesce(sum(g) OVER before, 0) AS g0, coalesce(sum(b) OVER before, 0) AS b0 FROM bins WINDOW before AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
worth AS (SELECT bin, (ng - g0) / ng + b0 / nb AS v FROM walk WHERE ng > 0 AND nb > 0),
cut AS (SELECT coalesce((SELECT min(bin) / {float(GRID // 2)}::DOUBLE FROM worth WHERE v > (SELECT max(v) FROM worth) - 1e-12), -1e9) AS cut)
SELECT page_id, r.host, r.path, rule, coalesce(r.verdict, CASE WHEN difference >= (SELECT cut FROM cut) THEN 'allow' ELSE 'block' END) AS verdict, difference FROM ruled r JOIN scored s ON r.host = s.host AND r.path = s.path"""


OP7 = _op7()

ORACLES = {"op1_suffix_dedup": OP1, "op6_decontaminate": OP6, "op7_url_filter": OP7, "op8_substring_dedup": OP8, "op10_ngram_join": OP10}
