"""DuckDB SQL for the dealt queries that SQL can say in full, written from their meaning."""

from __future__ import annotations

from .decontaminate import MASKS, MAX_WINDOW, MIN_WINDOW, SIMILARITY
from .urls import MANY_CHILDREN, PRIOR_WEIGHT, REJECT_AT, STEM, Z, UrlRule

WORD = r"[^\x20\x09-\x0D]+"
BIGGEST = (1 << 63) - 1

#: Words under a window that starts in a document with a smaller id too are gone.
REPEATS_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, {BIGGEST}) AS rank,
                  regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
win AS (SELECT rid, rank, i, list_aggregate(ws[i:i + 12], 'string_agg', ' ') AS g
        FROM d, unnest(range(1, len(ws) - 11)) AS u(i)),
lost AS (SELECT rid, i FROM (SELECT rid, i, rank, min(rank) OVER (PARTITION BY g) AS low FROM win) WHERE low < rank),
gone AS (SELECT DISTINCT rid, i + k AS p FROM lost, range(13) AS r(k)),
word AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
kept AS (SELECT rid, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""


def _masked(mask: tuple[int, ...]) -> str:
    return " || ' ' || ".join(f"ws[p + {o + 1}]" for o in mask)


def overlaps_sql() -> str:
    """Alignments that a seed of some mask proposes, laid over one another; the best of each pair."""
    def seeds(table: str) -> str:
        return " UNION ALL ".join(
            f"SELECT id, {kind} AS kind, p, {_masked(mask)} AS key FROM {table}, unnest(range(0, len(ws) - {mask[-1]})) AS u(p)"
            for kind, mask in enumerate(MASKS))

    return rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(lower(text), ''), '{WORD}') AS ws FROM documents),
b AS (SELECT * FROM (SELECT row_number() OVER () AS id, item_id, regexp_extract_all(coalesce(lower(text), ''), '{WORD}') AS ws
                     FROM benchmark) WHERE len(ws) >= {MIN_WINDOW}),
ds AS ({seeds("d")}),
bs AS ({seeds("b")}),
hit AS (SELECT DISTINCT ds.id AS d, bs.id AS b, ds.p - bs.p AS shift FROM ds JOIN bs USING (kind, key)),
laid AS (SELECT hit.d, hit.b, doc_id, item_id, shift, d.ws AS dw, b.ws AS bw, greatest(shift, 0) AS lo,
                least(shift + len(b.ws), len(d.ws)) AS hi, least({MAX_WINDOW}, len(b.ws)) AS size
         FROM hit JOIN d ON d.id = hit.d JOIN b ON b.id = hit.b),
same AS (SELECT *, list_transform(range(lo, hi), lambda x: CASE WHEN dw[x + 1] = bw[x - shift + 1] THEN 1 ELSE 0 END) AS eq
         FROM laid WHERE hi - lo >= size),
good AS (SELECT *, list_filter(range(0, hi - lo - size + 1),
                               lambda g: list_sum(eq[g + 1:g + size]) >= ceil({SIMILARITY}::DOUBLE * size)) AS starts FROM same),
cover AS (SELECT *, list_filter(range(0, hi - lo), lambda c: len(list_filter(starts, lambda g: g <= c AND g > c - size)) > 0) AS cv
          FROM good WHERE len(starts) > 0),
best AS (SELECT d, b, doc_id, item_id, (lo + starts[1])::INT AS first_word, len(cv)::INT AS n_words,
                len(list_filter(cv, lambda c: eq[c + 1] = 1))::INT AS n_equal FROM cover)
SELECT doc_id, item_id, first_word, n_words, n_equal FROM best
QUALIFY row_number() OVER (PARTITION BY d, b ORDER BY n_equal DESC, n_words DESC, first_word) = 1"""


#: One level of the template tree: the templates after segment ``lv`` is generalised, from those before.
#: Half a row is added to each form of a node before shapes are compared.
_LEVEL_SQL = rf"""
    WITH p AS (SELECT *, coalesce(array_to_string(seg[1:lv], '/'), '') AS up, coalesce(seg[lv + 1], '') AS own, seg[lv + 2:] AS below FROM t),
    f AS (SELECT host, up, own, array_to_string(list_transform(below, lambda s:
                   regexp_replace(replace(replace(s, '<hex>', '1'), '<n>', '0'), '[^01._~-]+', 'w', 'g')), '/') AS form,
                 sum(n) AS n, sum(lab) AS lab, sum(blk) AS blk FROM p GROUP BY ALL),
    c AS (SELECT host, up, own, left(own, {STEM}) AS stem, sum(n)::DOUBLE AS n, sum(lab)::DOUBLE AS lab, sum(blk)::DOUBLE AS blk FROM f GROUP BY ALL),
    wild AS (SELECT host, up FROM c GROUP BY ALL HAVING count(*) > {MANY_CHILDREN} AND count(*) * 2 > sum(n)),
    known AS (SELECT *, blk * 2 >= lab AS side FROM c WHERE lab > 0 AND own <> ''),
    pool AS (SELECT host, up, side, sum(blk) / sum(lab) AS rate, sum(n) AS total FROM known GROUP BY ALL),
    stems AS (SELECT host, up, side, stem, count(*) AS alike FROM known GROUP BY ALL),
    seen AS (SELECT host, up, side, form, sum(f.n)::DOUBLE AS seen FROM f JOIN known USING (host, up, own) GROUP BY ALL),
    kinds AS (SELECT host, up, count(DISTINCT form) AS kinds FROM f GROUP BY ALL),
    fits AS (SELECT host, up, own, stem, side, kinds, round(sum(f.n * f.n / (c.n * (coalesce(seen, 0) + 0.5) / (total + 0.5 * kinds))) - c.n, 6) AS far
             FROM c JOIN pool USING (host, up) JOIN f USING (host, up, own) JOIN kinds USING (host, up) LEFT JOIN seen USING (host, up, side, form)
             WHERE own <> '' AND (c.lab = 0 OR ((c.blk * 2 >= c.lab) = side AND abs(c.blk / c.lab - rate) <= {Z}::DOUBLE * sqrt(rate * (1 - rate) / c.lab)))
             GROUP BY host, up, own, stem, side, kinds, c.n
             HAVING round(sum(f.n * f.n / (c.n * (coalesce(seen, 0) + 0.5) / (total + 0.5 * kinds))) - c.n, 6)
                    <= greatest(kinds - 1, 1) + {Z}::DOUBLE * sqrt(2.0 * greatest(kinds - 1, 1))),
    ordered AS (SELECT host, up, own, side, rank() OVER (PARTITION BY host, up, own ORDER BY coalesce(alike, 0) DESC, far) AS place
                FROM fits LEFT JOIN stems USING (host, up, side, stem)),
    chosen AS (SELECT host, up, own, any_value(side) AS side FROM ordered WHERE place = 1 GROUP BY host, up, own HAVING count(*) = 1),
    kin AS (SELECT host, up, side FROM chosen GROUP BY ALL HAVING count(*) > 1),
    merged AS (SELECT host, up, own, IF(side, '*block', '*allow') AS to_name FROM chosen SEMI JOIN kin USING (host, up, side)),
    m AS (SELECT host, up, own, CASE WHEN own = '' THEN '' WHEN wild.host IS NOT NULL THEN '*' ELSE coalesce(to_name, own) END AS now
          FROM c LEFT JOIN wild USING (host, up) LEFT JOIN merged USING (host, up, own))
    SELECT lv + 1, host, raw, CASE WHEN len(seg) > lv THEN seg[1:lv] || [now] || below ELSE seg END, n, lab, blk
    FROM p JOIN m USING (host, up, own) WHERE lv < (SELECT max(len(raw)) FROM t)"""


def urls_sql(rules: list[UrlRule]) -> str:
    """Rules first, then the template tree, one level after another."""
    longest = sorted(rules, key=lambda r: -len(r.text))
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in longest]
    rule = " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in zip(fits, longest, strict=True))
    label = " ".join(f"WHEN rule = '{r.text}' THEN '{r.verdict}'" for r in longest)
    return rf"""
WITH RECURSIVE u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r AS (SELECT *, CASE {rule} END AS rule, list_transform(string_split(path, '/'),
        lambda s: CASE WHEN regexp_matches(s, '^[0-9a-f]{{12,}}$') THEN '<hex>' ELSE regexp_replace(s, '[0-9]+', '<n>', 'g') END) AS parts
      FROM u),
known AS (SELECT *, CASE {label} END AS label,
                 parts[2:] AS raw FROM r),
t(lv, host, raw, seg, n, lab, blk) AS (
  SELECT 0, host, raw, raw, count(*), count(label), count(*) FILTER (WHERE label = 'block') FROM known GROUP BY host, raw
  UNION ALL
  SELECT * FROM ({_LEVEL_SQL})),
leaf AS (SELECT *, coalesce(array_to_string(seg, '/'), '') AS template FROM t WHERE lv = (SELECT max(lv) FROM t)),
whole AS (SELECT sum(blk)::DOUBLE / greatest(sum(lab), 1) AS p FROM leaf),
every AS (SELECT template, (sum(blk)::DOUBLE + {PRIOR_WEIGHT} * (SELECT p FROM whole)) / (sum(lab)::DOUBLE + {PRIOR_WEIGHT}) AS pt
          FROM leaf GROUP BY template),
host AS (SELECT host, template, sum(blk)::DOUBLE AS bh, sum(lab)::DOUBLE AS lh FROM leaf GROUP BY ALL),
judged AS (SELECT host, raw, (bh + {PRIOR_WEIGHT} * pt) / (lh + {PRIOR_WEIGHT}) AS purity
           FROM leaf JOIN host USING (host, template) JOIN every USING (template))
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN purity >= {REJECT_AT} THEN 'block' ELSE 'allow' END) AS verdict
FROM known JOIN judged USING (host, raw)"""


#: Smoothed shares of every kept term in every group and language, priced against one another.
DIVERGENCE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT rid, lang, source, unnest(ws) AS t FROM d),
keep AS (SELECT lang, t, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT rid) >= 10),
size AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM keep GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
cell AS (SELECT lang, source, t, count(*) AS n FROM w SEMI JOIN keep USING (lang, t) GROUP BY ALL),
every AS (SELECT lang, source, t, coalesce(cell.n, 0)::HUGEINT AS n, keep.n::HUGEINT AS all_n
          FROM g JOIN keep USING (lang) LEFT JOIN cell USING (lang, source, t)),
share AS (SELECT lang, source, t, n, 1 + (1000000000 * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
                 1 + (1000000000 * (all_n + 2)) // (total + 2 * v) AS q FROM every JOIN size USING (lang)),
apart AS (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
          FROM share x JOIN share y ON x.lang = y.lang AND x.t = y.t AND x.source <> y.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
         FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN apart ON apart.lang = a.lang AND apart.source = a.source AND apart.item = b.source),
term AS (SELECT lang, source, 'term' AS part, t AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
         FROM share WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM (FROM pair UNION ALL FROM term)
QUALIFY part = 'pair' OR rank <= 10"""


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
                                   for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: Trees as one list of digests a level; crc32 bit by bit, of which only the last bit matters.
MERKLE_SQL = rf"""
WITH RECURSIVE crc AS (
  SELECT *, row_number() OVER () AS rid, doc_id::VARCHAR AS s,
         list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, len(s) + 1), lambda i: [ord(s[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
                     lambda c, x: xor(xor(c, x) >> 1, (xor(c, x) & 1) * 3988292384)) AS state FROM documents),
d AS (SELECT rid, doc_id, source, {_leaf_sql("text")} AS leaf,
             CASE WHEN coalesce(state & 1 = 1, false) THEN replace(text, chr(10), '') ELSE text END AS changed,
             {_leaf_sql("changed")} AS other FROM crc),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d),
up(source, level, hs) AS (
  SELECT source, 0, list(leaf ORDER BY place) FROM ranked GROUP BY source
  UNION ALL
  SELECT source, level + 1, list_transform(range(0, (len(hs) + 2) // 3), lambda i: sha256(array_to_string(hs[3 * i + 1:3 * i + 3], '')))
  FROM up WHERE len(hs) > 1),
sub AS (SELECT source, hs[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM up WHERE len(hs) = 1),
top(level, hs) AS (
  SELECT 0, list(subroot ORDER BY place) FROM sub
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(hs) + 2) // 3), lambda i: sha256(array_to_string(hs[3 * i + 1:3 * i + 3], '')))
  FROM top WHERE len(hs) > 1),
step AS (
  SELECT rid, level, place // (3 ** level)::BIGINT AS pos, hs FROM ranked JOIN up ON ranked.source IS NOT DISTINCT FROM up.source WHERE len(hs) > 1
  UNION ALL
  SELECT rid, 1000 + level, sub.place // (3 ** level)::BIGINT, hs
  FROM ranked JOIN sub ON ranked.source IS NOT DISTINCT FROM sub.source, top WHERE len(hs) > 1),
side AS (SELECT rid, level, array_to_string(hs[pos // 3 * 3 + 1:pos], '') AS l, array_to_string(hs[pos + 2:pos // 3 * 3 + 3], '') AS r FROM step),
proof AS (SELECT rid, list(l || '|' || r ORDER BY level) AS ps, string_agg(l || r, '' ORDER BY level) AS joined FROM side GROUP BY rid),
done AS (SELECT doc_id, leaf, subroot, (SELECT hs[1] FROM top WHERE len(hs) = 1) AS root, sha256(coalesce(joined, '')) AS proof_sha256,
                list_reduce([other] || coalesce(ps, []), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2))) AS folded_root
         FROM ranked JOIN sub ON ranked.source IS NOT DISTINCT FROM sub.source LEFT JOIN proof USING (rid))
SELECT *, folded_root = root AS verified FROM done"""
