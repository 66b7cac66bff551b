"""Queries over business records, diagnostics and literal values by name, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from tallyweave import catalog as c
from tallyweave.knobs import FAMILIES
from tallyweave.plans import party as p
from tallyweave.sources.parties import DUCK

QUERIES = {
    "address_components": p.components, "normalise_frame": p.names, "state_codes": p.state_codes, "exact_key_families": p.family_channel, "exact_key_family_ablation": p.ablation, "tfidf_topk_addr": p.addr_channel,
    "component_match_features": p.component_features, "feature_matrix": p.matrix, "edit_similarity_features": p.edit_features, "gbdt_scores": p.gbdt, "isotonic_scores": p.isotonic, "entity_roles": p.roles,
    "brier_ece": p.brier_ece, "reliability_table": p.reliability, "cap_report": p.cap_report, "channel_slots": p.channel_slots, "channel_pivot": p.channel_pivot, "channel_stats": p.channel_stats,
    "country_consistency": p.consistency, "country_mismatches": p.mismatches, "threshold_sweep": p.threshold_sweep, "stratified_sample": p.sample_counts, "smoke_sample": p.smoke, "held_out_split": p.held_out,
    "embed_topk": p.embed_topk, "embed_ann_pairs": p.embed_channel, "romanise": p.scripts, "clean_junk": p.junk, "submission_format": p.file_format, "submission_sets": p.file_sets, "contiguous_runs": p.contiguous, "split_overlap": p.overlap,
}

FOLD = "replace(replace({}, 'oo', 'o'), 'ph', 'f')"
# What the normaliser must find, from the parts that went into the records.
PARTY = f"""{DUCK},
pn AS (SELECT entity_id, country, want_num AS street_num, want_city AS city_norm, want_state AS state_canon, want_zip AS postcode, want_acronym AS name_acronym, business_address <> '' AS has_addr,
  trim(regexp_replace(lower(business_name), ' +', ' ', 'g')) AS name_norm, {FOLD.format("regexp_replace(regexp_replace(replace(lower(business_name), '&', 'and'), ' +', ' ', 'g'), ' (inc|private limited|sarl)$', '')")} AS name_roman,
  CASE WHEN entity_id LIKE 'S1-%' THEN CASE country WHEN 'US' THEN 'inc' WHEN 'India' THEN 'private limited' ELSE 'sarl' END ELSE '' END AS name_suffix,
  array_to_string(list_transform(string_split(replace(replace(lower(business_address), ', null', ''), ',', ''), ' '), lambda x: CASE x WHEN 'street' THEN 'st' WHEN 'road' THEN 'rd' WHEN 'avenue' THEN 'ave' WHEN 'lane' THEN 'ln' WHEN 'drive' THEN 'dr' ELSE x END), ' ') AS addr_roman FROM party)"""

# Addresses have no ceiling: each gram that two records of the pool share counts.
ADDR_TFIDF = c.TFIDF.replace("df <= floor(0.01::DOUBLE * n) AS core", "true AS core")

FAMILY = "ek AS (" + " UNION ALL ".join(f"SELECT {i} AS family, '{'+'.join(f)}' AS family_name, country, entity_id, {f[0]} AS k1, {f[1]} AS k2 FROM pn WHERE {f[0]} <> '' AND {f[1]} <> ''" for i, f in enumerate(FAMILIES)) + """),
ek1 AS (SELECT *, count(*) OVER (PARTITION BY family, country, k1, k2, entity_id LIKE 'S1-%') AS bucket FROM ek),
ek2 AS (SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id, a.family, a.family_name, b.bucket FROM ek1 a JOIN ek1 b USING (family, country, k1, k2)
  WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%' AND a.bucket <= 1000 AND b.bucket <= 1000),
ek3 AS (SELECT source1_entity_id, candidate_entity_id, count(DISTINCT family) AS families, min(bucket) AS bucket FROM ek2 GROUP BY ALL),
fam AS (SELECT source1_entity_id, candidate_entity_id, least(row_number() OVER (PARTITION BY source1_entity_id ORDER BY families DESC, bucket, candidate_entity_id), 65535)::INTEGER AS channel_rank, families::DOUBLE AS channel_score FROM ek3),
pt AS (SELECT a.entity_id AS source1_entity_id, b.entity_id AS candidate_entity_id FROM pn a JOIN pn b ON substr(a.entity_id, 4) = substr(b.entity_id, 4) AND a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%')"""

CAP_ROWS = """cr AS (SELECT c.*, n.country, t.source1_entity_id IS NOT NULL AS is_true, row_number() OVER (PARTITION BY c.source1_entity_id ORDER BY prior_score DESC, n_channels DESC, best_rank, c.candidate_entity_id) AS slot
  FROM cands c JOIN norm n ON n.entity_id = c.source1_entity_id LEFT JOIN truth t ON t.source1_entity_id = c.source1_entity_id AND t.candidate_entity_id = c.candidate_entity_id),
ch AS (SELECT * FROM (VALUES (0, 'name_tfidf'), (1, 'addr_tfidf'), (2, 'exact_key'), (3, 'rare_token'), (4, 'embed_ann')) v(i, channel))"""

CROSSED = """dr AS (SELECT doc_id, 'S' || (doc_id % 3 + 1) || '-' || doc_id AS entity_id, coalesce(lang, '') AS country FROM documents),
tr AS (SELECT entity_id AS source1_entity_id, 'S2-' || (doc_id + 1) AS candidate_entity_id, country AS a FROM dr WHERE doc_id % 3 = 0),
cj AS (SELECT tr.*, dr.country AS b, substr(candidate_entity_id, 1, 2) AS source, a AS country FROM tr LEFT JOIN dr ON dr.entity_id = candidate_entity_id AND dr.doc_id % 3 <> 0)"""

EMBED = """ev0 AS (SELECT CASE WHEN vec_id % 3 = 0 THEN 'S1-' ELSE 'S2-' END || vec_id AS id, label % 2 AS s, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
et AS (SELECT a.id AS source1_entity_id, b.id AS candidate_entity_id, round(list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)), 5) AS channel_score FROM ev0 a JOIN ev0 b USING (s) WHERE a.id LIKE 'S1-%' AND b.id LIKE 'S2-%'),
ek AS (SELECT source1_entity_id, candidate_entity_id, (row_number() OVER (PARTITION BY source1_entity_id ORDER BY channel_score DESC, candidate_entity_id))::INTEGER AS channel_rank, channel_score FROM et QUALIFY channel_rank <= 5)"""


def values(rows: list[tuple], columns: str) -> str:
    """A table of literal values."""
    show = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(show, r)) + ')' for r in rows)}) v({columns})"


ORACLES = {
    "address_components": f"WITH {PARTY} SELECT entity_id, street_num, city_norm, state_canon, postcode FROM pn",
    "normalise_frame": f"WITH {PARTY} SELECT entity_id, country, name_norm, name_roman, name_suffix, name_acronym, addr_roman, has_addr, 1 AS name_script, CASE WHEN has_addr THEN 1 ELSE 0 END AS addr_script FROM pn",
    "state_codes": f"WITH {PARTY} SELECT country, state_canon AS state, count(*) AS n FROM pn WHERE state_canon <> '' GROUP BY ALL",
    "exact_key_families": f"WITH {PARTY}, {FAMILY} SELECT * FROM fam",
    "exact_key_family_ablation": f"""WITH {PARTY}, {FAMILY}, x AS (SELECT DISTINCT source1_entity_id, candidate_entity_id, family_name AS family FROM ek2), y AS (SELECT *, count(*) OVER (PARTITION BY source1_entity_id, candidate_entity_id) AS n FROM x)
      SELECT family, count(*) AS pairs, count(pt.source1_entity_id) AS "true", count_if(n = 1) AS "only", count_if(n = 1 AND pt.source1_entity_id IS NOT NULL) AS only_true
      FROM y LEFT JOIN pt USING (source1_entity_id, candidate_entity_id) GROUP BY ALL""",
    "tfidf_topk_addr": f"WITH {PARTY}, norm AS (SELECT entity_id, country, list_filter(string_split(addr_roman, ' '), lambda x: x <> '') AS name_tokens FROM pn), {ADDR_TFIDF} SELECT * FROM tfidf",
    "component_match_features": f"""WITH {PARTY}, {FAMILY}, q AS (SELECT f.source1_entity_id, f.candidate_entity_id, a, b,
        list_distinct(list_filter(string_split(a.addr_roman, ' '), lambda x: regexp_matches(x, '[0-9]'))) AS u, list_distinct(list_filter(string_split(b.addr_roman, ' '), lambda x: regexp_matches(x, '[0-9]'))) AS v
      FROM fam f JOIN pn a ON a.entity_id = f.source1_entity_id JOIN pn b ON b.entity_id = f.candidate_entity_id)
      SELECT source1_entity_id, candidate_entity_id, (a.name_acronym = b.name_acronym)::INT::DOUBLE AS name_acronym_match, (split_part(a.name_roman, ' ', 1) = split_part(b.name_roman, ' ', 1))::INT::DOUBLE AS name_first_token_match,
        (a.name_suffix = b.name_suffix)::INT::DOUBLE AS name_suffix_agree, 1.0::DOUBLE AS name_digit_eq, (17 * 10 + 17)::DOUBLE AS name_script_pair,
        (a.street_num <> '' AND a.street_num = b.street_num)::INT::DOUBLE AS addr_street_num_match, (a.postcode <> '' AND a.postcode = b.postcode)::INT::DOUBLE AS addr_postcode_match,
        (a.state_canon <> '' AND a.state_canon = b.state_canon)::INT::DOUBLE AS addr_state_match, (a.city_norm <> '' AND a.city_norm = b.city_norm)::INT::DOUBLE AS addr_city_match,
        CASE WHEN len(u) = 0 OR len(v) = 0 THEN 0.0 ELSE round(len(list_intersect(u, v))::DOUBLE / (len(u) + len(v) - len(list_intersect(u, v))), 6) END::DOUBLE AS addr_numeric_jaccard,
        a.has_addr::INT::DOUBLE AS s1_has_addr, b.has_addr::INT::DOUBLE AS cand_has_addr, (a.has_addr AND b.has_addr)::INT::DOUBLE AS both_have_addr FROM q""",
    "entity_roles": "SELECT CASE WHEN c_custkey % 100 < 10 THEN 'calib' WHEN c_custkey % 100 < 30 THEN 'val' ELSE 'train' END AS role, count(*) AS n FROM customer GROUP BY ALL",
    "brier_ece": f"""WITH {c.LABELLED}, r AS (SELECT round(prob, 6) AS prob, label, ntile(10) OVER (ORDER BY round(prob, 6), source1_entity_id, candidate_entity_id) AS bin FROM lab),
      b AS (SELECT bin, count(*) AS n, avg(prob) AS m, avg(label) AS y FROM r GROUP BY ALL), g AS (SELECT prob, sum(label) AS p, count(*) - sum(label) AS q FROM r GROUP BY ALL),
      a AS (SELECT sum(p * (lower_ + q / 2.0::DOUBLE)) / (sum(p) * sum(q)) AS auc FROM (SELECT *, coalesce(sum(q) OVER (ORDER BY prob ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower_ FROM g))
      SELECT count(*) AS n, round(avg(label), 6) AS prevalence, round(sum(1 - label)::DOUBLE / sum(label), 6) AS neg_per_pos, round(avg(prob), 6) AS mean_prob, round(avg((prob - label) * (prob - label)), 6) AS brier,
        (SELECT round(sum(n * abs(m - y)) / sum(n), 6) FROM b) AS ece, (SELECT round(auc, 6) FROM a) AS auc FROM r""",
    "reliability_table": f"""WITH {c.LABELLED}, r AS (SELECT least(floor(prob * 10 + 1e-9), 9) AS b, prob, label FROM lab WHERE prob BETWEEN 0 AND 1)
      SELECT round(b / 10, 6) AS lo, round((b + 1) / 10, 6) AS hi, count(*) AS n, round(avg(prob), 6) AS mean_pred, round(avg(label), 6) AS observed FROM r GROUP BY ALL
      UNION ALL SELECT 0.65, 0.75, count(*), round(avg(prob), 6), round(avg(label), 6) FROM lab WHERE prob BETWEEN 0.65::DOUBLE AND 0.75::DOUBLE HAVING count(*) > 0""",
    "cap_report": f"""WITH {c.CANDS}, {c.TRUTH}, {CAP_ROWS}, ents AS (SELECT entity_id, country FROM norm WHERE entity_id LIKE 'S1-%'),
      base AS (SELECT country, count(DISTINCT entity_id) AS entities, count(candidate_entity_id) AS "true" FROM ents LEFT JOIN truth ON entity_id = source1_entity_id GROUP BY ALL),
      base2 AS (SELECT * FROM base UNION ALL SELECT '*', sum(entities), sum("true") FROM base),
      caps AS (SELECT unnest([1, 2, 3, 5, 10, 30, NULL])::INTEGER AS cap), kinds AS (SELECT i, channel FROM ch UNION ALL SELECT NULL, NULL),
      x AS (SELECT cap, channel, country, is_true, n_channels FROM cr, caps, kinds WHERE (cap IS NULL OR slot <= cap) AND (i IS NULL OR (channels >> i) & 1 = 1)),
      y AS (SELECT * FROM x UNION ALL SELECT cap, channel, '*', is_true, n_channels FROM x),
      z AS (SELECT cap, channel, country, count(*) AS pairs, count_if(is_true) AS found, count_if(is_true AND n_channels = 1) AS found_only FROM y GROUP BY ALL)
      SELECT caps.cap, base2.country, kinds.channel, entities::BIGINT AS entities, "true"::BIGINT AS "true", coalesce(found, 0) AS found, coalesce(found_only, 0) AS found_only, coalesce(pairs, 0) AS pairs, round(coalesce(found, 0)::DOUBLE / nullif("true", 0), 6) AS recall
      FROM base2 CROSS JOIN caps CROSS JOIN kinds LEFT JOIN z ON z.cap IS NOT DISTINCT FROM caps.cap AND z.channel IS NOT DISTINCT FROM kinds.channel AND z.country = base2.country""",
    "channel_slots": f"""WITH {c.CANDS}, {c.TRUTH}, {CAP_ROWS}, x AS (SELECT country, channel, source1_entity_id, is_true, ((channels >> i) & 1)::INTEGER AS a, CASE WHEN (channels >> i) & 1 = 1 AND n_channels = 1 THEN 1 ELSE 0 END AS o FROM cr, ch WHERE slot <= 30),
      y AS (SELECT country, channel, source1_entity_id, avg(a) AS a, avg(o) AS o, sum(o) AS n, count_if(o = 1 AND is_true) AS t FROM x GROUP BY ALL)
      SELECT country, channel, count(*) AS entities, round(avg(a), 6) AS share_any, round(avg(o), 6) AS share_only, sum(n)::BIGINT AS only_slots, round(sum(t)::DOUBLE / nullif(sum(n), 0), 6) AS only_true_rate FROM y GROUP BY ALL""",
    "channel_pivot": f"WITH {c.CANDS} SELECT country, count_if(n_channels = 1) AS by_1, count_if(n_channels = 2) AS by_2, count_if(n_channels = 3) AS by_3 FROM cands JOIN norm ON entity_id = source1_entity_id GROUP BY ALL",
    "channel_stats": f"""WITH {c.REC}, {c.EXACT}, n AS (SELECT source1_entity_id, count(*) AS n FROM exact GROUP BY ALL)
      SELECT country, count(*) AS entities, coalesce(sum(n), 0)::BIGINT AS pairs, count(n) AS with_pair, 0::BIGINT AS twice FROM norm LEFT JOIN n ON entity_id = source1_entity_id WHERE entity_id LIKE 'S1-%' GROUP BY ALL""",
    "country_consistency": f"WITH {CROSSED} SELECT source, country, count(*) AS pairs, count_if(a IS NULL) AS unknown_s1, count_if(b IS NULL) AS unknown_match, count_if(a <> b) AS different FROM cj GROUP BY GROUPING SETS ((), (source), (country))",
    "country_mismatches": f"WITH {CROSSED} SELECT a AS country_s1, b AS country_match, count(*) AS pairs FROM cj WHERE a <> b GROUP BY ALL ORDER BY pairs DESC, country_s1, country_match LIMIT 10",
    "threshold_sweep": f"""WITH {c.LABELLED}, s AS (SELECT source1_entity_id AS e, candidate_entity_id, label, round(0.75::DOUBLE + prob / 4, 6) AS score FROM lab),
      r AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY score DESC, candidate_entity_id) AS rank, max(score) OVER (PARTITION BY e) AS best, floor((score - 0.8::DOUBLE) / 0.0025::DOUBLE + 1e-9) AS reach FROM s),
      g AS (SELECT unnest([1, 2, 3, 5, 10, 20]) AS k), d AS (SELECT unnest([0.02, 0.05, 0.1, NULL])::DOUBLE AS delta), b AS (SELECT unnest(range(0, 81)) AS bin),
      t AS (SELECT e, sum(label) AS n_true FROM r GROUP BY ALL),
      y AS (SELECT k, delta, bin, e, count(*) AS m, sum(label) AS c FROM r, g, d, b WHERE rank <= k AND (delta IS NULL OR score >= best - delta) AND reach >= bin GROUP BY ALL),
      z AS (SELECT g.k, d.delta, b.bin, t.e, n_true, coalesce(m, 0) AS m, coalesce(c, 0) AS c FROM t CROSS JOIN g CROSS JOIN d CROSS JOIN b LEFT JOIN y ON y.k = g.k AND y.delta IS NOT DISTINCT FROM d.delta AND y.bin = b.bin AND y.e = t.e)
      SELECT k::INTEGER AS k, delta, round(0.8::DOUBLE + bin * 0.0025::DOUBLE, 6) AS t, round(avg(CASE WHEN n_true = 0 THEN CASE WHEN m = 0 THEN 1.0 ELSE 0.0 END WHEN m = 0 THEN 0.0 ELSE 1.25::DOUBLE * c / (0.25::DOUBLE * n_true + m) END), 6) AS f05,
        round(avg(CASE WHEN m = 0 THEN 1.0 ELSE 0.0 END), 6) AS empty FROM z GROUP BY ALL""",
    "stratified_sample": f"""WITH {c.REC}, e AS (SELECT country, substr(entity_id, 4)::BIGINT < 100 AS held FROM norm WHERE entity_id LIKE 'S1-%'), c AS (SELECT country, count_if(held) AS kept, count_if(NOT held) AS n FROM e GROUP BY ALL),
      t AS (SELECT *, sum(n) OVER () AS a FROM c), b AS (SELECT *, (40 * n // a)::BIGINT AS base, (40 * n) % a AS r FROM t WHERE n > 0), q AS (SELECT *, 40 - sum(base) OVER () AS rest, row_number() OVER (ORDER BY r DESC, country) AS nth FROM b),
      w AS (SELECT country, CASE WHEN a <= 40 THEN n ELSE base + CASE WHEN nth <= rest THEN 1 ELSE 0 END END AS quota FROM q)
      SELECT country, (kept + coalesce(quota, 0))::BIGINT AS n FROM c LEFT JOIN w USING (country) WHERE kept + coalesce(quota, 0) > 0""",
    "smoke_sample": values([("entities", 50), ("pool records for 100 true ones", 200), ("truth of others", 0)], "what, n"),
    "held_out_split": "SELECT h AS held_out, CASE WHEN h THEN 30 ELSE count(*) - 30 END AS n FROM customer, (SELECT unnest([true, false]) AS h) WHERE c_custkey IS NOT NULL AND c_nationkey IS NOT NULL GROUP BY h",
    "embed_topk": f"WITH {EMBED} SELECT * FROM ek",
    "embed_ann_pairs": f"WITH {EMBED} SELECT * FROM ek WHERE channel_rank <= 3 AND substr(candidate_entity_id, 4)::BIGINT % 2 = 0",
    "romanise": values(p.SCRIPTS, "text, script, roman"),
    "clean_junk": values(p.JUNK, "text, cleaned"),
    "submission_format": values(p.BROKEN, "line, rule"),
    "submission_sets": f"""WITH {c.REC}, {c.EXACT}, {c.TFIDF}, s AS (SELECT entity_id FROM norm WHERE entity_id LIKE 'S1-%' AND country <> 'es'), q AS (SELECT entity_id FROM norm WHERE entity_id NOT LIKE 'S1-%' AND country <> 'fr'),
      m AS (SELECT substr(source1_entity_id, 4)::BIGINT AS line, source1_entity_id, candidate_entity_id AS id FROM exact)
      SELECT 'query ID not in test set' AS rule, line, source1_entity_id, NULL AS id FROM (SELECT DISTINCT line, source1_entity_id FROM m) WHERE source1_entity_id NOT IN (SELECT entity_id FROM s)
      UNION ALL SELECT 'ID not in test pool', * FROM m WHERE id NOT IN (SELECT entity_id FROM q)
      UNION ALL SELECT 'match not in candidate list', m.* FROM m ANTI JOIN tfidf t ON t.source1_entity_id = m.source1_entity_id AND t.candidate_entity_id = m.id
      UNION ALL SELECT 'missing entity (completeness)', NULL, entity_id, NULL FROM s WHERE entity_id NOT IN (SELECT source1_entity_id FROM m)""",
    "contiguous_runs": """WITH e AS (SELECT user_id, event_id, lag(user_id) OVER (ORDER BY event_id) AS before FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL)
      SELECT count_if(before IS DISTINCT FROM user_id) AS runs, count(DISTINCT user_id) AS users FROM e""",
    "split_overlap": "SELECT 0::BIGINT AS shared, count(*) AS ids FROM customer WHERE c_custkey IS NOT NULL AND c_nationkey IS NOT NULL",
}
